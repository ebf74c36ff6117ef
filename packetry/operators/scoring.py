"""Scoring of predictions against truth, validation, and mining of group rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetry.functions.extract import normalize, normalize_flags, split_pipe
from packetry.functions.text import valid_iso_date

# Field weights and section points of the scorer.
WEIGHTS = {"applicant_name": 5, "species_code": 6, "home_world": 5, "visa_class": 5, "sponsor_id": 5, "arrival_date": 4, "declared_purpose": 3, "risk_flags": 8, "fee_status": 4}
EXTRACTION_POINTS, CALIBRATION_POINTS, MISSING_CAP = 50.0, 20.0, 10.0
FEES = ("paid", "waived", "unpaid", "unknown")
LABELS = ("APPROVED", "DENIED", "NEEDS_REVIEW")
CLASS_POINTS, RIGHT, FALSE_APPROVAL, DOUBTED, DOUBT = 80.0, 8, -4, 2, 1


def indexed(predictions: DataFrame, key: str = "case_id", order: str = "submission_id") -> DataFrame:
    """First prediction of each case; blank cases go."""
    from packetry.operators.consolidate import first_rows

    return first_rows(predictions.where(F.trim(F.coalesce(key, F.lit(""))) != ""), [key], [F.col(order)])


def duplicates(predictions: DataFrame, key: str = "case_id") -> DataFrame:
    """(case, extra rows) of cases predicted more than once."""
    rows = predictions.where(F.trim(F.coalesce(key, F.lit(""))) != "")
    return rows.groupBy(key).agg((F.count("*") - 1).alias("extra_rows")).where("extra_rows > 0")


def match(field: str, truth: Column, prediction: Column) -> Column:
    """Equality of normalised values; flags as sorted lists."""
    f = normalize_flags if field == "risk_flags" else normalize
    return f(truth) == f(prediction)


def confidence(c: Column) -> tuple[Column, Column]:
    """(value, valid): invalid confidences (null, NaN, outside 0 to 1) count as 0."""
    v = c.cast("double")
    ok = F.coalesce(~F.isnan(v) & v.between(0, 1), F.lit(False))
    return F.when(ok, v).otherwise(0.0), ok


def score_cases(truth: DataFrame, predictions: DataFrame, decided: str | None = None) -> DataFrame:
    """Per truth case: present, a map of field results, raw and maximal points, and the Brier score of the confidence.

    Fields listed in truth's unrecoverable_fields leave the maximum. decided names the column whose match the confidence is about.
    """
    t, p = truth.alias("t"), predictions.withColumn("_present", F.lit(True)).alias("p")
    rows = t.join(p, F.col("t.case_id") == F.col("p.case_id"), "left")
    lost = split_pipe(F.col("t.unrecoverable_fields")) if "unrecoverable_fields" in truth.columns else F.array().cast("array<string>")
    present = F.coalesce("p._present", F.lit(False))
    entries, raw, top = [], F.lit(0), F.lit(0)
    for field, weight in WEIGHTS.items():
        gone = F.array_contains(lost, field)
        hit = present & match(field, F.col(f"t.{field}"), F.col(f"p.{field}"))
        status = F.when(gone, "not_scorable_unrecoverable").when(hit, "matched").otherwise("missed")
        points = F.when(~gone & hit, weight).otherwise(0)
        most = F.when(gone, 0).otherwise(weight)
        entries.append(F.struct(F.lit(field).alias("k"), F.struct(status.alias("status"), points.alias("points"), most.alias("max_points")).alias("v")))
        raw, top = raw + points, top + most
    value, ok = confidence(F.col("p.confidence"))
    right = match(decided, F.col(f"t.{decided}"), F.col(f"p.{decided}")) if decided else F.lit(False)
    brier = F.when(present, F.when(ok, F.pow(value - right.cast("double"), 2)).otherwise(1.0))
    return rows.select(F.col("t.case_id").alias("case_id"), present.alias("present"), F.map_from_entries(F.array(*entries)).alias("field_results"), raw.alias("raw"), top.alias("max_raw"), brier.alias("brier"), F.when(present, ok).alias("confidence_valid"))


def totals(scored: DataFrame) -> DataFrame:
    """One row of section scores: extraction, calibration, penalty for missing cases, and counts. Ratios of nothing are 0."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    agg = scored.agg(
        F.count("*").alias("truth_cases"), F.count_if(~F.col("present")).alias("missing_cases"), F.sum("raw").alias("raw"), F.sum("max_raw").alias("max_raw"),
        F.avg("brier").alias("mean_brier"), F.count_if(F.col("present") & ~F.col("confidence_valid")).alias("invalid_confidence"),
    )
    return agg.select(
        "truth_cases", "missing_cases", "invalid_confidence", "mean_brier", (ratio(F.col("raw"), F.col("max_raw")) * EXTRACTION_POINTS).alias("extraction_score"),
        (F.coalesce(F.greatest(F.lit(0.0), 1 - 2 * F.col("mean_brier")), F.lit(0.0)) * CALIBRATION_POINTS).alias("calibration_score"),
        (ratio(F.col("missing_cases"), F.col("truth_cases")) * MISSING_CAP).alias("missing_penalty"),
    )


def class_points(truth: Column, prediction: Column) -> Column:
    """Points of a label against the true one: right, denied taken for approved, left to review, or decided where review was due."""
    t, p = F.upper(F.trim(truth)), F.upper(F.trim(prediction))
    points = F.when(~F.coalesce(p.isin(*LABELS), F.lit(False)), 0).when(t == p, RIGHT).when((t == "DENIED") & (p == "APPROVED"), FALSE_APPROVAL)
    return F.coalesce(points.when(p == "NEEDS_REVIEW", DOUBTED).when(t == "NEEDS_REVIEW", DOUBT).otherwise(0), F.lit(0))


def evaluated(truth: DataFrame, predictions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row of results, scores by case) of a submission: sections, penalty and total, and counts of what is wrong with the rows.

    Of predictions of one case the first in file order counts; blank cases are counted and left out.
    """
    at = F.monotonically_increasing_id() if "submission_id" not in predictions.columns else F.col("submission_id")
    rows = predictions.withColumn("case_id", F.trim("case_id")).withColumn("submission_id", at)
    first = indexed(rows)
    scored = score_cases(truth, first, decided="adjudication")
    pairs = truth.select("case_id", F.col("adjudication").alias("t")).join(first.select("case_id", F.col("adjudication").alias("p"), F.col("fee_status").alias("fee")), "case_id", "left")
    label, fee = F.upper(F.trim("p")), F.lower(F.trim("fee"))
    classes = pairs.select("case_id", class_points(F.col("t"), F.col("p")).alias("class_raw"), F.coalesce((F.upper("t") == "DENIED") & (label == "APPROVED"), F.lit(False)).alias("false_approval"), (~F.coalesce(label.isin(*LABELS), F.lit(False))).alias("bad_label"), (~F.coalesce(fee.isin(*FEES), F.lit(False))).alias("bad_fee"))
    scored = scored.join(classes, "case_id")
    n = truth.agg(F.count("*").alias("n_truth"))
    scored = scored.crossJoin(F.broadcast(n)).withColumn("missing_penalty_score", F.when(~F.col("present"), F.try_divide(F.lit(MISSING_CAP), F.col("n_truth"))).otherwise(0.0)).drop("n_truth")
    known = truth.select("case_id")
    counts = rows.agg(F.count("*").alias("submitted_rows"), F.count_if(F.coalesce(F.col("case_id"), F.lit("")) == "").alias("blank_rows"))
    again = duplicates(rows).agg(F.coalesce(F.sum("extra_rows"), F.lit(0)).alias("duplicate_rows"))
    extra = first.join(known, "case_id", "left_anti").agg(F.count("*").alias("extra_cases"))
    labels = scored.agg(F.sum("class_raw").alias("class_raw"), F.count_if("false_approval").alias("false_approvals"), F.count_if(F.col("present") & F.col("bad_label")).alias("invalid_adjudication"), F.count_if(F.col("present") & F.col("bad_fee")).alias("invalid_fee_status"))
    row = totals(scored)
    for one in (counts, again, extra, labels):
        row = row.crossJoin(F.broadcast(one))  # one row each
    share = F.coalesce(F.try_divide(F.col("class_raw"), F.col("truth_cases") * RIGHT), F.lit(0.0)) * CLASS_POINTS
    row = row.withColumn("classification_score", share)
    return row.withColumn("total_score", F.col("extraction_score") + F.col("classification_score") + F.col("calibration_score") - F.col("missing_penalty")), scored


def raw_row_errors(rows: DataFrame, kind: str) -> DataFrame:
    """(case_id, error) of every rule that rows(row, kinds) of a submission break; a row that lacks fields is judged no further."""
    from packetry.operators.rejects import FIELDS

    row, kinds = F.col("row"), F.col("kinds")
    names = F.array(*[F.lit(f) for f in FIELDS])
    missing, extra = F.array_except(names, F.map_keys(row)), F.array_sort(F.array_except(F.map_keys(row), names))
    cell = lambda f: F.trim(F.coalesce(F.try_element_at(row, F.lit(f)), F.lit("")))
    text = lambda f: F.try_element_at(kinds, F.lit(f)) == "STRING" if kind == "json" else F.lit(True)
    bad = lambda ok, message: F.when(~F.coalesce(ok, F.lit(False)), F.lit(message))
    value = F.expr("try_cast(trim(coalesce(try_element_at(row, 'confidence'), '')) as double)")
    number = F.coalesce(F.try_element_at(kinds, F.lit("confidence")).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.lit(False)) if kind == "json" else F.lit(True)
    checks = [bad(text(f), f"{f} must be a string") for f in FIELDS if f != "confidence"]
    checks += [
        bad(text("case_id") & cell("case_id").rlike(r"^MIB-[0-9]{6}\z"), "invalid case_id"), bad(text("sponsor_id") & cell("sponsor_id").rlike(r"^SPN-[0-9]{4}\z"), "invalid sponsor_id"), bad(text("arrival_date") & valid_iso_date(cell("arrival_date")), "invalid arrival_date"),
        F.when(text("fee_status"), bad(cell("fee_status").isin(*FEES), "invalid fee_status")), F.when(text("adjudication"), bad(cell("adjudication").isin(*LABELS), "invalid adjudication")),
        F.when(~number, "confidence must be a JSON number").when(value.isNull(), "confidence is not numeric").when(F.isnan(value) | ~value.between(0, 1), "confidence must be between 0 and 1"),
    ]
    lacks = [F.when(F.size(missing) > 0, F.concat(F.lit("missing fields "), F.array_join(missing, ", "))), F.when(F.size(extra) > 0, F.concat(F.lit("unexpected fields "), F.array_join(extra, ", ")))]
    every = F.when(F.size(missing) > 0, F.array(*lacks)).otherwise(F.array(*lacks, *checks))
    return rows.select(F.try_element_at(row, F.lit("case_id")).alias("case_id"), F.explode(F.array_compact(every)).alias("error"))


def field_accuracy(scored: DataFrame) -> DataFrame:
    """(field, scorable, matched, accuracy)."""
    long = scored.select(F.explode("field_results").alias("field", "r")).where(F.col("r.status") != "not_scorable_unrecoverable")
    return long.groupBy("field").agg(F.count("*").alias("scorable"), F.count_if(F.col("r.status") == "matched").alias("matched"), F.avg((F.col("r.status") == "matched").cast("int")).alias("accuracy"))


def confusion(truth: DataFrame, predictions: DataFrame, column: str) -> DataFrame:
    """(pair, n) of truth->prediction, MISSING where there is none."""
    rows = truth.alias("t").join(predictions.alias("p"), F.col("t.case_id") == F.col("p.case_id"), "left")
    t = F.coalesce(F.col(f"t.{column}"), F.lit(""))
    p = F.when(F.col("p.case_id").isNull(), "MISSING").otherwise(F.coalesce(F.col(f"p.{column}"), F.lit("")))
    return rows.groupBy(F.concat(t, F.lit("->"), p).alias("pair")).agg(F.count("*").alias("n"))


def row_errors(rows: DataFrame, key: str) -> DataFrame:
    """(key, error) of every rule a prediction row breaks."""
    c = F.col
    rules = {
        "case_id": c("case_id").rlike(r"^MIB-[0-9]{6}\z"), "sponsor_id": c("sponsor_id").rlike(r"^SPN-[0-9]{4}\z"), "arrival_date": valid_iso_date(c("arrival_date")),
        "fee_status": c("fee_status").isin(*FEES), "adjudication": c("adjudication").isin(*LABELS), "confidence": confidence(c("confidence"))[1],
    }
    bad = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return rows.select(key, F.explode(F.array_compact(F.array(*bad))).alias("error"))


def rates(rows: DataFrame, key: str, hit: Column, support: int, least: float) -> DataFrame:
    """(key, n, hits, rate) of the groups with enough support and rate."""
    agg = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))
    return agg.withColumn("rate", F.col("hits") / F.col("n")).where((F.col("n") >= support) & (F.col("rate") >= least))


def mined_splits(rows: DataFrame, bucket: str, features: list[str], outcome: str, support: int = 15, top: int = 25) -> DataFrame:
    """Conditional splits: (bucket, feature, value, n, best, best_n, gain) where one outcome is more frequent than in the bucket at large.

    gain is the rise of the best outcome's share over the bucket's own times n; the top splits by gain are a report.
    """
    long = rows.select(F.col(bucket).alias("bucket"), F.col(outcome).alias("outcome"), F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features])))
    counts = long.where("value is not null and outcome is not null").groupBy("bucket", "feature", "value", "outcome").agg(F.count("*").alias("k"))
    best = counts.groupBy("bucket", "feature", "value").agg(F.sum("k").alias("n"), F.max(F.struct("k", "outcome")).alias("b"))
    base = rows.where(F.col(outcome).isNotNull()).groupBy(F.col(bucket).alias("bucket"), F.col(outcome).alias("outcome")).agg(F.count("*").alias("bk"))
    size = base.groupBy("bucket").agg(F.sum("bk").alias("bn"))
    j = best.where(F.col("n") >= support).select("bucket", "feature", "value", "n", F.col("b.outcome").alias("outcome"), F.col("b.k").alias("best_n"))
    j = j.join(base, ["bucket", "outcome"]).join(size, "bucket")
    gain = F.round(F.col("best_n") - F.col("n") * F.col("bk") / F.col("bn"), 6)
    return j.select("bucket", "feature", "value", "n", F.col("outcome").alias("best"), "best_n", gain.alias("gain")).where("gain > 0").orderBy(F.desc("gain"), "bucket", "feature", "value").limit(top)


def results_json(total: DataFrame, confusion_counts: DataFrame, missing: DataFrame, examples: int = 20) -> DataFrame:
    """The whole evaluation as one pretty JSON value with sorted keys."""
    pairs = confusion_counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("pair", "n")))).alias("confusion"))  # one row per pair of labels
    few = missing.orderBy("case_id").limit(examples).agg(F.array_sort(F.collect_list("case_id")).alias("missing_case_ids"))
    row = total.crossJoin(pairs).crossJoin(few)
    return row.select(F.to_json(F.struct(*[F.col(c) for c in sorted(row.columns)]), {"pretty": "true"}).alias("json"))
