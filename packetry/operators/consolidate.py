"""Many readings of a case into one: priority picks, votes, merges. All are partial aggregates keyed by case, so hot cases spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetry.functions.extract import same_person
from packetry.functions.text import canon


def first_by(rows: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """First value that is not null of each column per key, in order."""
    at = F.struct(*order)
    return rows.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])


def last_by(rows: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Last value that is not null of each column per key, in order."""
    at = F.struct(*order)
    return rows.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])


def first_rows(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The whole first row per key."""
    cols = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("r"))
    return picked.select(*keys, "r.*")


def priority_pick(evidence: DataFrame, digital_first: list[str] = ()) -> DataFrame:
    """(case_id, field, value, source) of the best evidence (case_id, field, value, source, priority, is_ocr, bad).

    Usable values come before bad ones; for the digital_first fields an exact reading comes before scans; then by priority, then value.
    """
    scan = F.when(F.col("field").isin(*digital_first), F.col("is_ocr")).otherwise(False) if digital_first else F.lit(False)
    order = F.struct(F.col("bad"), (scan & ~F.col("bad")).alias("scan"), "priority", "value")
    rows = evidence.where(F.col("value").isNotNull() & (F.col("value") != ""))
    best = rows.groupBy("case_id", "field").agg(F.min_by(F.struct("value", "source"), order).alias("b"))
    return best.select("case_id", "field", "b.*")


def vote_key(c: Column) -> Column:
    """Letters, digits and blanks of a value, white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(c, r"\s+", " ")), "[^a-z0-9 ]", ""))


def corroborated(current: DataFrame, candidates: DataFrame) -> DataFrame:
    """(case_id, value, voted): the current value unless another is read at least twice and the current one at most once.

    current has (case_id, value, is_digital), candidates (case_id, value, ord). An exact current value is not outvoted by a scan variant
    of it. Of equally frequent values the greater one wins; the first candidate that reads so gives the writing.
    """
    counts = candidates.where("value is not null and value <> ''").groupBy("case_id", vote_key(F.col("value")).alias("k")).agg(F.count("*").alias("n"), F.min_by("value", "ord").alias("written"))
    best = counts.groupBy("case_id").agg(F.max(F.struct("n", "k", "written")).alias("b"))
    cur = current.withColumn("ck", vote_key(F.col("value")))
    own = counts.select("case_id", F.col("k").alias("ck"), F.col("n").alias("own"))
    rows = cur.join(best, "case_id", "left").join(own, ["case_id", "ck"], "left")
    room = F.greatest(F.lit(2), F.floor(F.greatest(F.length(canon(F.col("b.k"))), F.length(canon(F.col("value")))) * 0.34).cast("int"))
    variant = F.levenshtein(canon(F.col("b.k")), canon(F.col("value"))) <= room
    wins = F.coalesce((F.col("b.n") >= 2) & (F.coalesce("own", F.lit(0)) <= 1) & (F.col("b.k") != F.col("ck")) & ~(F.col("is_digital") & variant), F.lit(False))
    wins = wins & (F.col("value") != "")
    return rows.select("case_id", F.when(wins, F.col("b.written")).otherwise(F.col("value")).alias("value"), wins.alias("voted"))


def char_majority(readings: DataFrame) -> DataFrame:
    """(case_id, value): per-character majority over the readings (case_id, value, ord) of the most frequent length.

    Ties of lengths and characters go to the first reading. With fewer than two readings of that length the most frequent reading is taken.
    """
    rows = readings.where("value is not null")
    sized = rows.groupBy("case_id", F.length("value").alias("n")).agg(F.count("*").alias("c"), F.min("ord").alias("o"))
    length = sized.groupBy("case_id").agg(F.max_by(F.struct("n", "c"), F.struct("c", -F.col("o"))).alias("l"))
    same = rows.join(length, "case_id").where(F.length("value") == F.col("l.n"))
    chars = same.where(F.col("l.c") >= 2).select("case_id", "ord", F.posexplode(F.split("value", "")).alias("p", "ch")).where("ch <> ''")
    votes = chars.groupBy("case_id", "p", "ch").agg(F.count("*").alias("c"), F.min("ord").alias("o"))
    top = votes.groupBy("case_id", "p").agg(F.max_by("ch", F.struct("c", -F.col("o"))).alias("ch"))
    merged = top.groupBy("case_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "ch"))), lambda s: s["ch"]), "").alias("value"))
    whole = rows.groupBy("case_id", "value").agg(F.count("*").alias("c"), F.min("ord").alias("o")).groupBy("case_id").agg(F.max_by("value", F.struct("c", -F.col("o"))).alias("whole"))
    return whole.join(merged, "case_id", "left").select("case_id", F.coalesce("value", "whole").alias("value"))


def merged(base: DataFrame, second: DataFrame, key: str, fill: list[str], union: list[str] = (), either: list[str] = ()) -> DataFrame:
    """base with gaps filled from second: blank values coalesced, arrays united (sorted), flags ORed. Rows of base alone stay."""
    b, s = base.alias("b"), second.alias("s")
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    cols = [F.coalesce(some(f"b.{c}"), some(f"s.{c}")).alias(c) for c in fill]
    cols += [F.array_sort(F.array_union(F.coalesce(f"b.{c}", F.array().cast("array<string>")), F.coalesce(f"s.{c}", F.array().cast("array<string>")))).alias(c) for c in union]
    cols += [(F.coalesce(f"b.{c}", F.lit(False)) | F.coalesce(f"s.{c}", F.lit(False))).alias(c) for c in either]
    return b.join(s, F.col(f"b.{key}") == F.col(f"s.{key}"), "left").select(F.col(f"b.{key}").alias(key), *cols)


def names_conflict(names: Column) -> Column:
    """Whether any two of an array of names cannot be the same person (i < j, no self pairs)."""
    return F.exists(
        F.transform(names, lambda a, i: F.exists(F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), lambda b: ~same_person(a, b))),
        lambda x: x,
    )


def deficiency(values: list[Column]) -> Column:
    """Number of blank values."""
    total = F.lit(0)
    for v in values:
        total = total + F.coalesce((F.trim(v) == ""), F.lit(True)).cast("int")
    return total


def reference_date(dates: DataFrame, column: str, ahead: int = 30, plausible: int = 366, quantile: float = 0.99) -> DataFrame:
    """One row (reference): rank floor(quantile n) of the dates not more than plausible days after the median (rank n // 2), plus ahead days.

    Ranks come from counts per distinct date, of which there are few, not from a sort of all rows. No dates give null.
    """
    from pyspark.sql import Window

    counts = dates.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("d")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(F.lit(0)).orderBy("d")
    run = counts.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(0))))
    median = run.where(F.col("upto") > F.floor(F.col("total") / 2)).agg(F.min("d").alias("median"))
    kept = counts.crossJoin(F.broadcast(median)).where(F.col("d") <= F.date_add("median", plausible)).drop("median")
    run = kept.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(0))))
    rank = F.least(F.col("total") - 1, F.floor(F.col("total") * quantile))
    return run.where(F.col("upto") > rank).agg(F.date_add(F.min("d"), ahead).alias("reference"))
