"""Best representative of each duplicate group by a latent two-sided quality model.

Every reading asserts values; a value is a claim, backed by some sources and left out by the sources that speak about the
same case and field. Each source has, for each field, a sensitivity (chance to assert a true value) and a specificity (chance not to
assert a false one), inferred by expectation-maximisation. Claims are first counted by pattern (field, which sources assert, which only
cover). A round of the model adds up the expected counts of the patterns: on the driver while there are at most MAX_PATTERNS of
them, else spread over the cluster, in the same function; only the sums, a few numbers a field and source, come to the driver. The
posterior of a claim is then an expression over its bits. A multi-valued field keeps every value whose posterior is at least ``keep``.

The single survivor of a field is the claim of the highest posterior under a prior that the statement fixes: the odds of a claim fall
beyond any likelihood with each step of trust rank and, within a rank, with each earlier reading. The maximum is therefore taken
over (rank, time, likelihood of the model) in this order, then the smaller value. Sources with a null rank are never used; a claim
without known source ranks last.

Defined results: rows without case are ignored; cases with fewer than two rows yield nothing; a null read_at is oldest; repeated
rows count as readings but not as further claims; an empty table gives an empty table; malformed values are no claims; more than
MAX_SOURCES ranked sources are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetry.functions.text import valid_iso_date, well_formed_sponsor
from packetry.runtime import cut, small_side

FIELDS = ("sponsor_id", "sponsor_letter_id", "arrival_date")
#: Rank of a claim without known source; a real rank is far smaller.
LAST = 1_000_000
#: Sources are bits of a 64-bit mask.
MAX_SOURCES = 62
#: Most patterns whose rounds run on the driver.
MAX_PATTERNS = 50_000

_SPONSOR = r"(?<![A-Za-z0-9])(SPN-[0-9]{4})(?![A-Za-z0-9])"
_DATE = r"(?<![0-9A-Za-z-])([0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9A-Za-z-])"


def _usable(field: str, c: Column) -> Column:
    return valid_iso_date(c) if field == "arrival_date" else well_formed_sponsor(c)


def _correction(field: str):
    return lambda v: F.struct(F.lit(field).alias("field"), v.alias("value"), F.lit("correction").alias("source"))


def evidence(records: DataFrame, trust: DataFrame) -> DataFrame:
    """One row (case_id, field, value, source, rank, read_at) per usable assertion, and one with an empty field per reading."""
    parts = [F.array(F.struct(F.lit("").alias("field"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("source")))]
    for f in FIELDS:
        parts.append(F.array(F.struct(F.lit(f).alias("field"), F.col(f).alias("value"), F.try_element_at("field_sources", F.lit(f)).alias("source"))))
        inside = F.regexp_extract_all(F.coalesce(F.try_element_at("corrections", F.lit(f)), F.lit("")), F.lit(_DATE if f == "arrival_date" else _SPONSOR), F.lit(1))
        parts.append(F.transform(inside, _correction(f)))
    rows = records.where("case_id is not null").select("case_id", "read_at", F.inline(F.concat(*parts)))
    ok = F.col("field") == ""
    for f in FIELDS:
        ok = ok | ((F.col("field") == f) & _usable(f, F.col("value")))
    known, _ = small_side(trust.where("source_name is not null").groupBy("source_name").agg(F.min("trust_rank").alias("rank")).withColumn("listed", F.lit(True)))
    rows = rows.where(ok).join(known, F.col("source") == F.col("source_name"), "left")
    rows = rows.where("listed is null or rank is not null")
    return rows.select("case_id", "field", "value", F.when(F.col("listed"), F.col("source")).alias("source"), F.coalesce("rank", F.lit(LAST)).alias("rank"), "read_at")


def claims(rows: DataFrame, sources: list[str]) -> DataFrame:
    """One row per (case, field, value): bit mask of the asserting sources, its best rank and reading, and the number of assertions."""
    bit = F.lit(0).cast("bigint")
    for i, s in enumerate(sources):
        bit = F.when(F.col("source") == s, F.lit(1 << i).cast("bigint")).otherwise(bit)
    order = F.struct(F.col("rank").cast("int").alias("rank"), (-F.coalesce(F.unix_micros(F.col("read_at").cast("timestamp")), F.lit(-(1 << 60)))).alias("before"))
    return rows.groupBy("case_id", "field", "value").agg(F.bit_or(bit).alias("said"), F.min(order).alias("best"), F.count("*").alias("n"))


def _bits(mask: np.ndarray, n: int) -> np.ndarray:
    return (mask.astype(np.int64)[:, None] >> np.arange(n)) & 1


def expected(said: np.ndarray, cover: np.ndarray, count: np.ndarray, model: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each pattern under (prior, sensitivities, specificities), and the sums a round needs: true claims and all claims,
    then by source true claims asserted and covered, false claims left out and covered."""
    prior, sens, spec = model
    n = len(sens)
    s, c = _bits(said, n), _bits(cover, n)
    odds = np.log(prior) - np.log(1 - prior) + s @ (np.log(sens) - np.log(1 - spec)) + (c * (1 - s)) @ (np.log(1 - sens) - np.log(spec))
    post = 1 / (1 + np.exp(np.clip(-odds, -700, 700)))
    yes, no = post * count, (1 - post) * count
    return post, np.concatenate([[yes.sum(), count.sum()], yes @ (s * c), yes @ c, no @ (c * (1 - s)), no @ c])


def improved(sums: np.ndarray, n: int) -> tuple:
    """The model of the next round. Counts of a weak prior keep a source that says little from running to 0 or 1."""
    hit, seen, off, empty = sums[2:].reshape(4, n)
    return min(0.99, max(0.01, sums[0] / max(sums[1], 1))), (8 + hit) / (10 + seen), (9 + off) / (10 + empty)


def start(n: int) -> tuple:
    return 0.6, np.full(n, 0.8), np.full(n, 0.9)


def settled(a: tuple, b: tuple) -> bool:
    return max(float(np.abs(x - y).max(initial=0)) for x, y in zip(a[1:], b[1:])) < 1e-6


def infer(patterns: list[tuple[int, int, int]], n: int, rounds: int = 40) -> tuple[dict[tuple[int, int], float], list[tuple[float, float]]]:
    """Expectation-maximisation over (said, cover, count): posterior by pattern and (sensitivity, specificity) by source."""
    said, cover, count = (np.array([p[i] for p in patterns], dtype=np.int64) for i in range(3))
    model, post = start(n), np.zeros(len(patterns))
    for _ in range(rounds):
        post, sums = expected(said, cover, count, model)
        old, model = model, improved(sums, n)
        if settled(old, model):
            break
    return {(int(s), int(c)): float(p) for s, c, p in zip(said, cover, post)}, list(zip(model[1].tolist(), model[2].tolist()))


def fitted(patterns: DataFrame, n: int, rounds: int = 40, most: int = MAX_PATTERNS) -> dict[str, tuple]:
    """The model of each field from patterns(field, said, cover, n)."""
    patterns = cut(patterns)
    models = {f: start(n) for f in FIELDS}

    def sums(pdf: pd.DataFrame, models: dict[str, tuple]) -> pd.DataFrame:
        out = [(f, *expected(p["said"].to_numpy(), p["cover"].to_numpy(), p["n"].to_numpy(), models[f])[1]) for f, p in pdf.groupby("field")]
        return pd.DataFrame(out, columns=["field", *(f"s{i}" for i in range(2 + 4 * n))])

    local = patterns.limit(most + 1).toPandas()
    kind = ", ".join(["field string", *(f"s{i} double" for i in range(2 + 4 * n))])
    for _ in range(rounds):
        if len(local) <= most:
            found = sums(local, models)
        else:
            now = dict(models)

            def run(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
                for pdf in batches:
                    yield sums(pdf, now)

            found = patterns.mapInPandas(run, kind).groupBy("field").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(2 + 4 * n)]).toPandas()
        fresh = models | {r[0]: improved(np.array(r[1:], dtype=float), n) for r in found.itertuples(index=False)}
        still = all(settled(models[f], fresh[f]) for f in FIELDS)
        models = fresh
        if still:
            break
    return models


def posterior(models: dict[str, tuple], field: Column, said: Column, cover: Column) -> Column:
    """Posterior of a claim under the model of its field."""
    out = F.lit(None).cast("double")
    for f, (prior, sens, spec) in models.items():
        odds = F.lit(float(np.log(prior) - np.log(1 - prior)))
        for i, (a, b) in enumerate(zip(sens, spec)):
            has = lambda m: F.shiftright(m, i).bitwiseAND(F.lit(1))  # noqa: E731, B023
            odds = odds + has(said) * F.lit(float(np.log(a) - np.log(1 - b))) + (has(cover) - has(said)) * F.lit(float(np.log(1 - a) - np.log(b)))
        out = F.when(field == f, 1 / (1 + F.exp(-odds))).otherwise(out)
    return out


def judged(records: DataFrame, trust: DataFrame) -> tuple[DataFrame, DataFrame, list[str], dict[str, tuple]]:
    """Claims with their posterior, the readings of each case, the ranked sources, and the model of each field."""
    names = sorted(r["source_name"] for r in trust.where("source_name is not null").groupBy("source_name").agg(F.min("trust_rank").alias("r")).where("r is not null").limit(MAX_SOURCES + 1).collect())
    if len(names) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found = cut(claims(evidence(records, trust), names))  # read for the covers, the readings and the choice
    made = found.where("field <> ''")
    cover = made.groupBy("case_id", "field").agg(F.bit_or("said").alias("cover"))
    made = cut(made.join(cover, ["case_id", "field"]).select("case_id", "field", "value", "said", "cover", "best"))
    models = fitted(made.groupBy("field", "said", "cover").agg(F.count("*").alias("n")), len(names))
    readings = found.where("field = ''").select("case_id", "n")
    return made.withColumn("posterior", posterior(models, F.col("field"), F.col("said"), F.col("cover"))), readings, names, models


def survivors(records: DataFrame, trust: DataFrame, least_rows: int = 2) -> DataFrame:
    """The kept value (case_id, field_name, kept_value, posterior) of every field of each duplicated case."""
    made, readings, *_ = judged(records, trust)
    order = F.struct("best.rank", "best.before", (-F.col("posterior")).alias("unlikely"), "value")
    kept = made.groupBy("case_id", "field").agg(F.min(order).alias("k"))
    groups = readings.where(F.col("n") >= least_rows).select("case_id")
    return kept.join(groups, "case_id", "left_semi").select("case_id", F.col("field").alias("field_name"), F.col("k.value").alias("kept_value"), (-F.col("k.unlikely")).alias("posterior"))


def truths(records: DataFrame, trust: DataFrame, keep: float = 0.5) -> DataFrame:
    """Multi-valued form: every value judged true, (case_id, field_name, value, posterior)."""
    made, *_ = judged(records, trust)
    return made.where(F.col("posterior") >= keep).select("case_id", F.col("field").alias("field_name"), "value", "posterior")


def source_quality(records: DataFrame, trust: DataFrame) -> DataFrame:
    """Inferred (source_name, field_name, sensitivity, specificity)."""
    *_, names, models = judged(records, trust)
    rows = [(s, f, round(float(a), 6), round(float(b), 6)) for f, (_, sens, spec) in sorted(models.items()) for s, a, b in zip(names, sens, spec)]
    return records.sparkSession.createDataFrame(rows, "source_name string, field_name string, sensitivity double, specificity double")
