"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected copies: target tokens of the source over its tokens, at most max_repeats.
Documents of a source are put in order of size class and hash, their expected copies are summed up along that order, one random
offset per source is added, and a copy is emitted for each whole number the running sum crosses. The order spreads the copies
evenly over sizes, so the shares of tokens come out close to the targets.

The running sum has two levels: counts per (source, size class, hash bucket) form a small table that is accumulated once, and
ranks are taken inside one bucket only. The number of buckets of a source grows with its documents, so that a bucket holds about
BUCKET_ROWS of them at most; a source with a third of all documents is thus never sorted by one task.

Defined results: documents of null or unlisted sources count for the size of the mixture but are not used; documents without
tokens get no copies; a source without tokens, with a null target or a null cap of repeats reaches nothing / is uncapped by
nothing but its target; repeated documents are sampled one by one; an empty corpus gives no copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetry.llm.tokens import TOKENIZERS, counted
from packetry.runtime import cut, small_side

#: Documents a hash bucket of a source is meant to hold, and the most bits of the bucket number.
BUCKET_ROWS, MOST_BITS = 100_000, 30


def rates(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: share, cap, its tokens, tokens of the whole corpus and expected copies of each document."""
    wanted = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"), F.count("*").alias("documents"))
    total = have.agg(F.coalesce(F.sum("source_tokens"), F.lit(0)).alias("corpus_tokens"))
    rows = wanted.join(have, "source", "left").crossJoin(F.broadcast(total))  # one row
    want = F.coalesce("target_share", F.lit(0.0)) * F.col("corpus_tokens") / F.col("source_tokens")
    expected = F.when(F.col("source_tokens") > 0, F.least(want, F.coalesce(F.col("max_repeats").cast("double"), want))).otherwise(F.lit(0.0))
    return rows.withColumn("expected", F.greatest(expected, F.lit(0.0)))


def sampled(sizes: DataFrame, plan: DataFrame, seed: int = 42) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of every document of a target source that is used at least once."""
    bits = F.least(F.ceil(F.log2(F.greatest(F.coalesce("documents", F.lit(1)), F.lit(1)) / F.lit(float(BUCKET_ROWS)))), F.lit(MOST_BITS))
    known, _ = small_side(plan.select("source", "expected", F.greatest(bits, F.lit(0)).cast("int").alias("bits")))
    rows = sizes.where("n_tokens > 0").join(known, "source")
    h = F.xxhash64(F.lit(seed), "doc_id")
    rows = rows.withColumn("h", h).withColumn("size_class", F.floor(F.log2(F.col("n_tokens")) * 4).cast("int"))
    rows = rows.withColumn("bucket", F.expr("case when bits = 0 then 0L else shiftrightunsigned(h, 64 - bits) end").cast("int"))
    keys = ["source", "size_class", "bucket"]
    before = Window.partitionBy("source").orderBy("size_class", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id"))
    rows = rows.withColumn("rank", rank).join(starts, keys)  # partitioned by the keys already; rows of numbers, one a bucket
    offset = F.pmod(F.xxhash64(F.lit(seed), F.lit("offset"), "source"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    upto = lambda i: F.floor(offset + F.col("expected") * i)
    rows = rows.withColumn("copies", (upto(F.col("start") + F.col("rank")) - upto(F.col("start") + F.col("rank") - 1)).cast("int"))
    return rows.where("copies > 0").select("doc_id", "source", "n_tokens", "copies")


def mixture(documents: DataFrame, targets: DataFrame, seed: int = 42, folder: str = TOKENIZERS) -> DataFrame:
    """The mixture: (doc_id, source, n_tokens, copies)."""
    sizes = cut(counted(documents, folder=folder))
    return sampled(sizes, cut(rates(sizes, targets)), seed)


def shares(documents: DataFrame, targets: DataFrame, seed: int = 42, folder: str = TOKENIZERS) -> DataFrame:
    """Report by source: target and reached share of the mixture, tokens, documents used, copies and whether the cap bound."""
    sizes = cut(counted(documents, folder=folder))
    plan = cut(rates(sizes, targets))
    used = sampled(sizes, plan, seed).groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("used_tokens"), F.count("*").alias("used_documents"), F.max("copies").alias("most_copies")
    )
    rows = plan.join(used, "source", "left").fillna(0, ["used_tokens", "used_documents", "most_copies", "source_tokens", "documents"])
    rows = rows.crossJoin(F.broadcast(rows.agg(F.coalesce(F.sum("used_tokens"), F.lit(0)).alias("all_used"))))  # one row
    all_used = F.col("all_used")
    capped = F.coalesce(F.col("target_share") * F.col("corpus_tokens") > F.col("max_repeats") * F.col("source_tokens"), F.lit(False))
    return rows.select(
        "source", "target_share", F.when(all_used > 0, F.col("used_tokens") / all_used).otherwise(0.0).alias("actual_share"),
        F.when(F.col("corpus_tokens") > 0, F.col("used_tokens") / F.col("corpus_tokens")).otherwise(0.0).alias("share_of_target_size"),
        "source_tokens", "used_tokens", "corpus_tokens", "documents", "used_documents", "most_copies", "max_repeats", capped.alias("capped"),
    )
