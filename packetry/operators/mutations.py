"""Mutations of line tables for robustness suites, and the comparison of a base run with a mutated one. All are projections or unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replaced(lines: DataFrame, pattern: str, text: str, where: Column | None = None) -> DataFrame:
    """Every match of a pattern replaced, in the lines that where selects (all by default)."""
    new = F.regexp_replace("text", pattern, text)
    return lines.withColumn("text", F.when(F.coalesce(where, F.lit(False)), new).otherwise(F.col("text")) if where is not None else new)


def footers_reworded(lines: DataFrame, text: str = "Sheet of a packet") -> DataFrame:
    """Footers in other words."""
    from packetry.operators.lines import footer

    return lines.withColumn("text", F.when(footer(F.col("text")), text).otherwise(F.col("text")))


def injected(lines: DataFrame, text: str) -> DataFrame:
    """One more line with the given text at the end of each page."""
    last = lines.groupBy("packet", "page").agg((F.max("line_no") + 1).alias("line_no")).withColumn("text", F.lit(text))
    return lines.unionByName(last.select("packet", "page", "line_no", "text"), allowMissingColumns=True)


def recoloured(lines: DataFrame, where: Column, color: int = 0xF5F5F5) -> DataFrame:
    """Selected lines printed in another ink."""
    return lines.withColumn("color", F.when(where, color).otherwise(F.col("color")))


def turned(pages: DataFrame, degrees: int) -> DataFrame:
    """Pages turned by a multiple of 90 degrees."""
    return pages.withColumn("rotation", F.pmod(F.col("rotation") + degrees, F.lit(360)))


def differences(base: DataFrame, variant: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, diff): the columns in which two runs differ, with both values; keys that agree throughout are left out."""
    b, v = base.alias("b"), variant.alias("v")
    pair = lambda c: F.struct(F.col(f"b.{c}").cast("string").alias("base"), F.col(f"v.{c}").cast("string").alias("variant"))
    every = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[pair(c) for c in columns]))
    diff = F.map_filter(every, lambda _, x: ~x["base"].eqNullSafe(x["variant"]))
    return b.join(v, F.col(f"b.{key}") == F.col(f"v.{key}")).select(F.col(f"b.{key}").alias(key), diff.alias("diff")).where(F.size("diff") > 0)
