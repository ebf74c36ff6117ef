"""Sinks: JSON Lines with sorted keys, JSON, CSV, sidecars and summaries. Spark's committer makes a write appear whole or not at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sorted_json(df: DataFrame) -> Column:
    """All columns as one JSON object with sorted keys; nulls are kept."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"})


def write_json_lines(df: DataFrame, path: str, key: str = "case_id", one_file: bool = False) -> None:
    """JSON Lines ordered by key. The order is kept by range partitions; one_file is for small results only."""
    rows = df.orderBy(key).select(sorted_json(df).alias("value"))
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def write_predictions_object(df: DataFrame, path: str, key: str = "case_id") -> None:
    """{"predictions": [...]} as the baseline writes it; for results of a driver's size."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(key, *[c for c in df.columns if c != key]))), lambda r: r)
    df.agg(F.to_json(F.struct(rows.alias("predictions")), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_pretty(row: DataFrame, path: str) -> None:
    """A single row as indented JSON."""
    row.select(F.to_json(F.struct(*[F.col(c) for c in sorted(row.columns)]), {"pretty": "true"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_sidecar(df: DataFrame, path: str, key: str, reason: str, features: list[str]) -> None:
    """Reasons and features beside a result, with the number of blank features."""
    blank = sum((F.coalesce(F.trim(F.col(f).cast("string")) == "", F.lit(True)).cast("int") for f in features), F.lit(0))
    rows = df.select(key, reason, F.struct(*features, blank.alias("n_blank")).alias("feat"))
    rows.write.mode("overwrite").json(path)


def constant_rows(packets: DataFrame, values: dict[str, object], id_column: str = "packet_id") -> DataFrame:
    """Baseline predictor: the same values for every packet."""
    return packets.select(F.col(id_column).alias("case_id"), *[F.lit(v).alias(k) for k, v in values.items()])


def summary(row: DataFrame) -> str:
    """Console text of a one-row result."""
    first = row.first()
    return "\n".join(f"{k}: {v}" for k, v in (first.asDict() if first else {}).items())
