"""Readers of packets, tables, submissions and checkpoints."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetry.functions.text import strip
from packetry.operators.rejects import FIELDS

# Keys under which a JSON container may hold its rows, and suffixes of model files.
CONTAINER_KEYS = ("predictions", "submission", "results", "cases")
MODEL_SUFFIXES = ("bin", "ckpt", "gguf", "h5", "joblib", "mar", "mlmodel", "onnx", "pb", "pkl", "pt", "pth", "safetensors", "tflite")


def packets(spark: SparkSession, folder: str, strict: bool = False) -> DataFrame:
    """(path, length, packet_id) of the PDF files in a folder; strict takes lower-case suffixes only. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf" if strict else "*.[pP][dD][fF]").load(folder).select("path", "length")
    stem = F.regexp_extract("path", r"([^/]+)\.[pP][dD][fF]$", 1)
    found = F.regexp_extract(stem, "MIB-[0-9]{6,}", 0)
    return files.select("path", "length", F.when(found != "", found).otherwise(stem).alias("packet_id"))


def csv_strings(spark: SparkSession, path: str, breaks: bool = True) -> DataFrame:
    """CSV with a header, every column a string. With breaks, quoted fields may hold line breaks, and a file is one task; without, it is split."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=breaks, escape='"')


def strict_csv(spark: SparkSession, path: str, fields: Iterable[str] = FIELDS) -> DataFrame:
    """CSV whose header must be exactly the given fields in order; raises ValueError otherwise."""
    df = csv_strings(spark, path)
    if list(df.columns) != list(fields):
        raise ValueError(f"header {df.columns} is not {list(fields)}")
    return df


def keyed_last(df: DataFrame, key: str) -> DataFrame:
    """Last row of each key of a file source, keys trimmed, blank keys dropped.

    The order is that of paths, then of blocks of a file, then of rows in a block, however Spark packs the blocks into tasks.
    """
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = df.select(F.trim(F.col(key)).alias("_key"), F.struct(*[F.col(f"`{c}`") for c in df.columns if c != key]).alias("_row"), at.alias("_at"))
    last = rows.where(F.coalesce("_key", F.lit("")) != "").groupBy("_key").agg(F.max_by("_row", "_at").alias("_row"))
    return last.select(*[F.col("_key").alias(key) if c == key else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def manifest_ids(spark: SparkSession, path: str, breaks: bool = True) -> DataFrame:
    """Case ids of a manifest, trimmed."""
    return csv_strings(spark, path, breaks).select(F.trim("case_id").alias("case_id"))


def truth(spark: SparkSession, path: str) -> DataFrame:
    """Truth rows of a CSV, the last of a case holds."""
    return keyed_last(csv_strings(spark, path), "case_id")


def parse_cache(spark: SparkSession, path: str, schema: str, key: str = "case_id") -> DataFrame:
    """Records of a JSON object from case to record, nested fields typed by schema."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,struct<{schema}>>")).alias(key, "_r"))
    return raw.select(key, *[F.col(f"_r.`{f}`").alias(f) for f in raw.schema["_r"].dataType.names if f != key])


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One object per line; blank lines are skipped; a bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def checkpoint_rows(spark: SparkSession, path: str, schema: T.StructType | str, key: str = "case_id") -> DataFrame:
    """Tolerant JSON lines: unknown keys are dropped, broken lines skipped, the last entry of a key holds."""
    return keyed_last(spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path), key)


def json_container(spark: SparkSession, path: str, key: str = "case_id") -> DataFrame:
    """(row map<string,string>) of a JSON file that is a list, an object with a list, one row, or a map from key to row."""
    raw = spark.read.text(path, wholetext=True).select(strip(F.col("value")).alias("v"))
    rows = "array<map<string,string>>"
    lists = [F.from_json("v", rows), *[F.from_json(F.get_json_object("v", f"$.{k}"), rows) for k in CONTAINER_KEYS]]
    one = F.when(F.get_json_object("v", f"$.{key}").isNotNull(), F.array(F.from_json("v", "map<string,string>")))
    inner = F.from_json("v", "map<string,map<string,string>>")
    entry = lambda k, r: F.when(F.array_contains(F.map_keys(r), key), r).otherwise(F.map_concat(r, F.create_map(F.lit(key), k)))
    keyed = F.transform(F.map_entries(inner), lambda e: entry(e["key"], e["value"]))
    is_list = F.col("v").startswith("[")
    pick = F.when(is_list, lists[0]).otherwise(F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists[1:]], one, keyed))
    return raw.select(F.explode(pick).alias("row")).where("row is not null")


def submission(spark: SparkSession, path: str, fields: Iterable[str] = FIELDS) -> DataFrame:
    """Rows of a CSV, JSON Lines or JSON submission as strings; the format comes from the suffix, else from the first character."""
    suffix = os.path.splitext(path)[1].lower()
    if suffix not in (".csv", ".json", ".jsonl"):
        head = spark.read.text(path).where("trim(value) <> ''").limit(1).collect()
        start = head[0]["value"].lstrip()[:1] if head else ""
        suffix = ".json" if start in ("[", "{") else ".csv"
    if suffix == ".csv":
        return csv_strings(spark, path)
    if suffix == ".jsonl":
        return json_lines(spark, path, ", ".join(f"{f} string" for f in fields))
    row = F.col("row")
    return json_container(spark, path).select(*[F.try_element_at(row, F.lit(f)).alias(f) for f in fields])


def raw_submission(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """Rows of a submission as written, (row map<string,string>, kinds map<string,string> of JSON types), and its format, csv or json."""
    suffix = os.path.splitext(path)[1].lower()
    if suffix not in (".csv", ".json", ".jsonl"):
        head = spark.read.text(path).where("trim(value) <> ''").limit(1).collect()
        suffix = ".json" if head and head[0]["value"].lstrip()[:1] in ("[", "{") else ".csv"
    if suffix == ".csv":
        df = csv_strings(spark, path)
        cells = [x for c in df.columns for x in (F.lit(c), F.coalesce(F.col(f"`{c}`"), F.lit("")))]
        return df.select(F.create_map(*cells).alias("row"), F.create_map().cast("map<string,string>").alias("kinds")), "csv"
    if suffix == ".jsonl":
        texts = spark.read.text(path).where("trim(value) <> ''").select("value", F.lit(None).cast("string").alias("key"))
    else:
        raw = spark.read.text(path, wholetext=True).select(strip(F.col("value")).alias("v"))
        rows = "array<string>"
        alone = lambda a: F.transform(a, lambda t: F.struct(t.alias("value"), F.lit(None).cast("string").alias("key")))
        lists = [F.from_json(F.get_json_object("v", f"$.{k}"), rows) for k in CONTAINER_KEYS]
        one = F.when(F.get_json_object("v", "$.case_id").isNotNull(), F.array(F.col("v")))
        keyed = F.transform(F.map_entries(F.from_json("v", "map<string,string>")), lambda e: F.struct(e["value"].alias("value"), e["key"].alias("key")))
        pick = F.when(F.col("v").startswith("["), alone(F.from_json("v", rows))).otherwise(F.coalesce(*[F.when(F.size(x) > 0, alone(x)) for x in lists], alone(one), keyed))
        texts = raw.select(F.inline(pick))
    row = F.from_json("value", "map<string,string>")
    named = F.when(F.col("key").isNotNull() & ~F.coalesce(F.map_contains_key(row, "case_id"), F.lit(False)), F.map_concat(row, F.create_map(F.lit("case_id"), F.col("key")))).otherwise(row)
    held = F.try_parse_json("value")
    types = [x for f in FIELDS for x in (F.lit(f), F.schema_of_variant(F.try_variant_get(held, f"$.{f}", "variant")))]
    return texts.select(named.alias("row"), F.create_map(*types).alias("kinds")), "json"


def artifacts(spark: SparkSession, folder: str, most: int, total: int) -> DataFrame:
    """Model files below a folder with their size and whether the file, and all files together, keep to the limits."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    files = files.where(F.lower("path").rlike(r"\.(" + "|".join(MODEL_SUFFIXES) + r")$") & ~F.col("path").contains("/.git/"))
    return sized(files, most, total)


def sized(files: DataFrame, most: int, total: int) -> DataFrame:
    """Files (path, length) with whether each, and all together, keep to the limits."""
    all_size = F.broadcast(files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("_all")))  # one row
    return files.crossJoin(all_size).select("path", "length", (F.col("length") <= most).alias("file_ok"), (F.col("_all") <= total).alias("total_ok"))
