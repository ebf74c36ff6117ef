"""Session helpers: reading tables, cutting lineage durably, and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only while its measured size stays under this many bytes.
BROADCAST_LIMIT = 32 << 20


def session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the engine's defaults; on a cluster the launcher's own session is used instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table (a file or a folder of Parquet files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the cluster's shared checkpoint folder and return it without lineage.

    The folder is the session's ``spark.checkpoint.dir``; only where that is unset on a local master (tests) a temporary one is made, a
    cluster without it is refused. Checkpoint files outlive lost executors, unlike cached or locally checkpointed blocks.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        set_dir = sc.getConf().get("spark.checkpoint.dir", None)
        if not set_dir and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(set_dir or tempfile.mkdtemp(prefix="packetry-"))
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT) -> tuple[DataFrame, bool]:
    """Cut df and measure it: (df marked for broadcast, True) if its text size is under limit, else (df, False)."""
    df = cut(df)
    width = [F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(16) for c in df.columns]
    total = width[0]
    for w in width[1:]:
        total = total + w
    size = df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("b")).first()["b"]
    return (F.broadcast(df), True) if size <= limit else (df, False)


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", salts: int = 32, limit: int = BROADCAST_LIMIT, heavy: int = 1_000_000) -> DataFrame:
    """Join a large left to a dictionary: broadcast it while small, else spread the rows of heavy keys over many tasks.

    Beyond the limit the keys of more than heavy left rows (rows / heavy keys at most) are counted; only their dictionary rows are
    repeated, once per salt, and only their left rows draw a salt, from their own hash.
    """
    right, small = small_side(right, limit)
    if small:
        return left.join(right, keys, how)
    hot = left.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > heavy).select(*keys, F.lit(salts).alias("_salts"))
    hot, _ = small_side(hot)
    spread = right.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    plain = [F.col(f"`{c}`") for c in left.columns if not left.schema[c].dataType.simpleString().startswith("map")]
    mine = left.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*plain), F.coalesce("_salts", F.lit(1)).cast("bigint")).cast("int")).drop("_salts")
    return mine.join(spread, [*keys, "_salt"], how).drop("_salt")


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers of any cluster: Spark's own file server hands out its source once per context."""
    sc = spark.sparkContext
    if any(name.startswith("packetry-src") for name in map(os.path.basename, getattr(sc, "_python_includes", []))):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="packetry-"), "packetry-src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("packetry", os.path.relpath(full, root)))
    sc.addPyFile(path)
