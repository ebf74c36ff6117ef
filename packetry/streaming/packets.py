"""Structured Streaming: micro-batches of files, resumable state, full rewrite after each batch, and isolation of bad packets."""

from __future__ import annotations

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def file_batches(spark: SparkSession, folder: str, schema: str, most: int = 200, fmt: str = "parquet") -> DataFrame:
    """A stream over the files of a folder, at most so many per batch. Results must not depend on the order of files."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", most).load(folder)


def run_batches(
    stream: DataFrame, state: str, out: str, checkpoint: str, view: Callable[[DataFrame], DataFrame], key: str | None = None,
    work: Callable[[DataFrame, bool, bool], DataFrame] | None = None, governor: Governor | None = None, every: int = 1,
) -> StreamingQuery:
    """Process all available batches: append to the state table, then rewrite the output from the whole state.

    The batch id is a partition of the state, so a batch that is run again after a failure replaces itself. The checkpoint folder makes a
    later run take new files only. key: rows without it are not kept, so that their packets are tried again. work(batch, costly, deep)
    reads a batch as thoroughly as the governor still allows; the governor sees the time spent and the rows kept after each batch.
    The output is a function of the whole state (reference dates and the like), so it is made anew; every n-th batch only, to spare
    long runs, and by the caller's last view of the state after the stream has ended where n is more than one.
    """
    began = time.monotonic()

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = work(batch, governor is None or governor.costly, governor is None or governor.deep) if work else batch
        rows = rows.where(F.col(key).isNotNull()) if key else rows
        rows.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        kept = spark.read.option("basePath", state).parquet(state)
        if governor is not None:
            governor.after(time.monotonic() - began, kept.count())
        if batch_id % every == 0:
            view(kept).write.mode("overwrite").parquet(out)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def guarded(df: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, key: str) -> DataFrame:
    """Apply work, which takes a frame of any number of packets, to all packets; one that raises gives a row of nulls with its key and the error text.

    A batch is worked on whole. Where that fails it is halved until the bad packets stand alone, so that a few of them cost a few calls.
    """
    names = [x.split()[0] for x in schema.split(",")]

    def safe(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        try:
            yield work(pdf).assign(error=None)[[*names, "error"]]
        except Exception as e:  # the packet's own fault, not the job's
            if len(pdf) > 1:
                half = len(pdf) // 2
                yield from safe(pdf.iloc[:half])
                yield from safe(pdf.iloc[half:])
            else:
                yield pd.DataFrame({n: [pdf[key].iloc[0] if n == key else None] for n in names} | {"error": [f"{type(e).__name__}: {e}"]})[[*names, "error"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield from safe(pdf)

    return df.mapInPandas(run, schema + ", error string")


def unfinished(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs without a finished record."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


class Governor:
    """Budget of a batch run: deep work stops after two batches in a row projected over 80 %, costly work after two over 94 %."""

    def __init__(self, seconds_each: float, total: int, deep: float = 0.80, costly: float = 0.94):
        self.budget, self.total, self.limits = seconds_each * total, total, (deep, costly)
        self.strikes, self.deep, self.costly = [0, 0], True, True

    def after(self, elapsed: float, done: int) -> None:
        projected = elapsed + elapsed / max(done, 1) * (self.total - done)
        for i, limit in enumerate(self.limits):
            over = projected > limit * self.budget
            self.strikes[i] = self.strikes[i] + 1 if over else 0
        self.deep = self.deep and self.strikes[0] < 2
        self.costly = self.costly and self.strikes[1] < 2
