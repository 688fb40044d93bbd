"""Change feeds as Structured Streaming jobs.

A feed is read from files or from the paged source, filtered by state per key, and written batch by batch under the batch's
number, so that a batch that is repeated after a crash replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_table(spark: SparkSession, path: str, files: int = 64) -> DataFrame:
    """A folder of Parquet files (or one file) as a stream with the schema of what is there."""
    schema = spark.read.parquet(path).schema
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return stream.option("pathGlobFilter", "*.parquet").parquet(path)
    folder, _, name = path.rpartition("/")
    return stream.option("pathGlobFilter", name).parquet(folder)


def run_to_end(rows: DataFrame, folder: str, checkpoint: str, mode: str = "append", write: Callable[[DataFrame, int], None] | None = None) -> None:
    """Runs a stream over all that is there now. Each batch is written to its own folder by its number."""

    def one(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    rows.writeStream.foreachBatch(write or one).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def changed_only(stream: DataFrame, keys: tuple[str, ...], order: str, content: str) -> DataFrame:
    """The rows of a stream whose content differs from the last one of their key, in order within each batch. State per key: the
    content and order value last passed on; older rows than that are late repeats and are dropped. Of several rows with one order
    value the one with the least content counts. Repeats are dropped chunk by chunk, so a key's repeats need no memory."""
    types = dict(stream.dtypes)
    out = ", ".join(f"`{c}` {types[c]}" for c in (*keys, order, content))

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, at = state.get if state.exists else (None, None)
        rows = pd.concat([f[[order, content]].drop_duplicates() for f in frames]).drop_duplicates().sort_values([order, content], kind="stable")
        rows = rows[rows[order] > at] if at is not None else rows
        rows = rows.drop_duplicates(order)
        before = rows[content].shift()
        if len(rows):
            before.iloc[0] = last
            new = (rows[content] != before).to_numpy() | (np.arange(len(rows)) == 0) & (at is None)
            state.update((rows[content].iloc[-1], rows[order].iloc[-1].item()))
            kept = rows[new]
            yield kept.assign(**dict(zip(keys, key)))[[*keys, order, content]]
        elif not state.exists:
            state.update((last, at))

    return stream.select(*keys, order, content).groupBy(*keys).applyInPandasWithState(run, out, f"content {types[content]}, at {types[order]}", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(stream: DataFrame, time: Column, length: str, late: str, *by: str) -> DataFrame:
    """Counts in tumbling windows of event time, with a watermark."""
    timed = stream.withColumn("__time", time.cast("timestamp")).withWatermark("__time", late)
    return timed.groupBy(F.window("__time", length), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def first_within(stream: DataFrame, time: Column, late: str, *keys: str) -> DataFrame:
    """One row for each key within the watermark."""
    return stream.withColumn("__time", time.cast("timestamp")).withWatermark("__time", late).dropDuplicatesWithinWatermark(list(keys))


def sliding_counts(stream: DataFrame, time: Column, length: str, slide: str, late: str, *by: str) -> DataFrame:
    """Counts in sliding windows of event time, with a watermark."""
    timed = stream.withColumn("__time", time.cast("timestamp")).withWatermark("__time", late)
    return timed.groupBy(F.window("__time", length, slide), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def session_counts(stream: DataFrame, time: Column, gap: str, late: str, *by: str) -> DataFrame:
    """Counts in sessions of event time, which end after a gap, with a watermark."""
    timed = stream.withColumn("__time", time.cast("timestamp")).withWatermark("__time", late)
    return timed.groupBy(F.session_window("__time", gap), *by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), *by, "n")
