"""A table delivered again as a live feed: several micro-batches, with resent and delayed messages.

The rows of a table are cut into slices of equal time; each row is delivered in
the slices that ``delivery`` names for it (its own, later ones, or several).
Every slice is one file, and modification times follow the slices, so a file
stream that takes one file per micro-batch sees them in order.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import shared_dir
from tallyframe.streaming.runner import hadoop_path, source_stream

SLICE = "batch"


def on_time(slice_: Column) -> Column:
    """Every message once, in its own slice."""
    return F.array(slice_)


def sent_twice(slice_: Column) -> Column:
    """Every message in its own slice, and again in the next one."""
    return F.array(slice_, slice_ + 1)


def staged_feed(df: DataFrame, ts: str, slices: int, delivery: Callable[[Column], Column] = on_time, name: str = "feed") -> str:
    """Write ``df`` as a feed below the shared folder; returns the feed's folder.

    A row of time t belongs to slice (t - first) * slices div (last - first + 1 microsecond).
    """
    spark = df.sparkSession
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    first, last = df.agg(F.min(micros), F.max(micros)).first()
    folder = shared_dir(spark, "feeds", name, unique=True)
    first, width = first or 0, (last or 0) - (first or 0) + 1
    own = F.expr(f"(unix_micros(CAST(`{ts}` AS TIMESTAMP)) - {first}L) * {slices}L div {width}L").cast("int")
    sliced = df.withColumn(SLICE, own).withColumn(SLICE, F.explode(delivery(F.col(SLICE)).cast("array<int>")))
    sliced.repartition(SLICE).write.partitionBy(SLICE).parquet(folder)      # a slice is in one task: one file each
    fs, root = hadoop_path(spark, folder)
    start = int(time.time()) - 86_400
    for status in fs.listStatus(root):
        if status.isDirectory():
            number = int(status.getPath().getName().split("=")[1])
            for file in fs.listStatus(status.getPath()):
                fs.setTimes(file.getPath(), 1000 * (start + number), -1)
    return folder


def feed_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The feed as a stream, one slice per micro-batch."""
    return source_stream(spark, folder, f"{schema}, {SLICE} INT", max_files_per_trigger=1).drop(SLICE)
