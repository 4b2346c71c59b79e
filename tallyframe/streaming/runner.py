"""Running live operators: to completion (``run_available``) or continuously
(``start_live``).

``run_available`` writes outputs and checkpoints to a fresh folder under the
shared checkpoint directory, so a restarted query resumes from its offsets and state, and the
result is read from files (never collected through the driver).  What a
micro-batch writes depends on the output mode:

* ``append``: the parquet file sink (exactly once via its commit log), or,
  with a ``batch_transform``, one folder per batch;
* ``complete``: the whole result as a new version ``v=<batch>``;
* ``update``: the last version with the batch's keys replaced, as a new
  version; needs ``merge_keys``.

Folders are named by the batch id, so a replayed batch overwrites only itself.
A version counts from the moment Spark has put ``_SUCCESS`` into it; readers
take the last such version and never see one that is being written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.session import shared_dir
from tallyframe.streaming.accounts import BatchAccount, late_rows, read_account


@dataclass
class StreamRun:
    result: DataFrame
    path: str
    progress: list = field(default_factory=list)      # the last updates that Spark keeps
    account: DataFrame | None = None                  # every micro-batch, see ``accounts.read_account``

    @property
    def rows_dropped_by_watermark(self) -> int:
        """Late rows dropped by stateful operators over all micro-batches (by an aggregate: groups, after its partial step)."""
        return late_rows(self.account).agg(F.coalesce(F.sum("late_rows"), F.lit(0))).first()[0]

    @property
    def input_rows(self) -> int:
        return late_rows(self.account).agg(F.coalesce(F.sum("input_rows"), F.lit(0))).first()[0]


def in_own_session(stream: DataFrame, state_partitions: int) -> DataFrame:
    """The same stream in a session of its own, with the caller's settings and ``state_partitions`` state stores per operator.

    A stream keeps the count that it starts with for the life of its checkpoint;
    the caller's session, which other threads may use, is left as it is.
    """
    spark = stream.sparkSession
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    own.conf.set(_PARTITIONS, str(state_partitions))
    plan = stream._jdf.queryExecution().analyzed()
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own._jsparkSession, plan), own)


def source_stream(spark: SparkSession, folder: str, schema: StructType | str, *,
                  glob: str | None = None, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over ``folder`` (optionally only names matching ``glob``).

    Files are taken in modification-time order; ``max_files_per_trigger``
    bounds each micro-batch.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def table_stream(spark: SparkSession, folder: str, name: str, schema: StructType | str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over the table ``folder/name.parquet``, a folder of part files or one file.

    Raises ``FileNotFoundError`` if neither is there.
    """
    fs, path = hadoop_path(spark, f"{folder}/{name}.parquet")
    if not fs.exists(path):
        raise FileNotFoundError(f"{folder}/{name}.parquet")
    if fs.getFileStatus(path).isDirectory():
        return source_stream(spark, f"{folder}/{name}.parquet", schema, max_files_per_trigger=max_files_per_trigger)
    # A stream's path is a folder: watch the parent for exactly this name.
    return source_stream(spark, folder, schema, glob=f"{name}.parquet", max_files_per_trigger=max_files_per_trigger)


def committed(spark: SparkSession, out: str, prefix: str) -> list[str]:
    """Folders ``<prefix>=<number>`` below ``out`` that are complete, by number."""
    fs, path = hadoop_path(spark, out)
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()]
    numbers = sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{prefix}="))
    Path = spark._jvm.org.apache.hadoop.fs.Path
    return [f"{out}/{prefix}={n}" for n in numbers if fs.exists(Path(f"{out}/{prefix}={n}/_SUCCESS"))]


def read_output(spark: SparkSession, out: str, schema: StructType, output_mode: str, transformed: bool) -> DataFrame:
    """What a query has written so far (an empty frame before its first output)."""
    if output_mode == "append" and not transformed:
        fs, path = hadoop_path(spark, out)
        return spark.read.schema(schema).parquet(out) if fs.exists(path) else spark.createDataFrame([], schema)
    found = committed(spark, out, "b" if output_mode == "append" else "v")
    if output_mode != "append":
        found = found[-1:]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


Transform = Callable[[DataFrame], DataFrame]
Fold = Callable[[DataFrame, "DataFrame | None"], "tuple[DataFrame, DataFrame]"]


def _sink(stream: DataFrame, name: str, output_mode: str, batch_transform: Transform | None, base: str,
          merge_keys: list[str] | None = None, batch_fold: Fold | None = None, partition_by: list[str] | None = None):
    if output_mode not in ("append", "complete", "update"):
        raise ValueError(f"unknown output mode {output_mode!r}")
    if output_mode == "update" and not merge_keys:
        raise ValueError("update mode needs merge_keys: the columns that name a row of the result")
    if batch_fold and (batch_transform or output_mode != "append"):
        raise ValueError("batch_fold needs append mode and no batch_transform")
    out, ckpt = f"{base}/out", f"{base}/checkpoint"
    query = f"tallyframe_{name}_{base.rsplit('/', 1)[-1]}"
    writer = stream.writeStream.queryName(query).option("checkpointLocation", ckpt).outputMode(output_mode)
    if output_mode == "append" and batch_transform is None and batch_fold is None:
        writer = writer.format("parquet").option("path", out)
        return (writer.partitionBy(*partition_by) if partition_by else writer), out, query

    def prune(spark: SparkSession, folder: str) -> None:
        fs, _ = hadoop_path(spark, folder)
        for old in committed(spark, folder, "v")[:-KEPT_VERSIONS]:      # readers may still hold the one before
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)

    def before(spark: SparkSession, folder: str, batch_id: int) -> list[str]:
        return [v for v in committed(spark, folder, "v") if int(v.rsplit("=", 1)[1]) < batch_id][-1:]

    def fold_batch(batch: DataFrame, batch_id: int) -> None:
        # The carry of earlier batches is named by their ids, so a replayed batch starts from the same one again.
        spark, carried = batch.sparkSession, f"{base}/carry"
        found = before(spark, carried, batch_id)
        rows, carry = batch_fold(batch, spark.read.parquet(*found) if found else None)
        rows.write.mode("overwrite").parquet(f"{out}/b={batch_id}")
        carry.write.mode("overwrite").parquet(f"{carried}/v={batch_id}")
        prune(spark, carried)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch_transform(batch) if batch_transform else batch
        if output_mode == "append":
            rows.write.mode("overwrite").parquet(f"{out}/b={batch_id}")
            return
        spark = batch.sparkSession
        if output_mode == "update":
            found = before(spark, out, batch_id)
            if found:
                old = spark.read.schema(rows.schema).parquet(*found)
                same = [old[k].eqNullSafe(rows[k]) for k in merge_keys]
                rows = old.join(rows.select(*merge_keys), same, "left_anti").unionByName(rows)
        rows.write.mode("overwrite").parquet(f"{out}/v={batch_id}")
        prune(spark, out)

    return writer.foreachBatch(fold_batch if batch_fold else write_batch), out, query


KEPT_VERSIONS = 3
ACCOUNT_WAIT_S = 60
_PARTITIONS = "spark.sql.shuffle.partitions"


def _start(writer, stream: DataFrame, query: str, base: str):
    """Start the query and its account; returns both."""
    spark = stream.sparkSession
    account = BatchAccount(spark, query, f"{base}/account")
    spark.streams.addListener(account)
    try:
        return writer.start(), account
    except BaseException:
        spark.streams.removeListener(account)
        raise


def start_live(stream: DataFrame, name: str, path: str, *, output_mode: str = "append",
               trigger: str = "10 seconds", state_partitions: int | None = None,
               batch_transform: Transform | None = None, batch_fold: Fold | None = None,
               merge_keys: list[str] | None = None, partition_by: list[str] | None = None):
    """Start a long-running query (processing-time trigger) writing below ``path``: ``path/out`` for results,
    ``path/checkpoint`` for offsets and state, ``path/account`` for what every batch took in and dropped.

    Restarting with the same ``path`` resumes where the query stopped.
    Returns the ``StreamingQuery``; results are read with :func:`read_output`
    from ``path/out``, the account with ``accounts.read_account``.
    """
    base = path.rstrip("/")
    if state_partitions:
        stream = in_own_session(stream, state_partitions)
    writer, _, query = _sink(stream, name, output_mode, batch_transform, base, merge_keys, batch_fold, partition_by)
    return _start(writer.trigger(processingTime=trigger), stream, query, base)[0]


def run_available(stream: DataFrame, name: str, *, output_mode: str = "append",
                  batch_transform: Transform | None = None, batch_fold: Fold | None = None,
                  spark: SparkSession | None = None, timeout_s: float | None = None,
                  state_partitions: int | None = None, merge_keys: list[str] | None = None,
                  partition_by: list[str] | None = None, schema: StructType | None = None) -> StreamRun:
    """Process everything available now (``availableNow`` trigger), then stop.

    A catch-up takes as long as it takes; ``timeout_s`` sets a limit if one is wanted.
    ``batch_fold(batch, carry)`` returns the batch's rows and the carry for the
    next batch (the first gets None).  ``schema`` names the columns of the result;
    a fold needs it, and so does a ``batch_transform`` that runs a query of its own.
    """
    spark = spark or stream.sparkSession
    if state_partitions:
        stream = in_own_session(stream, state_partitions)
    base = shared_dir(spark, "streams", name, unique=True)
    writer, out, query = _sink(stream, name, output_mode, batch_transform, base, merge_keys, batch_fold, partition_by)
    handle, account = _start(writer.trigger(availableNow=True), stream, query, base)
    try:
        finished = handle.awaitTermination() if timeout_s is None else handle.awaitTermination(timeout_s)
        if finished is False:
            handle.stop()
            raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
        if handle.exception() is not None:
            raise RuntimeError(f"stream {name} failed: {handle.exception()}")
        if not account.ended.wait(ACCOUNT_WAIT_S) or account.failure:       # its entries arrive in order, the end last
            raise RuntimeError(f"the account of stream {name} is not complete: {account.failure}")
    finally:
        stream.sparkSession.streams.removeListener(account)
    schema = schema or (batch_transform(stream).schema if batch_transform else stream.schema)
    result = read_output(spark, out, schema, output_mode, bool(batch_transform or batch_fold))
    return StreamRun(result, out, list(handle.recentProgress), read_account(spark, f"{base}/account"))
