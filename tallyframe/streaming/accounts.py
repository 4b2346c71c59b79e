"""What every micro-batch of a stream took in and dropped, kept beside its output.

Spark keeps the last hundred progress updates of a query.  The account is a
listener that writes one small file per micro-batch, named by the batch, so a
batch that is replayed after a restart replaces its own entry and a history of
any length is complete.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

ACCOUNT_SCHEMA = ("batch_id LONG, input_rows LONG, watermark STRING, "
                  "operators ARRAY<STRUCT<operator: STRING, state_rows: LONG, late_rows: LONG>>")


class BatchAccount(StreamingQueryListener):
    """Writes the account of the query called ``name`` into ``folder``."""

    def __init__(self, spark: SparkSession, name: str, folder: str) -> None:
        self.spark, self.name, self.folder = spark, name, folder.rstrip("/")
        self.run: str | None = None
        self.ended = threading.Event()
        self.failure: Exception | None = None

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        if event.name == self.name:
            self.run = str(event.runId)

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        if event.progress.name != self.name:
            return
        try:
            self.enter(json.loads(event.progress.json))
        except Exception as problem:  # noqa: BLE001  (a listener's errors would only be logged; the runner raises this one)
            self.failure = problem

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        if str(event.runId) == self.run:
            self.ended.set()

    def enter(self, progress: dict) -> None:
        from tallyframe.streaming.runner import hadoop_path

        entry = {"batch_id": progress["batchId"], "input_rows": progress.get("numInputRows", 0),
                 "watermark": (progress.get("eventTime") or {}).get("watermark"),
                 "operators": [{"operator": op.get("operatorName"), "state_rows": op.get("numRowsTotal"),
                                "late_rows": op.get("numRowsDroppedByWatermark", 0)} for op in progress.get("stateOperators") or []]}
        fs, path = hadoop_path(self.spark, f"{self.folder}/b{progress['batchId']:012d}.json")
        out = fs.create(path, True)
        try:
            out.write(bytearray(json.dumps(entry).encode() + b"\n"))
        finally:
            out.close()


def read_account(spark: SparkSession, folder: str) -> DataFrame:
    """One row per micro-batch and stateful operator: batch_id, input_rows, watermark, place (of the operator), operator,
    state_rows, late_rows.  A batch without a stateful operator is one row whose last columns are null."""
    from tallyframe.streaming.runner import hadoop_path

    fs, path = hadoop_path(spark, folder)
    entries = (spark.read.schema(ACCOUNT_SCHEMA).json(folder) if fs.exists(path)
               else spark.createDataFrame([], ACCOUNT_SCHEMA))
    return entries.select("batch_id", "input_rows", "watermark", F.posexplode_outer("operators").alias("place", "op")).select(
        "batch_id", "input_rows", "watermark", "place", "op.operator", "op.state_rows", "op.late_rows")


def late_rows(account: DataFrame) -> DataFrame:
    """Per micro-batch with input: batch_id, input_rows, late_rows over all its operators.

    An aggregate counts the groups that it drops after its partial step; an
    operator that reads messages one by one (deduplication) counts messages.
    """
    return (account.groupBy("batch_id").agg(F.max("input_rows").alias("input_rows"),
                                            F.coalesce(F.sum("late_rows"), F.lit(0)).alias("late_rows"))
            .where("input_rows > 0"))
