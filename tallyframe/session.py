"""Session construction and the shared working folder.

The configuration here is what the operators assume: UTC session time (the
streaming operators cast event times), AQE on (runtime coalescing, runtime
broadcast of small join sides, skew-join splitting), and an explicit static
broadcast threshold, so that a join side is only broadcast after Spark has
measured it below the limit; beyond it the join stays a sort-merge join.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Static and runtime broadcast limits (bytes).  A side above them is joined by
# shuffle (sort-merge, with AQE skew splitting).
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # Session windows merged inside each task before the shuffle, so a box
    # sending a third of all messages is not shipped message by message.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Streaming state off the JVM heap with incremental checkpoints: for key spaces
# far beyond the 60,000 boxes of a national election (the default in-memory
# store is faster for bounded state of that size).
ROCKSDB_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(app: str = "tallyframe", master: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None,
                rocksdb_state: bool = False) -> SparkSession:
    """Create (or reuse) a session with the configuration the operators expect.

    On a cluster leave ``master`` unset (spark-submit decides) and size
    ``shuffle_partitions`` to the data: roughly input bytes / 128 MB for the
    widest shuffle; AQE coalesces the small ones at runtime.  Stateful
    streams keep their shuffle partition count for the life of their
    checkpoint, so size it before the first run.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb_state:
        conf.update(ROCKSDB_STATE_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # Runtime SQL settings also apply when the session already existed.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and not k.startswith("spark.sql.warehouse"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an existing session
                pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    When it is unset (a local test session) a private folder is created and
    registered; on a cluster an unset value is an error, since a machine-local
    folder would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext (e.g. Spark Connect)
        if root:
            return root
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current.rsplit("/", 1)[0]
        if sc.master != "local" and not sc.master.startswith("local["):      # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tallyframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder (optionally a fresh one)."""
    segs = [checkpoint_root(spark).rstrip("/"), "tallyframe", *parts]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join(segs)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (only used by tests to look at written files)."""
    return path[5:] if path.startswith("file:") else path


os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")
