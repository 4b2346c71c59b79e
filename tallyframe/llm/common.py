"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import sketch
from tallyframe.session import shared_dir

BATCH_BYTES = 4 << 20        # of rows that go to a Python worker at once
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder (a single file or a folder of part files)."""
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package when it is only on the driver's path (a checkout in local mode).

    Rows go to them in batches of ``BATCH_BYTES``, unless the session has a limit of its own: 10,000 whole texts
    at once take tens of MB in each worker, and as much again in the executor that fills the batch.
    """
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, *paths) if p)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage at a table that all executors share, so the loss of an
    executor later on costs nothing that lies before it.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name, unique=True)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def without_rows(df: DataFrame, keys: dict[str, Column], gone: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``keys`` (name -> expression) aren't in ``gone`` (columns of these names); null equals null.

    An anti join that moves few rows: a bitmap of bounded size tells for most
    rows that they aren't in ``gone``; only the others are joined.
    """
    names = list(keys)
    gone = written(gone.select(*[F.col(c).alias(f"_gone_{c}") for c in names]).distinct()
                   .withColumn("_mix", F.xxhash64(*[f"_gone_{c}" for c in names])), "gone_rows")
    hit = df.sparkSession.sparkContext.broadcast(sketch.bitmap(gone.select("_mix"), sketch.bits_for(gone.count(), 32)))

    @F.pandas_udf("boolean")
    def may_go(mix):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(sketch.in_bitmap(hit.value, mix.to_numpy()))

    flag = free_name(df, "_may_go")
    marked = df.withColumn(flag, may_go(F.xxhash64(*keys.values())))
    own = {c: free_name(df, f"_key_{c}") for c in names}
    rest = marked.where(F.col(flag)).drop(flag).withColumns({own[c]: keys[c] for c in names})
    same = reduce(lambda a, b: a & b, [rest[own[c]].eqNullSafe(gone[f"_gone_{c}"]) for c in names])
    return marked.where(~F.col(flag)).drop(flag).unionByName(rest.join(gone, same, "left_anti").drop(*own.values()))
