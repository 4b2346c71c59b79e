"""Catalog sources and sinks: views, tables, and materialised intermediates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.session import checkpoint_root, shared_dir


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a plan for SQL (``createOrReplaceTempView``); no data is stored."""
    df.createOrReplaceTempView(name)
    return df


def scan_view(spark: SparkSession, name: str, sql: bool = False) -> DataFrame:
    """Read a view or table back by catalog name, or through ``SELECT *``."""
    if sql:
        return spark.sql(f"SELECT * FROM `{name}`")
    return spark.table(name)


def save_table(df: DataFrame, name: str, *, path: str | None = None, fmt: str = "parquet",
               mode: str = "overwrite", partition_by: list[str] | None = None,
               bucket_by: tuple[int, list[str]] | None = None) -> str:
    """Save as a catalog table (re-runnable: overwrite, never delete paths by hand).

    With ``path`` the files live there (e.g. a shared folder) and the catalog
    only points at them.  ``bucket_by=(n, keys)`` writes the table bucketed
    so later joins and aggregations on ``keys`` need no shuffle.
    """
    writer = df.write.format(fmt).mode(mode)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, keys = bucket_by
        writer = writer.bucketBy(n, *keys).sortBy(*keys)
    writer.saveAsTable(name)
    return name


def save_bucketed(df: DataFrame, name: str, buckets: int, keys: list[str], *, path: str | None = None) -> str:
    """Save as a catalog table of ``buckets`` buckets by ``keys``, one sorted file each.

    Tables stored with the same number of buckets are joined and grouped by
    ``keys`` without a shuffle.  A bucket is read by one task, so choose their
    number for the larger table (its bytes / 128 MB, a power of two).
    """
    return save_table(df.repartition(buckets, *keys), name, path=path, bucket_by=(buckets, keys))


def join_bucketed(spark: SparkSession, left: str, right: str, keys: list[str], how: str = "inner") -> DataFrame:
    """Join of two bucketed tables by their common ``keys``, bucket by bucket.

    The merge hint keeps the join in place whatever the sizes: neither side is
    broadcast, hashed into memory or shuffled.
    """
    return spark.table(left).join(spark.table(right).hint("merge"), keys, how)


def materialize(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared checkpoint folder and read it back.

    This cuts the lineage: reports built on the result start from the files,
    and a lost executor re-reads them instead of recomputing the joins.
    """
    spark = spark or df.sparkSession
    path = shared_dir(spark, "materialized", name, unique=True)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint into the shared ``spark.checkpoint.dir``:
    the result is computed once and later reads start from the files."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
