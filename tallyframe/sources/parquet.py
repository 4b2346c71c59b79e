"""Parquet scans of the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sources.schemas import table_schema


def read_table(spark: SparkSession, base: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan ``{base}/{name}.parquet`` with its declared schema when known
    (restricted to ``columns``), else by the file's own schema."""
    path = f"{base.rstrip('/')}/{name}.parquet"
    schema = table_schema(name, columns)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
