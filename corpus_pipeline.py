"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; between stages the rows are written as Parquet in the shared folder and
read again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import stages
from tallyframe.llm.common import table, written

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", stages.quality),
    ("exact dedup", stages.exact_dedup),
    ("n-gram Jaccard join", stages.near_dedup),
    ("suffix-array dedup", stages.substring_dedup),
    ("best-fit packing", stages.packing),
]

#: SQL can't tokenise, cut repeated substrings or score hashed n-grams; tests/llm holds a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces with their places in the sequences."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
