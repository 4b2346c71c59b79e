"""Exact deduplication by content sort.

Sampled splitters range-partition the rows on their normalised bytes, each
partition is sorted externally, equal texts then lie next to each other and are
found by comparing whole neighbouring texts.

The range key is (first 64 characters, 64-bit hash, id): it has a bounded size
(Spark samples up to a million keys for the splitters, which must not be whole
documents) and it ends in the id, so that a group of copies that holds a third
of all rows is spread over as many partitions as its rows need.  Inside a
partition rows are ordered by (prefix, hash, whole text, id).  A run of equal
texts that touches the edge of a partition may go on in the next one: such runs
(two at most per partition) are put together by their SHA-256 in a summary of
at most two rows per partition, which is small enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import written

PREFIX_CHARS = 64


def _mark_runs(out_schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: rows of one sorted partition in, the same rows with their run's keeper and size out."""

    def emit(table: pa.Table, starts: np.ndarray, sizes: np.ndarray, edge: bool, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        which = np.repeat(np.arange(len(sizes)), sizes)
        head = np.zeros(table.num_rows, dtype=bool)
        head[starts] = True
        keep = table["_id"].combine_chunks().take(pa.array(starts[which]))
        cols = {c: table[c] for c in table.column_names}
        cols |= {"_keep": keep, "_size": pa.array(sizes[which].astype("int64")), "_head": pa.array(head),
                 "_edge": pa.array(np.full(table.num_rows, edge))}
        if "_own" in out_schema.names:       # one text per run, at its head
            cols["_own"] = texts.take(pa.array(which, mask=~head))
        yield from pa.table([cols[f.name] for f in out_schema], schema=out_schema).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.Table] = []     # rows (without their texts) of the run that is still open
        last = None                      # its text
        first_run = True
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column("_text")
            rows = pa.Table.from_batches([batch]).drop_columns(["_text"])
            new = np.ones(batch.num_rows, dtype=bool)
            new[0] = last is None or texts[0].as_py() != last
            if batch.num_rows > 1:
                new[1:] = pc.not_equal(texts.slice(1), texts.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            held, last = pa.array([last], texts.type), texts[batch.num_rows - 1].as_py()
            if not len(starts):
                pending.append(rows)
                continue
            if starts[0]:
                pending.append(rows.slice(0, int(starts[0])))
            if pending:
                done = pa.concat_tables(pending)
                yield from emit(done, np.array([0]), np.array([done.num_rows]), first_run, held)
                first_run = False
            a, z = int(starts[0]), int(starts[-1])
            if z > a:
                own = starts[:-1] - a
                sizes = np.diff(starts)
                heads = texts.take(pa.array(starts[:-1]))
                if first_run:            # the partition's first run ends inside this batch
                    yield from emit(rows.slice(a, int(sizes[0])), np.array([0]), sizes[:1], True, heads[:1])
                    a, own, sizes, heads, first_run = a + int(sizes[0]), own[1:] - sizes[0], sizes[1:], heads[1:], False
                if len(sizes):
                    yield from emit(rows.slice(a, z - a), own, sizes, False, heads)
            pending = [rows.slice(z)]
        if pending:
            done = pa.concat_tables(pending)
            yield from emit(done, np.array([0]), np.array([done.num_rows]), True, pa.array([last], pa.string()))

    return run


def content_sort_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                       normalise: Callable[[Column], Column] | None = None,
                       carry: tuple[str, ...] = (), text_as: str | None = None) -> DataFrame:
    """One row per input row: ``id_col``, the ``carry`` columns, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    With ``text_as``, kept rows also have their normalised text under that name
    (null in others): the copies' texts are not carried through the sort twice.

    ``normalise`` maps the text column before comparing (default: no change).
    ``keep`` is ``min`` or ``max``: which id of equal texts stays.

    Defined cases: a null text counts as empty; empty texts equal each other;
    null ids lose against any other id; of repeated rows (same id, same text)
    exactly one is ``kept`` while ``group_size`` counts them all; an empty table
    gives an empty result; extra columns are ignored unless named in ``carry``,
    where their names may clash with those of the result's internals.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    text = F.coalesce(F.col(text_col), F.lit(""))
    if normalise:
        text = normalise(text)
    rows = df.select(F.col(id_col).alias("_id"), text.alias("_text"), *[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)])
    rows = rows.withColumns({"_prefix": F.substring("_text", 1, PREFIX_CHARS), "_hash": F.xxhash64("_text")})
    by_id = F.col("_id").desc_nulls_last() if keep == "max" else F.col("_id").asc_nulls_last()
    ordered = (rows.repartitionByRange("_prefix", "_hash", by_id)
               .sortWithinPartitions("_prefix", "_hash", "_text", by_id)
               .drop("_prefix", "_hash")
               .withColumn("_sha", F.sha2("_text", 256)))
    marked_schema = ordered.drop("_text").withColumns({
        "_keep": F.col("_id"), "_size": F.lit(0).cast("long"), "_head": F.lit(True), "_edge": F.lit(True),
        **({"_own": F.lit(None).cast("string")} if text_as else {})}).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    marked = written(ordered.mapInArrow(_mark_runs(to_arrow_schema(marked_schema)), marked_schema), "content_sort")
    best = (F.max if keep == "max" else F.min)("_keep")
    edges = (marked.where("_edge and _head").groupBy("_sha")
             .agg(best.alias("_edge_keep"), F.sum("_size").alias("_edge_size")))
    joined = marked.join(F.broadcast(edges), "_sha", "left")   # at most two rows per partition
    keep_id = F.when(F.col("_edge"), F.col("_edge_keep")).otherwise(F.col("_keep"))
    return joined.select(
        F.col("_id").alias(id_col), *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)],
        keep_id.alias("keep_id"),
        F.when(F.col("_edge"), F.col("_edge_size")).otherwise(F.col("_size")).alias("group_size"),
        (F.col("_head") & F.col("_id").eqNullSafe(keep_id)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
        *([F.when(F.col("_head") & F.col("_id").eqNullSafe(keep_id), F.col("_own")).alias(text_as)] if text_as else []))


def dedup_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    others = tuple(c for c in df.columns if c != id_col)
    return content_sort_dedup(df, id_col, text_col, keep, carry=others).where("kept").select(*df.columns)
