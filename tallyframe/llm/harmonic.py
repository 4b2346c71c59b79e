"""Harmonic packing of tokenised documents into sequences.

A piece of ``length`` tokens belongs to class ``capacity // length``: class k
holds lengths in (capacity / (k + 1), capacity / k], so k of them always fit.
Every task keeps one open bin per class and closes it when it holds exactly k
pieces; workers share nothing and no row is moved.

Documents may be cut, so lengths are made to fit their class.  A document gives
whole sequences first.  Its rest stays one piece if it fills its share
capacity / k up to ``slack``; otherwise a piece of the next smaller share is cut
off, and the same holds for what is left.  A rest gets shorter by a square each
time, which makes two to three pieces of it.

The bins still open when a task ends (less than one sequence per class) are laid
end to end and cut at the capacity; the last sequence is cut into powers of two,
which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.bpe import class_table
from tallyframe.llm.common import reach_workers
from tallyframe.llm.packing import Tokens

CAPACITY = 1024
SLACK = 0.02              # unused part of a share up to which a piece is left as it is
END_ID = 0
SLICE_DOCS = 256
PLACES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def piece_lengths(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """Lengths of the pieces of ``n`` tokens, in order."""
    lengths, rest = [capacity] * (n // capacity), n % capacity
    while rest:
        k = capacity // rest
        share = capacity / k
        if share - rest < max(1.0, slack * share):
            return [*lengths, rest]
        lengths.append(capacity // (k + 1))
        rest -= lengths[-1]
    return lengths


@dataclass
class Piece:
    doc: object
    start: int
    ids: bytes                # little-endian unsigned 32-bit
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:4 * n], self.doc_tokens),
                Piece(self.doc, self.start + n, self.ids[4 * n:], self.doc_tokens))


@dataclass
class Bins:
    """The open bins of one task, one per class, and the sequences it has closed."""

    capacity: int
    first_sequence: int
    open: dict[int, list[Piece]] = field(default_factory=dict)
    closed: list[list[Piece]] = field(default_factory=list)

    def put(self, piece: Piece) -> None:
        k = self.capacity // len(piece)
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            self.closed.append(self.open.pop(k))

    def finish(self) -> None:
        """Lay what is left end to end: full sequences, then falling powers of two."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        total = sum(map(len, left))
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
        self.open, left = {}, left[::-1]
        for size in sizes:
            sequence: list[Piece] = []
            while size:
                piece = left.pop()
                if len(piece) > size:
                    piece, more = piece.cut(size)
                    left.append(more)
                sequence.append(piece)
                size -= len(piece)
            self.closed.append(sequence)

    def rows(self) -> list[tuple]:
        """Rows of the closed sequences, which are then forgotten."""
        out = []
        for sequence in self.closed:
            at = 0
            for p in sequence:
                out.append((p.doc, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, self.first_sequence, at, p.ids))
                at += len(p)
            self.first_sequence += 1
        self.closed = []
        return out


_tokens: dict[int, Tokens] = {}


def pack_harmonic(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  capacity: int = CAPACITY, slack: float = SLACK, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with their places: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (gapless from 0 in each sequence) and, with ``with_ids``, the ids (binary).

    A document's ids are the tokeniser's, then ``END_ID``.  A sequence never
    spans two tasks and its number starts with the task's, so a task that is
    run again gives whole sequences again.  The tokeniser file is read on the
    driver and broadcast.

    Defined cases: a null text counts as empty; an empty text is one piece that
    holds only ``END_ID``; null ids and repeated rows each get their own pieces;
    a text of any length is cut like others; equal lengths are placed in the
    order in which the task reads them; an empty table gives an empty result;
    extra columns are ignored, whatever their names.
    """
    if capacity < 1:
        raise ValueError("capacity must be 1 or more")
    spark = df.sparkSession
    reach_workers(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast((f.read(), class_table("tokenizers")))
    key = zlib.crc32(shared.value[0].encode())
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _tokens:
            _tokens[key] = Tokens(*shared.value)
        encode, end = _tokens[key].encode, END_ID.to_bytes(4, "little")
        bins, arrow_id = Bins(capacity, TaskContext.get().partitionId() << 40), None

        def emit() -> Iterator[pa.RecordBatch]:
            found = bins.rows()
            if found:
                doc, *numbers, ids = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, arrow_id), *[pa.array(n, pa.int64()) for n in numbers],
                     pa.array(ids if with_ids else [None] * len(ids), pa.binary())],
                    ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            arrow_id = batch.column(0).type
            for part in (batch.slice(i, SLICE_DOCS) for i in range(0, batch.num_rows, SLICE_DOCS)):
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    ids += end
                    n, at = len(ids) // 4, 0
                    for length in piece_lengths(n, capacity, slack):
                        bins.put(Piece(doc, at, ids[4 * at:4 * (at + length)], n))
                        at += length
                yield from emit()
        bins.finish()
        yield from emit()

    packed = rows.mapInArrow(run, f"_id {id_type}, {PLACES}").withColumnRenamed("_id", id_col)
    return packed if with_ids else packed.drop("ids")


def padding_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, tokens, padding (tokens up to ``capacity``, none at a power of two), pieces, documents cut."""
    filled = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n"), F.count(F.lit(1)).alias("pieces"),
        F.sum((F.col("length") < F.col("doc_tokens")).cast("long")).alias("parts"))
    power = F.expr("n & (n - 1)") == 0
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    return filled.agg(F.count(F.lit(1)).alias("sequences"), total("n", "tokens"),
                      total(F.when(power, 0).otherwise(capacity - F.col("n")), "padding"),
                      total("pieces", "pieces"), total("parts", "pieces_of_cut_documents"))
