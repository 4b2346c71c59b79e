"""Sum-of-squares packing of tokenised documents into sequences.

Documents longer than a sequence are cut into pieces first.  Pieces are dealt
by a hash into shards of about ``SHARD_ROWS`` pieces, and each shard is packed
by one task: pieces come in falling length, and each goes into the open
sequence after which the sum, over residual gaps, of the squared number of open
sequences with that gap is smallest; a new sequence is opened only when none
has room.  Only lengths decide, so a shard's state is one count per gap.  Each
shard leaves a few open sequences, a bounded loss per ``SHARD_ROWS`` pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.bpe import class_table, pretokens
from tallyframe.llm.common import written

CAPACITY = 2048
SHARD_ROWS = 50_000
END_ID = 0
MEMO_ENTRIES = 600_000       # bounded memory of a worker
MEMO_CHARS = 64
PIECES = "piece int, start long, length long, ids_crc32 long, ids binary"


def byte_ranks(tokenizer_json: str) -> dict[bytes, int]:
    """Ranks of a byte-level BPE tokeniser file: its vocabulary, written as bytes again (special tokens left out)."""
    spec = json.loads(tokenizer_json)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]     # bytes that stand for themselves; the others follow from 256 on
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {t["content"] for t in spec["added_tokens"]}
    return {bytes(map(byte_of.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in special}


class Tokens(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers, by the ranks of a tokeniser file."""

    def __init__(self, tokenizer_json: str, classes: bytes) -> None:
        super().__init__()
        import tiktoken

        # Merging one pre-token at a time, this gives the tokeniser's own ids in a quarter of its time.
        self.merge = tiktoken.Encoding("pieces", pat_str=r"\S+|\s+", mergeable_ranks=byte_ranks(tokenizer_json),
                                       special_tokens={})._encode_single_piece
        self.classes = np.frombuffer(classes, dtype=np.uint8)
        added = json.loads(tokenizer_json)["added_tokens"]
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that depend on the text around them")
        self.added = {t["content"]: array("I", [t["id"]]).tobytes() for t in added}
        names = sorted(self.added, key=len, reverse=True)     # the longest counts where several start
        self.split = re.compile("(" + "|".join(map(re.escape, names)) + ")").split if names else lambda text: [text]

    def __missing__(self, piece: str) -> bytes:
        out = array("I", self.merge(piece)).tobytes()
        if len(piece) <= MEMO_CHARS:
            self[piece] = out
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > MEMO_ENTRIES:                      # only between batches
            self.clear()
        parts = [self.split(text) if any(map(text.__contains__, self.added)) else [text] for text in texts]
        coded = iter(pretokens([p for own in parts for p in own[::2]], self.classes))     # every other part is an added token
        return [b"".join(self.added[p] if k % 2 else b"".join(map(self.__getitem__, next(coded))) for k, p in enumerate(own))
                for own in parts]


_tokens: dict[int, Tokens] = {}


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: only the first may be shorter than ``capacity``, if there are more."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *[(a, capacity) for a in range(first, n, capacity)]]


def token_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: ``id_col``, piece, start, length, ids_crc32 and, if asked for, ids (else null).

    A document's ids are the tokeniser's, then ``END_ID``.  The tokeniser file
    is read on the driver and broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast((f.read(), class_table("tokenizers")))
    key = zlib.crc32(shared.value[0].encode())
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _tokens:
            _tokens[key] = Tokens(*shared.value)
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                rows, cut, crc, own = [], [], [], []
                for k, ids in enumerate(_tokens[key].encode(part.column(1).to_pylist())):
                    ids += END_ID.to_bytes(4, "little")
                    for number, (a, n) in enumerate(cut_points(len(ids) // 4, capacity)):
                        data = ids[4 * a:4 * (a + n)]
                        rows.append(k)
                        cut.append((number, a, n))
                        crc.append(zlib.crc32(data))
                        own.append(data if with_ids else None)
                number, start, length = zip(*cut, strict=True) if cut else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(own, pa.binary())],
                    ["_id", "piece", "start", "length", "ids_crc32", "ids"])

    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, {PIECES}").withColumnRenamed("_id", id_col)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each of the lengths (falling; each between 1 and ``capacity``)."""
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    count = np.zeros(capacity + 1, dtype=np.int64)        # open sequences by residual gap; 0 stays 0: full ones don't count
    members: list[list[int]] = [[] for _ in range(capacity + 1)]
    opened = 0
    for k, size in enumerate(lengths.tolist()):
        # Moving a sequence from gap g to gap g - size changes the sum by 2 * (count[g - size] - count[g]) + 2,
        # or by 1 - 2 * count[g] when it gets full.
        have = count[size:capacity]
        change = 2 * (count[:capacity - size] - have) + 2
        if len(change):
            change[0] = 1 - 2 * have[0]
        change[have == 0] = np.iinfo(np.int64).max
        best = int(change.argmin()) if len(change) else 0
        if len(change) and have[best]:
            gap = size + best
            which = members[gap].pop()
            count[gap] -= 1
        else:
            gap, which, opened = capacity, opened, opened + 1
        sequence[k], offset[k] = which, capacity - gap
        if gap > size:
            count[gap - size] += 1
            members[gap - size].append(which)
    return sequence, offset


def pack(pieces: DataFrame, key_cols: tuple[str, ...], length_col: str = "length", capacity: int = CAPACITY,
         shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` (long) and ``offset`` (long, gapless from 0 in each sequence).

    ``key_cols`` and the row's place in the table decide its shard, so that
    rows with equal keys are spread as well; ``key_cols`` order equal lengths;
    ``pieces`` should be a written table, as it is counted first.
    Defined cases: lengths must lie between 1 and ``capacity`` (an error
    otherwise); null keys and repeated rows are packed like others; an empty
    table gives an empty result.
    """
    shards = max(1, -(-pieces.count() // shard_rows))
    rows = pieces.withColumn("_shard", F.pmod(F.xxhash64(*key_cols, F.monotonically_increasing_id()), F.lit(shards)).cast("long"))
    out = rows.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def run(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(group))
        table = table.sort_by([(length_col, "descending"), *[(c, "ascending") for c in key_cols]])
        lengths = table[length_col].to_numpy()
        if len(lengths) and not (lengths[-1] >= 1 and lengths[0] <= capacity):
            raise ValueError(f"lengths must lie between 1 and {capacity}")
        sequence, offset = sum_of_squares(lengths, capacity)
        table = table.append_column("sequence_id", pa.array((key[0].as_py() << 40) + sequence))
        yield from table.append_column("offset", pa.array(offset)).to_batches()

    return rows.groupBy("_shard").applyInArrow(run, out).drop("_shard")


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with their places.

    Defined cases: a null text counts as empty; an empty text is one piece that
    holds only ``END_ID``; null ids and repeated rows each get their own pieces;
    an empty table gives an empty result; extra columns are ignored.
    """
    pieces = token_pieces(df, tokenizer_path, id_col, text_col, capacity, with_ids)
    if not with_ids:
        return pack(written(pieces.drop("ids"), "pieces"), (id_col, "piece"), "length", capacity)
    # A shard holds lengths only; the ids meet their places afterwards.
    pieces = written(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    packed = pack(pieces.drop("ids"), (id_col, "piece"), "length", capacity)
    return packed.join(pieces.select("_row", "ids"), "_row").drop("_row")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids (binary), from a result of ``pack_documents(..., with_ids=True)``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))      # at most ``capacity`` pieces
    joined = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda done, x: F.concat(done, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
