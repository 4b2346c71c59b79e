"""Byte-level BPE: encoding with a two-tier lookup, and decoding.

A text is cut into pre-tokens.  Tier one: a minimal perfect hash over the
vocabulary (hash and displace, one slot per token, the key in the slot is
compared) resolves a pre-token that is a vocabulary entry as a whole.  Tier
two: any other pre-token starts as its single bytes in a doubly linked list,
and a heap of (rank, position) repeatedly joins the neighbouring pair of lowest
rank, the leftmost first.

The vocabulary (a fixed file of about 50,000 entries) and a table with one
byte per Unicode code point are broadcast: both have a fixed size whatever the
data.  The pre-token pattern is the usual one for these vocabularies; the table
of its letter and number classes is read off the tokeniser library itself, so
both agree on every code point.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The suffixes that the pattern cuts off after an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

OTHER, LETTER, NUMBER, SPACE, END = 0, 1, 2, 3, 4
SEPARATOR = "\U0010ffff"     # a noncharacter
MEMO_ENTRIES = 600_000       # bounded memory of a worker; beyond it the memo starts anew
MEMO_CHARS = 64              # longer pre-tokens are not kept
MASK = (1 << 64) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its id per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def class_table(library: str = "tiktoken") -> bytes:
    """Class of every code point (one byte each), as the tokeniser library's pattern engine sees it."""
    points = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    table = bytearray(0x110000)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        if library == "tiktoken":
            import tiktoken

            single = {bytes([i]): i for i in range(256)}
            enc = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
            found = bytes(enc.encode_ordinary(points)).decode()
        else:
            from tokenizers import Regex
            from tokenizers.pre_tokenizers import Split

            cutter = Split(Regex(pattern + "+"), "removed", invert=True)
            found = "".join(piece for piece, _ in cutter.pre_tokenize_str(points))
        for c in map(ord, found):
            table[c] = kind
    table[ord(SEPARATOR)] = END
    return bytes(table)


def pretokens(texts: list[str], classes: np.ndarray) -> list[list[str]]:
    """The pre-tokens of each text.

    Equals repeated matching of
    ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?other+|\\s+(?!\\S)|\\s+``.
    The texts are joined by a separator that has a class of its own and cut
    together; a text that holds the separator itself is cut at it and joined anew.
    """
    if any(SEPARATOR in t for t in texts):
        return [_with_separator(t, classes) if SEPARATOR in t else pretokens([t], classes)[0] for t in texts]
    text = SEPARATOR.join(texts) + SEPARATOR
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    kind = classes[points]
    cut = _cuts(text, points, kind)
    at = np.flatnonzero(cut)
    stops = np.flatnonzero(kind[at] == END)               # the separators are pre-tokens too: they end the texts
    at = at.tolist()
    pieces = [text[a:b] for a, b in zip(at, at[1:], strict=False)]
    out, last = [], 0
    for stop in stops.tolist():
        out.append(pieces[last:stop])
        last = stop + 1
    return out


def _with_separator(text: str, classes: np.ndarray) -> list[str]:
    """A text that holds the separator: there, it is what its own class says (neither letter, number nor space)."""
    classes = classes.copy()
    classes[ord(SEPARATOR)] = OTHER
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    at = [*np.flatnonzero(_cuts(text, points, classes[points])).tolist(), len(text)]
    return [text[a:b] for a, b in zip(at, at[1:], strict=False)]


def _cuts(text: str, points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """True where a pre-token starts."""
    n = len(points)
    cut = np.ones(n, dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    cut |= kind == END
    first = np.flatnonzero(cut)                           # runs of one class
    ends = np.append(first[1:], n)
    run_kind = kind[first]
    follows = np.append(run_kind[1:], END)                # class of the next run; END at the end of a text
    # White space before something: its last character stands alone, or joins what follows if it is a blank.
    tail = ends[(run_kind == SPACE) & (follows != END)] - 1
    cut[tail] = True
    cut[tail[points[tail] == 32] + 1] = False
    # A lone apostrophe that starts a match takes s, t, re, ve, m, ll or d from the letters after it.
    lone = first[(ends - first == 1) & (points[first] == 39) & (follows == LETTER)]
    for i in lone[cut[lone]].tolist():
        for suffix in CONTRACTIONS:
            if text.startswith(suffix, i + 1):
                cut[i + 1] = False
                if i + 1 + len(suffix) < n:
                    cut[i + 1 + len(suffix)] = True
                break
    return cut


class PerfectHash:
    """Minimal perfect hash over byte strings: as many slots as keys, each slot checked against its key.

    Hash and displace: keys fall into buckets by half of a 128-bit hash; from
    the largest bucket on, the smallest displacement that puts a whole bucket
    into free slots is kept.  A bucket of one key names its slot directly.
    """

    def __init__(self, keys: list[bytes]) -> None:
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 4)
        hashes = [xxhash.xxh3_128_intdigest(k) for k in keys]
        lo = np.array([h & MASK for h in hashes], dtype=np.uint64)
        hi = np.array([h >> 64 for h in hashes], dtype=np.uint64)
        bucket = (hi % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(starts)
        self.displace = [0] * self.buckets
        slots: list[int] = [-1] * n                  # slot -> key number
        free = np.ones(n, dtype=bool)
        odd = hi | np.uint64(1)
        for b in np.argsort(-sizes, kind="stable").tolist():
            members = order[starts[b]:starts[b + 1]]
            if len(members) < 2:
                break
            h, step = lo[members], odd[members]
            for d0 in range(0, 1 << 30, 256):
                d = np.arange(d0, d0 + 256, dtype=np.uint64)
                spots = (((h[None, :] + d[:, None] * step[None, :]) >> np.uint64(11)) % np.uint64(n)).astype(np.int64)
                ok = free[spots].all(axis=1)
                found = next((i for i in np.flatnonzero(ok).tolist() if len(set(spots[i].tolist())) == len(members)), -1)
                if found >= 0:
                    self.displace[b] = d0 + found
                    for key, spot in zip(members.tolist(), spots[found].tolist(), strict=True):
                        slots[spot] = key
                        free[spot] = False
                    break
        rest = iter(np.flatnonzero(free).tolist())
        for b in np.flatnonzero(sizes == 1).tolist():
            spot = next(rest)
            self.displace[b] = -spot - 1
            slots[spot] = int(order[starts[b]])
        self.slots = slots
        self.keys = [keys[k] for k in slots]

    def __call__(self, key: bytes) -> int:
        """The key's number, or -1 if it isn't one of the keys."""
        h = xxhash.xxh3_128_intdigest(key)
        hi = h >> 64
        d = self.displace[hi % self.buckets]
        spot = -d - 1 if d < 0 else ((((h & MASK) + d * (hi | 1)) & MASK) >> 11) % self.n
        return self.slots[spot] if self.keys[spot] == key else -1


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merging: a heap over linked bytes, lowest rank first, leftmost among equals."""
    n = len(piece)
    parts: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
    after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    heap = [(r, i) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        left = parts[i]
        if left is None or (j := after[i]) >= n:
            continue
        joined = left + parts[j]
        if get(joined) != rank:                      # an entry from before one side changed
            continue
        parts[i], parts[j] = joined, None
        k = after[i] = after[j]
        if k < n:
            prior[k] = i
            if (r := get(joined + parts[k])) is not None:
                heappush(heap, (r, i))
        h = prior[i]
        if h >= 0 and (r := get(parts[h] + joined)) is not None:
            heappush(heap, (r, h))
    return [ranks[p] for p in parts if p is not None]


class Codec(dict):
    """Encodes and decodes texts; as a mapping: pre-token -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], classes: bytes) -> None:
        super().__init__()
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.ranks = ranks
        self.classes = np.frombuffer(classes, dtype=np.uint8)
        tokens = list(ranks)
        self.ids = [ranks[t] for t in tokens]
        self.find = PerfectHash(tokens)
        self.tokens = {i: t for t, i in ranks.items()}

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        k = self.find(raw)
        ids = [self.ids[k]] if k >= 0 else merge_bytes(raw, self.ranks)
        out = array("I", ids).tobytes()
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = out
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        return [b"".join(map(self.__getitem__, pieces)) for pieces in pretokens(texts, self.classes)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_codecs: dict[str, Codec] = {}


def worker_codec(key: str, ranks: Callable[[], dict[bytes, int]], classes: Callable[[], bytes]) -> Codec:
    """One codec per Python worker and vocabulary."""
    if key not in _codecs:
        _codecs[key] = Codec(ranks(), classes())
    return _codecs[key]


def encode_documents(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (binary, the ids decoded).

    ``vocabulary`` is the path of a rank file on the driver.  Defined cases: a
    null text counts as empty; an empty text has no ids and decodes to no bytes;
    null ids and repeated rows are kept as they are; texts of any length are
    encoded whole; an empty table gives an empty result; other columns are
    ignored.
    """
    spark = df.sparkSession
    ranks = read_ranks(vocabulary)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    shared = spark.sparkContext.broadcast((ranks, class_table()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        codec = worker_codec(key, lambda: shared.value[0], lambda: shared.value[1])
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                ids = codec.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.binary())],
                    ["_id", "ids", "decoded"])

    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {id_type}, ids binary, decoded binary").withColumnRenamed("_id", id_col)


def decode_ids(df: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the bytes of the ids in ``ids_col`` (binary as above; null stays null)."""
    tokens = {i: t for t, i in read_ranks(vocabulary).items()}
    shared = df.sparkSession.sparkContext.broadcast(tokens)

    @F.pandas_udf("binary")
    def decode(column):  # noqa: ANN001, ANN202
        get = shared.value.__getitem__
        return column.map(lambda b: None if b is None else b"".join(map(get, np.frombuffer(b, dtype="<u4").tolist())))

    return df.withColumn(out_col, decode(F.col(ids_col)))
