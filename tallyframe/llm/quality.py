"""Quality filter: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words, marks and their pairs (a text's units and neighbouring units) are hashed into buckets, as many as the power of
two that holds the distinct n-grams of the input (at least ``LEAST_BUCKETS``).  Two
multinomials are counted over whole texts: the target from trusted rows, the
raw one from every document.  A document's score is the mean, over its own
n-grams, of log(target probability / raw probability); dividing by the number
of n-grams keeps long texts from being judged by their length.  Every document
is decided by the same fixed threshold.

Only counts leave the tasks.  Each adds up ``HELD_GRAMS`` n-grams at a time and
sends them as sorted hashes, cut into slices of the hash range and gap-coded (one
to two bytes an n-gram); a slice's counts are summed in one group, whose size
follows from the number of slices.  The fitted table has one byte a bucket (a code
for the few pairs of counts that a slice has; rare ones are listed apart).  It
grows with the vocabulary, so it is no broadcast: Spark hands it to the executors as one file,
which their workers map into memory and share.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import sketch
from tallyframe.llm.common import written
from tallyframe.session import shared_dir

LEAST_BUCKETS = 1 << 16
SLICE_BYTES = 1 << 22        # of text, for each slice of the hash range: bounds the counts that are summed in one group
HELD_GRAMS = 2_000_000       # bounded memory of a task
RARE = 255                   # code of a bucket whose value is listed apart
RARE_BLOCK_BITS = 8          # buckets of a block, whose listed values are found together
#: Added to every count: half a count for each bucket keeps unseen n-grams neutral.
SMOOTHING = 0.5
#: Documents below this mean log ratio (nats per n-gram) are rejected.
THRESHOLD = -0.5
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30

# Fixed values of the base rules: words are runs of other characters than BLANKS (what bytes.split cuts at).
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MEMO_ENTRIES = 300_000
#: Letter case and digits are told for code points below this; above, characters stand for themselves.
CASED = 0x3000
BLOCK_CHARS = 1 << 18
#: Kinds of characters: blank, part of a word (letters, digits, _ and all beyond ASCII), mark.
BLANK, WORD, MARK = 0, 1, 2
_FACTOR = 0x9E3779B97F4A7C15


class _Tables:
    """What a character is, and the powers of the hash, up to a block's length and more if one block needs it."""

    def __init__(self) -> None:
        chars = [chr(c) for c in range(CASED)]
        self.kind = np.array([BLANK if c in BLANKS else WORD if ord(c) >= 128 or c.isalnum() or c == "_" else MARK for c in chars] + [WORD], np.uint8)
        self.low = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars] + [0], np.uint64)
        # One number counts the upper-case, lower-case and digit characters of a unit side by side.
        self.flags = np.array([c.isupper() + ((c.islower() or c.istitle() and not c.isupper()) << 21) + (c.isdigit() << 42) for c in chars] + [0], np.int64)
        self.power = self.back = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            size = max(n, 2 * BLOCK_CHARS)
            inverse = pow(_FACTOR, -1, 1 << 64)
            self.power, self.back = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, f, np.uint64)]), dtype=np.uint64)
                                     for f in (_FACTOR, inverse))
        return self.power, self.back


_tables: list[_Tables] = []


def _block_hashes(text: str) -> np.ndarray:
    if not _tables:
        _tables.append(_Tables())
    t = _tables[0]
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = np.minimum(points, CASED).astype(np.intp)
    kind = t.kind[at]
    turns = kind[1:] != kind[:-1]
    first = np.flatnonzero(np.append(kind[:1] != BLANK, turns & (kind[1:] != BLANK)))
    if not len(first):
        return np.zeros(0, np.uint64)
    last = np.flatnonzero(np.append(turns & (kind[:-1] != BLANK), kind[-1:] != BLANK))
    low = t.low[at]
    far = np.flatnonzero(points >= CASED)
    low[far] = points[far]
    power, back = t.powers(len(points))
    sums = np.cumsum((low + np.uint64(1)) * power[:len(points)], dtype=np.uint64)
    value = (sums[last] - np.where(first > 0, sums[first - 1], np.uint64(0))) * back[first]
    size = (last - first + 1).astype(np.uint64)
    word = kind[first] == WORD
    counts = np.add.reduceat(t.flags[at], first)          # the blanks after a unit count nothing
    uppers, lowers, digits = counts & (1 << 21) - 1, counts >> 21 & (1 << 21) - 1, counts >> 42
    capitals = word & (size > 1) & (uppers > 0) & (lowers == 0)
    number = word & ~capitals & (digits == size.astype(np.int64))
    value = value * np.uint64(2) + size * np.uint64(0x94D049BB133111EB) + word
    value[capitals] = 1
    value[number] = np.uint64(2) + np.minimum(size[number], np.uint64(20))
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


def unit_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's units, in order.

    A unit is a run of letters, digits, _ and characters beyond ASCII, or a run of marks.
    Words lose their case; words in capitals are all alike, numbers of equal length too.
    A long text is cut into blocks at blanks.
    """
    if len(text) <= BLOCK_CHARS:
        return _block_hashes(text)
    found, at = [], 0
    while at < len(text):
        end = min((k for k in (text.find(b, at + BLOCK_CHARS) for b in BLANKS) if k >= 0), default=len(text))
        found.append(_block_hashes(text[at:end]))
        at = end
    return np.concatenate(found)


class _Numbers(dict):
    """Word -> its number, given at first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Words:
    """A worker's bounded memory of words: each has a number."""

    def __init__(self, entries: int = MEMO_ENTRIES) -> None:
        self.entries, self.numbers = entries, _Numbers()

    def number(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers: equal exactly for equal words of one text."""
        if len(self.numbers) > self.entries:          # only between texts
            self.numbers = _Numbers()
        return np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words))

    def units(self, numbers: np.ndarray) -> np.ndarray:
        """Hashes of the units of numbered words."""
        words = list(self.numbers)
        return unit_hashes(b" ".join(words[n] for n in numbers.tolist()).decode())


def ngrams(units: np.ndarray) -> np.ndarray:
    """Hashes of a text's units and pairs; every unit that repeats the one before it is one and the same pair."""
    pairs = (units[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (units[1:] + (units[:-1] >> np.uint64(31)))
    pairs[units[1:] == units[:-1]] = 1
    both = np.concatenate([units, pairs])
    both ^= both >> np.uint64(29)
    return both * np.uint64(0xBF58476D1CE4E5B9)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words lying in a ``window``-word window that occurs at least twice in the text (exact)."""
    if len(ids) - window + 1 < 2:
        return 0
    # Name windows of 2, 4, 8 ... words by pairs of names of shorter ones; the words' numbers are their names.
    names, width = ids, 1
    while width < window:
        step = min(width, window - width)
        size = len(names) - step
        distinct, names = np.unique(names[:size] * (int(names.max()) + 1) + names[step:], return_inverse=True)
        width += step
        if len(distinct) == len(names):
            return 0                                  # all distinct: so are all longer windows
    starts = np.flatnonzero((np.bincount(names) > 1)[names])
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def base_signals(text: str, raw: bytes, ids: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text with these word numbers."""
    seen: set[bytes] = set()
    dup_lines = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup_lines += 1
        elif line and not line.isspace():
            seen.add(line)
    return len(ids), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup_lines, repeated_words(ids)


_words = Words()


def _planes(values: np.ndarray) -> tuple[int, bytes]:
    """Whole numbers as planes of bytes, lowest first, without the empty upper ones."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return width, values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys as gaps, and their counts."""
    (a, gaps), (b, times) = _planes(np.diff(keys, prepend=np.uint64(0))), _planes(counts.astype(np.uint64) - np.uint64(1))
    return len(keys).to_bytes(4, "little") + bytes([a, b]) + zlib.compress(gaps + times, 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, a, b = int.from_bytes(data[:4], "little"), data[4], data[5]
    raw = zlib.decompress(data[6:])
    return np.cumsum(_from_planes(raw[:n * a], n, a), dtype=np.uint64), _from_planes(raw[n * a:], n, b) + np.uint64(1)


@dataclass(frozen=True)
class Grid:
    """Resolution of the counted hashes and number of slices, as powers of two, from the bytes of all texts."""

    bits: int                # at least as many as a bucket has: a text has at most two n-grams a byte
    slice_bits: int

    @staticmethod
    def of(text_bytes: int) -> Grid:
        return Grid(max(20, (2 * text_bytes).bit_length() + 2), max(6, (text_bytes // SLICE_BYTES).bit_length()))


def _count(grid: Grid, marks=None):  # noqa: ANN001, ANN202
    """Task function: (slice, packed counts) of the n-grams; the lowest bit of a key tells whether its text is trusted.

    With ``marks`` (a broadcast bitmap), rows whose third column may be in it are left out.
    """
    def sent(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        shift = np.uint64(grid.bits + 1 - grid.slice_bits)
        slices = keys >> shift
        starts = np.flatnonzero(np.diff(slices, prepend=slices[:1] + np.uint64(1)))
        rows = [(int(slices[i]), packed(keys[i:j] - (slices[i] << shift), counts[i:j])) for i, j in zip(starts, [*starts[1:], len(keys)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["slice", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for batch in batches:
            if marks is not None:
                batch = batch.filter(pa.array(~sketch.in_bitmap(marks.value, batch.column(2).to_numpy())))
            for text, trusted in zip(batch.column(0), batch.column(1), strict=True):
                found = ngrams(unit_hashes(text.as_py()))
                held.append((found >> np.uint64(64 - grid.bits) << np.uint64(1)) | np.uint64(trusted.as_py()))
                waiting += len(found)
                if waiting > HELD_GRAMS:
                    yield from sent(held)
                    held, waiting = [], 0
        if waiting:
            yield from sent(held)

    return run


def _sum(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a slice, added up."""
    parts = [unpacked(data.as_py()) for batch in group for data in batch.column("counts")]
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    parts.clear()
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    keys, counts = keys[starts], np.add.reduceat(counts, starts)
    grams = keys >> np.uint64(1)
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int64()), pa.array([1 + int((grams[1:] != grams[:-1]).sum())], pa.int64()), pa.array([int(counts.sum())], pa.int64()),
         pa.array([int(counts[(keys & np.uint64(1)) == 1].sum())], pa.int64()), pa.array([packed(keys, counts)], pa.binary())],
        ["slice", "n", "raw", "target", "counts"])


def _codes(grid: Grid, bits: int, base: float):  # noqa: ANN202
    """Task function: a slice's counts as one code a bucket, the values of the codes, and the buckets with rare values."""
    width = 1 << (bits - grid.slice_bits)

    def one(data: bytes) -> tuple[bytes, bytes, bytes, bytes]:
        keys, counts = unpacked(data)
        at = (keys >> np.uint64(1 + grid.bits - bits)).astype(np.int64)
        trusted = (keys & np.uint64(1)).astype(bool)
        raw = np.bincount(at, weights=counts, minlength=width).astype(np.int64)
        target = np.bincount(at[trusted], weights=counts[trusted], minlength=width).astype(np.int64)
        ratio = (np.log(target + SMOOTHING) - np.log(raw + SMOOTHING) + base).astype("<f4")
        values, which = np.unique(ratio, return_inverse=True)
        uses = np.bincount(which, weights=raw, minlength=len(values))      # how often texts will ask for the value
        common = np.argsort(-uses, kind="stable")[:RARE]
        code = np.full(len(values), RARE, dtype=np.uint8)
        code[common] = np.arange(len(common), dtype=np.uint8)
        codes = code[which]
        book = np.zeros(RARE + 1, dtype="<f4")
        book[:len(common)] = values[common]
        rare = np.flatnonzero(codes == RARE)
        return zlib.compress(codes.tobytes(), 1), book.tobytes(), rare.astype("<u8").tobytes(), ratio[rare].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column("slice"), batch.column("counts"), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([number.as_py()], pa.int64()), *[pa.array([x], pa.binary()) for x in one(data.as_py())]],
                                                 ["slice", "codes", "book", "rare", "values"])

    return run


@dataclass
class Ratios:
    """The fitted log ratios: where each slice lies in the file, and the file's layout."""

    file: str                # name of the file that Spark hands to the executors
    path: str                # the file in the shared folder
    bits: int
    slice_bits: int
    places: np.ndarray       # of each slice; the last place in the file is one of empty buckets
    n_places: int
    n_rare: int

    def __post_init__(self) -> None:
        self._open = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_open": None}

    def _parts(self) -> tuple[np.ndarray, ...]:
        """Codes, values of the codes, and the places and values of the rare buckets (views of the mapped file), and
        where the rare buckets of every block of buckets start."""
        if self._open is None:
            data = np.memmap(SparkFiles.get(self.file), dtype=np.uint8, mode="r")
            n = self.n_places
            sizes = [n << (self.bits - self.slice_bits), n * 4 * (RARE + 1), 8 * self.n_rare, 4 * self.n_rare]
            ends = np.cumsum(sizes)
            codes, books, rare, values = (data[end - size:end] for size, end in zip(sizes, ends, strict=True))
            rare = rare.view("<i8")
            starts = np.searchsorted(rare, np.arange(0, len(codes), 1 << RARE_BLOCK_BITS)).astype(np.int64)
            self._open = codes, books.view("<f4"), rare, values.view("<f4"), starts
        return self._open

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Log ratio of every hash's bucket."""
        codes, books, rare, values, starts = self._parts()
        local = self.bits - self.slice_bits
        place = self.places[(hashes >> np.uint64(64 - self.slice_bits)).astype(np.int64)]
        at = place << local
        if local:
            at = at + ((hashes << np.uint64(self.slice_bits)) >> np.uint64(64 - local)).astype(np.int64)
        code = codes[at]
        out = books[place * (RARE + 1) + code]
        odd = np.flatnonzero(code == RARE)               # the frequent n-grams among others, so no binary search
        if len(odd):
            wanted = at[odd]
            found = starts[wanted >> RARE_BLOCK_BITS]
            while (before := rare[found] < wanted).any():
                found += before
            out[odd] = values[found]
        return out


def fit_ratios(texts: DataFrame, text_col: str, trusted_col: str, text_bytes: int | None = None, buckets: int | None = None,
               others: tuple[DataFrame, str, Broadcast] | None = None) -> Ratios | None:
    """Log ratios from every row of ``texts``; rows with a true ``trusted_col`` also count as target.  None without any of these.

    ``others`` (table, key column, bitmap; then with ``text_bytes`` of all) holds more texts, none of them trusted:
    those rows count whose key isn't in the bitmap.  The task that counts them asks the bitmap.
    """
    spark = texts.sparkSession
    rows = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"), F.coalesce(F.col(trusted_col), F.lit(False)).alias("trusted"))
    if text_bytes is None:
        text_bytes = rows.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    grid = Grid.of(text_bytes)
    counts = rows.mapInArrow(_count(grid), "slice long, counts binary")
    if others is not None:
        more, key, marks = others
        counts = counts.unionAll(more.select(F.coalesce(F.col(text_col), F.lit("")), F.lit(False), F.col(key))
                                 .mapInArrow(_count(grid, marks), "slice long, counts binary"))
    grams = written(counts.groupBy("slice")
                    .applyInArrow(_sum, "slice long, n long, raw long, target long, counts binary"), "quality_grams")
    n, all_raw, all_target = grams.agg(F.sum("n"), F.sum("raw"), F.sum("target")).first()
    if not all_target:
        return None
    if buckets is None:
        buckets = max(LEAST_BUCKETS, 1 << grid.slice_bits, 1 << max(0, n - 1).bit_length())
    bits = min(grid.bits, buckets.bit_length() - 1)
    base = float(np.log(all_raw + SMOOTHING * (1 << bits)) - np.log(all_target + SMOOTHING * (1 << bits)))
    coded = grams.select("slice", "counts").mapInArrow(_codes(grid, bits, base), "slice long, codes binary, book binary, rare binary, values binary")
    return _stored(spark, coded, grid, bits, base)


def _stored(spark: SparkSession, coded: DataFrame, grid: Grid, bits: int, base: float) -> Ratios:
    """The table as one file in the shared folder, which Spark hands to every executor; the driver holds a slice at a time."""
    width = 1 << (bits - grid.slice_bits)
    name = f"quality_{uuid.uuid4().hex[:12]}.bin"
    path = f"{shared_dir(spark, 'llm', 'quality_table')}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    places = np.full(1 << grid.slice_bits, -1, dtype=np.int64)
    books, rare, values = [], [], []
    try:
        for place, row in enumerate(coded.toLocalIterator()):
            places[row["slice"]] = place
            out.write(bytearray(zlib.decompress(row["codes"])))
            books.append(row["book"])
            rare.append((np.frombuffer(row["rare"], "<u8") + np.uint64(place * width)).tobytes())
            values.append(row["values"])
        empty = np.zeros(RARE + 1, dtype="<f4")
        empty[0] = base                                  # no counts: both smoothed alike
        books.append(empty.tobytes())
        out.write(bytearray(width))
        for part in (books, rare, values):
            out.write(bytearray(b"".join(part)))
    finally:
        out.close()
    places[places < 0] = len(books) - 1
    spark.sparkContext.addFile(path)
    return Ratios(name, path, bits, grid.slice_bits, places, len(books), sum(map(len, rare)) // 8)


def fit(texts: DataFrame, text_col: str, trusted_col: str, buckets: int | None = None) -> np.ndarray:
    """The table of :func:`fit_ratios` as one array, for tables that fit in memory: log ratio per bucket, 0 without trusted rows."""
    found = fit_ratios(texts, text_col, trusted_col, buckets=buckets)
    if found is None:
        return np.zeros(buckets or LEAST_BUCKETS, dtype=np.float32)
    return found.of(np.arange(1 << found.bits, dtype=np.uint64) << np.uint64(64 - found.bits))


def assess(text: str, ratios: Ratios | None) -> tuple[tuple[int, int, int, int, int], float]:
    """Base signals of a text and the mean log ratio of its n-grams (0 without any)."""
    raw = text.encode()
    ids = _words.number(raw.split())
    found = ngrams(unit_hashes(text)) if ratios is not None else ()
    return base_signals(text, raw, ids), float(ratios.of(found).mean(dtype=np.float64)) if len(found) else 0.0


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: id, ``carry`` columns, base signals, llr, ``base_failed`` and ``kept``.

    ``trusted`` holds the ids of trusted documents in ``id_col``.

    Defined cases: a null text counts as empty and fails the base rules; a
    document without n-grams scores 0; without any trusted row every score is
    0; null ids are never trusted; repeated rows are counted and judged one by
    one; an empty table gives an empty result; extra columns are ignored unless
    carried.
    """
    good = trusted.select(F.col(id_col).alias("_trusted_id")).where("_trusted_id is not null").distinct().withColumn("_trusted", F.lit(True))
    # Most rows are told apart by a bitmap of bounded size; only those that may be trusted are joined.
    # The join is a sort-merge join at every size: its texts grow with the data.
    bits = sketch.bits_for(good.count(), 32)
    marks = docs.sparkSession.sparkContext.broadcast(sketch.bitmap(good.select(F.xxhash64("_trusted_id").alias("_mix")), bits))

    @F.pandas_udf("boolean")
    def may_be(mix):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(sketch.in_bitmap(marks.value, mix.to_numpy()))

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(id_col).alias("_mix"))
    asked = rows.where(may_be("_mix")).join(good.hint("merge"), F.col("_id") == F.col("_trusted_id"), "left").select("_text", "_trusted")
    text_bytes = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    ratios = fit_ratios(asked, "_text", "_trusted", text_bytes, others=(rows, "_mix", marks))
    rows = docs.select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)],
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = rows.drop("_text").withColumns({c: F.lit(0).cast("long") for c in names} | {"llr": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = [assess(t, ratios) for t in texts]
            signals = np.array([s for s, _ in found], dtype=np.int64).reshape(-1, len(names))
            llr = [x for _, x in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(signals[:, i]) for i in range(len(names))], pa.array(llr, pa.float64())],
                [f.name for f in out])

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.mapInArrow(run, out).select(
        F.col("_id").alias(id_col), *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)], *names, "llr",
        failed.alias("base_failed"), (~failed & (F.col("llr") >= threshold)).alias("kept"))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents marked as good in ``labels``."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
