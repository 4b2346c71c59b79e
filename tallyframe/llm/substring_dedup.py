"""Removal of repeated substrings, exact to the byte, by sorting suffixes at sampled places.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else.  Sorting a suffix for every byte of the corpus would move hundreds of
times its size, so suffixes are taken at anchors only: each ``length``-byte
window names the place of the smallest hash among its ``GRAM``-byte grams.
Equal windows name the same place, so they meet at equal grams, and nothing is
missed.  There is an anchor about every 85 bytes.

1. Count: an anchor's gram must occur at two places in different texts, or at
   two places of one text, to go on.  Grams that do are marked in a bitmap of
   bounded size that is broadcast; a false mark costs traffic, not correctness.
2. Contexts: each remaining anchor gives the bytes of all windows that name it
   (at most 2 * length - GRAM).  Equal contexts are counted; one that occurs
   twice is repeated from end to end.
3. Sort: the different contexts of one gram are sorted by what follows the
   anchor (deep-shallow sorting), which gives the tree of their common
   prefixes.  In each of its nodes, sorting the members by what lies before the
   anchor, backwards, gives each member's longest match to the left; with the
   node's depth to the right that is the longest repeated string around the
   anchor for that depth.  Grams of more than ``GROUP_ROWS`` different contexts
   are done by counting the hashes of their windows instead, which needs no group.
4. Spans are gathered per text (by a 128-bit hash, so equal texts share them) and cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import sketch
from tallyframe.llm.common import written
from tallyframe.llm.suffix_sort import common_prefix, deep_shallow_sort

LENGTH = 200
GRAM = 32
GROUP_ROWS = 20_000
LEAST_BITS, MOST_BITS = 1 << 22, 1 << 28          # of a broadcast bitmap (32 MB at most)
SLAB = 1 << 23                                    # very long texts are sampled in overlapping slabs
PLACE_BITS = 24
CONTEXT = "akey long, chash long, d1 long, d2 long, lo long, rel int, ctx binary"
VERDICT = "akey long, chash long, s int, e int"


def _slab_anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    h = data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    h ^= h >> np.uint64(32)
    width = 1
    for odd in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9FB21C651E98DF25):
        h = h[:-width] * np.uint64(odd) + h[width:]
        h ^= h >> np.uint64(31)
        width *= 2
    h *= np.uint64(0xD6E8FEB86659FD93)
    low = np.uint64(PLACE_BITS)
    least = (h >> low << low) | np.arange(len(h), dtype=np.uint64)     # leftmost among equal hashes
    span, width = length - GRAM + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[:width - span], least[span - width:])
    place = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    lo = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    hi = np.append(lo[1:], len(place)) - 1
    p = place[lo]
    return h[p], p, lo, hi


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash, place, and first and last window start, per anchor of a text (none if it is shorter than a window)."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if len(raw) < length:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    if len(raw) <= SLAB:
        return _slab_anchors(raw, length)
    parts = []
    for at in range(0, len(raw) - length + 1, SLAB - length + 1):
        key, p, lo, hi = _slab_anchors(raw[at:at + SLAB], length)
        parts.append((key, p + at, lo + at, hi + at))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _grams(length: int):  # noqa: ANN202
    """Task function: akey and a value that tells its places apart (equal texts count as one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for data, d1 in zip(part.column("data"), part.column("d1").to_pylist(), strict=True):
                    key, p, _, _ = anchors(data.as_py(), length)
                    keys.append(key)
                    places.append(p * np.int64(0x5851F42D4C957F2D) + np.int64(d1))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(places))], ["akey", "place"])

    return run


def _contexts(length: int, wanted):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sent: set[tuple[int, int]] = set()               # a context's bytes go once per batch
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                out: list[tuple] = []
                for data, d1, d2 in zip(part.column("data"), part.column("d1").to_pylist(), part.column("d2").to_pylist(), strict=True):
                    data = data.as_py()
                    key, p, lo, hi = anchors(data, length)
                    yes = sketch.in_bitmap(wanted.value, key)
                    if not yes.any():
                        continue
                    for k, at, a, z in zip(key[yes].view(np.int64).tolist(), p[yes].tolist(), lo[yes].tolist(), hi[yes].tolist(), strict=True):
                        ctx = data[a:z + length]
                        chash = xxhash.xxh3_64_intdigest(ctx, seed=at - a) - 2**63
                        new = (k, chash) not in sent
                        if new:
                            sent.add((k, chash))
                        out.append((k, chash, d1, d2, a, at - a, ctx if new else None))
                if out:
                    k, c, d1, d2, lo, rel, ctx = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k, pa.int64()), pa.array(c, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                         pa.array(lo, pa.int64()), pa.array(rel, pa.int32()), pa.array(ctx, pa.binary())],
                        ["akey", "chash", "d1", "d2", "lo", "rel", "ctx"])

    return run


def matches(rights: list[bytes], lefts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Per member, (left, right) extents around the anchor of strings of ``length`` or more that another member has too.

    ``rights`` start at the anchor; ``lefts`` are what lies before it, reversed.
    """
    m = len(rights)
    found: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    if m == 2:
        r, l = common_prefix(*rights), common_prefix(*lefts)
        if l + r >= length:
            found[0].append((l, r))
            found[1].append((l, r))
        return found
    order, lcp = deep_shallow_sort(rights)
    rank = [0] * m
    for place, k in enumerate(deep_shallow_sort(lefts)[0]):
        rank[k] = place
    most_left = max(map(len, lefts))

    def node(depth: int, members: list[int]) -> None:
        if depth + most_left < length:
            return
        by_left = sorted(members, key=rank.__getitem__)
        before = 0
        shared = [common_prefix(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:], strict=False)]
        for i, k in enumerate(by_left):
            after = shared[i] if i < len(shared) else 0
            best = max(before, after)
            if best + depth >= length:
                found[k].append((best, depth))
            before = after

    # Nodes of the tree of common prefixes: maximal ranges of the order with a common prefix of ``depth``.
    stack: list[tuple[int, int]] = []                        # (depth, first place)
    for place in range(1, m + 1):
        depth = lcp[place] if place < m else -1
        first = place - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            node(d, order[first:place])
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            if z > out[-1][1]:
                out[-1] = (out[-1][0], z)
        else:
            out.append((a, z))
    return out


def _sorted_groups(length: int):  # noqa: ANN202
    """Task function over contexts sorted by akey: repeated spans of each context, relative to its start."""
    def judge(key: int, rows: list[tuple[int, int, int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
        rights, lefts = [c[rel:] for _, _, rel, c in rows], [c[:rel][::-1] for _, _, rel, c in rows]
        for (chash, times, rel, ctx), found in zip(rows, matches(rights, lefts, length), strict=True):
            if times == 1:
                for a, z in merged([(rel - l, rel + r) for l, r in found]):
                    yield key, chash, a, z

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        last, out = None, []

        def batch_of() -> pa.RecordBatch:
            cols = zip(*out, strict=True) if out else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["akey", "chash", "s", "e"])

        for batch in batches:
            for k, chash, times, rel, ctx in zip(*(batch.column(c).to_pylist() for c in ("akey", "chash", "times", "rel", "ctx")), strict=True):
                if k != last:
                    if len(held) > 1:
                        out.extend(judge(last, held))
                    held, last = [], k
                held.append((chash, times, rel, ctx))
                if times > 1:
                    out.append((k, chash, 0, len(ctx)))
            if len(out) > 5000:
                yield batch_of()
                out.clear()
        if len(held) > 1:
            out.extend(judge(last, held))
        yield batch_of()

    return run


def _windows(length: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                out = []
                for k, chash, ctx in zip(*(part.column(c).to_pylist() for c in ("akey", "chash", "ctx")), strict=True):
                    for a in range(len(ctx) - length + 1):
                        h = xxhash.xxh3_128_intdigest(ctx[a:a + length])
                        out.append((k, chash, a, (h & (2**64 - 1)) - 2**63, (h >> 64) - 2**63))
                cols = zip(*out, strict=True) if out else ((),) * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], ["akey", "chash", "s", "w1", "w2"])

    return run


def _bits_for(rows: int) -> int:
    bits = LEAST_BITS
    while bits < 32 * rows and bits < MOST_BITS:
        bits *= 2
    return bits


def repeated_spans(docs: DataFrame, length: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """d1, d2, a, z: spans of repeated bytes per text; ``docs`` has d1, d2 (hash of the text) and data (its bytes)."""
    context = docs.sparkSession.sparkContext
    grams = docs.select("data", "d1").mapInArrow(_grams(length), "akey long, place long")
    twice = written(grams.groupBy("akey").agg(F.min("place").alias("lo"), F.max("place").alias("hi")).where("lo < hi").select("akey"), "grams")
    wanted = context.broadcast(sketch.bitmap(twice, _bits_for(twice.count())))
    places = written(docs.select("data", "d1", "d2").mapInArrow(_contexts(length, wanted), CONTEXT), "contexts")

    # Different contexts, how many texts or places have each, and how many different ones a gram has.
    one_each = places.groupBy("akey", "chash").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("d1", "d2", "lo")).alias("p1"), F.max(F.xxhash64("d1", "d2", "lo")).alias("p2"),
        F.first("rel").alias("rel"), F.max("ctx").alias("ctx"))
    one_each = written(one_each.select("akey", "chash", "rel", "ctx", F.when(F.col("p1") < F.col("p2"), 2).otherwise(1).alias("times")), "context_set")
    sizes = one_each.groupBy("akey").agg(F.count(F.lit(1)).alias("members"), F.max("times").alias("most")).where("members > 1 or most > 1")
    counted = one_each.join(sizes.drop("most"), "akey")
    fields = ["akey", "chash", "times", "rel", "ctx"]
    grouped = counted.where(F.col("members") <= group_rows).select(*fields).repartition("akey").sortWithinPartitions("akey", "chash")
    verdicts = grouped.mapInArrow(_sorted_groups(length), VERDICT)

    windows = counted.where(F.col("members") > group_rows).select(*fields)
    hashed = windows.mapInArrow(_windows(length), "akey long, chash long, s int, w1 long, w2 long").join(windows.select("akey", "chash", "times"), ["akey", "chash"])
    again = (hashed.groupBy("w1", "w2").agg(F.min("chash").alias("lo"), F.max("chash").alias("hi"), F.max("times").alias("times"))
             .where("lo < hi or times > 1").select("w1", "w2"))
    by_window = hashed.join(again, ["w1", "w2"]).select("akey", "chash", "s", (F.col("s") + length).alias("e"))
    verdicts = written(verdicts.unionByName(by_window), "verdicts")
    return (places.select("akey", "chash", "d1", "d2", "lo").join(verdicts, ["akey", "chash"])
            .select("d1", "d2", (F.col("lo") + F.col("s")).alias("a"), (F.col("lo") + F.col("e")).alias("z")))


def remove_repeats(df: DataFrame, text_col: str = "text", length: int = LENGTH, carry: tuple[str, ...] = ("doc_id",),
                   group_rows: int = GROUP_ROWS, whole_characters: bool = False) -> DataFrame:
    """The ``carry`` columns, n_bytes, n_removed, n_spans and ``kept`` (the remaining bytes) per row.

    With ``whole_characters``, ``kept`` loses what is left of characters cut in
    two; the counts stay.

    Defined cases: a null text counts as empty; texts shorter than ``length``
    lose nothing; a text of ``length`` or more bytes that occurs twice (repeated
    rows included) is removed whole; overlapping occurrences count; removal may
    cut inside a character, so ``kept`` is binary; an empty table gives an empty
    result; extra columns are ignored unless carried.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(*[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)], text.cast("binary").alias("data"),
                     F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(7), text).alias("d2"))
    copies = (rows.where(F.octet_length("data") >= length).groupBy("d1", "d2")
              .agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("data")).cast("long").alias("z"))
              .where("n > 1").select("d1", "d2", F.lit(0).cast("long").alias("a"), "z"))
    spans = repeated_spans(rows.select("data", "d1", "d2"), length, group_rows).unionByName(copies.select("d1", "d2", "a", "z"))
    per_text = written(spans.groupBy("d1", "d2").agg(F.sort_array(F.collect_set(F.struct("a", "z"))).alias("spans")), "spans")
    hit = df.sparkSession.sparkContext.broadcast(sketch.bitmap(per_text.select("d1"), _bits_for(per_text.count())))

    @F.pandas_udf("boolean")
    def may_have(d1):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(sketch.in_bitmap(hit.value, d1.to_numpy()))

    marked = rows.withColumn("touched", may_have("d1"))
    schema = rows.drop("data", "d1", "d2").withColumns({
        "n_bytes": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long"),
        "kept": F.lit(b"").cast("binary")}).schema
    names = [f.name for f in schema]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                out = []
                for data, spans in zip(part.column("data").to_pylist(), part.column("spans").to_pylist(), strict=True):
                    runs = merged([(s["a"], s["z"]) for s in spans or ()])
                    keep, at = [], 0
                    for a, z in runs:
                        keep.append(data[at:a])
                        at = z
                    keep.append(data[at:])
                    kept = b"".join(keep)
                    shown = kept.decode(errors="ignore").encode() if whole_characters and len(kept) < len(data) else kept
                    out.append((len(data), len(data) - len(kept), len(runs), shown))
                cols = zip(*out, strict=True) if out else ((),) * 4
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(f"_carry{i}") for i in range(len(carry))], *[pa.array(x, t) for x, t in zip(cols, kinds, strict=True)]], names)

    # A sort-merge join at every size: the filter and the cut run in different stages, each with one worker a task.
    touched = marked.where("touched").drop("touched").join(per_text.hint("merge"), ["d1", "d2"], "left").drop("d1", "d2").mapInArrow(cut, schema)
    whole = (marked.where("not touched").withColumns({
        "n_bytes": F.octet_length("data").cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long")})
        .withColumnRenamed("data", "kept"))
    return touched.unionByName(whole.select(*names)).select(
        *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)], "n_bytes", "n_removed", "n_spans", "kept")
