"""N-gram Jaccard self join with set-relation skipping, and its connected groups.

A document's set holds the 64-bit hashes of its distinct word shingles; equal
sets are one node.  Two sets can only reach the similarity if they share a
token among the first few of a fixed order of all tokens (prefix filter), so
each set is entered in the index lists of those tokens.  Any fixed order gives
the same result; this one goes by the number of tokens in a token's bucket,
counted over all texts, so that tokens which many texts share come last.

Index lists are joined in tasks with two kinds of skipping:

* by position: two sets are compared in the list of the first token that they
  share, where nothing but this token and those after it can be common.  A list
  is sorted by set size and divided into blocks; whole blocks are skipped by
  their bounds on size and on the tokens left, which bound the possible overlap,
  and single entries by the same bounds and by the distance of 512-bit parity
  signatures (never more than the sets' difference);
* by set relation: the answers of a set are taken from those computed for a
  similar set before it.  Once a set's answers are known they belong to its
  group and are not computed again for its members: only entries outside the
  group are still compared.  So a list yields the edges of a spanning forest of
  its candidates, not all their pairs.

The forest's edges are verified on the whole sets.  Where one fails, the
members that it was to connect are compared again, but only across groups that
are still apart, so no link between different groups is lost.  Where a part of a
list has few candidates, they are written as pairs and verified; where it has
many, the members are written instead, with their sets, into cells of bounded
size, and a task gives only the links that it found between groups.

A list of more than ``LIST_ROWS`` entries is split into blocks of rows that
share a few entries of the list (the spine); entries outside the list's largest
group then meet all blocks in a second pass, two blocks to a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import sketch
from tallyframe.llm.common import reach_workers, written
from tallyframe.llm.components import components

ORDER_BITS = 21              # buckets of the token order, as a power of two: two bytes each are broadcast
KEY_BITS = 1 << 28           # at most, of the filter of texts to verify, which is broadcast
TOKEN_BITS = 1 << 28         # at most, of the filter of shared tokens, which is broadcast
LIST_ROWS = 20_000
SPINE_ROWS = 16
BLOCK = 256
SMALL_LIST = 24
PAIRS_PER_ENTRY = 8          # candidates that are written as pairs; beyond, a part of a list is compared in cells
CELL_BYTES = 16 << 20        # of one side's sets
SIGNATURE_BITS = 512
SEEN_NODES = 200_000      # bounded memory of a task
POSTING = "token long, node long, n int, pos int, sig binary, tag long"


class Shingles:
    """Shingle sets of texts."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.weights = [np.uint64(xxhash.xxh3_64_intdigest(b"place %d" % i) | 1) for i in range(words)]

    def __call__(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit shingle hashes; words are runs of bytes other than ASCII white space, A-Z lower-cased."""
        words = text.encode().lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(words) < self.words:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        m = len(h) - self.words + 1
        s = np.zeros(m, dtype=np.uint64)
        for i, weight in enumerate(self.weights):
            part = h[i:i + m] * weight
            s += part ^ (part >> np.uint64(32))
            s *= np.uint64(0x9E3779B97F4A7C15)
            s ^= s >> np.uint64(29)
        return np.unique(s)


class Threshold:
    """Jaccard of at least num/den, in whole numbers."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den

    def prefix(self, n: int) -> int:
        """Entries of a set of ``n`` in which it must share a token with any set it links with."""
        return n - -(-self.num * n // self.den) + 1

    def least_size(self, n: int) -> int:
        return -(-self.num * n // self.den)

    def most_size(self, n: int) -> int:
        return self.den * n // self.num

    def overlap(self, sizes):  # noqa: ANN001, ANN201
        """Least overlap of two linked sets with this sum of sizes."""
        return -(-self.num * sizes // (self.num + self.den))

    def links(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both > 0 and self.den * both >= self.num * (len(a) + len(b) - both)


def signature(s: np.ndarray) -> bytes:
    """Parity of the set's tokens per bucket: two signatures differ in no more bits than the sets in tokens."""
    odd = np.bincount((s >> np.uint64(40)).astype(np.int64) % SIGNATURE_BITS, minlength=SIGNATURE_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _nodes_and_order(shingles: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, counts = Shingles(shingles), np.zeros(1 << ORDER_BITS, dtype=np.uint32)
        names = ["_id", "key", "node", "check", "n", "slice", "counts"]
        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                node, check, size = [], [], []
                for text in part.column(1).to_pylist():
                    s = sets(text)
                    np.add.at(counts, order_bucket(s), np.uint32(1))
                    h = xxhash.xxh3_128_intdigest(s.tobytes(), seed=seed)
                    node.append((h & (2**64 - 1)) - 2**63)
                    check.append((h >> 64) - 2**63)
                    size.append(len(s))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array(size, pa.int64()),
                     pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary())], names)
        for number, data in sketch.sliced(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), *[pa.nulls(1, pa.int64()) for _ in range(4)],
                 pa.array([number], pa.int32()), pa.array([data], pa.binary())], names)

    return run


def order_bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def crowding(counts: np.ndarray) -> np.ndarray:
    """Rank of each bucket in the token order: its count, scaled so that the usual ones fit into two bytes."""
    scale = 0
    while counts.mean() / (1 << scale) > 4096:
        scale += 1
    return np.minimum(counts >> scale, 65535).astype(np.uint16)


def _postings(shingles: int, seed: int, threshold: Threshold, order) -> Callable:  # noqa: ANN001
    """Task function: an entry (token, node, n, pos) per prefix token, and one row (node, n, sig) per node that it meets.

    ``tag`` tells apart the entries that several tasks give for one node.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Shingles(shingles)
        names = ["token", "node", "n", "pos", "sig", "tag"]
        seen: set[int] = set()
        first, given = TaskContext.get().partitionId() << 36, 0
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                tokens, node, size, pos, sig, length = [], [], [], [], [], []
                if len(seen) > SEEN_NODES:
                    seen.clear()
                for text in part.column(0).to_pylist():
                    s = sets(text)
                    n = len(s)
                    if not n:
                        continue
                    name = (xxhash.xxh3_128_intdigest(s.tobytes(), seed=seed) & (2**64 - 1)) - 2**63
                    if name in seen:
                        continue
                    seen.add(name)
                    k = threshold.prefix(n)
                    tokens.append(s[np.argsort(order.value[order_bucket(s)], kind="stable")[:k]])
                    node.append(name)
                    size.append(n)
                    length.append(k)
                    pos.append(np.arange(k, dtype=np.int32))
                    sig.append(signature(s))
                if tokens:
                    rows = sum(length)
                    tag = np.arange(first + given, first + given + len(node), dtype=np.int64)
                    given += len(node)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(node, dtype=np.int64), length)),
                         pa.array(np.repeat(np.array(size, dtype=np.int32), length)), pa.array(np.concatenate(pos)),
                         pa.nulls(rows, pa.binary()), pa.array(np.repeat(tag, length))], names)
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(len(node), pa.int64()), pa.array(node, pa.int64()), pa.array(size, pa.int32()),
                         pa.nulls(len(node), pa.int32()), pa.array(sig, pa.binary()), pa.array(tag)], names)

    return run


_BITS = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class IndexList:
    """The entries of one token, sorted by size: finds the candidates of an entry, skipping blocks by their bounds."""

    def __init__(self, n: np.ndarray, pos: np.ndarray, sig: np.ndarray, threshold: Threshold) -> None:
        self.n, self.sig, self.threshold = n.astype(np.int64), sig, threshold
        cuts = np.arange(0, len(n), BLOCK)
        self.rest = self.n - pos - 1                          # tokens after this one
        self.low = self.n[cuts]                               # sorted: the first entry of a block is its smallest
        self.high = np.append(self.n[cuts[1:] - 1], self.n[-1])
        self.most_rest = np.maximum.reduceat(self.rest, cuts)

    def candidates(self, x: int, free: np.ndarray) -> np.ndarray:
        """Entries among ``free`` that may be linked with entry ``x``."""
        t, n, rest = self.threshold, self.n[x], self.rest[x]
        bound = 1 + np.minimum(rest, self.most_rest)          # pairs that share a token before this one are found there
        blocks = np.flatnonzero((self.high >= t.least_size(n)) & (self.low <= t.most_size(n)) & (bound >= t.overlap(n + self.low)))
        if not len(blocks):
            return blocks
        at = np.concatenate([np.arange(b * BLOCK, min(len(self.n), (b + 1) * BLOCK)) for b in blocks.tolist()])
        at = at[free[at]]
        need = t.overlap(n + self.n[at])
        at = at[(1 + np.minimum(rest, self.rest[at]) >= need)
                & (self.n[at] >= t.least_size(n)) & (self.n[at] <= t.most_size(n))]
        if len(at):
            apart = _BITS[self.sig[at] ^ self.sig[x]].sum(axis=1)
            at = at[apart <= n + self.n[at] - 2 * t.overlap(n + self.n[at])]
        return at

    def forest(self) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Edges of a spanning forest of the candidates, and each entry's group (the number of its first entry)."""
        m = len(self.n)
        free, group, edges = np.ones(m, dtype=bool), np.arange(m), []
        left = m
        for root in range(m):
            if not free[root]:
                continue
            free[root] = False
            left -= 1
            queue = [root]
            while queue and left:
                x = queue.pop()
                found = self.candidates(x, free)
                if len(found):
                    free[found] = False
                    left -= len(found)
                    group[found] = root
                    found = found.tolist()
                    edges.extend((x, y) for y in found)
                    queue.extend(found)
        return edges, group


def _lists(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Runs of equal ``keys`` of a sorted partition, as arrays; a run may go on over several batches."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        now = {c: np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) if c == "sig"
               else batch.column(c).to_numpy() for c in batch.schema.names}
        if held:
            now = {c: np.concatenate([held[c], now[c]]) for c in now}
        change = np.zeros(len(now[keys[0]]) - 1, dtype=bool)
        for k in keys:
            change |= now[k][1:] != now[k][:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if z - a > 1:                                     # a list of one entry has no pairs
                yield {c: x[a:z] for c, x in now.items()}
        held = {c: x[cuts[-1]:] for c, x in now.items()}
    if held:
        yield held


def small_forest(n: list[int], pos: list[int], sig: list[int], threshold: Threshold) -> tuple[list[tuple[int, int]], np.ndarray]:
    """:meth:`IndexList.forest` for a few entries, without arrays."""
    group, edges, free = list(range(len(n))), [], list(range(len(n)))
    while free:
        root = free.pop(0)
        queue = [root]
        while queue and free:
            x = queue.pop()
            rest = []
            for y in free:
                sizes = n[x] + n[y]
                need = threshold.overlap(sizes)
                if (min(n[x] - pos[x], n[y] - pos[y]) >= need
                        and (sig[x] ^ sig[y]).bit_count() <= sizes - 2 * need):
                    edges.append((x, y))
                    group[y] = root
                    queue.append(y)
                else:
                    rest.append(y)
            free = rest
    return edges, np.array(group)


LISTED = "kind int, a long, b long, token long, grp long, node long, n int, pos int, sig binary"


def _join_lists(threshold: Threshold) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function over sorted lists: forest edges (kind 0), and the members of groups of three or more (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        members: list[tuple[np.ndarray, ...]] = []
        held = kept = 0
        for rows in _lists(batches, ["token", "block"]):
            one = np.flatnonzero(np.append(True, rows["node"][1:] != rows["node"][:-1]))   # equal sets are one node
            if len(one) < 2:
                continue
            node, n, pos, sig = rows["node"][one], rows["n"][one], rows["pos"][one], rows["sig"][one]
            if len(one) <= SMALL_LIST:
                edges, group = small_forest(n.tolist(), pos.tolist(), [int.from_bytes(x.tobytes(), "little") for x in sig], threshold)
            else:
                edges, group = IndexList(n, pos, sig, threshold).forest()
            if not edges:
                continue
            e = np.array(edges)
            found.append((node[e[:, 0]], node[e[:, 1]]))
            held += len(e)
            if held > 20_000:
                yield _listed(0, a=np.concatenate([a for a, _ in found]), b=np.concatenate([b for _, b in found]))
                found, held = [], 0
            # A group of two is decided by its edge.  So is every group in an unsplit list whose edges all hold.
            big = np.flatnonzero(np.bincount(group, minlength=len(group))[group] >= 3)
            if len(big):
                members.append((np.full(len(big), rows["token"][0]), node[group[big]], node[big], n[big], pos[big], sig[big]))
                kept += len(big)
                if kept > 20_000:
                    yield _members(members)
                    members, kept = [], 0
        if found:
            yield _listed(0, a=np.concatenate([a for a, _ in found]), b=np.concatenate([b for _, b in found]))
        if members:
            yield _members(members)

    return run


def _members(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    token, grp, node, n, pos, sig = (np.concatenate(x) for x in zip(*parts, strict=True))
    return _listed(1, token=token, grp=grp, node=node, n=n, pos=pos, sig=sig)


def _listed(kind: int, **cols: np.ndarray) -> pa.RecordBatch:
    size = len(next(iter(cols.values())))
    kinds = {"kind": pa.int32(), "a": pa.int64(), "b": pa.int64(), "token": pa.int64(), "grp": pa.int64(), "node": pa.int64(),
             "n": pa.int32(), "pos": pa.int32(), "sig": pa.binary()}
    out = []
    for c, kind_of in kinds.items():
        if c == "kind":
            out.append(pa.array(np.full(size, kind, dtype=np.int32)))
        elif c == "sig" and c in cols:
            out.append(pa.array([x.tobytes() for x in cols[c]], kind_of))
        else:
            out.append(pa.array(cols[c], kind_of) if c in cols else pa.nulls(size, kind_of))
    return pa.RecordBatch.from_arrays(out, list(kinds))


CROSSED = "a long, b long, cell long, side int, node long, comp long"


def _crossed(**cols: np.ndarray) -> pa.RecordBatch:
    size = len(next(iter(cols.values())))
    kinds = {"a": pa.int64(), "b": pa.int64(), "cell": pa.int64(), "side": pa.int32(), "node": pa.int64(), "comp": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(cols[c], k) if c in cols else pa.nulls(size, k) for c, k in kinds.items()], list(kinds))


def _cross(threshold: Threshold) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function over pairs of blocks: candidates across components.

    Side 0 is compared with side 1, or with itself where there is no other.
    The result is candidate pairs (a, b), or members of cells where there are
    more than ``PAIRS_PER_ENTRY`` pairs for an entry.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["token", "grp", "block", "other"]
        for rows in _lists(batches, keys):
            node, comp, right, m = rows["node"], rows["comp"], rows["side"] == 1, len(rows["node"])
            index = IndexList(rows["n"], rows["pos"], rows["sig"], threshold)
            part = np.cumsum(index.n * 8) // CELL_BYTES          # of a cell's side: neighbours in size
            if right.any():
                asked = np.flatnonzero(~right)
            else:
                main = np.unique(comp, return_counts=True)
                main = main[0][main[1].argmax()]
                asked = np.flatnonzero(comp != main)             # pairs inside the largest component need no look
            name = b"".join(int(rows[k][0]).to_bytes(8, "little", signed=True) for k in keys)
            for own in np.unique(part[asked]).tolist():
                mine = asked[part[asked] == own]
                pairs, held, cells = [], 0, {}
                for x in mine.tolist():
                    free = comp != comp[x]
                    free &= right if right.any() else (comp == main) | (np.arange(m) < x)
                    found = index.candidates(x, free)
                    if not len(found):
                        continue
                    held += len(found)
                    if held <= PAIRS_PER_ENTRY * len(mine):
                        pairs.append((x, found))
                    for p in np.unique(part[found]).tolist():
                        xs, ys = cells.setdefault(p, (np.zeros(m, dtype=bool), np.zeros(m, dtype=bool)))
                        xs[x] = True
                        ys[found[part[found] == p]] = True
                if held <= PAIRS_PER_ENTRY * len(mine):
                    for x, found in pairs:
                        yield _crossed(a=np.full(len(found), node[x]), b=node[found])
                    continue
                for p, sides in cells.items():
                    cell = xxhash.xxh3_64_intdigest(name + own.to_bytes(8, "little") + p.to_bytes(8, "little")) - 2**63
                    for side, some in enumerate(sides):
                        size = int(some.sum())
                        yield _crossed(cell=np.full(size, cell), side=np.full(size, side, dtype=np.int32), node=node[some], comp=comp[some])

    return run


def _cell_links(threshold: Threshold) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function over sorted cells: links between the sides, on the whole sets, that connect components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("cell", "side", "node", "comp", "set")], strict=True):
                if held and held[0][0] != row[0]:
                    yield from _one_cell(held, threshold)
                    held = []
                held.append(row)
        if held:
            yield from _one_cell(held, threshold)

    return run


def _one_cell(rows: list[tuple], threshold: Threshold) -> Iterator[pa.RecordBatch]:
    left, right = ([r for r in rows if r[1] == side] for side in (0, 1))
    if not left or not right:
        return
    comps, comp = np.unique(np.array([r[3] for r in left + right]), return_inverse=True)
    comp, others = comp[:len(left)], comp[len(left):]
    now = np.arange(len(comps))                              # the component that each has become part of
    sizes = np.array([len(r[4]) // 8 for r in right])
    values, at = np.unique(np.frombuffer(b"".join(r[4] for r in right), np.uint64), return_inverse=True)
    starts = np.append(0, np.cumsum(sizes)[:-1])
    edges = []
    for k, row in enumerate(left):
        apart = now[others] != now[comp[k]]
        if not apart.any():
            continue
        s = np.frombuffer(row[4], np.uint64)
        place = np.minimum(np.searchsorted(values, s), len(values) - 1)
        has = np.zeros(len(values), dtype=np.int64)
        has[place[values[place] == s]] = 1
        both = np.add.reduceat(has[at], starts)
        linked = apart & (both > 0) & (threshold.den * both >= threshold.num * (len(s) + sizes - both))
        for y in np.flatnonzero(linked).tolist():
            mine, its = now[comp[k]], now[others[y]]
            if mine != its:
                now[now == its] = mine
                edges.append((row[2], right[y][2]))
    if edges:
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in edges], pa.int64()), pa.array([b for _, b in edges], pa.int64())], ["a", "b"])


def _verify(threshold: Threshold) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                ok = [threshold.links(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                      for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ok, pa.bool_())], ["a", "b", "ok"])

    return run


class NgramJoin:
    """The join's steps over one table; see :func:`jaccard_groups`."""

    def __init__(self, texts: DataFrame, words: int, threshold: Threshold, list_rows: int) -> None:
        self.texts, self.words, self.threshold, self.list_rows = texts, words, threshold, list_rows
        self.context = texts.sparkSession.sparkContext
        self.seed = 0

    def nodes(self) -> DataFrame:
        """_id, key (of the text), node, n per row; sets the token order."""
        id_type = self.texts.schema["_id"].dataType.simpleString()
        while True:
            scan = written(self.texts.withColumn("key", F.xxhash64("_text")).mapInArrow(
                _nodes_and_order(self.words, self.seed),
                f"_id {id_type}, key long, node long, check long, n long, slice int, counts binary"), "shingle_sets")
            rows = scan.where("slice is null").select("_id", "key", "node", "check", "n")
            clash = rows.groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo <> hi")
            if clash.isEmpty():
                break
            self.seed += 1                                    # two different sets with the same 64 bits: name them anew
        counts = sketch.summed(scan.where("slice is not null"), 1 << ORDER_BITS)
        self.order = self.context.broadcast(crowding(counts))
        return rows.drop("check")

    def sets(self, rows: DataFrame, wanted: DataFrame) -> DataFrame:
        """node, set (sorted hashes, binary) of the ``wanted`` nodes; only texts whose key may be asked for are cut again."""
        keys = written(rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key")).select("key"), "asked_keys")
        asked = self.context.broadcast(sketch.bitmap(keys, sketch.bits_for(keys.count(), most=KEY_BITS)))
        words, seed = self.words, self.seed

        # The task that cuts the texts also asks the filter: a function of its own would take a second worker beside it.
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            make = Shingles(words)
            for batch in batches:
                batch = batch.filter(pa.array(sketch.in_bitmap(asked.value, batch.column(1).to_numpy())))
                for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                    found = [s.tobytes() for s in map(make, part.column(0).to_pylist()) if len(s)]
                    node = [(xxhash.xxh3_128_intdigest(s, seed=seed) & (2**64 - 1)) - 2**63 for s in found]
                    yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(found, pa.binary())], ["node", "set"])

        scan = self.texts.select("_text", F.xxhash64("_text").alias("key")).mapInArrow(run, "node long, set binary")
        return scan.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("set").alias("set"))

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """a, b, ok of each pair; the shuffle that groups ``sets`` serves both of its joins."""
        with_sets = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
                     .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
                     .select("a", "b", "sa", "sb"))
        return written(with_sets.mapInArrow(_verify(self.threshold), "a long, b long, ok boolean"), "verified")

    def links(self, rows: DataFrame) -> DataFrame:
        """Enough links (a, b) between nodes to give the connected components of all links."""
        limit = self.list_rows
        postings = written(self.texts.select("_text").mapInArrow(
            _postings(self.words, self.seed, self.threshold, self.order), POSTING), "postings")
        sigs = postings.where("token is null").groupBy("node").agg(F.min_by("sig", "tag").alias("sig"), F.min("tag").alias("own"))
        postings = postings.where("token is not null").drop("sig")
        shared = written(postings.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("rows"))
                         .where("lo < hi").select("token", "rows"), "shared_tokens")
        # Most tokens are in one set only; a bitmap of bounded size spares their entries the shuffle of the join.
        marks = self.context.broadcast(sketch.bitmap(shared.select("token"), sketch.bits_for(shared.count(), most=TOKEN_BITS)))

        @F.pandas_udf("boolean")
        def may_share(token):  # noqa: ANN001, ANN202
            import pandas as pd

            return pd.Series(sketch.in_bitmap(marks.value, token.to_numpy()))

        postings = postings.where(may_share("token"))
        # Both sides grow with the data.  Of the entries that several tasks gave for a node, one task's stay.
        entries = postings.join(shared.hint("merge"), "token").join(sigs, "node").where("tag = own").drop("tag", "own")
        entries = written(entries, "entries")
        # Blocks of long lists, by their nodes (``rows`` may count a node once per task); the spine (entries of
        # small hashes) goes to every block.
        mix = F.xxhash64("node", "token")
        long = entries.where(F.col("rows") > limit)
        nodes = long.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("blocks"))
        long = long.join(nodes, "token").withColumn("block", F.pmod(mix, F.col("blocks")).cast("int"))
        short = entries.where(F.col("rows") <= limit).withColumns({"blocks": F.lit(1), "block": F.lit(0)})
        entries = short.unionByName(long)
        split = long.where("blocks > 1")
        spine = (split.groupBy("token", "blocks", F.pmod(F.shiftright(mix, 20), F.lit(SPINE_ROWS)).alias("place"))
                 .agg(F.min_by(F.struct("node", "n", "pos", "sig"), mix).alias("s"))
                 .select("token", F.col("s.node"), F.col("s.n"), F.col("s.pos"), F.col("s.sig"),
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
        cols = ["token", "node", "n", "pos", "sig", "block"]
        listed = (entries.select(*cols).unionByName(spine.select(*cols))
                  .repartition("token", "block").sortWithinPartitions("token", "block", "n", "node"))
        joined = written(listed.mapInArrow(_join_lists(self.threshold), LISTED), "lists")
        pairs = written(joined.where("kind = 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        sets = self.sets(rows, pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct())
        first = self.verified(pairs, sets)
        links = first.where("ok").select("a", "b")
        # Groups (and split lists) whose members aren't all in one component by now.
        comps = written(components(links), "components").select(F.col("node"), F.col("component").alias("comp"))
        again = (joined.where("kind = 1").join(split.select("token").distinct().withColumn("whole", F.lit(True)), "token", "left")
                 .where("whole is null").select("token", "grp", "node", "n", "pos", "sig")
                 .unionByName(split.select("token", F.lit(0).cast("long").alias("grp"), "node", "n", "pos", "sig")))
        again = again.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        apart = (again.groupBy("token", "grp").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"))
                 .where("lo < hi"))
        if apart.isEmpty():
            return links
        open_rows = written(again.join(apart, ["token", "grp"]), "open_groups")
        sizes = open_rows.groupBy("token", "grp", "comp").agg(F.count(F.lit(1)).alias("k"))
        main = sizes.groupBy("token", "grp").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.max("k").alias("in_main"))
        open_rows = open_rows.join(main, ["token", "grp"]).withColumn("outside", F.col("size") - F.col("in_main"))
        # A task compares a block of entries outside the largest component with itself, with a later such block, or
        # with a block of the largest component; a group that fits is one block.
        inside = F.col("comp") == F.col("main")
        mains, rests = (F.ceil(F.col(c) / limit).cast("int") for c in ("in_main", "outside"))
        mine = F.pmod(F.xxhash64("node"), F.when(inside, mains).otherwise(rests)).cast("int")

        def place(side, block, other):  # noqa: ANN001, ANN202
            return F.struct(F.lit(side).alias("side"), block.cast("int").alias("block"), other.cast("int").alias("other"))

        all_rests, all_mains = F.sequence(F.lit(0), rests - 1), F.sequence(F.lit(0), mains - 1)
        as_left = F.concat(F.transform(all_mains, lambda j: place(0, mine, j)),
                           F.transform(F.filter(all_rests, lambda j: j >= mine), lambda j: place(0, mine, mains + j)))
        as_right = F.transform(F.filter(all_rests, lambda j: j < mine), lambda j: place(1, j, mains + mine))
        places = (F.when(F.col("size") <= limit, F.array(place(0, F.lit(0), F.lit(0))))
                  .when(inside, F.transform(all_rests, lambda j: place(1, j, mine)))
                  .otherwise(F.concat(as_left, as_right)))
        keys = ["token", "grp", "block", "other"]
        spread = (open_rows.withColumn("place", F.explode(places)).select("token", "grp", "node", "n", "pos", "sig", "comp", "place.*")
                  .repartition(*keys).sortWithinPartitions(*keys, "n", "node"))
        more = written(spread.mapInArrow(_cross(self.threshold), CROSSED), "crossed")
        cells = more.where("cell is not null").select("cell", "side", "node", "comp")
        more = more.where("cell is null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        more = written(more.join(first, ["a", "b"], "left_anti"), "more_pairs")
        if not more.isEmpty():
            sets = self.sets(rows, more.select(F.col("a").alias("node")).unionAll(more.select("b")).distinct())
            links = links.unionAll(self.verified(more, sets).where("ok").select("a", "b"))
        if not cells.isEmpty():
            sets = self.sets(rows, cells.select("node").distinct())
            filled = cells.join(sets, "node").repartition("cell").sortWithinPartitions("cell", "side", "node")
            links = links.unionAll(written(filled.select("cell", "side", "node", "comp", "set").mapInArrow(
                _cell_links(self.threshold), "a long, b long"), "cell_links"))
        return links


def jaccard_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100,
                   list_rows: int = LIST_ROWS, detail: bool = False) -> DataFrame:
    """Per row: ``id_col``, ``n_shingles`` (set size), ``component_id`` (smallest id reachable by links, itself included).

    With ``detail`` also ``key`` (64-bit hash of the text) and ``component`` (a
    number that the rows of a group share, whatever their ids; null without words).

    Rows link when their sets of ``words``-word shingles have a Jaccard
    similarity of at least num/den.  Words are runs of bytes other than ASCII
    white space, with A-Z lower-cased; with fewer words than ``words`` the whole
    sequence is the one shingle.

    Defined cases: a null or wordless text has an empty set and no links;
    repeated rows and equal texts are linked; a row whose id is null takes part
    and gets its group's smallest other id, or null; an empty table gives an
    empty result; extra columns are ignored.
    """
    reach_workers(df.sparkSession)
    texts = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    join = NgramJoin(texts, words, Threshold(num // math.gcd(num, den), den // math.gcd(num, den)), list_rows)
    rows = join.nodes()
    links = join.links(rows)
    # From nodes to the smallest id of the rows that have them.
    first = written(rows.where("n > 0").groupBy("node").agg(F.min("_id").alias("lowest")), "node_ids")
    comps = written(components(links), "components")
    ids = (first.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node")))
    best = ids.groupBy("component").agg(F.min("lowest").alias("component_id"))
    named = ids.join(best, "component").select("node", "component_id", "component")
    joined = rows.join(named, "node", "left")
    return joined.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                         F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
                         *(["key", "component"] if detail else []))
