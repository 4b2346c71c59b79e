"""Importance resampling towards a target distribution, with hashed n-gram features.

1. Runs of one to ``max_n`` words are hashed into ``buckets`` counters, over the
   whole corpus and over the target texts; each task adds into one array.
2. A bucket's gain is the floored log ratio of its smoothed shares (target to
   corpus).  All gains are one array of ``buckets`` numbers, which is broadcast;
   a document's weight is the floored mean of its features' gains.
3. A draw without replacement takes the highest weights with Gumbel noise from a
   seeded hash of the id.  The cutoff is found without sorting all rows: a
   quantile sketch gives a bracket of scores around the wanted rank; exact counts
   of the rows above it and in it validate the bracket or widen it; only its rows
   are sorted.
4. The drawn rows are ranked by a range sort; a row's rank is its place in its
   partition plus the rows of earlier partitions.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import reach_workers, written

BUCKETS = 10_000
MIN_WORDS = 20
DRAW = (25, 100)              # numerator and denominator of the share that is drawn
SEED = 7
SKETCH_ACCURACY = 2_000       # relative rank error of the sketch: 1 / 2,000
FIRST_MARGIN = 2 / SKETCH_ACCURACY
WIDEN = 8
BLOCK_BYTES = 1 << 20
HELD_FEATURES = 1 << 20

# A-Z become lower case; whatever is not a letter, a digit or part of a character beyond ASCII becomes a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_blocks(text: str) -> Iterator[list[bytes]]:
    """The words of a text, in blocks of about ``BLOCK_BYTES``, so that a very long text needs no list of all its words."""
    data = text.encode().translate(_WORD_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + BLOCK_BYTES)
        end = len(data) if end < 0 else end
        words = data[at:end].split()
        if words:
            yield words
        at = end


def feature_hashes(text: str, max_n: int = 2) -> Iterator[tuple[int, np.ndarray]]:
    """(words, crc32 of every feature) per block of a text; the features of a block end in it."""
    held: list[list[int]] = []                # running checksums of the runs that end in the last word, shortest first
    for words in word_blocks(text):
        spaced = [b" " + w for w in words]
        found = [np.fromiter(map(zlib.crc32, words), np.int64, len(words))]
        runs = found[0].tolist()
        tails = [[runs[-1]]]
        for n in range(1, max_n):             # a run of n + 1 words continues the checksum of one of n words
            before = ([held[n - 1][-1]] if len(held) >= n else []) + runs[:-1]
            follow = spaced[len(spaced) - len(before):]
            runs = list(map(zlib.crc32, follow, before))
            if not runs:
                break
            found.append(np.array(runs, np.int64))
            tails.append([runs[-1]])
        held = tails
        yield len(words), np.concatenate(found)


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, max_n: int = 2) -> np.ndarray:
    """Features per bucket over all texts: one array of ``buckets`` counts, summed by Spark over the tasks' arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, size = np.zeros(buckets, np.int64), [], 0
        for batch in batches:
            for text in batch.column(0):
                for _, hashes in feature_hashes(text.as_py(), max_n):
                    held.append(hashes)
                    size += len(hashes)
                    if size > HELD_FEATURES:
                        counts += np.bincount(np.concatenate(held) % buckets, minlength=buckets)
                        held, size = [], 0
        if held:
            counts += np.bincount(np.concatenate(held) % buckets, minlength=buckets)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(counts[own])], ["bucket", "n"])

    texts = df.select(F.col(text_col).alias("_text")).where("_text IS NOT NULL AND _text <> ''")
    summed = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in summed.collect():              # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in the target over that in the corpus), per bucket, in doubles."""
    size, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + size) / (float(s + 1) * float(t_all + size))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(row_id: object, seed: int = SEED) -> int:
    """Gumbel noise in thousandths from a seeded hash of the id (a null id hashes as the empty text)."""
    h = int(hashlib.sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gain_array, max_n: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gain_array.value
        for batch in batches:
            words, features, weights, scores = [], [], [], []
            for row_id, text in zip(batch.column("_id"), batch.column("_text"), strict=True):
                n_words, n_features, total = 0, 0, 0
                for own, hashes in feature_hashes(text.as_py() or "", max_n):
                    n_words += own
                    n_features += len(hashes)
                    total += int(gain[hashes % len(gain)].sum())
                weight = total // n_features if n_features else 0
                words.append(n_words)
                features.append(n_features)
                weights.append(weight)
                scores.append(weight + noise(row_id.as_py(), seed))
            kept = [i for i, name in enumerate(batch.schema.names) if name != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in kept], *[pa.array(x, pa.int64()) for x in (words, features, weights, scores)]],
                [*[batch.schema.names[i] for i in kept], "_words", "_features", "_weight", "_score"])

    return run


def ranked(df: DataFrame, order: list[Column], out: str = "_rank") -> DataFrame:
    """``df`` with the rank (from 1) of every row in ``order``, which must tell all rows apart."""
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = np.arange(at, at + batch.num_rows, dtype=np.int64)
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(places), part, np.int32)), pa.array(places)],
                                             [*batch.schema.names, "_part", "_place"])

    schema = df.withColumns({"_part": F.lit(0), "_place": F.lit(0).cast("long")}).schema
    placed = written(sorted_rows.mapInArrow(run, schema), "ranked")
    before, total = [], 0
    for row in placed.groupBy("_part").agg(F.max("_place").alias("last")).orderBy("_part").collect():      # one row a partition
        before.append((row["_part"], total))
        total += row["last"] + 1
    starts = df.sparkSession.createDataFrame(before, "_part int, _before long")
    return (placed.join(F.broadcast(starts), "_part")                  # as many rows as partitions
            .withColumn(out, F.col("_before") + F.col("_place") + 1).drop("_part", "_place", "_before"))


def bracket(rows: DataFrame, score: str, k: int, n: int, first_margin: float = FIRST_MARGIN) -> tuple[int, int, int]:
    """(low, high, rows above high): scores low..high hold the row that is ``k``-th from the top of the ``n`` rows.

    The sketch's quantiles propose brackets, each ``WIDEN`` times as wide as the
    one before; exact counts decide.  The last one spans all scores.
    """
    wanted, margins, margin = 1 - k / n, [], first_margin
    while margin < 1:
        margins.append(margin)
        margin *= WIDEN
    margins.append(1.0)
    at = [min(1.0, max(0.0, wanted + side * m)) for m in margins for side in (-1, 1)]
    found = rows.agg(F.percentile_approx(score, at, SKETCH_ACCURACY).alias("q"), F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    for i in range(len(margins)):
        low, high = (found["lo"], found["hi"]) if i == len(margins) - 1 else found["q"][2 * i:2 * i + 2]
        counts = rows.agg(F.coalesce(F.sum((F.col(score) > high).cast("long")), F.lit(0)).alias("above"),
                          F.coalesce(F.sum(F.col(score).between(low, high).cast("long")), F.lit(0)).alias("inside")).first()
        if counts["above"] < k <= counts["above"] + counts["inside"]:
            return low, high, counts["above"]
    raise ValueError(f"no row {k} among {n}")


def importance_resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        target_text_col: str = "text", share: tuple[int, int] = DRAW, min_words: int = MIN_WORDS,
                        buckets: int = BUCKETS, max_n: int = 2, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``id_col``, the ``carry`` columns, n_features, weight, score and rank (null if not drawn).

    Of the N documents with at least ``min_words`` words, floor(N * share) are drawn.

    Defined cases: a null or empty text has no features, weight 0, and is never
    drawn; a null id hashes as the empty text and comes after all ids in a tie;
    repeated rows are rows of their own, tied ones in any order; without target
    features every bucket is smoothed alike; an empty table gives an empty
    result; extra columns are ignored unless named in ``carry``, whatever their names.
    """
    reach_workers(df.sparkSession)
    gain = gains(bucket_counts(df, text_col, buckets, max_n), bucket_counts(target, target_text_col, buckets, max_n))
    shared = df.sparkSession.sparkContext.broadcast(gain)                     # 8 bytes per bucket
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)])
    numbers = {c: F.lit(0).cast("long") for c in ("_words", "_features", "_weight", "_score")}
    scored = rows.mapInArrow(_score(shared, max_n, seed), rows.drop("_text").withColumns(numbers).schema)
    scored = written(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")      # the number tells repeated rows apart

    fit = scored.where(F.col("_words") >= min_words)
    n = fit.count()
    k = share[0] * n // share[1]
    order = [F.col("_score").desc(), F.col("_id").asc_nulls_last(), F.col("_row").asc()]
    if k:
        low, high, above = bracket(fit, "_score", k, n)
        cut = ranked(fit.where(F.col("_score").between(low, high)).select("_score", "_id", "_row"), order).where(F.col("_rank") == k - above).first()
        same_id = F.col("_id").eqNullSafe(F.lit(cut["_id"]))
        earlier = F.col("_id").isNotNull() if cut["_id"] is None else F.coalesce(F.col("_id") < F.lit(cut["_id"]), F.lit(False))
        tied = earlier | (same_id & (F.col("_row") <= cut["_row"]))
        drawn = (F.col("_words") >= min_words) & ((F.col("_score") > cut["_score"]) | ((F.col("_score") == cut["_score"]) & tied))
        both = ranked(scored.where(drawn), order).unionByName(scored.where(~drawn).withColumn("_rank", F.lit(None).cast("long")))
    else:
        both = scored.withColumn("_rank", F.lit(None).cast("long"))
    return both.select(F.col("_id").alias(id_col), *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)],
                       F.col("_features").alias("n_features"), F.col("_weight").alias("weight"),
                       F.col("_score").alias("score"), F.col("_rank").alias("rank"))
