"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are per document, so token labels are derived first: among the sampled
labelled rows, a word or word beginning is offending if it is far more frequent
in toxic documents than in others; in toxic documents its tokens are labelled 1,
all other tokens 0.  A two-state chain with word, affix and neighbour features
is fitted to those labels by maximum likelihood.  For every document,
forward-backward gives each token's marginal; tokens of at least one half form
the offending spans, and a logistic function of the marginals' maximum and sum,
fitted on labelled rows that the chain has not seen, is the document's score.

Fitting uses at most ``MAX_TOXIC`` + ``MAX_CLEAN`` labelled rows (those of
smallest seeded hash), on the driver.  The model is a table of fixed size and
is broadcast.  Scoring reads every whole text; the recursion runs over all
tokens of a batch at once, in blocks joined by 2x2 products, so a very long
text costs no more per token than a short one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOXIC = 700
MAX_CLEAN = 1400
FEATURES = 1 << 18
TOKEN = re.compile(r"[^\W_]+")
PREFIXES, SUFFIXES = (3, 4, 5), (3, 4)
MEMO_WORDS = 300_000
BATCH_TOKENS = 400_000
STEPS, RATE, RIDGE = 60, 0.15, 1e-6
MIN_TOXIC_DOCS, MIN_ODDS = 3, 30.0


def feature_ids(word: str) -> list[int]:
    """Hashed features of a token from its own word."""
    w = word.lower()
    names = [f"w={w}", *[f"p={w[:n]}" for n in PREFIXES if len(w) > n], *[f"s={w[-n:]}" for n in SUFFIXES if len(w) > n]]
    return [xxhash.xxh3_64_intdigest(x) % FEATURES for x in names]


def neighbour_ids(word: str) -> tuple[int, int]:
    """Hashed features that a word gives to the token after it and to the one before it."""
    w = word.lower()
    return xxhash.xxh3_64_intdigest(f"after={w}") % FEATURES, xxhash.xxh3_64_intdigest(f"before={w}") % FEATURES


def forward_backward(lift: np.ndarray, starts: np.ndarray, trans: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised forward and backward vectors of every token (shape (n, 2)), and the weights exp(lift).

    ``lift``: log weight of state 1 over state 0 per token; ``starts``: true at
    the first token of each chain; ``trans`` (2x2) and ``first`` (2): positive
    transition and start weights.  All chains lie one after the other; a start
    forgets what lies before it.  Blocks of tokens are advanced together: a
    first sweep multiplies each block's matrices, a short loop carries the
    vectors from block to block, a second sweep fills in every token.
    """
    n = len(lift)
    length = max(1, int(math.sqrt(n)))
    blocks = -(-n // length)
    pad = blocks * length - n
    w = np.exp(np.clip(np.concatenate([lift, np.zeros(pad)]), -30, 30)).reshape(blocks, length).T.copy()
    s = np.concatenate([starts, np.ones(pad, dtype=bool)]).reshape(blocks, length).T
    m00, m10 = np.where(s, first[0], trans[0, 0]), np.where(s, first[0], trans[1, 0])
    m01, m11 = np.where(s, first[1], trans[0, 1]) * w, np.where(s, first[1], trans[1, 1]) * w

    # Block products (row vectors times matrices), rescaled at each step.
    a, b, c, d = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for t in range(length):
        a, b = a * m00[t] + b * m10[t], a * m01[t] + b * m11[t]
        c, d = c * m00[t] + d * m10[t], c * m01[t] + d * m11[t]
        top = np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a / top, b / top, c / top, d / top
    x, y = 0.5, 0.5
    into = np.empty((blocks, 2))
    for k, (pa_, pb, pc, pd) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)):
        into[k] = x, y
        x, y = x * pa_ + y * pc, x * pb + y * pd
        x, y = x / (x + y), y / (x + y)
    x, y = 1.0, 1.0
    out = np.empty((blocks, 2))
    for k, pa_, pb, pc, pd in zip(range(blocks - 1, -1, -1), a[::-1].tolist(), b[::-1].tolist(), c[::-1].tolist(), d[::-1].tolist(), strict=True):
        out[k] = x, y
        x, y = pa_ * x + pb * y, pc * x + pd * y
        x, y = x / (x + y), y / (x + y)

    alpha, beta = np.empty((length, blocks, 2)), np.empty((length, blocks, 2))
    f0, f1 = into[:, 0], into[:, 1]
    for t in range(length):
        f0, f1 = f0 * m00[t] + f1 * m10[t], f0 * m01[t] + f1 * m11[t]
        total = f0 + f1
        f0, f1 = f0 / total, f1 / total
        alpha[t, :, 0], alpha[t, :, 1] = f0, f1
    g0, g1 = out[:, 0], out[:, 1]
    for t in range(length - 1, -1, -1):
        beta[t, :, 0], beta[t, :, 1] = g0, g1
        g0, g1 = m00[t] * g0 + m01[t] * g1, m10[t] * g0 + m11[t] * g1
        total = g0 + g1
        g0, g1 = g0 / total, g1 / total
    flat = lambda z: z.transpose(1, 0, 2).reshape(-1, 2)[:n]
    return flat(alpha), flat(beta), w.T.reshape(-1)[:n]


def marginals(lift: np.ndarray, starts: np.ndarray, trans: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of state 1 per token."""
    if not len(lift):
        return np.zeros(0)
    alpha, beta, _ = forward_backward(lift, starts, trans, first)
    both = alpha * beta
    return both[:, 1] / both.sum(axis=1)


class Model:
    """Fitted weights: one per hashed feature, a bias, transitions, starts and the document calibration."""

    def __init__(self) -> None:
        self.weights = np.zeros(FEATURES)
        self.bias, self.log_trans, self.log_first = -3.0, np.zeros((2, 2)), np.zeros(2)
        self.calibration = np.array([0.0, 0.0, 0.0])

    def token_marginals(self, lift: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return marginals(lift + self.bias, starts, np.exp(self.log_trans), np.exp(self.log_first))

    def document_score(self, p: np.ndarray) -> float:
        x = document_features(p) @ self.calibration
        return float(1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, x)))))


def document_features(p: np.ndarray) -> np.ndarray:
    top = float(np.clip(p.max(), 1e-6, 1 - 1e-6)) if len(p) else 1e-6
    return np.array([1.0, math.log(top / (1 - top)), math.log1p(float(p[p > 0.05].sum())) if len(p) else 0.0])


def offending(docs: list[tuple[list[str], int]]) -> set[str]:
    """Words and word beginnings that speak for toxic documents by odds of at least ``MIN_ODDS``."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    sizes = [1.0, 1.0]
    for words, toxic in docs:
        units = set()
        for w in {w.lower() for w in words}:
            units.update((f"w={w}", *[f"p={w[:n]}" for n in (4, 5) if len(w) > n]))
        counts[toxic].update(units)
        sizes[toxic] += 1
    return {u for u, t in counts[1].items() if t >= MIN_TOXIC_DOCS
            and (t / sizes[1]) / ((counts[0][u] + 0.1) / sizes[0]) >= MIN_ODDS}


def fit(rows: list[tuple[str, int]]) -> Model:
    """Model from (text, toxic) rows; every fifth one is left to the calibration."""
    model = Model()
    if not {0, 1} <= {y for _, y in rows}:                # one class or no rows at all: everything is the only class
        model.calibration[0] = 30.0 if rows and rows[0][1] else -30.0
        return model
    docs = [(TOKEN.findall(t), y) for t, y in rows]
    order = {0: 0, 1: 0}
    train, held = [], []
    for d in docs:
        order[d[1]] += 1
        (held if order[d[1]] % 5 == 0 else train).append(d)
    units = offending(train)

    def hit(w: str) -> bool:
        w = w.lower()
        return f"w={w}" in units or any(f"p={w[:n]}" in units for n in (4, 5) if len(w) > n)

    hits = {w: hit(w) for words, y in train if y for w in set(words)}
    train = [(words, np.array([y and hits[w] for w in words], dtype=bool)) for words, y in train
             if words and (not y or any(hits[w] for w in words))]
    # One column of feature numbers per kind of feature; FEATURES itself is a feature that always weighs nothing.
    numbers: dict[str, int] = {}
    own: list[list[int]] = []
    near: list[tuple[int, int]] = []
    flat: list[int] = []
    for words, _ in train:
        for w in words:
            k = numbers.get(w)
            if k is None:
                k = numbers[w] = len(own)
                own.append(feature_ids(w))
                near.append(neighbour_ids(w))
            flat.append(k)
    token = np.array(flat)
    y = np.concatenate([labels for _, labels in train])
    starts = np.zeros(len(token), dtype=bool)
    starts[np.cumsum([0, *[len(w) for w, _ in train[:-1]]])] = True
    width = max(map(len, own))
    table = np.full((len(own), width), FEATURES, dtype=np.int32)
    for k, ids in enumerate(own):
        table[k, :len(ids)] = ids
    nearby = np.array(near, dtype=np.int32)
    columns = [table[token, i] for i in range(width)]
    after, before = np.full(len(token), FEATURES, dtype=np.int32), np.full(len(token), FEATURES, dtype=np.int32)
    after[1:] = np.where(starts[1:], FEATURES, nearby[token[:-1], 0])
    before[:-1] = np.where(starts[1:], FEATURES, nearby[token[1:], 1])
    columns += [after, before]
    size = FEATURES + 1
    w = np.zeros(size)
    shape = np.concatenate([w, [model.bias], np.zeros(4), np.zeros(2)])   # weights, bias, transitions, starts
    m1, m2 = np.zeros_like(shape), np.zeros_like(shape)
    now, past = y[1:].astype(int), y[:-1].astype(int)
    inner = ~starts[1:]
    seen_trans = np.bincount((past * 2 + now)[inner], minlength=4).astype(float)
    seen_first = np.bincount(y[starts].astype(int), minlength=2).astype(float)
    for step in range(1, STEPS + 1):
        w, bias, log_trans, log_first = shape[:size], shape[-7], shape[-6:-2].reshape(2, 2), shape[-2:]
        lift = np.full(len(token), bias)
        for c in columns:
            lift += w[c]
        trans, first = np.exp(log_trans), np.exp(log_first)
        alpha, beta, lifted = forward_backward(lift, starts, trans, first)
        p = alpha * beta
        p = p[:, 1] / p.sum(axis=1)
        # Pairs: alpha(t-1) * transition * weight(t) * beta(t), normalised.
        last, here = alpha[:-1][inner], beta[1:][inner]
        wt = lifted[1:][inner]
        pairs = np.stack([last[:, i] * trans[i, j] * (wt if j else 1.0) * here[:, j] for i in (0, 1) for j in (0, 1)])
        expected = (pairs / pairs.sum(axis=0)).sum(axis=1)
        error = y - p
        gw = np.zeros(size)
        for c in columns:
            gw += np.bincount(c, weights=error, minlength=size)
        gw[FEATURES] = 0
        grad = np.concatenate([gw, [error.sum()], seen_trans - expected,
                               seen_first - np.array([(1 - p[starts]).sum(), p[starts].sum()])]) / len(token)
        grad -= RIDGE * shape
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad ** 2
        shape = shape + RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-9)
    model.weights = shape[:FEATURES].copy()
    model.bias, model.log_trans, model.log_first = float(shape[-7]), shape[-6:-2].reshape(2, 2).copy(), shape[-2:].copy()
    scorer = Scorer(model)
    scorer_rows = scorer.marginals([words for words, _ in held])
    x = np.array([document_features(p) for p in scorer_rows])
    model.calibration = logistic(x, np.array([float(t) for _, t in held]))
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton steps, both classes weighing the same (so one half is a fair threshold)."""
    b = np.zeros(x.shape[1])
    share = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        b = b + np.linalg.solve(h, x.T @ (share * (y - p)) - ridge * b)
    return b


class Scorer:
    """Token marginals of texts under a model, with a bounded memory of word weights."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.parts: list[tuple[float, float, float]] = []

    def _add(self, word: str) -> int:
        k = self.numbers[word] = len(self.parts)
        w = self.model.weights
        after, before = neighbour_ids(word)
        self.parts.append((float(sum(w[i] for i in feature_ids(word))), float(w[after]), float(w[before])))
        return k

    def marginals(self, docs: list[list[str]]) -> list[np.ndarray]:
        """One array of marginals per document (its tokens given)."""
        if len(self.numbers) > MEMO_WORDS:                # only between batches
            self._forget()
        sizes = [len(d) for d in docs]
        get, add = self.numbers.get, self._add
        token = np.fromiter((k if (k := get(w)) is not None else add(w) for d in docs for w in d), dtype=np.int64, count=sum(sizes))
        if not len(token):
            return [np.zeros(0) for _ in docs]
        table = np.array(self.parts)
        cuts = np.cumsum([0, *sizes])
        starts = np.zeros(len(token), dtype=bool)
        starts[cuts[:-1][np.array(sizes) > 0]] = True
        lift = table[token, 0]
        lift[1:] += np.where(starts[1:], 0.0, table[token[:-1], 1])
        lift[:-1] += np.where(starts[1:], 0.0, table[token[1:], 2])
        p = self.model.token_marginals(lift, starts)
        return [p[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def spans_of(text: str, p: np.ndarray) -> list[dict]:
    """Offending spans (code point offsets): runs of tokens with a marginal of one half or more."""
    out: list[dict] = []
    if not len(p) or p.max() < 0.5:
        return out
    inside = False
    for m, q in zip(TOKEN.finditer(text), p.tolist(), strict=True):
        if q >= 0.5:
            if inside:
                out[-1]["end"], out[-1]["p"] = m.end(), max(out[-1]["p"], q)
            else:
                out.append({"start": m.start(), "end": m.end(), "p": q})
        inside = q >= 0.5
    return out


def fold(id_col: str) -> F.Column:
    """crc32 of the id as text, mod 5 (a null id as the empty text); rows of remainder 0 are never learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> list[tuple[str, int]]:
    """The bounded sample of labelled rows that the model is fitted on, in a fixed order."""
    usable = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
              .where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull()).where(fold("_id") != 0)
              .groupBy("_id").agg(F.max("_y").alias("_y")).withColumn("_mix", F.xxhash64(F.lit(17), "_id")))
    chosen = (usable.where("_y = 1").orderBy("_mix", "_id").limit(MAX_TOXIC)
              .unionAll(usable.where("_y = 0").orderBy("_mix", "_id").limit(MAX_CLEAN)))      # bounded: safe to broadcast
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_mix", "_y").agg(F.min("_text").alias("_text"))
    return [(r["_text"], r["_y"]) for r in sorted(found.collect(), key=lambda r: (r["_mix"], r["_id"]))]


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic") -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``score`` (0 to 1), ``predicted`` and ``spans`` (start, end, p).

    Defined cases: a null text counts as empty and, like any text without
    tokens, gets the score of no evidence; without labels of both classes every
    score is 0 (or 1 if all are toxic); of several labels of one id the toxic
    one holds; null labels and null ids teach nothing; repeated rows are scored
    one by one; an empty table gives an empty result; extra columns are ignored.
    """
    model = fit(training_rows(docs, labels, id_col, text_col, label_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("_id"), (fold(id_col) == 0).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = (f"_id {rows.schema['_id'].dataType.simpleString()}, held_out boolean, score double, "
              "spans array<struct<start:int,end:int,p:double>>")
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str], list[list[str]]]]:
        at, texts, tokens, held = 0, [], [], 0
        for text in batch.column(2).to_pylist():
            texts.append(text)
            tokens.append(TOKEN.findall(text))
            held += len(tokens[-1])
            if held >= BATCH_TOKENS:
                yield batch.slice(at, len(texts)), texts, tokens
                at, texts, tokens, held = at + len(texts), [], [], 0
        if texts:
            yield batch.slice(at, len(texts)), texts, tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for part, texts, tokens in groups(batch):
                found = scorer.marginals(tokens)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([scorer.model.document_score(p) for p in found], pa.float64()),
                    pa.array([spans_of(t, p) for t, p in zip(texts, found, strict=True)], spans_type)],
                    ["_id", "held_out", "score", "spans"])

    return rows.mapInArrow(run, schema).select(
        F.col("_id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
