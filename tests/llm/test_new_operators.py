"""Harmonic packing, importance resampling and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(params=["table", "odd", "empty"])
def table(request, spark, odd_docs, no_docs):
    return {"table": spark.read.parquet(f"{SF}/documents.parquet"), "odd": odd_docs, "empty": no_docs}[request.param]


# ------------------------------------------------------------------ harmonic packing
def test_harmonic_pieces_hold_every_token_once(spark, table):
    from tokenizers import Tokenizer

    from tallyframe.llm.harmonic import pack_harmonic
    from tallyframe.llm.packing import sequences

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids_of = Counter()
    for r in table.select("doc_id", "text").collect():
        ids = np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        ids_of[r["doc_id"], ids] += 1
    packed = pack_harmonic(table.repartition(3), P.path("byte_bpe_50k.json"), with_ids=True)
    found = packed.collect()
    parts, places = defaultdict(list), defaultdict(list)
    for r in found:
        parts[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["length"] * 4 == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(bytes(r["ids"]))
    for (doc, n), own in parts.items():      # repeated rows: every start as often as the row
        want = Counter({k[1]: c for k, c in ids_of.items() if k[0] == doc and len(k[1]) == 4 * n})
        covered = Counter()
        for start, data in own:
            assert any(ids[4 * start:4 * start + len(data)] == data for ids in want)
            for j in range(len(data) // 4):
                covered[start + j] += 1
        assert covered == Counter({j: sum(want.values()) for j in range(n)})
    assert {(d, n) for d, n in parts} == {(d, len(i) // 4) for d, i in ids_of}
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024
    assert sum(len(r["ids"]) for r in sequences(packed).collect()) == sum(len(i) * c for (_, i), c in ids_of.items())


def test_harmonic_classes_hold_their_count_and_little_padding(spark):
    from tallyframe.llm.harmonic import Bins, Piece, pack_harmonic, padding_report, piece_lengths

    for n in range(1, 5000):
        lengths = piece_lengths(n)
        assert sum(lengths) == n and lengths[:n // 1024] == [1024] * (n // 1024) and len(lengths) <= n // 1024 + 4
        for x in lengths:
            share = 1024 / (1024 // x)
            assert share - x < max(1.0, 0.02 * share)
    bins = Bins(1024, 7)
    for _ in range(8):
        bins.put(Piece("d", 0, bytes(4 * 341), 341))
    assert [len(s) for s in bins.closed] == [3, 3]
    bins.finish()
    assert sorted(sum(map(len, s)) for s in bins.closed) == sorted([1023, 1023, 512, 128, 32, 8, 2])
    report = padding_report(pack_harmonic(spark.read.parquet(f"{SF}/documents.parquet"), P.path("byte_bpe_50k.json"))).first()
    assert report["padding"] <= 0.005 * report["tokens"]


def test_harmonic_query(spark):
    from tallyframe.llm.queries import queries

    out = queries()["op11_harmonic"](spark, SF)
    assert dict(out.dtypes) == {c: "bigint" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
    assert out.agg({"length": "sum"}).first()[0] == out.where("start = 0").agg({"doc_tokens": "sum"}).first()[0]


# ------------------------------------------------------------------ importance resampling
def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_resample(docs, target, share=(25, 100), min_words=20, size=10_000):
    def features(text):
        w = words_of(text)
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    def count(texts):
        return Counter(zlib.crc32(f.encode()) % size for t in texts for f in features(t))

    s, t = count(x for _, x in docs), count(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + size) / ((s[b] + 1.0) * (t_all + size)))) for b in range(size)}
    out = []
    for i, x in docs:
        f = features(x)
        weight = math.floor(sum(gain[zlib.crc32(w.encode()) % size] for w in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(x))])
    fit = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    k = share[0] * len(fit) // share[1]
    ranks = {id(r): j + 1 for j, r in enumerate(fit[:k])}
    return Counter((*r[:4], ranks.get(id(r))) for r in out)


@pytest.mark.parametrize("share", [(25, 100), (1, 3), (0, 1), (1, 1)])
def test_importance_equals_brute_force(spark, table, share):
    from tallyframe.llm.importance import importance_resample

    if share != (25, 100) and table.count() > 100:
        table = table.limit(60)
    target = spark.read.parquet(f"{SF}/benchmark.parquet").unionByName(
        spark.createDataFrame([(None, None), (None, "")], "item_id BIGINT, text STRING"), allowMissingColumns=True)
    found = importance_resample(table.repartition(3), target, share=share).collect()
    docs = [(r["doc_id"], r["text"]) for r in table.collect()]
    want = brute_resample(docs, [r["text"] for r in target.collect()], share)
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found) == want


def test_importance_long_texts_in_blocks(monkeypatch):
    from tallyframe.llm import importance

    text = "A-b c9 ÉÈ straße  tail_end, " * 50 + "x"
    want = Counter(zlib.crc32(" ".join(g).encode()) for n in (1, 2, 3) for w in [words_of(text)] for g in zip(*[w[i:] for i in range(n)]))
    for size in (1, 7, 40, 1 << 20):
        monkeypatch.setattr(importance, "BLOCK_BYTES", size)
        assert Counter(h for _, part in importance.feature_hashes(text, 3) for h in part.tolist()) == want


def test_importance_bracket_widens_and_holds_ties(spark):
    from pyspark.sql import functions as F

    from tallyframe.llm.importance import bracket, ranked

    rows = spark.range(3000).select(F.col("id").alias("_id"), F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).cast("long").alias("s"))
    values = sorted((r["s"] for r in rows.collect()), reverse=True)
    for k in (1, 2, 499, 1500, 2500, 2999, 3000):
        for margin in (1e-9, 1e-3):
            low, high, above = bracket(rows, "s", k, 3000, margin)
            assert above == sum(v > high for v in values) < k <= sum(v >= low for v in values)
    places = ranked(rows, [F.col("s").desc(), F.col("_id").asc()]).collect()
    want = sorted(((r["s"], r["_id"]) for r in places), key=lambda x: (-x[0], x[1]))
    assert [(r["s"], r["_id"]) for r in sorted(places, key=lambda r: r["_rank"])] == want
    assert sorted(r["_rank"] for r in places) == list(range(1, 3001))


def test_importance_draws_documents_like_the_target(spark):
    from tallyframe.llm.importance import importance_resample

    def text(i):
        return " ".join(f"{'good' if i % 4 == 0 else 'other'}{(i * 7 + j) % 40}" for j in range(40))

    docs = spark.createDataFrame([(i, text(i), "c") for i in range(400)], "doc_id BIGINT, text STRING, rank STRING")
    target = spark.createDataFrame([(text(4 * i),) for i in range(30)], "text STRING")
    out = importance_resample(docs, target, carry=("rank",)).toDF("doc_id", "own", "n_features", "weight", "score", "rank").collect()
    drawn = [r["doc_id"] for r in out if r["rank"] is not None]
    assert len(drawn) == 100 and sum(i % 4 == 0 for i in drawn) > 60


def test_importance_query(spark):
    from tallyframe.llm.queries import queries

    out = queries()["op12_importance"](spark, SF)
    assert dict(out.dtypes) == {c: "bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")}
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert Counter(tuple(r) for r in out.collect()) == brute_resample(docs, target)


# ------------------------------------------------------------------ conversation repair
TALK = re.compile(r"(s?(ua)+)?")


def brute_faults(rows):
    """(role, text, fault) of the rows (turn, role, text) of one conversation, in order."""
    seen, out = set(), []
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute_repair(rows):
    """(cost, audit, result) by a cheapest-first search: (cost, audit) never falls along a path, so the first end is the answer."""
    def step(state, initial):
        nxt = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
        return nxt.get((state, initial))

    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, result = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, result
        for role in ("user", "assistant"):
            to = step(state, role[0])
            if to:
                heapq.heappush(queue, (cost + 3, audit + "I", i, to, (*result, f"{role}:")))
        if i < len(rows):
            own, text, fault = rows[i]
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, state, result))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault else 0
            for edit, role, price in [("K", own, 0), ("R", "user", 3), ("R", "assistant", 3)]:
                to = step(state, role[:1])
                if to:
                    heapq.heappush(queue, (cost + price + extra, audit + edit, i + 1, to, (*result, f"{role}:{text}")))


def brute_damage(table):
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        own = convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        own += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return convs


def brute_facts(table):
    out = {}
    for conv, rows in brute_damage(table).items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in rows if t is not None]
        faults = brute_faults(rows)
        count = Counter(f for _, _, f in faults)
        initials = [r[:1] for r, _, _ in faults]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, result = brute_repair(faults)
        assert TALK.fullmatch("".join(r[:1] for r in result))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["duplicate"], count["truncated"],
                     illegal, cost, audit, hashlib.sha256("\n".join(result).encode()).hexdigest(), result)
    return out


FACT_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("case", ["table", "odd", "empty"])
def test_repair_equals_brute_force(spark, odd_turns, case):
    from tallyframe.llm.repair import damaged, repair_conversations, repaired_rows

    df = {"table": spark.read.parquet(f"{SF}/conversations.parquet"), "odd": odd_turns, "empty": odd_turns.limit(0)}[case]
    want = brute_facts([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()])
    rows = damaged(df.repartition(3))
    found = repair_conversations(rows)
    assert {r["conv_id"]: tuple(r[c] for c in FACT_COLUMNS) for r in found.collect()} == {c: f[:-1] for c, f in want.items()}
    assert found.count() == len(want)
    after = defaultdict(list)
    for r in repaired_rows(rows, found).collect():
        after[r["conv_id"]].append((r["place"], f"{r['role']}:{r['text']}"))
    assert {c: tuple(t for _, t in sorted(x)) for c, x in after.items()} == {c: f[-1] for c, f in want.items() if f[-1]}
    assert all([p for p, _ in sorted(x)] == list(range(len(x))) for x in after.values())


def test_repair_audits_equal_a_plain_search(monkeypatch):
    import random

    from tallyframe.llm.repair import CUT_SHORT, FINE, MUST_GO, Parse, Repairer

    rng, kinds = random.Random(5), {"": FINE, "truncated": CUT_SHORT, "blank": MUST_GO}
    repairer = Repairer()
    for trial in range(1500):
        monkeypatch.setattr(Parse, "CHUNK_ROWS", (1, 3, 4096)[trial % 3])
        rows = [(rng.choice(["system", "user", "assistant", "tool"] if trial % 2 else ["user", "assistant"]), f"{i}", rng.choice(["", "", "", "truncated", "blank"]))
                for i in range(rng.randrange(9) if trial % 50 else 60)]
        parse = Parse(repairer)
        for role, text, fault in rows:
            parse.read(role, text, kinds[fault])
        cost, audit, digest = parse.finish()
        want = brute_repair(rows)
        assert (cost, audit) == want[:2] and digest == hashlib.sha256("\n".join(want[2]).encode()).hexdigest()
    assert len(repairer.steps) < 5000


def test_repair_grammar_table():
    import itertools

    from tallyframe.llm.repair import END, GRAMMAR, START, Stacks, Table

    stacks = Stacks(Table(GRAMMAR, START))
    sizes = []
    for n in range(7):
        sizes.append(len(stacks.cells))
        for word in itertools.product("sua", repeat=n):
            cells = {0}
            for symbol in word:
                cells = {c for cell in cells for c in stacks.after(cell, symbol)}
            assert any(stacks.after(c, END) for c in cells) == bool(TALK.fullmatch("".join(word)))
    assert sizes[6] == len(stacks.cells)          # however long the conversation


def test_repair_long_conversation_in_chunks(spark):
    from tallyframe.llm.repair import plain, repair_conversations

    rows = [(1, k, ("tool", "user", "assistant")[k % 7 % 3], f"Line {k}.") for k in range(9000)] + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    found = {r["conv_id"]: r for r in repair_conversations(plain(spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING"))).collect()}
    cost, audit, result = brute_repair([(r, t, "") for c, _, r, t in rows if c == 1])
    assert (found[1]["cost"], found[1]["audit"]) == (cost, audit)
    assert found[1]["repaired_sha256"] == hashlib.sha256("\n".join(result).encode()).hexdigest()
    assert found[2]["audit"] == "KK" and found[2]["cost"] == 0


def test_repair_deals_rows_once(spark):
    from tallyframe.llm.repair import damaged, repair_conversations

    plan = repair_conversations(damaged(spark.read.parquet(f"{SF}/conversations.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_repair_query(spark):
    from tallyframe.llm.queries import queries

    out = queries()["op13_repair"](spark, SF)
    want = brute_facts([tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()])
    assert {r["conv_id"]: tuple(r[c] for c in FACT_COLUMNS) for r in out.collect()} == {c: f[:-1] for c, f in want.items()}


# ------------------------------------------------------------------ stages
def test_near_dedup_keeps_every_unlinked_text(spark):
    """Rows of one id: a text that is linked with nothing stays, whatever else has its id."""
    from tallyframe.llm import stages

    a = " ".join(f"a{i}" for i in range(40))
    b, c = " ".join(f"b{i}" for i in range(40)), " ".join(f"c{i}" for i in range(40))
    rows = [(1, a, "x"), (5, a + " more", "x"), (5, b, "x"), (None, c, "x"), (None, c + " end", "y"), (7, c + " last", "z"),
            (9, "short", "x"), (9, "short", "w"), (8, None, "x"), (8, "", "x"), (8, None, "x"), (6, b + " tail", "x"), (6, b + " tail two", "x")]
    for cols in ("doc_id BIGINT, text STRING, _others STRING", "doc_id BIGINT, text STRING, key STRING"):
        docs = spark.createDataFrame(rows, cols).repartition(3)
        kept = stages.near_dedup(spark, docs, SF)
        assert kept.columns == docs.columns
        got = Counter((r[0], r[1]) for r in kept.collect())
        assert got == Counter([(1, a), (5, b), (7, c + " last"), (9, "short"), (8, None), (8, ""), (8, None)])
        assert [r[2] for r in kept.where("doc_id = 9").collect()] == ["w"]


def test_exact_dedup_stage_keeps_texts_of_kept_rows(spark, table):
    from tallyframe.llm import stages

    kept = stages.exact_dedup(spark, table.repartition(5), SF)
    assert kept.columns == table.columns
    best = {}
    for r in table.collect():
        t = r["text"] or ""
        best[t] = max((x for x in (best.get(t), r["doc_id"]) if x is not None), default=None)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter((i, t) for t, i in best.items())


def test_bitmap_holds_every_key_in_a_bit_each(spark):
    from tallyframe.llm import sketch

    keys = spark.range(5000).selectExpr("xxhash64(id) AS k")
    packed = sketch.bitmap(keys, 1 << 20)
    own = np.array([r["k"] for r in keys.collect()], np.int64)
    assert len(packed) == 1 << 17 and sketch.in_bitmap(packed, own).all()
    assert np.unpackbits(packed).sum() == len({int(k) & ((1 << 20) - 1) for k in own.tolist()})


# ------------------------------------------------------------------ quality: the table in slices
def test_quality_units_are_named_like_plain_words(monkeypatch):
    """Two units have the same hash exactly if their plain names are equal."""
    import random

    from tallyframe.llm import quality

    def names(text):
        out = []
        for unit in re.findall(r"[\x80-\U0010ffff\w]+|[^ \t\n\r\x0b\x0c\w\x80-\U0010ffff]+", text):
            if not re.match(r"[\x80-\U0010ffff\w]", unit):
                out.append("m:" + unit)
            elif len(unit) > 1 and unit.isupper():
                out.append("U:")
            else:
                out.append(f"N:{min(len(unit), 20)}" if unit.isdigit() else "w:" + "".join(c.lower() if ord(c) < quality.CASED else c for c in unit))
        return out

    rng, seen = random.Random(6), {}
    alphabet = [*"abcxyzABC019_", *".,-#'\x00\x7f", *" \t\n\r\x0b\x0c", *"éÉüÜßжЖαΩ中文\xa0\u2028😀"]
    for trial in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        monkeypatch.setattr(quality, "BLOCK_CHARS", (5, 1 << 18)[trial % 2])
        found = quality.unit_hashes(text).tolist()
        want = names(text)
        assert len(found) == len(want)
        for name, h in zip(want, found):
            assert seen.setdefault(name, h) == h
    assert len(set(seen.values())) == len(seen) > 3000
    assert len(quality.unit_hashes("")) == 0 and len(quality.unit_hashes(" \n")) == 0


def test_quality_counts_are_packed_and_merged_exactly():
    from tallyframe.llm.quality import packed, unpacked

    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (1, 2**62), (1000, 2**20), (5000, 2**62), (300, 300)):
        keys = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        counts = rng.integers(1, 2**33 if n == 300 else 3, len(keys))
        again = unpacked(packed(keys, counts))
        assert (again[0] == keys).all() and (again[1] == counts.astype(np.uint64)).all()
    dense = np.unique(rng.integers(0, 2**28, 10**6, dtype=np.uint64))
    assert len(packed(dense, np.ones(len(dense), np.int64))) < 1.6 * len(dense)


def test_quality_scores_equal_brute_force(spark, odd_docs, monkeypatch):
    """llr and kept of every row, from exact counts of n-gram hashes; rare values and many slices included."""
    from tallyframe.llm import quality

    monkeypatch.setattr(quality, "SLICE_BYTES", 1 << 12)
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd_docs.select("doc_id", "text", "lang", "source", "n_chars"))
    good = spark.createDataFrame([(i,) for i in (*range(0, 150, 2), None, 4, 4)], "doc_id BIGINT")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    words, grams = quality.Words(), []
    for _, text in rows:
        grams.append(quality.ngrams(words.units(words.number(text.encode().split()))).tolist())
    raw = Counter(g for own in grams for g in own)
    buckets = max(1 << 16, 1 << (len(raw) - 1).bit_length())
    trusted = {i for (i,) in good.collect() if i is not None}
    a, b = np.full(buckets, 0.5), np.full(buckets, 0.5)
    for (i, _), own in zip(rows, grams):
        for g in own:
            b[g * buckets >> 64] += 1
            a[g * buckets >> 64] += i in trusted
    ratio = np.log(a / a.sum()) - np.log(b / b.sum())
    want = sorted((i if i is not None else -1, round(float(np.mean([ratio[g * buckets >> 64] for g in own])), 4) if own else 0.0) for (i, _), own in zip(rows, grams))
    found = quality.judge(docs, good).collect()
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, round(r["llr"], 4)) for r in found)
    assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([x for _, x in got], [x for _, x in want], atol=2e-4)
    assert all(r["kept"] == (not r["base_failed"] and r["llr"] >= quality.THRESHOLD) for r in found)


def test_quality_rejects_alike_at_two_sizes(spark):
    """The share of rejected rows of bad quality doesn't fall as the corpus grows."""
    from tallyframe.llm.quality import judge, trusted_ids

    shares = []
    for sf in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        bad = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").select("doc_id")
        judged = judge(spark.read.parquet(f"{sf}/documents.parquet"), trusted_ids(spark, sf)).where("not base_failed").join(bad, "doc_id")
        shares.append(judged.where("not kept").count() / judged.count())
    assert min(shares) > 0.9 and abs(shares[0] - shares[1]) < 0.02 + 1 - min(1, shares[0])


def test_quality_without_trusted_rows(spark, odd_docs):
    from tallyframe.llm.quality import judge

    none = spark.createDataFrame([(999,)], "doc_id BIGINT")
    assert {r["llr"] for r in judge(odd_docs, none).collect()} == {0.0}


# ------------------------------------------------------------------ html
BODY = [f"Sentence {k} of the article goes on for long enough to be counted as a line of its text." for k in range(5)]
TEXT = "".join(f"<p>{t}</p>" for t in BODY)


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>", "<main><div class=post>{}</div></main>"])
def test_html_adverts_and_names(wrap):
    from tallyframe.llm.html_text import extract

    def got(html):
        return extract(f"<body><nav><a>Home</a></nav>{wrap.format(html)}<footer>&copy; Foot</footer></body>").split("\n\n")

    # H1: a paragraph that is an advert or an alert goes, and the one after it stays.
    assert got(TEXT + '<p class="advert">Buy this, it is cheap and good and here now.<p>Last words of the text.</p>') == [*BODY, "Last words of the text."]
    assert got(f'<p role="alert">Your session has run out, please sign in again.</p>{TEXT}') == BODY
    # H2: a boilerplate word inside a longer name does not delete the article's text.
    inner = '<div class="side-effects"><p>The side effects of it are described in this line.</p></div>'
    assert got(TEXT + inner + "<p>End of the text.</p>") == [*BODY, "The side effects of it are described in this line.", "End of the text."]
    assert got(f'<div id="comment-policy-essay">{TEXT}</div>') == BODY
    assert got(TEXT + '<div class="ad-slot left">Buy now, cheap, and here.</div><div class="socialShare">Share it with all friends.</div>') == BODY


def test_html_forms_and_short_articles():
    from tallyframe.llm.html_text import extract

    # H3: a page in one form keeps its prose; a form beside text goes; controls go.
    assert extract(f"<form action=x>{TEXT}<button>Send</button><select><option>A</option></select></form>").split("\n\n") == BODY
    assert extract(f"<div>{TEXT}</div><form><p>Subscribe to our long letter, which comes once a week to you.</p></form>").split("\n\n") == BODY
    two = "<p>A short first line.</p><p>And a second one.</p>"
    assert extract(f"<article>{two}</article>") == extract(f"<div>{two}</div>") == "A short first line.\n\nAnd a second one."


def test_html_surge_decides_inside_a_declared_article():
    from tallyframe.llm.html_text import extract, main_lines

    links = "".join(f"<li><a href=x>Linked title number {k} of another page</a></li>" for k in range(6))
    # H4: what lies beyond a long list of links and never surges is no text; what surges again is.
    assert extract(f"<article><h1>Title</h1>{TEXT}<ul>{links}</ul><p>Tags</p></article>").split("\n\n") == ["Title", *BODY]
    assert extract(f"<article>{TEXT}<ul>{links}</ul>{TEXT}</article>").split("\n\n") == BODY + BODY
    assert main_lines([3, 2, 0, 200, 5], anchored=True) == [True] * 5
    assert main_lines([]) == [] and main_lines([0, 0]) == [False, False] and main_lines([1]) == [True]


def brute_main(weights, window=3, surge=80):
    """Kept lines by definition: a line lies in a stretch of non-empty windows, at or after its first line that surges."""
    n = len(weights)
    sums = [sum(weights[k:k + window]) for k in range(n)]
    limit = max(1, min(surge, max(sums, default=0) // 2))
    keep, k = [False] * n, 0
    while k < n:
        if sums[k] == 0:
            k += 1
            continue
        end = k
        while end < n and sums[end] > 0:
            end += 1
        starts = [j for j in range(k, end) if sums[j] >= limit and weights[j]]
        if starts:
            last = max(j for j in range(k, end) if weights[j])
            for j in range(starts[0], last + 1):
                keep[j] = True
        k = end
    return keep


def test_html_windows_equal_brute_force():
    import random

    from tallyframe.llm.html_text import main_lines

    rng = random.Random(2)
    for _ in range(3000):
        weights = [rng.choice([0, 0, 0, 3, 20, 60, 200]) for _ in range(rng.randrange(14))]
        assert main_lines(weights) == brute_main(weights), weights


def test_html_query_equals_a_plain_reader(spark):
    """The query over whole pages against a reader of the test pages' own layout: blocks of the article, in order."""
    from html import unescape

    from tallyframe.llm.queries import queries

    def plain(html):
        body = re.sub(r"(?s)<(script|style)\b.*?</\1>|<!--.*?-->", " ", html or "")
        found = re.search(r"(?s)<article>(.*?)</article>", body)
        blocks = re.split(r"</?(?:p|h1|h2|h3|div|ul|li)\b[^>]*>", found.group(1)) if found else []
        texts = [" ".join(unescape(re.sub(r"<[^>]+>", "", re.sub(r"<br[^>]*>", " ", b))).split()) for b in blocks]
        return "\n\n".join(t for t in texts if t)

    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = {r["page_id"]: r for r in queries()["op3_html"](spark, sf).collect()}
    assert set(out) == set(pages)
    for i, html in pages.items():
        assert out[i]["text"] == plain(html) and out[i]["n_chars"] == len(out[i]["text"])


# ------------------------------------------------------------------ archives, hot keys, orders
def test_warc_same_rows_in_any_order_give_the_same_archive(spark, scratch):
    import random

    from tallyframe.llm.warc import write_warc

    rows = [(7, "http://same", "<p>" + f"{k} " * 60 + "</p>") for k in range(40)] + [(k, f"http://{k}", "<p>" + f"{k % 9} " * 90) for k in range(60)]
    rows += [(None, None, f"null {k % 3}" * 40) for k in range(50)]
    found = []
    for trial in range(3):
        random.Random(trial).shuffle(rows)
        df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").repartition(2 + 3 * trial)
        folder = f"file://{scratch}/w{trial}"
        manifest = write_warc(df, folder, file_bytes=1500, part_bytes=4000)
        found.append(sorted(tuple(r) for r in manifest.collect()))
        assert sum(r[1] for r in found[-1]) == len(rows)
    assert found[0] == found[1] == found[2] and len({f[0].split("-")[1] for f in found[0]}) > 3
    per_part = Counter()
    for name, records, *_ in found[0]:
        per_part[name.split("-")[1]] += records
    assert max(per_part.values()) < 60                    # neither the hot id nor the null ids are one partition


def test_packing_spreads_rows_of_one_key(spark):
    from pyspark.sql import functions as F

    from tallyframe.llm.packing import pack

    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(0).alias("piece"), (F.col("id") % 900 + 1).alias("length"))
    path = f"{spark.conf.get('spark.checkpoint.dir')}/pieces_one_key"
    rows.write.mode("overwrite").parquet(path)
    packed = pack(spark.read.parquet(path), ("doc_id", "piece"), capacity=2048, shard_rows=100)
    per_shard = packed.groupBy(F.shiftright("sequence_id", 40).alias("s")).count()
    assert packed.count() == 3000 and per_shard.agg({"count": "max"}).first()[0] < 200


def brute_stratified(rows, shards, seed_rank):
    """Shard of every row of (key, source): ranks in the source by the seeded hash, then all rows by fractional rank."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    placed = []
    for source, own in by.items():
        own.sort(key=lambda r: seed_rank[r[0]])
        placed += [((k + 1 - seed_rank["u", source]) / len(own), seed_rank[r[0]], r[0]) for k, r in enumerate(own)]
    placed.sort()
    n = len(placed)
    return {key: (k * shards // n, k - -(-(k * shards // n) * n // shards)) for k, (_, _, key) in enumerate(placed)}


def test_stratified_order_equals_brute_force(spark):
    """Shard and slot of every row, from the same seeded hashes, in plain Python; in one bucket and in many."""
    from pyspark.sql import functions as F

    from tallyframe.llm.sharding import OFFSET_SPACE, stratified_shards

    docs = spark.read.parquet(f"{SF}/documents.parquet").dropDuplicates(["doc_id"])
    mixes = docs.select("doc_id", "source", F.xxhash64(F.lit(42), "doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).alias("m"),
                        F.expr(f"pmod(xxhash64(42, coalesce(concat('s', source), 'n')), {OFFSET_SPACE}L)").alias("u")).collect()
    rank = {r["doc_id"]: (r["m"] % (1 << 31), r["m"]) for r in mixes} | {("u", r["source"]): (r["u"] + 0.5) / OFFSET_SPACE for r in mixes}
    for bucket_rows in (20_000,):
        found = {r["doc_id"]: (r["shard"], r["slot"]) for r in stratified_shards(docs, shards=16, bucket_rows=bucket_rows).collect()}
        ordered = {k: (v[1] if isinstance(v, tuple) else v) for k, v in rank.items()}
        assert found == brute_stratified([(r["doc_id"], r["source"]) for r in mixes], 16, ordered)


def test_stratified_equal_rows_are_spread(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tallyframe.llm import sharding

    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("s").alias("source"),
                                  F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).otherwise("same").alias("text"))
    tables, write = {}, sharding.written
    monkeypatch.setattr(sharding, "written", lambda d, name: tables.setdefault(name, write(d, name)))
    placed = sharding.stratified_shards(df, shards=7, bucket_rows=100)
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) - min(sizes) <= 1
    assert tables["shard_ranks"].groupBy("_part").count().agg({"count": "max"}).first()[0] < 200
    assert tables["shard_ranks"].groupBy("_mix").count().agg({"count": "max"}).first()[0] < 10
    hot = placed.where("doc_id IS NULL").groupBy("shard").count().collect()
    assert max(r["count"] for r in hot) - min(r["count"] for r in hot) < 80


# ------------------------------------------------------------------ the pipeline
def brute_pipeline(rows, trusted):
    """Pieces (doc_id, piece, start, length, crc) of the rows (doc_id, text) that the five stages keep."""
    from tokenizers import Tokenizer

    from tallyframe.llm import quality
    from tests.llm.test_operators import brute_groups, brute_repeats, sizes

    words = quality.Words()
    grams = [quality.ngrams(words.units(words.number((t or "").encode().split()))).tolist() for _, t in rows]
    raw = Counter(g for own in grams for g in own)
    buckets = max(1 << 16, 1 << (len(raw) - 1).bit_length())
    a, b = np.full(buckets, 0.5), np.full(buckets, 0.5)
    for (i, _), own in zip(rows, grams):
        for g in own:
            b[g * buckets >> 64] += 1
            a[g * buckets >> 64] += i in trusted
    ratio = np.log(a / a.sum()) - np.log(b / b.sum())
    good = []
    for (i, t), own in zip(rows, grams):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        times = Counter(windows)
        covered = {k + j for k, g in enumerate(windows) if times[g] > 1 for j in range(8)}
        if len(w) >= 20 and 100 * len(covered) <= 30 * len(w) and np.mean([ratio[g * buckets >> 64] for g in own]) >= quality.THRESHOLD:
            good.append((i, t))
    best = {}
    for i, t in good:
        best[t] = i if t not in best or best[t] is None else max(best[t], -1 if i is None else i)
    distinct = [(i, t) for t, i in best.items()]
    _, group = brute_groups([t for _, t in distinct], 5, 80)
    members = defaultdict(list)
    for k, g in enumerate(group):
        members[g].append(k)
    lone = [distinct[min(own, key=lambda k: (distinct[k][0] is None, distinct[k][0] or 0))] for own in members.values()]
    raws = [t.encode() for _, t in lone]
    out = Counter()
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for (i, _), data, gone in zip(lone, raws, brute_repeats(raws)):
        text = bytes(x for x, g in zip(data, gone) if not g).decode(errors="ignore")
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, n in enumerate(sizes(len(ids))):
            out[i, k, at, n, zlib.crc32(ids[at:at + n].tobytes())] += 1
            at += n
    return out


@pytest.mark.parametrize("case", ["table", "odd"])
def test_pipeline_equals_brute_force(spark, scratch, odd_docs, case):
    import corpus_pipeline

    folder = SF
    if case == "odd":
        folder = scratch
        text = lambda name, n=60: " ".join(f"{name}{k}" for k in range(n))      # noqa: E731
        passage = " ".join(f"shared{k}" for k in range(60))
        more = [(1, text("a")), (5, text("a") + " word"), (5, text("b")), (None, text("c")), (6, text("c")), (7, None), (8, text("d")), (8, text("d")),
                (9, text("e") + " " + passage), (10, text("f") + " " + passage + " tail"), (None, text("g")), (11, text("h") + " é" * 3)]
        added = spark.createDataFrame(more, "doc_id BIGINT, text STRING")
        odd_docs.unionByName(added, allowMissingColumns=True).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(i, 1, 0) for i in (1, 3, 5, 6, 8, 9, 10, 11)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()}
    want = brute_pipeline([(r["doc_id"], r["text"]) for r in docs.collect()], trusted)
    found = corpus_pipeline.run(spark, folder).collect()
    assert len(want) > 6 and Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:])) and sum(n for _, n in own) <= 2048


# ------------------------------------------------------------------ every query by name, and the choice of a sequence
LONGS = "bigint"
CONTRACTS = {
    "op1_bpe": {"doc_id": LONGS, "n_tokens": LONGS, "ids_sha256": "string", "decoded_sha256": "string"},
    "op2_packing": {"doc_id": LONGS, "piece": "int", "start": LONGS, "length": LONGS, "ids_crc32": LONGS, "sequence_id": LONGS, "offset": LONGS},
    "op3_html": {"page_id": LONGS, "url": "string", "text": "string", "n_chars": LONGS},
    "op4_content_sort": {"doc_id": LONGS, "keep_id": LONGS, "group_size": LONGS, "kept": "boolean", "text_sha256": "string"},
    "op5_quality": {"doc_id": LONGS, "n_words": LONGS, "word_chars": LONGS, "n_symbols": LONGS, "n_dup_lines": LONGS, "n_repeat_words": LONGS,
                    "base_failed": "boolean", "kept": "boolean"},
    "op6_warc": {"page_id": LONGS, "payload_bytes": LONGS, "payload_digest": "string", "record_type": "string", "refers_to": LONGS},
    "op7_stratified": {"doc_id": LONGS, "size": LONGS, "text_crc32": LONGS, "law": "string", "shard": "int", "slot": LONGS, "grown_shard": "int"},
    "op8_toxicity": {"doc_id": LONGS, "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_suffix": {"doc_id": LONGS, "n_bytes": LONGS, "n_removed": LONGS, "n_spans": LONGS, "kept_sha256": "string"},
    "op10_ngram_join": {"doc_id": LONGS, "n_shingles": LONGS, "component_id": LONGS},
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_query_columns_and_rows(spark, name):
    from tallyframe.llm.queries import queries

    out = queries()[name](spark, SF)
    types = dict(out.dtypes)
    assert {c: types.get(c) for c in CONTRACTS[name]} == CONTRACTS[name]
    found = out.collect()
    key = "page_id" if "page_id" in types else "doc_id"
    rows = spark.read.parquet(f"{SF}/{'pages' if key == 'page_id' else 'documents'}.parquet").collect()
    ids = Counter(r[key] for r in rows)
    assert Counter(r[key] for r in found if r.asDict().get("piece", 0) == 0) == ids
    if name == "op7_stratified":
        text = {r["doc_id"]: (r["text"] or "").encode() for r in rows}
        sizes = Counter(r["shard"] for r in found)
        assert {r["law"] for r in found} == {"rows"} and set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
        assert all(r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in found)
        assert all(sorted(r["slot"] for r in found if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    if name == "op8_toxicity":
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    if name == "op9_suffix":
        assert all(r["n_bytes"] == len((t["text"] or "").encode()) for t in rows for r in found if r["doc_id"] == t["doc_id"])


def test_packing_chooses_the_smallest_sum_of_squares():
    import random

    from tallyframe.llm.packing import sum_of_squares

    def brute(lengths, capacity):
        gaps = []                                        # of every sequence, full ones included
        for size in lengths:
            best = None
            for gap in sorted({g for g in gaps if g >= size}):
                after = list(gaps)
                after[after.index(gap)] = gap - size
                cost = sum(n * n for g, n in Counter(after).items() if g)
                if best is None or cost < best[0]:
                    best = cost, gap
            if best is None:
                gaps.append(capacity - size)
            else:
                gaps[gaps.index(best[1])] -= size
        return Counter(gaps)

    rng = random.Random(4)
    for _ in range(150):
        lengths = sorted((rng.randrange(1, 33) for _ in range(rng.randrange(60))), reverse=True)
        sequence, offset = sum_of_squares(np.array(lengths, dtype=np.int64), 32)
        filled = Counter()
        for n, s, at in zip(lengths, sequence.tolist(), offset.tolist()):
            assert at == filled[s]
            filled[s] += n
        assert Counter(32 - n for n in filled.values()) == brute(lengths, 32)
