"""Every operator against a brute-force version, on rows with all the odd cases, and on empty tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

SF = "/root/testdata/sf0.001"


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]


@pytest.fixture(params=["table", "odd", "empty"])
def table(request, spark, odd_docs, no_docs):
    return {"table": docs(spark), "odd": odd_docs, "empty": no_docs}[request.param]


def sizes(n):
    first = n % 2048 or 2048
    return [min(first, n), *[2048] * ((n - 1) // 2048 if n > 2048 and n % 2048 else max(0, n // 2048 - 1))]


def test_bpe_equals_the_tokeniser_library(spark, table):
    import tiktoken

    from tallyframe.llm.bpe import decode_ids, encode_documents, read_ranks

    path = P.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    coded = decode_ids(encode_documents(table, path), path, out_col="again").collect()
    want = Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows_of(table, "doc_id", "text"))
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), bytes(r["decoded"])) for r in coded) == want
    assert all(bytes(r["again"]) == bytes(r["decoded"]) for r in coded)


def test_packing_pieces_and_places(spark, table):
    from tokenizers import Tokenizer

    from tallyframe.llm.packing import pack_documents, sequences

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    packed = pack_documents(table, P.path("byte_bpe_50k.json"), with_ids=True)
    found = packed.collect()
    want = Counter()
    for i, t in rows_of(table, "doc_id", "text"):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, n in enumerate(sizes(len(ids))):
            want[i, k, at, n, zlib.crc32(ids[at:at + n].tobytes())] += 1
            at += n
        assert at == len(ids)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    filled = defaultdict(list)
    for r in found:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 2048
    total = sum(r["length"] for r in found)
    assert len(filled) <= 1.05 * total / 2048 + 1
    assert sum(len(r["ids"]) // 4 for r in sequences(packed).collect()) == total


def test_packing_reads_added_tokens_as_the_tokeniser_does(spark):
    from tokenizers import Tokenizer

    from tallyframe.llm.packing import token_pieces

    end = "<|endoftext|>"
    texts = [f"{end}at the start", f"in the  {end} middle", f"at the end {end}", end, f"{end}{end} \n{end}", "<|endoftext", f"a{end}b  "]
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    found = token_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING"), P.path("byte_bpe_50k.json"), with_ids=True)
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in found.collect()} == {
        k: [*tok.encode(t, add_special_tokens=False).ids, 0] for k, t in enumerate(texts)}


def test_html_keeps_the_article_alone():
    from tallyframe.llm.html_text import extract

    page = ("<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a>Menu</a></ul>"
            "<div class='cookie-notice'>We use cookies</div><article><h1>Head &amp; more</h1><p>First  <b>bold</b>\n line.<br>Next."
            "<p>Short.</p><div class=ad>Buy</div><p>a &lt; b</p></article><section class='comments'><article class='comment'>"
            "<p>A reader says a lot of things here that go on for long enough to be a surge of text.</p></article></section>"
            "<aside>Side</aside><footer>&copy; Foot</footer><script>var a='<p>no</p>'</script></body></html>")
    assert extract(page) == "Head & more\n\nFirst bold line. Next.\n\nShort.\n\na < b"
    assert extract("") == "" and extract("<nav><a>x</a></nav>") == ""
    body = "".join(f"<p>{'A sentence of the text without any container. ' * 3}</p>" for _ in range(4))
    assert extract(f"<div><a>Home</a></div><div><a>About</a></div>{body}<div><a>Next</a></div>").count("sentence") == 12


def test_html_text_outside_a_declared_article():
    from tallyframe.llm.html_text import extract

    body = [f"Sentence {k} of the main text, which lies in plain paragraphs and goes on for a while." for k in range(6)]
    cards = "".join(f"<article><p>Read this card about something else {k}</p></article>" for k in range(3))
    text = "".join(f"<p>{t}</p>" for t in body)
    assert extract(f"<div>{text}</div><section>{cards}</section>") == "\n\n".join(body)
    links = "".join(f"<div><a href=x>Link {k}</a></div>" for k in range(5))
    assert extract(f"<article>{text}{links}</article><p>Short note.</p>") == "\n\n".join(body)


def test_html_rows(spark):
    from tallyframe.llm.html_text import extract_text

    df = spark.createDataFrame([(1, "u", None, "c"), (1, "u", None, "c"), (None, None, "<article><p>x</p></article>", "c")],
                               "page_id BIGINT, url STRING, html STRING, text STRING")
    assert sorted(rows_of(extract_text(df), "url", "text", "n_chars"), key=str) == [("u", "", 0), ("u", "", 0), (None, "x", 1)]


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_dedup(spark, table, keep):
    from tallyframe.llm.exact_dedup import content_sort_dedup

    groups = defaultdict(list)
    for i, t in rows_of(table, "doc_id", "text"):
        groups[t or ""].append(i)
    pick = max if keep == "max" else min
    want = Counter()
    for t, ids in groups.items():
        best = pick((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
    found = content_sort_dedup(table, keep=keep).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == want
    assert Counter(r["text_sha256"] for r in found if r["kept"]) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in groups)


def test_exact_dedup_over_many_partitions(spark):
    """A group of copies that spans partitions, whose runs meet at their edges."""
    from tallyframe.llm.exact_dedup import content_sort_dedup

    df = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN concat('t', id % 7) ELSE 'same' END AS text")
    found = content_sort_dedup(df, keep="max")
    assert found.where("kept").count() == 8
    assert found.where("group_size = (SELECT count(*) FROM range(4000) WHERE id % 3 <> 0) AND keep_id = 3998").count() == 2666


def test_quality_base_rules(spark, table):
    import re

    from tallyframe.llm.quality import judge

    word = re.compile(r"[^\x20\x09-\x0D]+")
    want = Counter()
    for i, t in rows_of(table, "doc_id", "text"):
        t = t or ""
        w = word.findall(t)
        grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        times, covered, seen, dup = Counter(grams), set(), set(), 0
        for k, g in enumerate(grams):
            if times[g] > 1:
                covered.update(range(k, k + 8))
        for line in t.split("\n"):
            if word.search(line):
                dup += line in seen
                seen.add(line)
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered),
             len(w) < 20 or 100 * len(covered) > 30 * len(w)] += 1
    found = judge(table, spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")).collect()
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[c] for c in cols) for r in found) == want
    assert not any(r["kept"] for r in found if r["base_failed"])


def test_quality_separates_labelled_rows(spark):
    from tallyframe.llm.quality import judge, trusted_ids

    sf = "/root/testdata/sf0.01"
    judged = judge(spark.read.parquet(f"{sf}/documents.parquet"), trusted_ids(spark, sf)).where("not base_failed")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    share = {r["quality"]: r["s"] for r in judged.join(labels, "doc_id").groupBy("quality").agg({"*": "count"}).collect() for r in [
        {"quality": r["quality"], "s": judged.join(labels, "doc_id").where(f"quality = {r['quality']} and kept").count() / r["count(1)"]}]}
    assert share[1] > 0.99 and share[0] < 0.1


def test_quality_table_grows_with_the_ngrams(spark):
    from pyspark.sql import functions as F

    from tallyframe.llm.quality import Words, fit, ngrams

    df = docs(spark).select("text", (F.col("doc_id") % 3 == 0).alias("trusted"))
    words, raw, target = Words(), Counter(), Counter()
    for text, trusted in rows_of(df, "text", "trusted"):
        found = ngrams(words.units(words.number((text or "").encode().split()))).tolist()
        raw.update(found)
        if trusted:
            target.update(found)
    table = fit(df, "text", "trusted")
    buckets = len(table)
    assert buckets // 2 < len(raw) <= buckets and buckets > 1 << 16
    a, b = np.full(buckets, 0.5), np.full(buckets, 0.5)
    for into, counts in ((a, target), (b, raw)):
        for gram, k in counts.items():
            into[gram * buckets >> 64] += k
    assert np.allclose(table, np.log(a / a.sum()) - np.log(b / b.sum()), atol=1e-5)


def test_warc_round_trip(spark, scratch):
    from tallyframe.llm.warc import read_warc, write_warc

    same, short = "<p>" + "é" * 200 + "</p>", "tiny"
    rows = [(5, "http://a/ü", same), (3, None, same), (9, "http://b", same), (1, "u", short), (2, "u", short), (4, "u", None),
            (7, "u\r\nX-Bad: 1", "<p>" + "z" * 50_000), (None, "n", same), (3, None, same)]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").selectExpr("*", "'x' AS _payload")
    manifest = write_warc(df, f"file://{scratch}/warc", file_bytes=4000)
    assert manifest.count() >= 1 and manifest.agg({"records": "sum"}).first()[0] == len(rows)
    found = Counter(rows_of(read_warc(spark, f"file://{scratch}/warc"), "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"))
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = html == same and i is not None and i > 3
        want["" if i is None else str(i), "revisit" if revisit else "response", len(raw), hashlib.sha256(raw).hexdigest(), "3" if revisit else None] += 1
    assert found == want
    again = write_warc(df, f"file://{scratch}/warc2", file_bytes=4000)
    assert sorted(rows_of(manifest, "file", "sha256")) == sorted(rows_of(again, "file", "sha256"))


def test_warc_empty(spark, scratch):
    from tallyframe.llm.warc import read_warc, write_warc

    df = spark.createDataFrame([], "page_id BIGINT, url STRING, html STRING")
    assert write_warc(df, f"file://{scratch}/w").isEmpty() and read_warc(spark, f"file://{scratch}/w").isEmpty()


def test_shards_are_even_and_mixed(spark, table):
    from tallyframe.llm.sharding import stratified_shards

    found = stratified_shards(table, shards=16, bucket_rows=16)
    rows = found.collect()
    texts = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows_of(table, "doc_id", "text"))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == texts
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if len(rows) >= 16:
        assert set(slots) == set(range(16)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
        for source, n in Counter(r["source"] for r in rows).items():
            per = Counter(r["shard"] for r in rows if r["source"] == source)
            assert all(abs(per[s] - n / 16) < 2.5 for s in range(16))


def test_chain_marginals_equal_enumeration():
    from itertools import product

    from tallyframe.llm.toxicity import marginals

    rng = np.random.default_rng(1)
    lift = rng.normal(size=11)
    starts = np.zeros(11, dtype=bool)
    starts[[0, 4, 5]] = True
    trans, first = rng.uniform(0.2, 2, (2, 2)), rng.uniform(0.2, 2, 2)
    want = []
    for a, z in ((0, 4), (4, 5), (5, 11)):
        total, ones = 0.0, np.zeros(z - a)
        for path in product((0, 1), repeat=z - a):
            w = first[path[0]] * np.exp(sum(lift[a + k] for k, s in enumerate(path) if s))
            for x, y in zip(path, path[1:]):
                w *= trans[x, y]
            total += w
            ones += w * np.array(path)
        want.extend(ones / total)
    assert np.allclose(marginals(lift, starts, trans, first), want)


def test_toxicity_on_held_out_rows(spark, odd_docs, no_docs):
    from tallyframe.llm.toxicity import score_toxicity

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = score_toxicity(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    seen = scored.where("held_out").join(labels, "doc_id").groupBy("toxic").avg("predicted").collect()
    rate = {r["toxic"]: r["avg(predicted)"] for r in seen}
    assert rate[1] > 0.85 and rate[0] < 0.05
    span = scored.where("size(spans) > 0").first()
    assert 0 <= span["spans"][0]["start"] < span["spans"][0]["end"]
    odd = score_toxicity(odd_docs, spark.createDataFrame([(3, None, 1), (None, 1, 1)], "doc_id BIGINT, quality INT, toxic INT")).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert score_toxicity(no_docs, labels).isEmpty()


def test_sorting_equals_sorted():
    from tallyframe.llm.suffix_sort import common_prefix, deep_shallow_sort

    rng = np.random.default_rng(3)
    for _ in range(200):
        strings = [bytes(rng.integers(97, 99, rng.integers(0, 120)).astype(np.uint8)) for _ in range(rng.integers(1, 30))]
        strings += [b"a" * 100 + s for s in strings]
        order, lcp = deep_shallow_sort(strings, shallow=16)
        assert sorted(order) == list(range(len(strings)))
        assert [strings[k] for k in order] == sorted(strings)
        assert all(lcp[i] == common_prefix(strings[order[i - 1]], strings[order[i]]) for i in range(1, len(order)))


def brute_repeats(texts, length=200):
    places = defaultdict(list)
    for d, raw in enumerate(texts):
        for k in range(len(raw) - length + 1):
            places[raw[k:k + length]].append((d, k))
    gone = [bytearray(len(t)) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for d, k in found:
                gone[d][k:k + length] = b"\1" * length
    return gone


@pytest.mark.parametrize("group_rows", [20_000, 1])
def test_repeated_substrings(spark, table, group_rows):
    from tallyframe.llm.substring_dedup import remove_repeats

    pairs = [(i, (t or "").encode()) for i, t in rows_of(table, "doc_id", "text")]
    want = Counter()
    for (i, raw), gone in zip(pairs, brute_repeats([r for _, r in pairs])):
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        want[i, len(raw), sum(gone), runs, kept] += 1
    found = remove_repeats(table, group_rows=group_rows).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found) == want


def brute_groups(texts, words, num):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= num * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    return [len(s) for s in sets], [find(x) for x in range(len(sets))]


@pytest.mark.parametrize(("words", "num", "list_rows"), [(3, 90, 20_000), (5, 80, 4)])
def test_jaccard_groups(spark, table, words, num, list_rows):
    from tallyframe.llm.ngram_join import jaccard_groups

    pairs = rows_of(table, "doc_id", "text")
    n, group = brute_groups([t for _, t in pairs], words, num)
    want = Counter()
    for k, (i, _) in enumerate(pairs):
        ids = [j for (j, _), g in zip(pairs, group) if g == group[k] and j is not None]
        want[i, n[k], min(ids) if ids and n[k] else i] += 1
    found = jaccard_groups(table, words=words, num=num, list_rows=list_rows).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == want


@pytest.fixture
def join_tables(monkeypatch):
    """The tables that the n-gram join writes, by name."""
    from tallyframe.llm import ngram_join

    found, write = defaultdict(list), ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda df, name: found[name].append(write(df, name)) or found[name][-1])
    return found


def groups_equal_brute_force(spark, texts, words, num, **options):
    from tallyframe.llm.ngram_join import jaccard_groups

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(4)
    _, group = brute_groups(texts, words, num)
    found = dict(rows_of(jaccard_groups(df, words=words, num=num, **options), "doc_id", "component_id"))
    assert found == {i: min(j for j, h in enumerate(group) if h == g) for i, g in enumerate(group)}


def test_equal_texts_are_one_entry_of_a_list(spark, join_tables):
    """A text in a third of all rows with one near copy: its lists hold two nodes, not a third of the rows."""
    base = " ".join(f"word{k}" for k in range(100))
    texts = [base] * 100 + [base + " more"] + [" ".join(f"own{d}x{k}" for k in range(40)) for d in range(200)]
    groups_equal_brute_force(spark, texts, 3, 90, list_rows=20)
    (entries,) = join_tables["entries"]
    assert entries.count() == entries.select("token", "node").distinct().count() > 0
    assert entries.groupBy("token").count().agg({"count": "max"}).first()[0] == 2


def template_texts(own, template=93, docs=90):
    shared = [f"t{k}" for k in range(template)]
    return [" ".join(shared + [f"own{d}x{k}" for k in range(own)]) for d in range(docs)]


def test_a_template_below_the_similarity_gives_no_pairs(spark, join_tables, monkeypatch):
    """The shared part reaches into the prefix of every set, and no two sets are similar enough."""
    from tallyframe.llm import ngram_join

    monkeypatch.setattr(ngram_join, "signature", lambda s: bytes(64))        # as of long sets, whose signatures tell nothing
    groups_equal_brute_force(spark, template_texts(own=8), 1, 90, list_rows=20)
    assert sum(t.count() for name in ("pairs", "more_pairs") for t in join_tables[name]) < 90


@pytest.mark.parametrize("list_rows", [20_000, 7])
@pytest.mark.parametrize("cell_bytes", [1 << 24, 3000])
def test_cells_of_a_list_with_many_candidates(spark, join_tables, monkeypatch, list_rows, cell_bytes):
    """Long sets that pass every bound and mostly fail: links are found without a row per pair."""
    from tallyframe.llm import ngram_join

    monkeypatch.setattr(ngram_join, "PAIRS_PER_ENTRY", 2)
    monkeypatch.setattr(ngram_join, "CELL_BYTES", cell_bytes)
    monkeypatch.setattr(ngram_join, "signature", lambda s: bytes(64))        # so that no pair is skipped by it
    rng = np.random.default_rng(5)
    texts = [" ".join([f"t{k}" for k in range(85)] + [f"o{k}" for k in rng.permutation(30)[:15]]) for _ in range(60)]
    texts += [texts[5] + " one", texts[9] + " two", texts[9] + " two three"]
    groups_equal_brute_force(spark, texts, 1, 90, list_rows=list_rows)
    assert sum(t.count() for t in join_tables["crossed"]) > 0 and join_tables["cell_links"]


def test_components_of_a_chain(spark):
    from tallyframe.llm.components import components

    edges = spark.range(60).selectExpr("id AS a", "id + 1 AS b").unionAll(spark.createDataFrame([(100, 101), (101, 101)], "a BIGINT, b BIGINT"))
    found = dict(map(tuple, components(edges).collect()))
    assert found == {k: 0 for k in range(61)} | {100: 100, 101: 100}


def test_pipeline_stages(spark, odd_docs, no_docs):
    import corpus_pipeline

    for start in (docs(spark), no_docs):
        now = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == start.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, now, SF)
        kept = {r["doc_id"] for r in now.collect()}
        assert {r["doc_id"] for r in packed.collect()} == kept and len(kept) <= start.count()
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd_docs, SF).collect()


def test_stage_decisions(spark):
    """Exact copies leave the largest id, near copies the smallest, and a clean document stays as it is."""
    from tallyframe.llm import stages

    base = " ".join(f"word{k}" for k in range(120))
    rows = [(1, base), (2, base), (3, base + " more"), (4, " ".join(f"other{k}" for k in range(90)))]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").selectExpr("*", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    exact = stages.exact_dedup(spark, df, SF)
    assert sorted(rows_of(exact, "doc_id")) == [(2,), (3,), (4,)]
    near = stages.near_dedup(spark, exact, SF)
    assert sorted(rows_of(near, "doc_id", "text")) == [(2, base), (4, rows[3][1])]
    assert sorted(rows_of(stages.substring_dedup(spark, near, SF), "text")) == sorted([(base,), (rows[3][1],)])


@pytest.mark.parametrize("name", ["op4_content_sort", "op6_warc"])
def test_query_equals_its_sql(spark, name):
    import __spark_entry__ as entry
    from tests.oracle_check import compare, duck

    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {q if q == "pipeline" else q.split("_")[0] + "_" for q in entry.queries()}
    sf = "/root/testdata/sf0.01"
    assert compare(spark, duck(sf), name, entry.queries()[name], entry.oracle_sql()[name], sf)["ok"]
