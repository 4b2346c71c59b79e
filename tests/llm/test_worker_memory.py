"""What a task of the pipeline holds in Python: one worker at a time, and small batches of texts."""

from __future__ import annotations

import pytest

from tallyframe.llm import common, ngram_join, quality, stages, substring_dedup

DOCS = "doc_id BIGINT, text STRING, n_chars BIGINT"
PYTHON = ("MapInArrow", "ArrowEvalPython", "FlatMapGroupsInArrow")


def workers_at_once(df) -> int:
    """Most Python steps in one stage of the plan of ``df``: each has a worker of its own in every task."""
    def most(node, above):  # noqa: ANN001, ANN202
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return most(node.initialPlan(), above)
        above = 0 if "Exchange" in name else above + (name in PYTHON)
        below = node.children()
        return max([above, *[most(below.apply(i), above) for i in range(below.size())]])

    return most(df._jdf.queryExecution().executedPlan(), 0)


@pytest.fixture
def docs(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i % 7:300 + i]) for i in range(40)] + [" ".join(words[:50]) + " é" * 150 + f" end {i}" for i in range(5)]
    return spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], DOCS)


@pytest.fixture
def planned(spark, monkeypatch):
    """Workers at once of every table that the operators write, by its name."""
    seen: dict[str, int] = {}

    def noted(df, name):  # noqa: ANN001, ANN202
        seen[name] = max(seen.get(name, 0), workers_at_once(df))
        return common.written(df, name)

    for module in (ngram_join, quality, substring_dedup, stages):
        monkeypatch.setattr(module, "written", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    yield seen
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ngram_join_has_one_worker_a_task(spark, docs, planned):
    kept = stages.near_dedup(spark, docs, "")
    assert workers_at_once(kept) == 1
    assert {"verified", "postings", "lists"} <= planned.keys() and max(planned.values()) == 1


def test_sets_are_those_of_the_wanted_texts(spark, docs):
    join = ngram_join.NgramJoin(docs.selectExpr("doc_id AS _id", "text AS _text"), 5, ngram_join.Threshold(4, 5), 100)
    rows = join.nodes()
    wanted = rows.where("_id % 3 = 0").select("node").distinct()
    sets = join.sets(rows, wanted)
    assert workers_at_once(sets) == 1
    cut = ngram_join.Shingles(5)
    assert (sorted(bytes(r["set"]) for r in sets.collect())
            == sorted({cut(r["text"]).tobytes() for r in docs.where("doc_id % 3 = 0").collect()}))


def test_quality_has_one_worker_a_task(spark, docs, planned):
    judged = quality.judge(docs, docs.where("doc_id % 2 = 0").select("doc_id"))
    assert workers_at_once(judged) == 1
    assert planned["quality_grams"] == 1
    found = {r["doc_id"]: r["llr"] for r in judged.collect()}
    ratios = quality.fit_ratios(docs.selectExpr("text", "doc_id % 2 = 0 AS good"), "text", "good")      # all in one table
    for row in docs.collect():
        assert found[row["doc_id"]] == quality.assess(row["text"], ratios)[1]


def test_substring_stage_has_one_worker_a_task(spark, docs, planned):
    cut = stages.substring_dedup(spark, docs, "")
    assert workers_at_once(cut) == 1 and max(planned.values()) == 1


def test_cut_characters_go_whole(spark):
    # The passages are equal from the second byte of é (C3 A9) and of \u0169 (C5 A9) on.
    rows = [(1, "one \u00e9" + "passage " * 30 + "x"), (2, "two \u0169" + "passage " * 30 + "y")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    plain = {r["doc_id"]: r for r in substring_dedup.remove_repeats(df).collect()}
    whole = {r["doc_id"]: r for r in substring_dedup.remove_repeats(df, whole_characters=True).collect()}
    assert {k: bytes(r["kept"]) for k, r in plain.items()} == {1: b"one \xc3x", 2: b"two \xc5y"}
    assert {k: bytes(r["kept"]) for k, r in whole.items()} == {1: b"one x", 2: b"two y"}
    assert all(plain[k][c] == whole[k][c] for k in plain for c in ("n_bytes", "n_removed", "n_spans"))


def test_batches_are_small_unless_the_session_says_otherwise(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    df = spark.createDataFrame([(i, "x" * 100_000) for i in range(200)], "doc_id BIGINT, text STRING").coalesce(1)

    def sizes(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], ["n", "size"])

    try:
        spark.conf.unset(name)
        common.reach_workers(spark)
        found = df.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r["n"] for r in found) == 200
        assert max(r["size"] for r in found) < 1.2 * common.BATCH_BYTES
        spark.conf.set(name, "123456")
        common.reach_workers(spark)
        assert spark.conf.get(name) == "123456"
    finally:
        spark.conf.unset(name)
        if before is not None:
            spark.conf.set(name, before)
