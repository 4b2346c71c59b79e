"""Randomised checks of row-wise winners, in-row top k and "hits else top n"
against plain-Python answers (ties, nulls and zeros included)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.functions.rowwise import row_argmax, row_max, row_top_k
from tallyframe.operators import rank

COLS = ["a", "b", "c", "d"]
vote = st.one_of(st.none(), st.integers(min_value=0, max_value=4))
rows_st = st.lists(st.tuples(*[vote] * len(COLS)), min_size=50, max_size=200)


def py_argmax(row):
    present = [v for v in row if v is not None]
    if not present:
        return None, None
    m = max(present)
    return (COLS[row.index(m)] if m > 0 else None), m


def py_top_k(row, k):
    ranked = sorted(((v, i) for i, v in enumerate(row) if v is not None), key=lambda t: (-t[0], t[1]))
    return [(COLS[i], v) for v, i in ranked[:k]]


def test_row_winner_and_top_k_match_python(spark):
    @settings(max_examples=5, deadline=None)
    @given(rows_st, st.integers(min_value=1, max_value=4))
    def check(data, k):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id INT, a INT, b INT, c INT, d INT")
        out = df.select("id", row_argmax(COLS, require_positive=True).alias("w"), row_max(COLS).alias("m"),
                        row_top_k(COLS, k).alias("t")).orderBy("id").collect()
        for r, row in zip(out, data):
            assert (r.w, r.m) == py_argmax(list(row))
            assert [(x.party, x.votes) for x in r.t] == py_top_k(list(row), k)

    check()


def test_hits_or_top_n_matches_python(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.integers(min_value=0, max_value=30), min_size=20, max_size=150),
           st.integers(min_value=25, max_value=40), st.integers(min_value=1, max_value=12))
    def check(values, hit_at, n):
        df = spark.createDataFrame(list(enumerate(values)), "id INT, v INT")
        got = sorted(r.id for r in rank.hits_or_top_n(df, F.col("v") >= hit_at, "v", n, ["id"]).collect())
        hits = [i for i, v in enumerate(values) if v >= hit_at]
        want = hits or [i for v, i in sorted((-v, i) for i, v in enumerate(values))[:n]]
        assert got == sorted(want)

    check()


def test_representativeness_matches_python(spark):
    from tallyframe.model import Layout
    from tallyframe.operators import compare

    L = Layout(parties=("a", "b", "c"))
    unit_st = st.tuples(st.sampled_from(["G1", "G2", "G3"]), st.one_of(st.none(), st.integers(0, 5)))
    row_st = st.tuples(st.integers(0, 15), st.one_of(st.none(), st.integers(0, 3)),
                       st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3))

    def winner(sums):
        present = [v for v in sums if v is not None]
        if not present or max(present) <= 0:
            return None
        return L.parties[sums.index(max(present))]

    @settings(max_examples=5, deadline=None)
    @given(st.lists(unit_st, min_size=16, max_size=16), st.lists(row_st, min_size=20, max_size=80))
    def check(units, rows_):
        # units: id -> (group, population); rows: (unit id, a, b, c), several rows per unit allowed
        data = [(uid, f"u{uid}", units[uid][0], units[uid][1], a, b, c) for uid, a, b, c in rows_]
        df = spark.createDataFrame(data, "unit_id INT, unit STRING, community STRING, population INT, "
                                         "a INT, b INT, c INT")
        got = {r.community: r for r in compare.representativeness(df, L, "community").collect()}
        present = {uid for uid, *_ in rows_}
        want = {}
        for g in sorted({units[u][0] for u in present}):
            members = sorted(u for u in present if units[u][0] == g)
            sums = {u: [sum(x for uid, *v in rows_ if uid == u for x in [v[i]] if x is not None)
                        if any(v[i] is not None for uid, *v in rows_ if uid == u) else None
                        for i in range(3)] for u in members}
            big = sorted(members, key=lambda u: (units[u][1] is None, -(units[u][1] or 0), u))[0]
            gsum = [sum(s[i] for s in sums.values() if s[i] is not None)
                    if any(s[i] is not None for s in sums.values()) else None for i in range(3)]
            want[g] = (big, winner(sums[big]), winner(gsum))
        assert set(got) == set(want)
        for g, (big, up, gp) in want.items():
            assert (got[g].unit_id, got[g].unit_party, got[g].group_party) == (big, up, gp), g

    check()
