"""A hot group and a hot unit: answers stay exact, and the plans combine map-side.

One community holds 40 % of the units, and one unit is reported on 300 rows.
Results are compared with a brute-force pandas computation of the same
questions on the collected fixture (small by construction).
"""

from pyspark.sql import functions as F

from tallyframe.model import Layout
from tallyframe.operators import compare, rates

PARTIES = ("a", "b", "c")
L = Layout(parties=PARTIES)


def skewed(spark):
    ids = spark.range(0, 3000)
    unit = F.when(F.col("id") < 300, F.lit(0)).otherwise(F.col("id"))          # unit 0: 300 rows
    community = F.when(F.col("id") % 5 < 2, F.lit("HOT")).otherwise(F.concat(F.lit("G"), (F.col("id") % 7).cast("string")))
    community = F.when(F.col("id") < 300, F.lit("HOT")).otherwise(community)
    return ids.select(
        unit.cast("bigint").alias("unit_id"),
        F.concat(F.lit("u"), unit.cast("string")).alias("unit"),
        F.lit("p").alias("province"),
        community.alias("community"),
        F.when(unit == 0, F.lit(10_000)).otherwise((F.col("id") * 37) % 1000).cast("bigint").alias("population"),
        F.lit(10).cast("bigint").alias("census"),
        F.lit(8).cast("bigint").alias("voters"),
        F.lit(6).cast("bigint").alias("valid"),
        ((F.col("id") * 7) % 4).cast("bigint").alias("a"),
        ((F.col("id") * 11) % 4).cast("bigint").alias("b"),
        ((F.col("id") * 13) % 3).cast("bigint").alias("c"),
    )


def brute(pdf):
    units = pdf.groupby(["community", "unit_id", "unit"], as_index=False).agg(
        population=("population", "max"), a=("a", "sum"), b=("b", "sum"), c=("c", "sum"))

    def winner(row):
        m = max(row[p] for p in PARTIES)
        return next(p for p in PARTIES if row[p] == m) if m > 0 else None

    out = {}
    for com, g in units.groupby("community"):
        big = g.sort_values(["population", "unit_id"], ascending=[False, True]).iloc[0]
        sums = {p: int(g[p].sum()) for p in PARTIES}
        out[com] = {"unit_id": int(big.unit_id), "unit_party": winner(big), "group_party": winner(sums),
                    "group_population": int(g.population.sum()), "n_units": len(g),
                    "share": float(big.population) / float(g.population.sum()) * 100.0}
    return out


def test_skewed_groups_match_brute_force(spark):
    df = skewed(spark)
    expect = brute(df.toPandas())
    rep = {r.community: r for r in compare.representativeness(df, L, "community").collect()}
    pop = {r.community: r for r in rates.population_by_group(df, L, "community").collect()}
    assert set(rep) == set(expect) == set(pop)
    for com, e in expect.items():
        r = rep[com]
        assert (r.unit_id, r.unit_party, r.group_party) == (e["unit_id"], e["unit_party"], e["group_party"]), com
        assert abs(r.population_share - e["share"]) < 1e-9
        assert (pop[com].group_population, pop[com].n_units) == (e["group_population"], e["n_units"])


def test_hot_group_is_combined_before_the_shuffle(spark):
    df = skewed(spark)
    for out in (compare.representativeness(df, L, "community"), rates.population_by_group(df, L, "community"),
                compare.winner_per_group(df, L, "community")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        # Every exchange on the group key sits above a partial aggregate.
        for part in plan.split("Exchange hashpartitioning(community")[1:]:
            assert "partial_" in part.split("Exchange")[0] or "partial_" in part
    plan = compare.max_row_per_group(df, L, "community")._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(community", 1)[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_share_of_group_joins_totals_by_broadcast_at_runtime(spark):
    out = rates.share_of_group(skewed(spark), L, "community")
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString()
    final_part = final.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final_part     # one row per group: AQE broadcasts it
    sums = out.groupBy("community").agg(F.sum("population_share").alias("s")).collect()
    assert all(abs(r.s - 100.0) < 1e-9 for r in sums)
