"""The election model laid over the provided TPC-H-style tables.

One results row per customer that placed orders:

==============  ==========================================================
unit_id, unit   ``c_custkey``, ``c_name``
province        ``n_name`` (the customer's nation)
community       ``r_name`` (the nation's region)
population      Σ order totals, as ``decimal(28,2)``
census          orders placed
voters          orders with status F or O
valid           orders with status F
p1 .. p5        status-F orders per priority, in priority order
==============  ==========================================================

Plan: ``orders`` is aggregated per customer *before* the join (partial
aggregation in every scan task, one shuffle by customer key), so the join
sees one row per customer instead of every order, and a customer holding a
third of all orders is a handful of partial rows.  The joined result stays
hash-partitioned by customer key, which later per-unit windows and
aggregates reuse.  ``nation`` and ``region`` are joined by Spark's
size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.model import Layout
from tallyframe.sources.parquet import read_table

# The order priorities of the test data, in their natural order;
# they play the parties p1..p5.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PARTIES = tuple(f"p{i + 1}" for i in range(len(PRIORITIES)))

TESTBED = Layout(parties=PARTIES)

# Report parameters on the test bed.
COHORT_SIZE = 20                 # units per size cohort
SMALL_BELOW = 1_000_000          # "small" unit: population under this
TOP_N = 10
TOP_PARTIES = 5
BAND_CUT = None                  # share band cut in %; None = median share across groups

# Province cohorts for the list filter.  One entry is written with an accent on
# purpose: both sides are folded before they are compared.
PROVINCE_COHORTS = {
    "sparse": ("NATION_3", "NATIÓN_7", "NATION_11", "NATION_19", "NATION_23"),
    "dense": ("NATION_0", "NATION_5", "NATION_8", "NATION_14"),
}


def results_wide(spark: SparkSession, sf_dir: str, layout: Layout = TESTBED) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    final = F.col("o_orderstatus") == F.lit("F")
    tallies = orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias(layout.population),
        F.count(F.lit(1)).alias(layout.census),
        F.count_if(F.col("o_orderstatus").isin("F", "O")).alias(layout.voters),
        F.count_if(final).alias(layout.valid),
        *[F.count_if(final & (F.col("o_orderpriority") == F.lit(prio))).alias(party)
          for prio, party in zip(PRIORITIES, layout.parties)],
    )
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    places = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
                      .join(region, nation.n_regionkey == region.r_regionkey))
    joined = tallies.join(places, tallies.o_custkey == places.c_custkey, "inner")
    return joined.select(
        F.col("c_custkey").alias(layout.unit_id),
        F.col("c_name").alias(layout.unit),
        F.col("n_name").alias(layout.province),
        F.col("r_name").alias(layout.community),
        layout.population, layout.census, layout.voters, layout.valid, *layout.parties,
    )
