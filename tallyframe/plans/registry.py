"""Query registry: every report question of the model, on the test bed.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables.  Orders end in the unit key, so results are reproducible.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators import clean, compare, joins, profile, rates
from tallyframe.plans import election, reports
from tallyframe.plans.testbed import TESTBED, results_wide
from tallyframe.session import shared_dir
from tallyframe.sources import delimited, parquet, tables

L = TESTBED
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Built anew each time: a plan keeps the file listing it was made with.
    return results_wide(spark, sf_dir, L)


# ----------------------------------------------------------------- join and scans
@query
def dim_fact_join(spark, sf_dir):
    return _base(spark, sf_dir)


def _own_name(base: str) -> str:
    """A name in the catalog that no other run uses."""
    return f"{base}_{uuid.uuid4().hex[:12]}"


@query
def view_scan(spark, sf_dir):
    name = _own_name("tallyframe_results_wide")
    tables.register_view(_base(spark, sf_dir), name)
    return tables.scan_view(spark, name, sql=True)


@query
def join_coverage(spark, sf_dir):
    # All customers against all events: the users are only a part of the customers.
    dim = parquet.read_table(spark, sf_dir, "customer", ["c_custkey"])
    fact = parquet.read_table(spark, sf_dir, "events", ["user_id"])
    return joins.join_coverage(dim, fact, "c_custkey", "user_id", "dimension", "fact")


# ----------------------------------------------------------------- report questions
def _wrap(name: str, fn: reports.ReportFn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_base(spark, sf_dir))
    run.__name__ = name
    run.__doc__ = fn.__doc__
    return run


for _name, (_fn, _bounded) in reports.REPORTS.items():
    REGISTRY[_name] = _wrap(_name, _fn)
    globals()[_name] = REGISTRY[_name]


def cohort_members(spark, sf_dir):
    """A cohort list kept as a table: written in capitals or not, padded, some names accented, some listed twice."""
    nation = parquet.read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    kind = F.col("n_nationkey") % 4
    listed = nation.where(kind < 3).select(
        F.concat(F.lit(" "), F.regexp_replace("n_name", "NATION_1", "NATIÓN_1"), F.lit("  ")).alias("place"),
        F.when(kind == 0, "coast").when(kind == 1, "inland").alias("cohort"))
    again = nation.where(F.col("n_nationkey") % 8 == 0).select(F.col("n_name").alias("place"), F.lit("island").alias("cohort"))
    return listed.unionByName(again)


@query
def cohort_by_table(spark, sf_dir):
    by_province = rates.turnout_by_group(_base(spark, sf_dir), L, [L.province])
    return compare.tag_by_table(by_province, L.province, cohort_members(spark, sf_dir), "place", "cohort")


# ----------------------------------------------------------------- text columns profiled
def orders_as_text(spark, sf_dir):
    """Orders as a raw file holds them: every column is text, some are padded, empty or mixed."""
    orders = parquet.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    key, price, day = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.col("o_orderdate").cast("date").cast("string")
    third = F.col("o_orderkey") % 3
    return orders.select(
        key.alias("order_key"), F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("customer"), F.col("o_orderstatus").alias("status"),
        price.alias("price"), F.when(third == 0, key).when(third == 1, price).alias("number_or_none"), day.alias("ordered"),
        F.when(third == 0, day).otherwise(F.concat(day, F.lit(" 10:30:00"))).alias("seen"), F.when(third == 0, "").otherwise(day).alias("day_or_blank"),
        F.when(third == 0, key).otherwise(F.col("o_orderpriority")).alias("mixed"), (F.col("o_orderstatus") == "F").cast("string").alias("final"),
        F.lit("").alias("blank"))


@query
def profile_columns(spark, sf_dir):
    # The distinct counts are estimates, without an exact counterpart in SQL.
    return profile.profile_columns(orders_as_text(spark, sf_dir)).drop("approx_distinct")


# ----------------------------------------------------------------- tables stored by the join key
BUCKETS = 16


@query
def bucketed_join(spark, sf_dir):
    units = parquet.read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"]).select(F.col("c_custkey").alias(L.unit_id), F.col("c_name").alias(L.unit))
    tallies = (parquet.read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderstatus"]).groupBy(F.col("o_custkey").alias(L.unit_id))
               .agg(F.count(F.lit(1)).alias(L.census), F.count_if(F.col("o_orderstatus").isin("F", "O")).alias(L.voters)))
    names = []
    for part, rows in (("units", units), ("tallies", tallies)):
        names.append(_own_name(f"tallyframe_bucketed_{part}"))
        tables.save_bucketed(rows, names[-1], BUCKETS, [L.unit_id], path=shared_dir(spark, "tables", names[-1], unique=True))
    return rates.with_turnout(tables.join_bucketed(spark, *names, [L.unit_id]), L, abstention_col=None)


# ----------------------------------------------------------------- cleaning
@query
def clean_strings(spark, sf_dir):
    # The documents carry no padding of their own; pad the short text columns
    # the way a fixed-width export would, then trim every string column.
    docs = parquet.read_table(spark, sf_dir, "documents")
    padded = docs.withColumns({"lang": F.concat(F.lit("  "), "lang", F.lit(" ")),
                               "source": F.concat(F.lit(" "), "source", F.lit("   "))})
    return clean.trim_strings(padded)


@query
def fold_accents(spark, sf_dir):
    docs = parquet.read_table(spark, sf_dir, "documents", ["doc_id", "lang", "text"])
    return clean.fold_columns(docs, ["text"])


# Dirty headers as a results file might carry them (accents, spaces, symbols).
DIRTY_CUSTOMER_HEADERS = ("Código Cliente", "Nombre (C)", "C_NationKey", "Saldo €", "Segmento-Mercado")


@query
def clean_headers(spark, sf_dir):
    cust = parquet.read_table(spark, sf_dir, "customer",
                              ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    return clean.clean_headers(cust.toDF(*DIRTY_CUSTOMER_HEADERS))


TYPED_COLUMNS = {"custkey_text": "bigint", "priority_text": "bigint", "price_text": "double"}


def _dirty_orders(spark, sf_dir):
    orders = parquet.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"])
    return orders.select(
        "o_orderkey",
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("custkey_text"),
        F.col("o_orderpriority").alias("priority_text"),
        F.format_number("o_totalprice", 2).alias("price_text"),
    )


@query
def typed_cast(spark, sf_dir):
    typed = clean.typed_cast(_dirty_orders(spark, sf_dir), TYPED_COLUMNS)
    return typed.withColumn("_rejected", F.array_join("_rejected", ",")).withColumnRenamed("_rejected", "rejected")


@query
def reject_report(spark, sf_dir):
    return clean.reject_report(_dirty_orders(spark, sf_dir), TYPED_COLUMNS)


# ----------------------------------------------------------------- sinks read back
REPORT_SCHEMA = "unit_id BIGINT, unit STRING, community STRING, province STRING, population DECIMAL(28,2)"


@query
def delimited_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "reports", "population_top10", unique=True)
    report = reports.population_top10(_base(spark, sf_dir))
    delimited.write_report(report, path, sep=";", encoding="ISO-8859-1", single_file=True)
    return delimited.read_report(spark, path, REPORT_SCHEMA, sep=";", encoding="ISO-8859-1")


@query
def raw_delimited_scan(spark, sf_dir):
    """The base written as raw election files and loaded again: Latin-1, dirty headers, padded and
    accented names, two results files with their columns in different orders."""
    base = tables.materialize(_base(spark, sf_dir), "raw_scan_base")
    folder = shared_dir(spark, "raw", "election", unique=True)
    places = base.select(
        F.col(L.unit_id).alias("Unit_ID "), F.concat(F.lit("  "), L.unit, F.lit(" ")).alias("Unit."),
        F.regexp_replace(L.province, "NATION", "NATIÓN").alias("(Province)"),
        F.col(L.community).alias("Community"), F.floor(L.population).cast("bigint").alias("Population €"))
    delimited.write_report(places, f"{folder}/places", sep=";", encoding="ISO-8859-1")
    counts = [L.unit_id, L.census, L.voters, L.valid, *L.parties]
    early = F.col(L.province) < F.lit("NATION_2")
    for part, rows, order in (("a", early, counts), ("b", ~early, counts[::-1])):
        raw = base.where(rows).select(*[F.col(c).alias(f"{c.upper()} ") for c in order])
        delimited.write_report(raw, f"{folder}/results/{part}", sep=";", encoding="ISO-8859-1")
    return election.election_base(spark, f"{folder}/places", f"{folder}/results/*", L)


@query
def managed_table_roundtrip(spark, sf_dir):
    name = _own_name("tallyframe_results_joined")
    path = shared_dir(spark, "tables", name, unique=True)
    tables.save_table(_base(spark, sf_dir), name, path=path)
    return tables.scan_view(spark, name)


def queries() -> dict[str, Query]:
    from tallyframe.streaming import registry as live  # noqa: F401  (registers stream_* entries)

    return dict(REGISTRY)
