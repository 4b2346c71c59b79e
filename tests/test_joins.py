from tallyframe.operators import joins
from tests.conftest import rows
from tests.fixtures import dim, fact


def test_join_coverage_counts_both_sides(spark):
    """Keys on one side only, each way: 10 has no results, 11 has no place row."""
    out = joins.join_coverage(dim(spark), fact(spark), "codigo", "codigo", "dim", "fact")
    assert rows(out) == [("dim_only", 1, 1), ("fact_only", 1, 1)]


def test_join_coverage_null_keys_and_empty_side(spark):
    left = spark.createDataFrame([(1,), (None,), (None,)], "k BIGINT")
    right = spark.createDataFrame([(1,), (1,)], "k BIGINT")
    assert rows(joins.join_coverage(left, right, "k", "k")) == [("left_only", 2, 1), ("right_only", 0, 0)]


def test_join_dimension_keeps_matched_rows(spark):
    j = joins.join_dimension(fact(spark), dim(spark), "codigo")
    assert j.count() == 13      # 14 fact rows, one without a place


def test_inner_join_drops_unmatched_and_keeps_one_key(spark):
    j = joins.join_dimension(fact(spark), dim(spark), "codigo")
    assert j.columns.count("codigo") == 1
    assert sorted({r.codigo for r in j.collect()}) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 13, 14]
