import pytest

from tallyframe.operators import clean
from tests.conftest import rows


def test_trim_strings_only_touches_strings(spark):
    df = spark.createDataFrame([("  a ", 1, " b")], "x STRING, n BIGINT, y STRING")
    out = clean.trim_strings(df)
    assert out.dtypes == df.dtypes
    assert out.collect()[0] == ("a", 1, "b")


def test_clean_headers_renames(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Código` INT, `PODEMOS-IU-EQUO` INT, `AND` INT")
    assert clean.clean_headers(df).columns == ["cdigo", "podemosiuequo", "and"]


def test_clean_headers_collision_is_refused(spark):
    df = spark.createDataFrame([(1, 2)], "`ERC-CATS` INT, `ERCCATS` INT")
    with pytest.raises(ValueError, match="collide"):
        clean.clean_headers(df)


def test_clean_headers_empty_is_refused(spark):
    df = spark.createDataFrame([(1,)], "`¿?` INT")
    with pytest.raises(ValueError, match="no usable"):
        clean.clean_headers(df)


def test_fold_columns(spark):
    df = spark.createDataFrame([("Ávila", 1)], "p STRING, n INT")
    assert clean.fold_columns(df).collect()[0] == ("Avila", 1)


DIRTY = [("9",), ("200",), (" 12 ",), ("1.234",), ("1,5",), ("abc",), ("",), (None,)]


def test_typed_cast_dirty_numbers(spark):
    """Typed once with try_cast; dirty text is null and reported, never an error."""
    df = spark.createDataFrame(DIRTY, "v STRING")
    out = clean.typed_cast(df, {"v": "bigint"})
    assert out.schema["v"].dataType.simpleString() == "bigint"
    got = [(r.v, list(r._rejected)) for r in out.collect()]
    assert got == [(9, []), (200, []), (12, []), (None, ["v"]), (None, ["v"]), (None, ["v"]), (None, []), (None, [])]
    # Typed order ranks 9 below 200 (as text "9" > "200").
    assert [r.v for r in out.filter("v IS NOT NULL").orderBy("v").collect()] == [9, 12, 200]


def test_reject_report(spark):
    df = spark.createDataFrame(DIRTY, "v STRING")
    rep = clean.reject_report(df, {"v": "bigint"})
    assert rows(rep) == [("v", 8, 2, 3, 3)]


TRICKY = ["9", " 12 ", "+5", "-0", "007", "1.0", "1.", ".5", "1e3", "1E-2", "-1.5e+2", "1d", "2.5f", "NaN",
          "-Infinity", "inf", "+INF", "0x1p3", "١٢", "12a", "", "a1", "1,5", "1.234", "9" * 25, "\t7\n",
          "1 000", "--1", "+-1", "e5", ".", "1e", "1.2.3", "Infinityx", None]


@pytest.mark.parametrize("dtype", ["int", "bigint", "smallint", "double", "float", "decimal(10,2)", "decimal(38,0)"])
def test_guarded_cast_equals_plain_try_cast(spark, dtype):
    from pyspark.sql import functions as F

    from tallyframe.functions.numeric import tolerant_cast

    df = spark.createDataFrame([(v,) for v in TRICKY], "v STRING")
    got = df.select(tolerant_cast("v", dtype).alias("a"), F.trim("v").try_cast(dtype).alias("b")).collect()
    for v, r in zip(TRICKY, got):
        same = (r.a == r.b) or (r.a != r.a and r.b != r.b)   # NaN == NaN
        assert same, (dtype, v, r.a, r.b)


def test_guarded_cast_property(spark):
    """Random strings over a number-ish alphabet: the guard never changes a result."""
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from pyspark.sql import functions as F

    from tallyframe.functions.numeric import tolerant_cast

    alphabet = st.sampled_from(list("0123456789+-.eEdDfFxXpP ,\t") + ["١", "٢", "٣", "NaN", "inf", "Infinity", "a"])
    strings = st.lists(st.lists(alphabet, max_size=8).map("".join), min_size=100, max_size=100)

    @settings(max_examples=4, deadline=None)
    @given(strings)
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "v STRING")
        cols = []
        for i, t in enumerate(["bigint", "double", "decimal(20,4)"]):
            cols += [tolerant_cast("v", t).alias(f"a{i}"), F.trim("v").try_cast(t).alias(f"b{i}")]
        for v, r in zip(values, df.select(*cols).collect()):
            for i in range(3):
                a, b = r[f"a{i}"], r[f"b{i}"]
                assert a == b or (a != a and b != b), (v, i, a, b)

    check()
