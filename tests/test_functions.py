import unicodedata

from pyspark.sql import functions as F

from tallyframe.functions import clean_header, fold_accents, fold_table, fold_text, pct, row_argmax, row_max
from tests.conftest import rows
from tests.fixtures import LAYOUT, fact


def _nfkd_strip(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def test_fold_table_follows_rule():
    src, dst = fold_table()
    assert len(src) == len(dst) > 150
    for a, b in zip(src, dst):
        assert _nfkd_strip(a) == b
    assert "ß" not in src  # no decomposition: kept as is


def test_fold_equals_nfkd_rule_on_every_latin_character(spark):
    chars = [chr(cp) for cp in range(0x00A0, 0x0250)]
    df = spark.createDataFrame([(c,) for c in chars] + [("x" + "".join(chars) + "y",)], "s STRING")
    got = [r[0] for r in df.select(fold_accents("s")).collect()]
    assert got == [_nfkd_strip(c) for c in chars] + ["x" + "".join(_nfkd_strip(c) for c in chars) + "y"]
    assert [fold_text(c) for c in chars] == [_nfkd_strip(c) for c in chars]


def test_fold_equals_nfkd_rule_on_every_code_point(spark):
    points = [cp for cp in range(1, 0x110000) if not 0xD800 <= cp < 0xE000]
    texts = ["x" + "".join(map(chr, points[i:i + 4000])) + "y" for i in range(0, len(points), 4000)]
    texts += ["Việt Nam", "e\u0301te\u0301", "ﬁn", "Ｍ", "Αθήνα", "한국어", "½", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, s STRING").repartition(8)
    got = {r.i: r.f for r in df.select("i", fold_accents("s").alias("f")).collect()}
    assert [got[i] for i in range(len(texts))] == [_nfkd_strip(t) for t in texts]
    assert fold_text("Việt ﬁ") == "Viet fi"


def test_fold_accents_column(spark):
    df = spark.createDataFrame([("Ávila",), ("Málaga",), ("Ñandú",), (None,), ("straße",), ("Çà",)], "s STRING")
    out = [r[0] for r in df.select(fold_accents("s")).collect()]
    assert out == ["Avila", "Malaga", "Nandu", None, "straße", "Ca"]


def test_fold_is_idempotent(spark):
    df = spark.createDataFrame([("Élève àçcént",)], "s STRING")
    once = df.select(fold_accents("s").alias("s"))
    twice = once.select(fold_accents("s").alias("s"))
    assert once.collect() == twice.collect()
    assert fold_text("Élève") == "Eleve"


def test_clean_header_rule():
    # Non-word characters are deleted (not folded), then lower-cased.
    assert clean_header("Código") == "cdigo"
    assert clean_header("PODEMOS-IU-EQUO") == "podemosiuequo"
    assert clean_header("AND") == "and"
    assert clean_header(" Municipio ") == "municipio"
    assert clean_header("ERC-CATS") == "erccats"


def test_row_argmax_first_wins_and_last_party(spark):
    """The last party can win (the reference named the next party or failed)."""
    df = fact(spark).select("codigo", row_argmax(LAYOUT.parties, require_positive=True).alias("w"),
                            row_max(LAYOUT.parties).alias("m"))
    got = {r.codigo: (r.w, r.m) for r in df.collect() if r.codigo != 9}
    assert got[1] == ("pp", 600)
    assert got[5] == ("and", 1000)          # last declared party
    assert got[6] == (None, 0)              # nobody has a vote: no winner
    assert got[7] == (None, None)           # every party null
    assert got[8] == ("pp", 40)             # tie pp / podemosiuequo -> first declared
    assert got[12] == ("pp", 500)


def test_row_argmax_without_positive_rule(spark):
    df = spark.createDataFrame([(0, 0), (None, None), (None, 3)], "a BIGINT, b BIGINT")
    out = [r[0] for r in df.select(row_argmax(["a", "b"])).collect()]
    assert out == ["a", None, "b"]


def test_pct_zero_denominator_is_null(spark):
    """A zero census gives null, never DIVIDE_BY_ZERO under ANSI."""
    df = spark.createDataFrame([(1, 0), (1, 4), (None, 2)], "a BIGINT, b BIGINT")
    assert [r[0] for r in df.select(pct("a", "b")).collect()] == [None, 25.0, None]


def test_no_python_udf_in_expressions(spark):
    df = fact(spark).select(fold_accents(F.lit("Á")).alias("x"), row_argmax(LAYOUT.parties).alias("w"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert rows(df.limit(1), "x") == [("A",)]
