import os

import pytest

from tallyframe.operators import clean
from tallyframe.sources import materialize, read_delimited, read_report, register_view, save_table, scan_view, write_report
from tests.conftest import rows
from tests.fixtures import DIM_SCHEMA, dim, joined

LATIN1_DIM = "Código;Municipio;Provincia;Comunidad;Población\n1; Ávila ;Ávila;Castilla y León;57000\n2;Málaga;Málaga;Andalucía; 1.234\n3;Soria;Soria;Castilla y León;39000\n"


def _write_latin1(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="latin-1") as fh:
        fh.write(text)
    return path


def test_read_delimited_latin1_with_header_cleaning(spark, scratch):
    path = _write_latin1(scratch, "municipios.csv", LATIN1_DIM)
    df = read_delimited(spark, path)
    assert df.columns == ["cdigo", "municipio", "provincia", "comunidad", "poblacin"]
    got = clean.fold_columns(clean.trim_strings(df)).collect()
    assert [r.municipio for r in got] == ["Avila", "Malaga", "Soria"]


def test_read_delimited_declared_schema_and_rejects(spark, scratch):
    path = _write_latin1(scratch, "municipios.csv", LATIN1_DIM)
    raw = read_delimited(spark, path, "codigo STRING, municipio STRING, provincia STRING, comunidad STRING, poblacion STRING")
    typed = clean.typed_cast(raw, {"codigo": "bigint", "poblacion": "bigint"})
    assert [(r.codigo, r.poblacion) for r in typed.collect()] == [(1, 57000), (2, None), (3, 39000)]
    assert rows(clean.reject_report(raw, {"poblacion": "bigint"})) == [("poblacion", 3, 0, 2, 1)]


def test_report_roundtrip(spark, scratch):
    out = os.path.join(scratch, "top.csv")
    src = joined(spark).select("codigo", "municipio", "poblacion")
    write_report(src, out, sep=";", encoding="ISO-8859-1", single_file=True)
    back = read_report(spark, out, "codigo BIGINT, municipio STRING, poblacion BIGINT", sep=";", encoding="ISO-8859-1")
    assert rows(back) == rows(src)
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 1
    # Re-running overwrites instead of failing (D3).
    write_report(src, out, sep=";", encoding="ISO-8859-1", single_file=True)


def test_report_keeps_null_and_empty_apart(spark, scratch):
    src = spark.createDataFrame([(1, ""), (2, None), (3, "ñ"), (4, 'a"b;c'), (5, "?")], "k INT, s STRING")
    for encoding in ("UTF-8", "ISO-8859-1"):
        out = write_report(src, os.path.join(scratch, encoding), encoding=encoding)
        assert rows(read_report(spark, out, "k INT, s STRING", encoding=encoding), "k") == [(i,) for i in range(1, 6)]
        assert {r.k: r.s for r in read_report(spark, out, "k INT, s STRING", encoding=encoding).collect()} == \
            {r.k: r.s for r in src.collect()}


def test_report_refuses_what_the_encoding_cannot_hold(spark, scratch):
    src = spark.createDataFrame([("Łódź €",)], "s STRING")
    with pytest.raises(Exception):
        write_report(src, os.path.join(scratch, "latin"), encoding="ISO-8859-1")


def test_files_with_other_column_orders_go_by_name(spark, scratch):
    folder = os.path.join(scratch, "res ults")
    _write_latin1(folder, "a.csv", "Codigo;PP;PSOE\n1;38;2\n")
    _write_latin1(folder, "b.csv", "Codigo;PSOE;PP\n2;2;38\n")
    assert rows(read_delimited(spark, folder)) == [("1", "38", "2"), ("2", "38", "2")]
    _write_latin1(folder, "c.csv", "Codigo;PSOE;NUEVO\n2;2;38\n")
    with pytest.raises(ValueError, match="nuevo"):
        read_delimited(spark, folder)


def test_save_table_rerun_and_joined_frame(spark, scratch):
    """The joined frame is saved, and saving again overwrites."""
    name = "test_elecciones_join"
    path = os.path.join(scratch, "tbl")
    save_table(joined(spark), name, path=path)
    save_table(joined(spark), name, path=path)
    back = scan_view(spark, name)
    assert "municipio" in back.columns and "validos" in back.columns
    assert back.count() == joined(spark).count()


def test_views(spark):
    register_view(dim(spark), "test_municipios")
    assert rows(scan_view(spark, "test_municipios", sql=True)) == rows(scan_view(spark, "test_municipios"))


def test_materialize_cuts_lineage(spark):
    m = materialize(dim(spark), "dim_test")
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "Relation" in plan
    assert rows(m) == rows(spark.createDataFrame(dim(spark).collect(), DIM_SCHEMA))


def test_checkpoint_root_comes_from_the_session(spark):
    from tallyframe.session import checkpoint_root, shared_dir

    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x", unique=True), shared_dir(spark, "x", unique=True)
    assert a != b and a.startswith(root.rstrip("/"))


def test_csv_modes(spark, scratch):
    import pytest

    path = _write_latin1(scratch, "bad.csv", "a;b\n1;2\nx;3\n4;5\n")
    schema = "a INT, b INT"
    assert [tuple(r) for r in read_delimited(spark, path, schema).collect()] == [(1, 2), (None, 3), (4, 5)]
    # (count() would not parse the fields, so it would keep the bad row)
    assert len(read_delimited(spark, path, schema, mode="DROPMALFORMED").collect()) == 2
    with pytest.raises(Exception):
        read_delimited(spark, path, schema, mode="FAILFAST").collect()
