"""The whole report flow on election files as they arrive: ';', Latin-1,
raw headers, padded and accented names, a dirty number, a code on one side only."""

import os

import pytest

from tallyframe.plans import election, reports
from tallyframe.sources import read_report
from tests.conftest import rows
from tests.fixtures import DIM, FACT, PARTIES

RAW_PARTY_HEADERS = ["PP", "PSOE", "PODEMOS-IU-EQUO", "C's", "AND"]


def _cell(v):
    return "" if v is None else str(v)


def write_files(folder):
    os.makedirs(folder, exist_ok=True)
    places = os.path.join(folder, "municipios.csv")
    with open(places, "w", encoding="latin-1") as fh:
        fh.write("Codigo;Municipio;Provincia;Comunidad;Poblacion\n")
        for code, name, prov, com, pop in DIM:
            pop_txt = "1.234" if code == 10 else _cell(pop)          # a dirty number
            fh.write(f"{code};  {name} ;{prov};{com};{pop_txt}\n")
    results = os.path.join(folder, "elecciones.csv")
    with open(results, "w", encoding="latin-1") as fh:
        fh.write("Codigo;Censo;Votantes;Validos;" + ";".join(RAW_PARTY_HEADERS) + "\n")
        for row in FACT:
            fh.write(";".join(_cell(v) for v in row) + "\n")
    return places, results


PARAMS = reports.ReportParams(
    layout=election.SPAIN_2016.with_parties(PARTIES), top_n=3, cohort_size=2, small_below=1000,
    province_cohorts=election.SPAIN_2016_PARAMS.province_cohorts)


def test_election_files_to_reports(spark, scratch):
    places, results = write_files(os.path.join(scratch, "in"))
    base = election.election_base(spark, places, results, PARAMS.layout)
    assert base.count() == 12          # one row per unit: 9 had two rows, 11 has no place
    huesca = base.filter("codigo = 9").collect()[0]
    assert (huesca.censo, huesca.votantes, huesca.pp) == (200, 110, 30)
    out = reports.run_reports(base, os.path.join(scratch, "out"), params=PARAMS)
    assert set(out) == set(reports.REPORTS)

    rep = {r.comunidad: r for r in reports.representativeness(base, PARAMS).collect()}
    assert rep["Madrid"].coincides is True and rep["Galicia"].coincides is False
    assert rep["Andalucia"].unit_party == "and"                  # folded name, last party wins

    hits = rows(reports.unanimous_or_top10(base, PARAMS), "codigo", "party")
    assert hits == [(3, "pp"), (5, "and")]
    tags = rows(reports.cohort_by_list(base, PARAMS), "provincia", "cohort")
    assert tags == [("Avila", "vacia"), ("Madrid", "llena"), ("Malaga", "llena"), ("Sevilla", "llena"),
                    ("Soria", "vacia"), ("Teruel", "vacia")]
    top = read_report(spark, out["population_top10"],
                      "codigo BIGINT, municipio STRING, comunidad STRING, provincia STRING, poblacion BIGINT")
    assert [r.codigo for r in top.orderBy("poblacion", ascending=False).collect()] == [1, 5, 4]


def test_election_rejects_and_coverage(spark, scratch):
    places, results = write_files(os.path.join(scratch, "in"))
    rej = {(r.file, r.column_name): (r.n_blank, r.n_ok, r.n_rejected)
           for r in election.rejects(spark, places, results, PARAMS.layout).collect()}
    assert rej[("places", "poblacion")] == (1, 11, 1)          # null for Soria, '1.234' rejected
    assert rej[("results", "pp")] == (1, 13, 0)
    cov = rows(election.coverage(spark, places, results, PARAMS.layout))
    assert cov == [("places_only", 1, 1), ("results_only", 1, 1)]


def test_command_line(spark, scratch, capsys):
    from tallyframe.__main__ import main

    places, results = write_files(os.path.join(scratch, "in"))
    out = os.path.join(scratch, "cli")
    assert main(["coverage", places, results]) == 0
    assert "places_only\t1\t1" in capsys.readouterr().out
    assert main(["rejects", places, results]) == 0
    assert "poblacion\t13\t1\t11\t1\tplaces" in capsys.readouterr().out
    # The Spanish configuration lists 51 parties; the fixture file has five of its own.
    with pytest.raises(ValueError, match="missing columns"):
        main(["reports", places, results, out])
    assert main(["reports", places, results, out, "--parties", "auto", "--top-n", "3"]) == 0
    printed = capsys.readouterr().out
    for name in [*reports.REPORTS, "rejects", "coverage"]:
        assert os.path.exists(os.path.join(out, name, "_SUCCESS")), name
    assert "population_top10" in printed and os.path.isdir(os.path.join(out, "turnout_by_province"))
    top = spark.read.option("header", "true").csv(os.path.join(out, "population_top10"))
    assert top.count() == 3


def test_command_line_band_cuts(spark, scratch, capsys):
    from tallyframe.__main__ import main

    places, results = write_files(os.path.join(scratch, "in"))
    out = os.path.join(scratch, "cli_bands")
    assert main(["reports", places, results, out, "--only", "representativeness_by_band",
                 "--parties", ",".join(PARTIES), "--band-cuts", "50,58"]) == 0
    bands = spark.read.option("header", "true").csv(os.path.join(out, "representativeness_by_band"))
    assert sorted(r.share_band for r in bands.collect()) == ["[50, 58)", "[58, inf)"]
    capsys.readouterr()


def _write(folder, name, lines):
    path = os.path.join(folder, name)
    os.makedirs(folder, exist_ok=True)
    with open(path, "w", encoding="latin-1") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_unknown_and_missing_columns_are_refused(spark, scratch):
    places = _write(scratch, "p.csv", ["Codigo;Municipio;Provincia;Comunidad;Poblacion", "1;A;P;C;10"])
    results = _write(scratch, "r.csv", ["Codigo;Censo;Votantes;Validos;PP;NUEVO;Blancos;Nota",
                                        "1;90;80;78;20;48;3;x", "1;10;8;7;2;5;1;y"])
    layout = election.SPAIN_2016.with_parties(["pp", "psoe"])
    with pytest.raises(ValueError, match="psoe.*nuevo"):
        election.election_base(spark, places, results, layout)
    layout = election.file_parties(["codigo", "censo", "votantes", "validos", "pp", "nuevo", "blancos", "nota"],
                                   layout, keep=["blancos"], ignore=["nota"])
    assert layout.parties == ("pp", "nuevo")
    base = election.election_base(spark, places, results, layout, keep=["blancos"], ignore=["nota"])
    assert rows(base, "codigo", "pp", "nuevo", "blancos") == [(1, 22, 53, 4)]


def test_repeated_place_codes_are_refused(spark, scratch):
    places = _write(scratch, "p.csv", ["Codigo;Municipio;Provincia;Comunidad;Poblacion", "1;A;P;C;10", "1;A;P;C;10"])
    results = _write(scratch, "r.csv", ["Codigo;Censo;Votantes;Validos;PP", "1;90;80;78;20"])
    with pytest.raises(ValueError, match="not unique"):
        election.election_base(spark, places, results, election.SPAIN_2016.with_parties(["pp"]))
