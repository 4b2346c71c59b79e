import os

from tallyframe.plans import reports
from tallyframe.plans.testbed import results_wide
from tallyframe.sources import read_report
from tests.conftest import SF_SMALL, rows


def test_bundle_writes_every_report_from_one_base(spark, scratch):
    base = results_wide(spark, SF_SMALL)
    names = ["population_top10", "turnout_by_province", "representativeness", "unit_top_parties"]
    out = reports.run_reports(base, os.path.join(scratch, "out"), names)
    assert sorted(out) == sorted(names)
    for name in names:
        parts = [f for f in os.listdir(out[name]) if f.startswith("part-")]
        bounded = reports.REPORTS[name][1]
        assert parts and (len(parts) == 1 or not bounded)
    direct = reports.population_top10(base)
    back = read_report(spark, out["population_top10"],
                       "unit_id BIGINT, unit STRING, community STRING, province STRING, population DECIMAL(28,2)")
    assert rows(back) == rows(direct)


def test_every_report_is_registered():
    from tallyframe.plans import registry

    assert set(reports.REPORTS) <= set(registry.REGISTRY)
