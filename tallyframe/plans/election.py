"""Loading an election from its two delimited files, and the Spanish settings.

The place file (one row per municipality) and the results file (one row per
municipality or polling table, one count column per party) are ``;``
separated Latin-1 text with a header.  Headers are cleaned by the results-file
rule, the place strings are trimmed and accent-folded, numbers are re-typed
with ``try_cast`` (dirty values become null and are counted by
:func:`rejects`), and the results are joined to the places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.model import SPAIN_2016, SPAIN_EMPTY_PROVINCES, SPAIN_FULL_PROVINCES, Layout
from tallyframe.operators import clean, joins
from tallyframe.plans.reports import ReportParams
from tallyframe.sources.delimited import read_delimited, write_report

SPAIN_2016_PARAMS = ReportParams(
    layout=SPAIN_2016, top_n=10, cohort_size=20, small_below=10_000, top_parties=5,
    province_cohorts={"vacia": SPAIN_EMPTY_PROVINCES, "llena": SPAIN_FULL_PROVINCES})


def _place_types(layout: Layout) -> dict[str, str]:
    return {layout.unit_id: "bigint", layout.population: "bigint"}


def _count_types(layout: Layout, columns: list[str], keep: Sequence[str] = ()) -> dict[str, str]:
    wanted = [layout.unit_id, layout.census, layout.voters, layout.valid, *layout.parties, *keep]
    return {c: "bigint" for c in wanted if c in columns}


def check_columns(columns: Sequence[str], layout: Layout, keep: Sequence[str] = (),
                  ignore: Sequence[str] = ()) -> None:
    """Raise unless a results file has every column of the layout and no unexplained one.

    A party the layout does not know would otherwise lose its votes silently.
    """
    wanted = [layout.unit_id, layout.census, layout.voters, layout.valid, *layout.parties, *keep]
    missing = [c for c in wanted if c not in columns]
    unknown = [c for c in columns if c not in wanted and c not in ignore]
    if missing or unknown:
        raise ValueError(f"results file: missing columns {missing}, unknown columns {unknown}; "
                         "name the parties, and the other columns to keep or to ignore")


def file_parties(columns: Sequence[str], layout: Layout, keep: Sequence[str] = (),
                 ignore: Sequence[str] = ()) -> Layout:
    """The layout with the file's own parties: every column that has no other role, in file order."""
    known = {layout.unit_id, layout.census, layout.voters, layout.valid, *keep, *ignore}
    return layout.with_parties(c for c in columns if c not in known)


def load_places(spark: SparkSession, path: str, layout: Layout = SPAIN_2016, **csv) -> DataFrame:
    raw = clean.trim_strings(read_delimited(spark, path, **csv))
    folded = clean.fold_columns(raw, [c for c in raw.columns if c not in _place_types(layout)])
    return clean.typed_cast(folded, _place_types(layout)).drop("_rejected")


def load_results(spark: SparkSession, path: str, layout: Layout = SPAIN_2016,
                 keep: Sequence[str] = (), **csv) -> DataFrame:
    raw = read_delimited(spark, path, **csv)
    return clean.typed_cast(raw, _count_types(layout, raw.columns, keep)).drop("_rejected")


def results_per_unit(results: DataFrame, layout: Layout, keep: Sequence[str] = ()) -> DataFrame:
    """One row per unit: the counts of every row of the unit (polling tables) summed.

    Partial aggregation in every task shrinks the fact to units before any
    shuffle; a unit reported on very many rows is one partial row per task.
    ``keep`` names further counts to sum; other columns are dropped (the place
    attributes come from the dimension).
    """
    counts = [c for c in _count_types(layout, results.columns, keep) if c != layout.unit_id]
    return results.groupBy(layout.unit_id).agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in counts])


def election_base(spark: SparkSession, places_path: str, results_path: str,
                  layout: Layout = SPAIN_2016, keep: Sequence[str] = (), ignore: Sequence[str] = (),
                  **csv) -> DataFrame:
    """Results per unit joined to places on the unit code (inner; see ``coverage``
    for what it drops).  One row per unit, so every report counts a unit once.

    ``keep`` names counts beside the layout's that are summed and kept, ``ignore``
    columns to leave out.  Raises ``ValueError`` for any other column, for a missing
    one, and for a unit code on several rows of the places file.
    """
    places = joins.require_unique(load_places(spark, places_path, layout, **csv), layout.unit_id)
    loaded = load_results(spark, results_path, layout, keep, **csv)
    check_columns(loaded.columns, layout, keep, ignore)
    return joins.join_dimension(results_per_unit(loaded, layout, keep), places, layout.unit_id)


def coverage(spark: SparkSession, places_path: str, results_path: str, layout: Layout = SPAIN_2016,
             **csv) -> DataFrame:
    """Unit codes present in one file only, per side."""
    return joins.join_coverage(load_places(spark, places_path, layout, **csv),
                               load_results(spark, results_path, layout, **csv),
                               layout.unit_id, layout.unit_id, "places", "results")


def rejects(spark: SparkSession, places_path: str, results_path: str, layout: Layout = SPAIN_2016,
            **csv) -> DataFrame:
    """Per file and column: rows, blanks, parsed and rejected numbers."""
    places = clean.trim_strings(read_delimited(spark, places_path, **csv))
    results = read_delimited(spark, results_path, **csv)
    return (clean.reject_report(places, _place_types(layout)).withColumn("file", F.lit("places"))
            .unionByName(clean.reject_report(results, _count_types(layout, results.columns))
                         .withColumn("file", F.lit("results"))))


def write_quality(spark: SparkSession, places_path: str, results_path: str, out_dir: str,
                  layout: Layout = SPAIN_2016, **csv) -> dict[str, str]:
    """Write ``rejects`` and ``coverage`` below ``out_dir``, beside the reports they qualify."""
    out = {}
    for name, frame in (("rejects", rejects), ("coverage", coverage)):
        path = f"{out_dir.rstrip('/')}/{name}"
        out[name] = write_report(frame(spark, places_path, results_path, layout, **csv), path, single_file=True)
    return out
