"""Command line: ``python -m tallyframe ...``, or on a cluster
``spark-submit --py-files tallyframe.zip tallyframe/__main__.py ...``.

    reports   PLACES RESULTS OUT   every report for an election, as CSV folders below OUT,
                                   with the rejected values and the unmatched codes beside them
    rejects   PLACES RESULTS       per-column counts of values that did not parse
    coverage  PLACES RESULTS       unit codes present in one file only

The session comes from spark-submit (master, executors, ``spark.checkpoint.dir``);
``--local N`` runs on this machine with N threads instead.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tallyframe")
    ap.add_argument("command", choices=["reports", "rejects", "coverage"])
    ap.add_argument("places")
    ap.add_argument("results")
    ap.add_argument("out", nargs="?")
    ap.add_argument("--sep", default=";")
    ap.add_argument("--encoding", default="ISO-8859-1")
    ap.add_argument("--only", default="", help="comma-separated report names")
    ap.add_argument("--local", type=int, default=0, help="run locally with N threads")
    ap.add_argument("--top-n", type=int, default=10, help="length of the top and bottom lists")
    ap.add_argument("--cohort-size", type=int, default=20, help="units in each size cohort")
    ap.add_argument("--small-below", type=float, default=10_000, help="population under which a unit is small")
    ap.add_argument("--band-cuts", default="", help="comma-separated share cuts in %% (default: the median)")
    ap.add_argument("--parties", default="", help="comma-separated party columns (cleaned names), or 'auto': "
                    "every results column without another role (default: the 2016 file's)")
    ap.add_argument("--keep", default="", help="comma-separated other count columns to sum and keep")
    ap.add_argument("--ignore", default="", help="comma-separated results columns to leave out")
    args = ap.parse_args(argv)

    from tallyframe.plans import election, reports
    from tallyframe.session import get_session
    from tallyframe.sources.delimited import read_delimited

    spark = get_session(app="tallyframe", master=f"local[{args.local}]" if args.local else None,
                        shuffle_partitions=args.local or None)
    csv = {"sep": args.sep, "encoding": args.encoding}
    layout = election.SPAIN_2016
    keep, ignore = ([c for c in v.split(",") if c] for v in (args.keep, args.ignore))
    if args.parties == "auto":
        layout = election.file_parties(read_delimited(spark, args.results, **csv).columns, layout, keep, ignore)
    elif args.parties:
        layout = layout.with_parties(p for p in args.parties.split(",") if p)
    if args.command == "reports":
        if not args.out:
            ap.error("reports needs an OUT folder")
        base = election.election_base(spark, args.places, args.results, layout, keep, ignore, **csv)
        names = [n for n in args.only.split(",") if n] or None
        cuts = [float(c) for c in args.band_cuts.split(",") if c]
        params = replace(election.SPAIN_2016_PARAMS, layout=layout, top_n=args.top_n, cohort_size=args.cohort_size,
                         small_below=args.small_below,
                         band_cut=(cuts[0] if len(cuts) == 1 else cuts) if cuts else None)
        done = reports.run_reports(base, args.out, names, params=params)
        done |= election.write_quality(spark, args.places, args.results, args.out, layout, **csv)
        for name, path in done.items():
            print(f"{name}\t{path}")
    elif args.command == "rejects":
        for r in election.rejects(spark, args.places, args.results, layout, **csv).collect():   # a few rows per column
            print("\t".join(str(v) for v in r))
    else:
        for r in election.coverage(spark, args.places, args.results, layout, **csv).collect():  # two rows
            print("\t".join(str(v) for v in r))
    return 0


if __name__ == "__main__":
    sys.exit(main())
