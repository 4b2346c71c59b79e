"""Write PLANS.md: the physical plan of every batch query as a large cluster would see it.

Usage: ``python tests/plan_report.py [sf_dir] > PLANS.md``.  AQE is switched
off and the broadcast limit lowered so that only the fixed-size dimensions
(nation, region) are broadcast; ``customer`` and ``orders`` are treated as
huge.  For each query the table lists the shuffles (exchange and keys) and
the operators that bound work per task.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NOTES = """Reading the table:

* **Base twice** (`large_vs_small_union`, `cohort_*`): the query uses the base in two branches, the large and the
  small cohort. With AQE off each branch shows its own exchanges. With AQE on (as `get_session` sets it), identical
  exchanges are computed once and reused. The report bundle reads the base from one materialised copy in any case.
* **`unanimous_or_top10*`** write the winner of every unit once; the hits, the top n and the `NOT EXISTS` probe read
  those files. The row shows what is planned after that.
* **`share_of_group`** writes the units and the totals (one row per group) once. The planner then knows the size of
  the totals, so small ones are broadcast and the units are not shuffled by group; the row shows that last step.
* **`representativeness`** reads the base once. Its group step is a sort-based aggregate because the largest-unit
  pick keeps a struct in its buffer; both of its aggregates combine map-side.
* **Windows** (`largest_unit_per_group`, `max_row_per_group`, `cohort_top_parties`) all run a partial
  `WindowGroupLimit` before their shuffle, so a task sends at most n rows per group.
* **Cleaning queries** are narrow (no exchange); `typed_cast` has one single-row exchange for its global counts."""

MARKERS = [
    ("partial aggregate", r"partial_"),
    ("TakeOrderedAndProject", r"TakeOrderedAndProject"),
    ("partial WindowGroupLimit", r"WindowGroupLimit .*Partial"),
    ("Expand", r"\bExpand\b"),
    ("SortAggregate", r"\bSortAggregate\b"),
    ("SortMergeJoin", r"\bSortMergeJoin\b"),
    ("BroadcastHashJoin", r"\bBroadcastHashJoin\b"),
    ("scalar subquery", r"Subquery"),
]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from tallyframe.plans import registry
    from tallyframe.session import get_session

    spark = get_session(master="local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10240")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print("# Plans at scale\n")
    print("Generated by `tests/plan_report.py`: AQE off, broadcast only for the fixed-size `nation` and `region`,")
    print("so `orders` and `customer` are planned as if they were huge. On a real cluster AQE then coalesces small")
    print("shuffles, splits skewed ones and turns joins with small measured sides into broadcasts. The base")
    print("(`orders` pre-aggregated per customer, joined to `customer`) costs two exchanges by itself.\n")
    print("| query | exchanges | exchange keys | bounded / notable operators |")
    print("| --- | --- | --- | --- |")
    for name in registry.REGISTRY:
        if name.startswith("stream_") or name.endswith("roundtrip") or name == "representativeness_by_band":
            continue
        df = registry.REGISTRY[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        ex = re.findall(r"Exchange (hashpartitioning\(([^)]*)\)|SinglePartition|rangepartitioning\(([^)]*)\))", plan)
        keys = []
        for full, h, r in ex:
            if h:
                keys.append("hash(" + ", ".join(k.split("#")[0] for k in h.split(", ")[:-1]) + ")")
            elif r:
                keys.append("range")
            else:
                keys.append("single")
        notes = [label for label, pat in MARKERS if re.search(pat, plan)]
        print(f"| `{name}` | {len(ex)} | {', '.join(keys)} | {', '.join(notes)} |")
    print("\nNot listed: the two round trips (they write and read back files), `representativeness_by_band` (it")
    print("checkpoints `representativeness`, listed above, then reads one row per group), and the live queries")
    print("(streaming plans; their state is bounded by watermarks and by the number of boxes).\n")
    print(NOTES)


if __name__ == "__main__":
    main(sys.argv)
