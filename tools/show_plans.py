"""Print the physical plans of the core operators as they run at scale.

    python tools/show_plans.py [sf_dir] > PLANS.md

Broadcast joins are switched off (at 100 TB no fact or state side is under
the broadcast threshold), so the plans show the shuffles a cluster runs.
Only the operator tree is printed, with the pushed filters and read schema
of each scan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from lakezones import queries as Q  # noqa: E402
from lakezones.operators.changes import changed_rows, current_state, snapshot_diff  # noqa: E402
from lakezones.operators.ledger import watermarks_of  # noqa: E402
from lakezones.operators.rownum import attach_row_numbers, dense_row_number  # noqa: E402
from lakezones.session import local_session  # noqa: E402


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    keep = []
    for line in plan.split("\n"):
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        if "FileScan" in line:
            pushed = re.search(r"PushedFilters: \[[^\]]*\]", line)
            schema = re.search(r"ReadSchema: struct<[^>]*>?", line)
            head = line[:line.index("FileScan")] + "FileScan parquet"
            line = " ".join(x for x in (head, pushed.group(0) if pushed else "",
                                        schema.group(0)[:110] if schema else "") if x)
        keep.append(line[:200])
    return "\n".join(keep)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    orders = Q.table(spark, sf, "orders")
    old = Q.old_orders(orders)
    versions = old.withColumn("batch_id", F.lit("b1")).withColumn("ROW_NUMBER", F.lit(1))
    state = current_state(versions, ["o_orderkey"]).select(*orders.columns)
    keyed = changed_rows(orders, state, orders.columns, base_unique=True, key=["o_orderkey"])
    cases = [
        ("Wide table: lineitem ⋈ (orders ⋈ customer) ⋈ part (J1, J2, P1, P2)", Q.q_wide_table(spark, sf)),
        ("Snapshot diff, EXCEPT DISTINCT by name (U1)", snapshot_diff(orders, old)),
        ("Current state by key (max_by, partial aggregate)", current_state(versions, ["o_orderkey"])),
        ("Changed rows against the keyed current state (J3)", keyed),
        ("Whole-row changed rows, keyless base (J3)", changed_rows(orders, old, orders.columns)),
        ("Incremental extract: key-only numbering joined back to the changed rows",
         attach_row_numbers(keyed, orders, ["o_orderkey"])),
        ("Dense row numbers of a unique key, joined back (P4, W1; plan after the checkpoint)",
         dense_row_number(orders, ["o_orderkey"], unique=True)),
        ("Dense row numbers, rows carried whole (plan after the checkpoint)",
         dense_row_number(Q.table(spark, sf, "customer"), ["c_name"])),
        ("Watermarks for every table (A5)", watermarks_of(Q.events_ledger(Q.table(spark, sf, "events")))),
    ]
    print("# Physical plans at scale\n")
    print(f"Generated by `tools/show_plans.py` on `{sf}` with broadcast joins off "
          "(`spark.sql.autoBroadcastJoinThreshold=-1`), AQE on. Initial adaptive plans; "
          "AQE may still coalesce partitions and split skewed ones at run time.\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
