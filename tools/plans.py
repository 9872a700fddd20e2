"""Summarise the physical plan of each output (after execution, AQE final plan).

usage: python tools/plans.py [sf_dir] > docs/PLANS.md
With stored intermediates each output's plan starts at the scans of its inputs,
so the counts are per stage of the pipeline.
"""

from __future__ import annotations

import collections
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockpulse.plans import LedgerRun  # noqa: E402
from stockpulse.session import local_session  # noqa: E402
from stockpulse.sources import load_tables, write_outputs  # noqa: E402
from stockpulse.sources.testdata import load_testdata, testdata_params  # noqa: E402

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "Window ", "WindowGroupLimit",
         "HashAggregate", "ObjectHashAggregate", "SortAggregate", "InMemoryTableScan",
         "Scan ExistingRDD", "FileScan", "WholeStageCodegen", "PythonUDF", "ArrowEvalPython"]


def summarise(name: str, df) -> str:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    c = collections.Counter()
    for line in plan.splitlines():
        for n in NODES:
            if n in line:
                c[n.strip()] += 1
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)))
    out = [f"### {name}", "", "| node | count |", "|---|---|"]
    out += [f"| {k} | {v} |" for k, v in sorted(c.items())]
    if pushed:
        out += ["", "Pushed filters: " + "; ".join(p for p in pushed if p)]
    return "\n".join(out) + "\n"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    work = tempfile.mkdtemp(prefix="stockpulse-plans-")
    write_outputs(load_testdata(spark, sf), f"{work}/sources")
    run = LedgerRun(load_tables(spark, f"{work}/sources"), testdata_params(),
                    materialize="table", output_path=f"{work}/outputs")
    print(f"# Physical plans per output ({os.path.basename(sf)}, intermediates stored as tables)\n")
    print("Generated by `python tools/plans.py`. Counts are nodes in the executed (AQE final)\n"
          "plan of each output, starting from its stored inputs; the plan of the\n"
          "output itself is what the count of `Exchange` nodes (shuffles) describes.\n")
    from stockpulse.operators import action, buyer, demand, overlay, quarantine, risk, safety, suppress
    t, p = run.t, run.p
    # each output built fresh on top of its stored inputs
    outs = {
        "v1 demand ledger": lambda: demand.demand_ledger(t, p),
        "v2 suppressed ledger (skew-safe balance)": lambda: suppress.suppressed_ledger_full(
            run.v1_full, t["bin_stock"], p),
        "v3 quarantine pipe": lambda: quarantine.quarantine_pipe(t["lots"], t["item_master"], p),
        "v4 extended ledger": lambda: overlay.extended_ledger(
            run.v2_full, run.v3, p),
        "v5 supply action": lambda: action.supply_action(run.v4, run.v3, p),
        "vs safety stock": lambda: safety.safety_stock_calc(
            t["ss_items"], t["receipts"], t["receipt_lines"], t["consumption"], p),
        "deficit rows (shared by v6 and v7)": lambda: risk.deficit_rows(run.v4, run.v3, p),
        "v6 run risk": lambda: risk.run_risk(run.deficits, run.vs, p),
        "v7 buyer rows (B1-B5)": lambda: buyer.priced_rows(run.deficits, run.vs, run.v4, t["receipt_lines"], p),
        "v7 buyer control (from the buyer rows)": lambda: buyer.buyer_control(
            run.deficits, run.vs, run.v4, t["receipt_lines"], p, sort=False,
            cut=lambda df: run._cut(df, "buyer_rows")),
    }
    for name, make in outs.items():
        print(summarise(name, make()))


if __name__ == "__main__":
    main()
