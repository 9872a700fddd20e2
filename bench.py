"""Benchmark: time the eight composed outputs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Steps: (1) the test-data adapter writes the twelve source tables once (the
stand-in for a user's source tables); (2) end to end: all eight outputs, written
as Parquet, independent ones as concurrent jobs (the headline value); (3) every
table of a run one after another, from its stored inputs (``own``).  ``queries`` adds
up a view and all it needs; ``on_stored_inputs`` is what run risk and buyer control
take on a stored extended ledger and safety stock.  Median of $BENCH_REPS after a
warming pass.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockpulse.plans import LedgerRun  # noqa: E402
from stockpulse.session import local_session  # noqa: E402
from stockpulse.sources import load_tables, write_outputs  # noqa: E402
from stockpulse.sources.testdata import load_testdata, testdata_params  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPS = int(os.environ.get("BENCH_REPS", "1"))
VIEWS = {"v1_demand_ledger": "v1_full", "v2_suppressed_ledger": "v2_full", "v3_quarantine_pipe": "v3",
         "v4_extended_ledger": "v4", "v5_supply_action": "v5", "vs_safety_stock": "vs",
         "v6_run_risk": "v6", "v7_buyer_control": "_v7_rows"}


def _sf(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def main() -> None:
    spark = local_session(cores=CPUS, shuffle_partitions=max(CPUS, 8), app="stockpulse-bench")
    spark.sparkContext.setLogLevel("ERROR")
    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="stockpulse-bench-")
    params = testdata_params()
    outputs = f"{scratch}/outputs"

    t0 = time.time()
    write_outputs(load_testdata(spark, SF_DIR), f"{scratch}/sources")
    adapt_s = time.time() - t0
    tables = load_tables(spark, f"{scratch}/sources")

    def run() -> LedgerRun:
        return LedgerRun(tables, params, materialize="table", output_path=outputs)

    def end_to_end() -> tuple[float, LedgerRun]:
        t, r = time.time(), run()
        r.materialize_all()
        return time.time() - t, r

    def one_by_one() -> dict[str, float]:
        """Seconds of each table of a run, built from its stored inputs."""
        r, own = run(), {}
        for attr in [a for wave in LedgerRun.WAVES for a in wave]:
            t = time.time()
            getattr(r, attr)
            own[attr] = time.time() - t
        r.release()
        return own

    def upstream(attr: str) -> set[str]:
        return {attr}.union(*(upstream(n) for n in LedgerRun.NEEDS[attr]))

    _, warm = end_to_end()  # warms the JVM and the file cache
    rows = {name: getattr(warm, attr).count() for name, attr in VIEWS.items()}
    warm.release()
    full, owns = [], []
    for _ in range(REPS):
        sec, r = end_to_end()
        r.release()
        full.append(sec)
        owns.append(one_by_one())
    own = {a: statistics.median(o[a] for o in owns) for a in owns[0]}
    # cold: a view and everything it needs, one after another
    cold = {name: round(sum(own[a] for a in upstream(attr)), 3) for name, attr in VIEWS.items()}
    stored = {name: round(own["deficits"] + own[VIEWS[name]], 3) for name in ("v6_run_risk", "v7_buyer_control")}

    print(json.dumps({
        "metric": "end_to_end_all_outputs_sec", "value": round(statistics.median(full), 3), "unit": "sec",
        "queries": cold, "on_stored_inputs": stored,
        "own": {name: round(own[attr], 3) for name, attr in VIEWS.items()},
        "sf": _sf(SF_DIR), "cpus": CPUS, "reps": REPS, "adapter_write_sec": round(adapt_s, 3), "rows": rows}))


if __name__ == "__main__":
    main()
