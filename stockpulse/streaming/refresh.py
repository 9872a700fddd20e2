"""Refresh all outputs when new planning files arrive (Structured Streaming).

A file-source stream watches the planning table's directory.  Each
micro-batch with new files re-runs the whole ledger over the current snapshot
of every source and publishes a new version of the outputs (``sources.publish``),
each table written once; the ledger's per-item running balances depend on all of
an item's rows, so there is no partial update.
The stream's progress lives in a checkpoint under the cluster's shared
``spark.checkpoint.dir`` (or an explicit location), so a restarted driver
resumes where it stopped; a replayed batch publishes the same outputs again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stockpulse.params import Params
from stockpulse.plans.views import LedgerRun
from stockpulse.sources.io import load_tables
from stockpulse.sources.publish import new_version, prune, switch
from stockpulse.sources.schemas import PLANNING


def start_refresh(spark: SparkSession, source_base: str, output_base: str,
                  params: Callable[[], Params], fmt: str = "parquet",
                  checkpoint_location: str | None = None, trigger: str | None = "1 minute",
                  available_now: bool = False, keep: int = 2) -> StreamingQuery:
    """Start the refresh stream; ``params()`` is called per batch (e.g. as_of = now).

    Readers take the outputs through ``sources.read_published(spark, output_base, name)``;
    the last ``keep`` versions stay."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    location = checkpoint_location or (f"{base}/stockpulse-refresh" if base else None)
    if location is None:
        raise RuntimeError("set spark.checkpoint.dir or pass checkpoint_location")
    watch = spark.readStream.schema(PLANNING).format(fmt).load(f"{source_base}/planning")

    def refresh(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        version = new_version(output_base)
        run = LedgerRun(load_tables(spark, source_base, fmt), params(), materialize="table", output_path=version, layout=True)
        try:
            run.materialize_all()  # writes its outputs into the version as they are built
        finally:
            run.release()  # each batch removes its own intermediates
        switch(spark, output_base, version)
        prune(spark, output_base, keep)

    w = watch.writeStream.foreachBatch(refresh).option("checkpointLocation", location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()
