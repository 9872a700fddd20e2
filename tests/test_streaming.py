"""The refresh stream re-runs the outputs for new planning files."""

import tempfile

from conftest import SF_SMALL
from stockpulse.sources import read_published, write_outputs
from stockpulse.sources.testdata import load_testdata
from stockpulse.sources.testdata import testdata_params as td_params
from stockpulse.streaming import start_refresh


def test_refresh_available_now(spark):
    work = tempfile.mkdtemp(prefix="stockpulse-stream-")
    write_outputs(load_testdata(spark, SF_SMALL), f"{work}/sources")
    q = start_refresh(spark, f"{work}/sources", f"{work}/outputs", td_params,
                      checkpoint_location=f"{work}/stream-ckpt", available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    v7 = read_published(spark, f"{work}/outputs", "buyer_control")
    assert len(v7.columns) == 22 and v7.count() > 0
    assert len(read_published(spark, f"{work}/outputs", "demand_ledger").columns) == 31
