import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockpulse.params import Params  # noqa: E402
from stockpulse.session import local_session  # noqa: E402
from stockpulse.sources.schemas import SOURCE_SCHEMAS  # noqa: E402

AS_OF = dt.datetime(2026, 1, 15, 10, 0, 0)
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, app="stockpulse-tests")
    s.sparkContext.setLogLevel("ERROR")
    if s.conf.get("spark.checkpoint.dir", None) is None:
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stockpulse-ckpt-"))
    yield s


@pytest.fixture
def params():
    return Params(as_of=AS_OF)


def make_tables(spark, **rows):
    """Source tables from lists of dicts; absent tables are empty, absent columns NULL."""
    out = {}
    for name, schema in SOURCE_SCHEMAS.items():
        data = [tuple(r.get(f.name) for f in schema.fields) for r in rows.get(name, [])]
        out[name] = spark.createDataFrame(data, schema)
    return out
