import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlens.session import build_session  # noqa: E402
from ledgerlens.sources.fixtures import DRIVER_TABLES  # noqa: E402

SF_DIR = os.environ.get("LEDGERLENS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, app_name="ledgerlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    yield con
    con.close()
