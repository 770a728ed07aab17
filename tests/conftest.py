import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session, checkpoint_root
    # more than one shuffle partition, so hidden reliance on row order fails
    s = build_session("local[*]", app="strata-tests", shuffle_partitions=8)
    checkpoint_root(s)  # creates and registers one only if the session has none
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from strata.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
