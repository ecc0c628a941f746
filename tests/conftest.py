from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reunion.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="reunion-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from reunion.sources.tables import TABLES, table_path

    def connect(sf_dir: str):
        con = duckdb.connect()
        for t in TABLES:
            p = table_path(sf_dir, t)
            if os.path.exists(p):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
        return con

    return connect
