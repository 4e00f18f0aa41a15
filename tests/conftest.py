"""One small session for all tests, and a comparison with DuckDB."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# the workers import the package and the tests' plug-ins
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE.parent), str(HERE), os.environ.get("PYTHONPATH", "")])
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "3g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def _plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(_plain, v)) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="session")
def against_sql():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.sql(f"create view {name.split('.')[0]} as select * from '{DATA}/{name}'")

    def check(df, sql: str) -> None:
        want = con.sql(sql)
        columns = sorted(df.columns)
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        a = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
        b = sorted((tuple(_plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
        assert a == b

    return check
