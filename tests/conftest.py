"""A session for all tests, and DuckDB over the same tables."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from screenforge.session import prepare

    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


def rows_of(frame) -> list[tuple]:
    """Rows of a pandas frame in a form that compares: columns by name, rows sorted, numbers rounded."""

    def plain(v):
        if v is None or v != v:
            return None
        if isinstance(v, float) or type(v).__name__.startswith(("float", "Decimal")):
            return round(float(v), 6)
        return str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(plain(v) for v in row) for row in frame.itertuples(index=False)), key=str)
