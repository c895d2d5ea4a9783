import datetime as dt
import glob
import os

import duckdb
import pytest

from faultline.contract import EVENT_SCHEMA
from faultline.session import local_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), "faultline-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.maxMetadataStringLength", 10000)
    session.conf.set("spark.sql.shuffle.partitions", "3")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    def connect(sf: str):
        connection = duckdb.connect()
        connection.sql("SET timezone = 'UTC'")
        for path in glob.glob(f"{TESTDATA}/sf{sf}/*.parquet"):
            connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        return connection

    return connect


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def event(id, ts="2024-01-01 00:00:00", service="a-service", level="INFO", latency=10, endpoint="/x", trace=None, host="h", message="m"):
    return (id, trace or f"{id:036d}", service, host, level, at(ts) if isinstance(ts, str) else ts, message, latency, endpoint)


@pytest.fixture(scope="session")
def events_of(spark):
    def build(rows):
        return spark.createDataFrame(rows, EVENT_SCHEMA)

    return build


def rows_of(df, *columns):
    return sorted(tuple(row[c] for c in (columns or df.columns)) for row in df.collect())
