import os

import pytest
from pyspark.sql import DataFrame

from docquery.session import get_session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def docs(spark):
    """Documents from `{id: body}` and a DDL of the body."""

    def make(bodies: dict, ddl: str, index: str = "posts") -> DataFrame:
        rows = [(index, key, body) for key, body in bodies.items()]
        return spark.createDataFrame(rows, f"_index string, _id string, _source struct<{ddl}>")

    return make


def rows(df: DataFrame) -> list[dict]:
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=str)


pytest.rows = rows
