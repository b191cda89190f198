from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from occspark.schema import OCCURRENCE_SCHEMA, conform  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def occurrences(spark):
    """Build occurrence rows from dicts; absent fields are null."""

    def build(*rows: dict) -> DataFrame:
        names = sorted({k for r in rows for k in r})
        types = {f.name: f.dataType.simpleString() for f in OCCURRENCE_SCHEMA.fields}
        schema = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names)
        frame = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
        return conform(frame, OCCURRENCE_SCHEMA)

    return build


def records(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]
