"""The driver contract, and some queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from verification.compare import compare

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are absent")


def test_every_sql_has_its_query():
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 100


@needs_tables
def test_flagship_query(spark):
    frame = contract.entry(spark)
    assert "color_value" in frame.columns and frame.count() > 0


@needs_tables
@pytest.mark.parametrize(
    "name", ["a28_x5_impact_summary", "j9_w2_assign_areas", "o3_o4_composition_rows", "x3_completion_counts"]
)
def test_query_equals_its_sql(spark, name):
    assert compare(spark, FOLDER, [name]) == []


def test_taxon_names_of_odd_texts_equal_their_sql(spark, tmp_path):
    given = ["", " ", None, "()", "Aİb (İ) İ", "Ornitha (Lirida) vexans", "ΣKı"]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").coalesce(1).write.parquet(path)
    name = "f9_normalise_taxon_name"
    got = contract.queries()[name](spark, str(tmp_path)).collect()
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    wanted = connection.sql(contract.oracle_sql()[name]).fetchall()
    assert sorted(map(tuple, got)) == sorted(wanted) and len(wanted) == len(given)
