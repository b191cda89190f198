"""The pipeline's stages on a small folder of tables, and the registered queries."""

from __future__ import annotations

import corpus_pipeline
import __spark_entry__ as contract
from occspark.llm import decontaminate, simhash


def test_every_operator_has_one_query():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in contract.queries()


def test_stages_take_effect_on_what_the_one_before_kept(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, items = docs.columns, spark.read.parquet(f"{folder}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder).cache()
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after.columns == columns
        kept[name], docs = ids, after
        if name == "near_dedup":
            groups = simhash.groups(after).toPandas()
            assert (groups.doc_id == groups.component_id).all()
        if name == "decontamination":
            assert decontaminate.find(after, items).count() == 0
    assert kept["secret_scan"] == kept["decontamination"] and 0 < len(kept["mixture"]) < len(kept["secret_scan"])
    again = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert again == kept["mixture"]
