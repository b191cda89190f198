"""Session sizing and lineage cutting."""

from __future__ import annotations

from pyspark.sql import functions as F

from occspark.session import checkpoint_dir, cut_lineage, shuffle_partitions
from occspark.streaming.ingest import first_seen


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(1024**4) == 8192
    assert shuffle_partitions(100 * 1024**4) == 819_200


def test_lineage_is_cut_in_the_shared_folder(spark):
    kept = cut_lineage(spark.range(5).where("id > 1"))
    assert kept.count() == 3
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert "ExistingRDD" in kept._jdf.queryExecution().executedPlan().toString()


def test_first_seen_on_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "uuid string, seconds long")
    rows.withColumn("ts", F.timestamp_seconds("seconds")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("uuid string, seconds long, ts timestamp").parquet(str(tmp_path / "in"))
    query = (
        first_seen(stream, "ts", ["uuid"], "1 hour")
        .writeStream.format("memory")
        .queryName("first_seen_rows")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(r["uuid"] for r in spark.table("first_seen_rows").collect()) == ["a", "b"]
