"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_PARTITION_BYTES = 128 * 1024**2


def shuffle_partitions(input_bytes: int, low: int = 200) -> int:
    """Partitions that keep a full shuffle of the input at a size tasks hold in memory.

    Adaptive execution merges partitions that turn out small, so this errs upwards.
    """
    return max(low, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "occspark",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings every job here assumes.

    On a cluster the master and resources come from spark-submit; only
    engine-behaviour settings are fixed.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    settings |= conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    ``spark.checkpoint.dir`` is authoritative. Only a session without one
    (a local test run) gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
    fallback = tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared folder (survives executor loss)."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)


def stored_once(df: DataFrame) -> DataFrame:
    """``df`` as compressed files of the shared folder, for several jobs that read it, each only its columns."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
