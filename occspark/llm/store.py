"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of sessions without a checkpoint folder (local tests), by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new, unused folder below ``spark.checkpoint.dir``; a temporary one only for an unset local session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        root = _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(frame: DataFrame, rows_together: int | None = None) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: computed once, safe against lost executors.

    ``rows_together`` bounds a row group. A writer holds the whole group, though it asks for its size only after a
    hundred rows, and a reader decodes all its lists at once: rows of many MB need groups of one. So small a group
    gains nothing by dictionaries; zstd makes it smaller than both do.
    """
    folder = shared_folder(frame.sparkSession)
    writer = frame.write
    if rows_together is not None:
        writer = writer.option("parquet.block.row.count.limit", rows_together)
        writer = writer.option("parquet.enable.dictionary", "false").option("compression", "zstd")
    writer.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def cut(frame: DataFrame) -> DataFrame:
    """A reliable checkpoint; Spark removes its files once the frame is gone."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint(eager=True)


#: Rows and bytes of text that Python workers take at once.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
_ROWS_BY_DEFAULT = "10000"


def bound_batches(spark: SparkSession) -> None:
    """Have texts passed to Python in batches of bounded size, unless the session says otherwise.

    The default of 10,000 rows means tens of MB of text per batch and several times that in a worker.
    """
    rows, size = BATCH
    if spark.conf.get(rows, _ROWS_BY_DEFAULT) == _ROWS_BY_DEFAULT:
        for name in (rows, size):
            spark.conf.set(name, BATCH[name])
