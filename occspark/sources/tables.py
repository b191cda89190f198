"""Parquet sources and all sinks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occspark.functions.text import safe_key
from occspark.schema import OCCURRENCE_SCHEMA, empty_table

# Stored-table settings, and folders that hold no family tables.
COMPRESSION = "zstd"
COMPRESSION_LEVEL = 3
ROW_GROUP_ROWS = 100_000
SKIPPED_FOLDERS = (".scratch", "species", "quality_reports")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does a path exist on whatever file system it names?"""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = file_system.globStatus(hadoop_path)
    return matches is not None and len(matches) > 0


def read_shards(
    spark: SparkSession, folder: str, schema: T.StructType = OCCURRENCE_SCHEMA
) -> DataFrame:
    """All shards of a folder under the fixed schema."""
    return spark.read.schema(schema).parquet(folder)


def read_files(
    spark: SparkSession, paths: Iterable[str], schema: T.StructType = OCCURRENCE_SCHEMA
) -> DataFrame:
    """A list of tables, absent ones skipped; none at all gives an empty table."""
    present = [p for p in paths if path_exists(spark, p)]
    return spark.read.schema(schema).parquet(*present) if present else empty_table(spark, schema)


def read_by_name(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """S3: tables with differing columns, matched by name."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """One table as it is."""
    return spark.read.parquet(path)


def with_source_file(df: DataFrame) -> DataFrame:
    """The file each row came from, for per-file counts."""
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_family_tables(
    spark: SparkSession,
    root: str,
    taxon_class: str | None = None,
    order: str | None = None,
    family: str | None = None,
) -> DataFrame:
    """All family tables under ``root/class/order/family/family.parquet`` in one scan.

    The path yields the three key columns. Tables of other shapes and of work folders
    are left out by a condition on the path, so no listing happens on the driver
    beyond Spark's own.
    """
    rows = (
        spark.read.option("mergeSchema", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(root)
    )
    anchor = root.rstrip("/").rsplit("/", 1)[-1]
    path = F.substring_index(F.col("_metadata.file_path"), f"/{anchor}/", -1)
    # A family table is one file, or a folder of part files under that name.
    parts = F.split(F.regexp_replace(path, r"\.parquet/.*\z", ".parquet"), "/")
    keyed = rows.withColumn("_parts", parts)
    keys = {
        "class_key": F.get("_parts", F.lit(0)),
        "order_key": F.get("_parts", F.lit(1)),
        "family_key": F.get("_parts", F.lit(2)),
    }
    keyed = keyed.withColumns(keys)
    is_family = (F.size("_parts") == 4) & (
        F.get("_parts", F.lit(3)) == F.concat("family_key", F.lit(".parquet"))
    )
    skipped = F.arrays_overlap("_parts", F.array(*[F.lit(f) for f in SKIPPED_FOLDERS]))
    keyed = keyed.where(is_family & ~skipped)
    for column, wanted in (("class_key", taxon_class), ("order_key", order), ("family_key", family)):
        if wanted:
            keyed = keyed.where(F.col(column) == safe_key(F.lit(wanted)))
    return keyed.drop("_parts")


def check_inputs(spark: SparkSession, paths: Iterable[str]) -> None:
    """Name every missing input at once."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError("Missing inputs: " + ", ".join(missing))


def check_outputs(spark: SparkSession, paths: Iterable[str], overwrite: bool) -> None:
    """Refuse to replace any output unless asked to."""
    present = [p for p in paths if path_exists(spark, p)]
    if present and not overwrite:
        raise FileExistsError("Outputs exist already: " + ", ".join(present))


def write_table(
    df: DataFrame,
    path: str,
    overwrite: bool = False,
    partition_by: Sequence[str] = (),
    row_group_rows: int = ROW_GROUP_ROWS,
) -> None:
    """Zstd Parquet with bounded row groups."""
    writer = (
        df.write.mode("overwrite" if overwrite else "errorifexists")
        .option("compression", COMPRESSION)
        .option("parquet.compression.codec.zstd.level", COMPRESSION_LEVEL)
        .option("parquet.block.row.count.limit", row_group_rows)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, overwrite: bool = False, compression: str = "none") -> None:
    """Comma-separated text with a header, written by all tasks."""
    mode = "overwrite" if overwrite else "errorifexists"
    writer = df.write.mode(mode).option("header", True).option("nullValue", "")
    # The level of gzip files: four fifths of the usual saving at a fifth of its time.
    writer.option("zlib.compress.level", "BEST_SPEED").csv(path, compression=compression)


def write_json(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """One JSON object per row, nulls kept."""
    mode = "overwrite" if overwrite else "errorifexists"
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def publish_view(df: DataFrame, name: str) -> None:
    """S13 for a session: a named view."""
    df.createOrReplaceTempView(name)


def publish_table(df: DataFrame, name: str) -> None:
    """S13 across sessions: a table of the session's catalog."""
    df.write.mode("overwrite").saveAsTable(name)


def write_features(features: DataFrame, path: str, overwrite: bool = False) -> None:
    """Newline-delimited GeoJSON features."""
    features.write.mode("overwrite" if overwrite else "errorifexists").text(path)
