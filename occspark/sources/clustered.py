"""A stored cube whose slices read only the files that can have their rows.

Rows are range partitioned and sorted by family, genus and cell, so a file holds few families and
genera and a compact piece of the map. Beside the rows lies an inventory: which values of every
dimension each file has. A selection is first looked up there; what it reads of the cube are the
files that have a value of every included dimension and a year in range, and inside them the row
groups that Parquet's own bounds leave. The full predicate is applied to the rows read, so a file
too many costs time and nothing else. Options without a selection come from the inventory alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occspark.operators.slicer import OPTION_COLUMNS, SlicerState, option_values, predicate
from occspark.sources import tables

CLUSTERED_BY = ("family", "genus", "lat_bin", "lon_bin")
LISTED = ("family", "genus", "species", "stateProvince", "year", "Status", "state_status_level")


def write_clustered(cube: DataFrame, path: str, files: int | None = None, overwrite: bool = False) -> None:
    """Store a cube and its inventory; ``files`` is left to the shuffle partitions unless given."""
    spark = cube.sparkSession
    keys = [F.col(c).asc_nulls_last() for c in CLUSTERED_BY if c in cube.columns]
    dealt = cube.repartitionByRange(files, *keys) if files else cube.repartitionByRange(*keys)
    tables.write_table(dealt.sortWithinPartitions(*keys), f"{path}/rows", overwrite)
    stored = tables.read_table(spark, f"{path}/rows")
    listed = [c for c in LISTED if c in stored.columns]
    texts = stored.select(F.col("_metadata.file_path").alias("file"), *[F.col(c).cast("string") for c in listed])
    inventory = texts.unpivot(["file"], listed, "dimension", "value").distinct()
    tables.write_table(inventory.sort("dimension", "value"), f"{path}/inventory", overwrite)


def _wanted(state: SlicerState) -> dict[str, object]:
    """A condition on the inventory's values for every dimension that the state narrows down by inclusion."""
    wanted = {}
    for dimension in ("family", "genus", "species", "stateProvince"):
        included, _ = state.lists(dimension)
        if included:
            wanted[dimension] = F.col("value").isin(*included)
    if state.status_column:
        wanted[state.status_column] = F.col("value").isin(*state.include_conservation_statuses)
    year = F.col("value").cast("long")
    bounds = [year >= int(state.year_min)] if state.year_min is not None else []
    bounds += [year <= int(state.year_max)] if state.year_max is not None else []
    if bounds:
        wanted["year"] = reduce(lambda a, b: a & b, bounds)
    return wanted


def files_of(spark: SparkSession, path: str, state: SlicerState) -> list[str]:
    """The files that can have rows of a selection; one name per stored file at most comes to the driver."""
    inventory = tables.read_table(spark, f"{path}/inventory")
    wanted = _wanted(state)
    if not wanted:
        return [r[0] for r in inventory.select("file").distinct().collect()]
    met = reduce(
        lambda a, b: a | b, ((F.col("dimension") == d) & condition for d, condition in wanted.items())
    )
    per_file = inventory.where(met).groupBy("file").agg(F.count_distinct("dimension").alias("met"))
    return [r[0] for r in per_file.where(F.col("met") == len(wanted)).collect()]


def read_slice(spark: SparkSession, path: str, state: SlicerState) -> DataFrame:
    """The cube's rows of a selection, from the files that can have them."""
    whole = tables.read_table(spark, f"{path}/rows")
    files = files_of(spark, path, state)
    rows = spark.read.schema(whole.schema).parquet(*files) if files else whole.where(F.lit(False))
    return rows.where(predicate(state))


def stored_options(spark: SparkSession, path: str, state: SlicerState) -> DataFrame:
    """A26 over a stored cube: option values under a selection, without one from the inventory alone."""
    if state != SlicerState():
        return option_values(read_slice(spark, path, state), state)
    names = {c: o for o, c in OPTION_COLUMNS.items()}
    named = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    inventory = tables.read_table(spark, f"{path}/inventory").where("value IS NOT NULL")
    listed = inventory.select(named[F.col("dimension")].alias("option"), "value").where("option IS NOT NULL")
    return listed.distinct().orderBy("option", "value")
