"""Small stored inputs: conservation reference, species targets, boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occspark.functions.text import clean_text, safe_key
from occspark.operators.areas import boundary_table, published_columns
from occspark.operators.conservation import clean_reference

# The filter column, and the name it has in older target lists.
_FACETS = ("facet_fq", "ala_facet_fq")


def read_conservation_reference(spark: SparkSession, path: str) -> DataFrame:
    """The reference CSV as clean text, with ``row_order`` for first-wins matching."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    # File order: files by name; a multi-line CSV file is read by one task, and ids rise within it.
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
    return clean_reference(raw.withColumn("row_order", place))


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of species targets, coerced and checked.

    Filters may be a list, or one text joined by `` | ``. Raises when the list is
    empty, a name is missing, or keys repeat.
    """
    raw = spark.read.option("multiLine", True).json(path)
    if "scientific_name" not in raw.columns:
        raise ValueError("The target list is empty or has no scientific_name.")
    return check_targets(coerce_targets(raw))


def coerce_targets(raw: DataFrame) -> DataFrame:
    present = set(raw.columns)

    def text(*names: str) -> Column:
        found = [clean_text(n) for n in names if n in present]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    filters = F.array().cast("array<string>")
    facets = next((c for c in _FACETS if c in present), None)
    if facets:
        given = F.col(facets)
        if raw.schema[facets].dataType.typeName() != "array":
            given = F.split(given.cast("string"), r" \| ")
        cleaned = F.filter(F.transform(given, clean_text), lambda x: x.isNotNull())
        filters = F.coalesce(cleaned, filters)
    suspect = F.col("target_match_suspect") if "target_match_suspect" in present else F.lit(False)
    name = text("scientific_name")
    return raw.select(
        F.coalesce(text("key"), F.nullif(safe_key(name), F.lit(""))).alias("key"),
        name.alias("scientific_name"),
        text("common_name").alias("common_name"),
        text("taxon_lsid").alias("taxon_lsid"),
        text("class", "taxon_class").alias("source_class"),
        text("order").alias("source_order"),
        text("family").alias("source_family"),
        filters.alias("facet_fq_filters"),
        F.coalesce(suspect.cast("boolean"), F.lit(False)).alias("target_match_suspect"),
    )


def check_targets(targets: DataFrame) -> DataFrame:
    """Raise on an empty list, a missing name or key, or repeated keys."""
    invalid = F.col("scientific_name").isNull() | F.col("key").isNull()
    counts = targets.agg(F.count(F.lit(1)).alias("n"), F.count_if(invalid).alias("invalid")).first()
    if counts["n"] == 0:
        raise ValueError("The target list is empty.")
    if counts["invalid"]:
        raise ValueError(f"{counts['invalid']} targets lack a scientific_name or key.")
    repeated = repeated_targets(targets)
    count = repeated.count()
    if count:
        # An error message names a few; ``repeated_targets`` returns all of them.
        names = [r["key"] for r in repeated.orderBy("key").limit(20).collect()]
        raise ValueError(f"Duplicate species target keys ({count} in all): " + ", ".join(names))
    return targets


def repeated_targets(targets: DataFrame) -> DataFrame:
    """(key, count) of every key that is listed more than once."""
    return targets.groupBy("key").count().where("count > 1")


def query_columns(targets: DataFrame) -> DataFrame:
    """A target's values under the query column names of the occurrence table."""
    return targets.select(
        F.col("key").alias("query_species_key"),
        F.col("scientific_name").alias("query_scientific_name"),
        F.col("common_name").alias("query_common_name"),
        F.col("taxon_lsid").alias("query_taxon_lsid"),
        "target_match_suspect",
    )


def read_boundaries(spark: SparkSession, path: str, level: str) -> DataFrame:
    """Boundaries of one level from newline-delimited GeoJSON features."""
    feature = F.from_json(
        "value", "struct<type string, geometry string, properties map<string,string>>"
    )
    features = spark.read.text(path).select(feature.alias("f")).where(F.col("f.type") == "Feature")
    properties = F.col("f.properties")
    wanted = [*published_columns(level).items()]
    columns = [
        F.coalesce(
            F.try_element_at(properties, F.lit(given)), F.try_element_at(properties, F.lit(own))
        ).alias(own)
        for own, given in wanted
    ]
    return boundary_table(
        features.select(*columns, F.col("f.geometry").alias("geometry_geojson")), level
    )
