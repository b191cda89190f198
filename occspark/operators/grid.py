"""Rounded-coordinate grid cube and dimension inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.functions.keys import round_coordinate
from occspark.schema import (
    CUBE_CONSERVATION_FIELDS,
    DEFAULT_GRID_DECIMALS,
    SINCE_YEAR,
    ensure_columns,
)

TAXON_DIMENSIONS = ("family", "genus", "species", "scientificName")
CUBE_DIMENSIONS = (*TAXON_DIMENSIONS, "year", "stateProvince")
CUBE_SOURCE_COLUMNS = {
    **{c: "string" for c in (*TAXON_DIMENSIONS, "taxonConceptID", "stateProvince")},
    "year": "long",
}

# The columns the dashboards list values of, under their output names.
INVENTORY = {
    "family_values": "family",
    "genus_values": "genus",
    "species_values": "species",
    "scientific_name_values": "scientificName",
    "state_values": "stateProvince",
    "status_values": "Status",
    "state_status_values": "state_status",
    "state_status_level_values": "state_status_level",
    "year_values": "year",
}


def mapped_rows(df: DataFrame) -> DataFrame:
    """Rows with both coordinates."""
    return df.where(F.col("decimalLatitude").isNotNull() & F.col("decimalLongitude").isNotNull())


def since(df: DataFrame, year: int = SINCE_YEAR) -> DataFrame:
    """Rows of a year or later; an unknown year is left out."""
    return df.where(F.col("year") >= year)


def with_cube_columns(df: DataFrame) -> DataFrame:
    """P5: every column a cube groups by, conservation columns as text."""
    full = ensure_columns(df, {**CUBE_SOURCE_COLUMNS, **{c: "string" for c in CUBE_CONSERVATION_FIELDS}})
    return full.withColumns({c: F.col(c).cast("string") for c in CUBE_CONSERVATION_FIELDS})


def aggregate_cube(
    df: DataFrame, place: Sequence[Column | str], count_null: bool, order: Sequence[str] = ()
) -> DataFrame:
    """Group by place and all dimensions.

    The name and the year are dimensions themselves, so their distinct count, minimum
    and maximum inside a group are known without aggregating. Only the taxon concepts
    need counting: per (group, concept) first, then per group. ``count_null`` tells
    whether a null counts as a value. With ``order``, groups meet in the range partitions of these places
    and of all dimensions, so ``cube_order`` by them shuffles nothing more. A dimension that ``df`` lacks
    is null in the cube and no key of its groups.
    """
    every = (*CUBE_DIMENSIONS, *CUBE_CONSERVATION_FIELDS)
    absent = {c: F.lit(None).cast(CUBE_SOURCE_COLUMNS.get(c, "string")) for c in every if c not in df.columns}
    dims = [c for c in every if c not in absent]
    places = [p if isinstance(p, Column) else F.col(p) for p in place]
    named = df.select(*places, *dims, "taxonConceptID", *(["_n"] if "_n" in df.columns else []))
    names = [c for c in named.columns if c not in ("taxonConceptID", "_n")]
    n = F.sum("_n") if "_n" in df.columns else F.count(F.lit(1))
    concepts = named.groupBy(*names, "taxonConceptID").agg(n.alias("_rows"))
    if order:
        concepts = concepts.repartitionByRange(*_stored_order([*order, *dims]))
    known = F.count("taxonConceptID")
    if count_null:
        distinct_concepts = known + F.max(F.col("taxonConceptID").isNull().cast("int"))
        distinct_names = F.lit(1)
    else:
        distinct_concepts = known
        distinct_names = F.when(F.col("scientificName").isNotNull(), 1).otherwise(0)
    return (
        concepts.groupBy(*names)
        .agg(F.sum("_rows").alias("record_count"), distinct_concepts.alias("distinct_taxon_concepts"))
        .withColumns(absent)
        .select(
            *[c for c in names if c not in dims],
            *every,
            "record_count",
            distinct_names.cast("long").alias("distinct_scientific_names"),
            F.col("distinct_taxon_concepts").cast("long").alias("distinct_taxon_concepts"),
            F.col("year").alias("min_year"),
            F.col("year").alias("max_year"),
        )
    )


def grid_cube(df: DataFrame, decimals: int = DEFAULT_GRID_DECIMALS, ordered: bool = False) -> DataFrame:
    """A1: records per rounded coordinate and dimension; half-way cases round to even.

    ``ordered`` prepares the cube for ``cube_order``.
    """
    place = [
        round_coordinate("decimalLatitude", decimals, half_even=True).alias("lat_bin"),
        round_coordinate("decimalLongitude", decimals, half_even=True).alias("lon_bin"),
    ]
    absent = [c for c in (*CUBE_DIMENSIONS, *CUBE_CONSERVATION_FIELDS) if c not in df.columns]
    rows = mapped_rows(with_cube_columns(df)).drop(*absent)
    return aggregate_cube(rows, place, count_null=True, order=CUBE_PLACE if ordered else ())


CUBE_PLACE = ("lat_bin", "lon_bin")
#: O1: the stored order of a grid cube, nulls last.
CUBE_ORDER = (*CUBE_PLACE, *CUBE_DIMENSIONS, *CUBE_CONSERVATION_FIELDS)


def _stored_order(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def cube_order(cube: DataFrame, place: Sequence[str] = CUBE_PLACE) -> DataFrame:
    """O1: cube rows in their stored order, nulls last (a range-partitioned sort)."""
    return cube.orderBy(*_stored_order([*place, *CUBE_DIMENSIONS, *CUBE_CONSERVATION_FIELDS]))


def rebin(cube: DataFrame, decimals: int | None) -> DataFrame:
    """A3: the cube at a coarser precision. Distinct measures are added up, as bins are."""
    if decimals is None:
        return cube
    full = ensure_columns(cube, CUBE_CONSERVATION_FIELDS)
    place = [
        round_coordinate(c, max(int(decimals), 0)).alias(c) for c in ("lat_bin", "lon_bin")
    ]
    return full.groupBy(*place, *CUBE_DIMENSIONS, *CUBE_CONSERVATION_FIELDS).agg(
        *[
            F.sum(c).alias(c)
            for c in ("record_count", "distinct_scientific_names", "distinct_taxon_concepts")
        ],
        F.min("min_year").alias("min_year"),
        F.max("max_year").alias("max_year"),
    )


def dimension_values(df: DataFrame, inventory: dict[str, str] = INVENTORY) -> DataFrame:
    """The distinct non-null values of every dimension, one row per value.

    Rows and not arrays: a dimension may have millions of values, and one row per
    value is combined on the map side and never gathered in one place.
    """
    present = {label: c for label, c in inventory.items() if c in df.columns}
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("dimension"), F.col(c).cast("string").alias("value"))
            for label, c in present.items()
        ]
    )
    return (
        df.select(*set(present.values()))
        .select(F.explode(pairs).alias("p"))
        .select("p.dimension", "p.value")
        .where(F.col("value").isNotNull())
        .distinct()
    )


def dimension_bounds(df: DataFrame) -> DataFrame:
    """Rows, mapped rows and the year bounds, from one scan."""
    mapped = F.col("decimalLatitude").isNotNull() & F.col("decimalLongitude").isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(mapped).alias("mapped_row_count"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
    )


def source_counts(df: DataFrame, year: int = SINCE_YEAR) -> DataFrame:
    """All rows, rows since a year, and those of them with coordinates."""
    recent = F.col("year") >= year
    mapped = F.col("decimalLatitude").isNotNull() & F.col("decimalLongitude").isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("source_row_count"),
        F.count_if(recent).alias("since_year_row_count"),
        F.count_if(recent & mapped).alias("coordinate_row_count"),
    )
