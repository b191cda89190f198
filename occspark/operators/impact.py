"""What a second source would add to the existing table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.functions.keys import match_key
from occspark.operators.membership import anti_join, prefiltered, semi_join
from occspark.schema import BUTTERFLY_FAMILIES, ensure_columns

_SOURCE_KEY_COLUMNS = {
    "scientific_name": "string",
    "event_date_start": "string",
    "decimal_latitude": "double",
    "decimal_longitude": "double",
}
_BASE_KEY_COLUMNS = {
    "scientificName": "string",
    "eventDate_iso": "string",
    "decimalLatitude": "double",
    "decimalLongitude": "double",
}


def in_families(df: DataFrame, families: Sequence[str], column: str = "family") -> DataFrame:
    """Rows of the listed families; no list, or no such column, keeps every row."""
    if not families or column not in df.columns:
        return df
    return df.where(F.col(column).isin(*families))


def source_keys(source: DataFrame) -> DataFrame:
    """F14 for a canonical table. The day is used as it stands there."""
    full = ensure_columns(source, _SOURCE_KEY_COLUMNS)
    return full.withColumn("match_key", _key(_SOURCE_KEY_COLUMNS))


def base_keys(base: DataFrame) -> DataFrame:
    """F14 for an occurrence table."""
    full = ensure_columns(base, _BASE_KEY_COLUMNS)
    return full.withColumn("match_key", _key(_BASE_KEY_COLUMNS))


def _key(columns: dict[str, str]) -> Column:
    name, date, latitude, longitude = columns
    return match_key(name, date, latitude, longitude)


def candidate_duplicates(source: DataFrame, base: DataFrame) -> DataFrame:
    """Source rows whose key exists in the base table."""
    return semi_join(source_keys(source), base_keys(base), "match_key").select(*source.columns)


def candidate_new(source: DataFrame, base: DataFrame) -> DataFrame:
    """Source rows whose key does not."""
    return anti_join(source_keys(source), base_keys(base), "match_key").select(*source.columns)


def value_totals(df: DataFrame, column: str = "family") -> DataFrame:
    """Rows per value, nulls dropped, sorted by value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(column)
    )


def impact_summary(
    source: DataFrame,
    base: DataFrame | None,
    families: Sequence[str] = BUTTERFLY_FAMILIES,
    base_found: bool = True,
    base_error: str | None = None,
) -> DataFrame:
    """One row of counts; ``base=None`` stands for an absent or unreadable table.

    The source is counted per key. Of the base only rows whose key the source may have are
    shuffled (``prefiltered``), and only as keys; its rows are counted where they are. A source
    without a ``family`` column has no keys, as its families cannot be checked: its rows count, none
    is a duplicate.
    """
    rows = in_families(source, families)
    per_key = source_keys(rows).groupBy("match_key").agg(F.count(F.lit(1)).alias("source_n"))
    considered = None if base is None else in_families(base, families)
    if considered is None or (families and "family" not in source.columns):
        met = per_key.withColumn("known", F.lit(False))
    else:
        known = prefiltered(base_keys(considered).select("match_key"), per_key, "match_key").distinct()
        met = per_key.join(known.withColumn("known", F.lit(True)), ["match_key"], "left")
    totals = met.agg(
        F.coalesce(F.sum("source_n"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("source_n"))), F.lit(0)).alias("candidate_duplicate_rows"),
    )
    if considered is None:
        totals = totals.withColumn("existing_rows_considered", F.lit(0).cast("long"))
    else:
        # One row each: two counts stacked and added, so that neither table waits for a join.
        counted = considered.agg(F.count(F.lit(1)).alias("existing_rows_considered"))
        names = ["source_rows", "candidate_duplicate_rows", "existing_rows_considered"]
        stacked = totals.unionByName(counted, allowMissingColumns=True)
        totals = stacked.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    fresh = F.col("source_rows") - F.col("candidate_duplicate_rows")
    ratio = F.when(
        F.col("source_rows") > 0,
        F.round(F.col("candidate_duplicate_rows") / F.col("source_rows"), 6),
    ).otherwise(F.lit(0.0))
    return totals.select(
        F.lit(base_found).alias("base_table_found"),
        F.lit(base is not None).alias("base_table_readable"),
        F.lit(base_error).cast("string").alias("base_read_error"),
        "existing_rows_considered",
        "source_rows",
        "candidate_duplicate_rows",
        fresh.alias("candidate_new_rows"),
        ratio.alias("candidate_duplicate_ratio"),
        (F.col("existing_rows_considered") + F.col("source_rows")).alias(
            "expected_rows_without_dedupe"
        ),
        (F.col("existing_rows_considered") + fresh).alias("expected_rows_after_dedupe"),
    )


def impact_family_counts(
    source: DataFrame, base: DataFrame | None, families: Sequence[str] = BUTTERFLY_FAMILIES
) -> DataFrame:
    """Rows per family on both sides, one row per side and family."""
    sides = [("source", source)] + ([("base", base)] if base is not None else [])
    parts = [
        value_totals(in_families(df, families)).select(F.lit(side).alias("side"), "family", "count")
        for side, df in sides
        if "family" in df.columns
    ]
    if not parts:
        return source.sparkSession.createDataFrame([], "side string, family string, count long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
