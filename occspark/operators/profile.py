"""Data-quality profile of a table, or of every group of a table.

Everything that needs distinct values comes from one value-count table: the rows
``(column, value, n)`` of all columns, built by one ``unpivot`` and one aggregate
that combines on the map side. A wide ``count(DISTINCT ...)`` over 42 columns would
copy each row 42 times as well, but could not yield the top values from the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occspark.operators.skew import lookup_join, reference_join, top_n
from occspark.session import cut_lineage, stored_once

TOP_VALUES = 10
HIGH_NULL_PERCENT = 90.0
#: Hash buckets of a column's values, and how many times as many buckets as values are looked at first.
BUCKETS, LARGEST = 4_096, 4
SPECIES_COLUMNS = ("scientificName", "species", "query_scientific_name")


@dataclass(frozen=True)
class QualityProfile:
    summary: DataFrame
    column_profile: DataFrame
    top_values: DataFrame
    species_counts: DataFrame


def value_counts(df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] = ()) -> DataFrame:
    """How often each value of each column occurs, values as text, null included."""
    chosen = list(columns) or [c for c in df.columns if c not in keys]
    texts = df.select(*keys, *[F.col(f"`{c}`").cast("string").alias(c) for c in chosen])
    return (
        texts.unpivot(list(keys), [F.col(f"`{c}`") for c in chosen], "column", "value")
        .groupBy(*keys, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def column_basics(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A10: rows, nulls and distinct values (null counts as one) of every column."""
    return counts.groupBy(*keys, "column").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count(F.lit(1)).alias("distinct_count"),
    )


def column_profile(
    df: DataFrame, counts: DataFrame | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Null share and flags of every column; an empty table still lists its columns."""
    counts = value_counts(df, keys) if counts is None else counts
    basics = column_basics(counts, keys)
    types = [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name not in keys]
    listed = df.sparkSession.createDataFrame(types, "column string, dtype string")
    # One row per column of the schema, so this side is bounded by the table's width.
    joined = basics.join(F.broadcast(listed), ["column"], "inner" if keys else "right")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("row_count", "null_count", "distinct_count")}
    joined = joined.withColumns(zero)
    percent = F.when(
        F.col("row_count") > 0, F.col("null_count") / F.col("row_count") * 100.0
    ).otherwise(F.lit(0.0))
    any_rows = F.col("row_count") > 0
    flags = F.array_compact(
        F.array(
            F.when(any_rows & (F.col("null_count") == F.col("row_count")), F.lit("empty_column")),
            F.when(any_rows & (percent >= HIGH_NULL_PERCENT), F.lit("high_null")),
            F.when(any_rows & (F.col("distinct_count") <= 1), F.lit("single_value")),
        )
    )
    return joined.select(
        *keys,
        "column",
        "dtype",
        "null_count",
        F.round(percent, 4).alias("null_percent"),
        (F.col("row_count") - F.col("null_count")).alias("non_null_count"),
        "distinct_count",
        F.array_join(flags, "|").alias("flags"),
    )


def _bucketed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """A row per cell with its value as text and the hash bucket of the value; one pass over the table."""
    texts = df.select(*keys, *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    cells = texts.unpivot(list(keys), [F.col(f"`{c}`") for c in columns], "column", "value")
    return cells.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int"))


def _counted(cells: DataFrame, chosen: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts of the values in the chosen buckets, which are broadcast after a size check: the cells aren't shuffled."""
    met = reference_join(cells, chosen.select(*by), by, "left_semi")
    return met.groupBy(*[c for c in cells.columns if c not in ("value", "bucket")], "value").agg(F.count(F.lit(1)).alias("n"))


def leading_values(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], n: int, buckets: int = BUCKETS
) -> DataFrame:
    """Exact counts of values that include the ``n`` most frequent of every column; few others are counted.

    For a stored table: it is read up to three times, which a table that is yet to be joined would pay by as many joins.
    A value occurs at most as often as all values of its hash bucket together. After one pass for the
    buckets' totals, the values of each column's largest buckets are counted. Their n-th largest count
    is a bound: a bucket with a smaller total has none of the leading values. Buckets that reach the bound
    are counted as well, for the columns that have any; a column of mostly different values is then counted whole.
    """
    by = [*keys, "column"]
    cells = _bucketed(df, keys, columns, buckets)
    totals = cut_lineage(cells.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("total")))
    largest = cut_lineage(top_n(totals, by, [F.col("total").desc(), F.col("bucket")], LARGEST * n).drop("rank"))
    first = cut_lineage(_counted(cells, largest, [*by, "bucket"]))
    nth = top_n(first, by, [F.col("n").desc()], n).where(F.col("rank") == n).select(*by, F.col("n").alias("bound"))
    open_buckets = totals.join(largest.select(*by, "bucket"), [*by, "bucket"], "left_anti").join(nth, by, "left")
    rest = cut_lineage(open_buckets.where(F.col("total") >= F.coalesce("bound", F.lit(0))))
    left = [r[0] for r in rest.select("column").distinct().collect()]  # at most the table's width
    if not left:
        return first
    second = _counted(_bucketed(df, keys, left, buckets), rest, [*by, "bucket"])
    return first.unionByName(second)


def top_values(
    df: DataFrame,
    counts: DataFrame | None = None,
    keys: Sequence[str] = (),
    n: int = TOP_VALUES,
    max_categories: int | None = None,
) -> DataFrame:
    """The most frequent values of every text or boolean column.

    With ``max_categories`` only of columns with that many different values at most. Value counts that
    are there already (``counts``) are used; else the values are counted in one pass over the table.
    """
    categorical = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in keys
    ]
    if counts is not None:
        kept = counts.where(F.col("column").isin(*categorical))
    elif not categorical:
        kept = value_counts(df.limit(0).withColumn("none", F.lit("")), keys, ["none"])
    else:
        kept = value_counts(df, keys, categorical)
    order = [F.col("n").desc(), F.col("value").asc_nulls_last()]
    ranked = top_n(kept, [*keys, "column"], order, n)
    if max_categories is not None:
        # The rows are summed so that this branch keeps the counts, as the other does: Spark then shuffles them once.
        sizes = [F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows")]
        few = kept.groupBy(*keys, "column").agg(*sizes).where((F.col("rows") > 0) & (F.col("values") <= max_categories))
        ranked = lookup_join(ranked, few.select(*keys, "column"), [*keys, "column"], "left_semi")
    return ranked.select(*keys, "column", "rank", "value", F.col("n").alias("count"))


def species_counts(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per name, from the first name column the table has."""
    name = next((c for c in SPECIES_COLUMNS if c in df.columns), None)
    if name is None:
        schema = T.StructType([*[df.schema[k] for k in keys], *_NAME_COUNT.fields])
        return df.sparkSession.createDataFrame([], schema)
    return (
        df.where(F.col(name).isNotNull())
        .groupBy(*keys, F.col(name).alias("name"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(*keys, F.col("count").desc(), "name")
    )


_NAME_COUNT = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("count", T.LongType())]
)


def duplicate_ids(df: DataFrame, column: str = "uuid") -> DataFrame:
    """Identifiers beyond the first of each value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return counts.agg(surplus.alias("duplicate_uuid_count"))


def _outside(c: str, bound: int) -> Column:
    return F.count_if((F.col(c) < -bound) | (F.col(c) > bound))


def coordinate_issues(df: DataFrame) -> DataFrame:
    """Latitudes and longitudes out of range, counted separately and added."""
    return df.agg(
        (_outside("decimalLatitude", 90) + _outside("decimalLongitude", 180)).alias(
            "coordinate_issue_count"
        )
    )


def year_coverage(df: DataFrame) -> DataFrame:
    """First and last year, and how many different ones."""
    years = df.where(F.col("year").isNotNull()).select("year").distinct()
    return years.agg(
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
        F.count(F.lit(1)).alias("distinct_year_count"),
    )


def profile(df: DataFrame, keys: Sequence[str] = ()) -> QualityProfile:
    """The whole profile, per group of ``keys`` when given.

    Its tables are written by jobs of their own, so the value counts that three of them start from are stored.
    """
    counts = stored_once(value_counts(df, keys))
    columns = column_profile(df, counts, keys)
    has_places = {"decimalLatitude", "decimalLongitude"} <= set(df.columns)
    places = (
        _outside("decimalLatitude", 90) + _outside("decimalLongitude", 180)
        if has_places
        else F.lit(0)
    )
    direct = [F.count(F.lit(1)).alias("row_count"), places.alias("coordinate_issue_count")]
    if "year" in df.columns:
        direct += [F.min("year").alias("min_year"), F.max("year").alias("max_year")]
    scanned = df.groupBy(*keys).agg(*direct)

    name = next((c for c in SPECIES_COLUMNS if c in df.columns), None)
    known = F.col("value").isNotNull()

    def per_column(column: str | None, value: Column) -> Column:
        hit = known & (F.col("column") == F.lit(column))
        return F.coalesce(F.sum(F.when(hit, value)), F.lit(0))

    from_values = counts.groupBy(*keys).agg(
        per_column("uuid", F.col("n") - 1).alias("duplicate_uuid_count"),
        per_column(name, F.lit(1)).alias("species_count"),
        per_column("year", F.lit(1)).alias("distinct_year_count"),
    )
    flags = columns.groupBy(*keys).agg(
        F.collect_set(F.nullif(F.col("flags"), F.lit(""))).alias("column_flags")
    )
    width = len([c for c in df.columns if c not in keys])
    # The three parts share no column but the keys; stacking them and taking the one
    # non-null value of each column puts them side by side without a join.
    parts = scanned.unionByName(from_values, allowMissingColumns=True).unionByName(
        flags, allowMissingColumns=True
    )
    measures = [c for c in parts.columns if c not in keys]
    summary = parts.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])
    summary = summary.withColumns(
        {
            c: F.coalesce(c, F.lit(0))
            for c in ("duplicate_uuid_count", "species_count", "distinct_year_count")
        }
    ).withColumn("column_count", F.lit(width))
    if "year" not in df.columns:
        summary = summary.drop("distinct_year_count")
    found = F.transform("column_flags", lambda f: F.split(f, r"\|"))
    return QualityProfile(
        summary=summary.withColumn("quality_flags", quality_flags(F.flatten(found))).drop(
            "column_flags"
        ),
        column_profile=columns,
        top_values=top_values(df, counts, keys),
        species_counts=species_counts(df, keys),
    )


def quality_flags(column_flags: Column) -> Column:
    """The columns' flags and those of the table, sorted."""
    table = F.array_compact(
        F.array(
            F.when(F.col("duplicate_uuid_count") > 0, F.lit("duplicate_uuid")),
            F.when(F.col("coordinate_issue_count") > 0, F.lit("coordinate_range_issue")),
            F.when(F.col("species_count") == 0, F.lit("missing_species_counts")),
        )
    )
    return F.array_sort(F.array_union(column_flags, table))
