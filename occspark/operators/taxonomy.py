"""Completion of genus and species, and name facets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.functions.text import is_probable_scientific_name, is_valid_facet_label, safe_key
from occspark.schema import ensure_columns
from occspark.operators.skew import lookup_join, reference_join, top_n

# Ranks an authority may fill from, and its acceptance rule.
SPECIES_RANKS = ("species", "subspecies")
ACCEPTED_STATUSES = ("ACCEPTED", "SYNONYM")
MIN_CONFIDENCE = 90

MISSING_REPORT_COLUMNS = (
    "uuid scientificName taxonRank genus species family taxonConceptID month year"
).split()


def missing_taxonomy() -> Column:
    return F.col("genus").isNull() | F.col("species").isNull()


def missing_taxonomy_rows(df: DataFrame) -> DataFrame:
    """P20: rows still lacking genus or species, report columns only."""
    available = [c for c in MISSING_REPORT_COLUMNS if c in df.columns]
    order = [F.col(c).asc_nulls_last() for c in ("scientificName", "uuid") if c in available]
    return df.where(missing_taxonomy()).select(*available).orderBy(*order)


def unresolved_names(df: DataFrame) -> DataFrame:
    """Their distinct names, sorted."""
    return (
        df.where(missing_taxonomy() & F.col("scientificName").isNotNull())
        .select("scientificName")
        .distinct()
        .orderBy("scientificName")
    )


def exact_lookup(df: DataFrame) -> DataFrame:
    """A4: names whose complete records agree on one genus and one species.

    Agreement is min = max, so no distinct sets are kept and the aggregate combines
    on the map side.
    """
    complete = F.col("scientificName").isNotNull() & ~missing_taxonomy()
    return (
        df.where(complete)
        .groupBy("scientificName")
        .agg(
            F.min("genus").alias("lookup_genus"),
            F.max("genus").alias("_genus_max"),
            F.min("species").alias("lookup_species"),
            F.max("species").alias("_species_max"),
        )
        .where(
            (F.col("lookup_genus") == F.col("_genus_max"))
            & (F.col("lookup_species") == F.col("_species_max"))
        )
        .select("scientificName", "lookup_genus", "lookup_species")
    )


def apply_exact_fills(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Fill null genus and species from unambiguous records of the same name."""
    lookup = exact_lookup(df) if lookup is None else lookup
    return _fill(lookup_join(df, lookup, ["scientificName"]), "lookup", df.columns)


def accepted_authority(authority: DataFrame) -> DataFrame:
    """The authority rows that may fill: right rank, accepted, both names given.

    A name the authority lists more than once fills from its smallest pair.
    """
    accepted = (
        F.lower(F.trim("rank")).isin(*SPECIES_RANKS)
        & F.upper("status").isin(*ACCEPTED_STATUSES)
        & (F.col("confidence") >= MIN_CONFIDENCE)
        & (F.col("genus") != "")
        & (F.col("species") != "")
    )
    return (
        authority.where(accepted)
        .groupBy("scientificName")
        .agg(F.min(F.struct("genus", "species")).alias("pair"))
        .select(
            "scientificName",
            F.col("pair.genus").alias("authority_genus"),
            F.col("pair.species").alias("authority_species"),
        )
    )


def apply_authority_fills(df: DataFrame, authority: DataFrame) -> DataFrame:
    """Fill what is still missing from the authority table."""
    lookup = accepted_authority(authority)
    return _fill(lookup_join(df, lookup, ["scientificName"]), "authority", df.columns)


def authority_rejections(df: DataFrame, authority: DataFrame) -> DataFrame:
    """Unresolved names for which the authority has no acceptable row."""
    names = df.where(missing_taxonomy() & F.col("scientificName").isNotNull())
    names = names.select("scientificName").distinct()
    return names.join(accepted_authority(authority), ["scientificName"], "left_anti")


def fill_lookup(df: DataFrame, authority: DataFrame | None = None) -> DataFrame:
    """Both lookups as one table, one row per name."""
    lookup = exact_lookup(df)
    if authority is None:
        blank = F.lit(None).cast("string")
        return lookup.withColumns({"authority_genus": blank, "authority_species": blank})
    return lookup.join(accepted_authority(authority), ["scientificName"], "full_outer")


def complete_taxonomy(df: DataFrame, authority: DataFrame | None = None) -> DataFrame:
    """Both fills with one pass over the fact table: the two lookups are merged first."""
    return _fill_both(lookup_join(df, fill_lookup(df, authority), ["scientificName"]), df.columns)


def apply_fill_lookup(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Both fills from a stored lookup, broadcast when its measured size allows."""
    return _fill_both(reference_join(df, lookup, ["scientificName"]), df.columns)


def _fill_both(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    return joined.withColumns(
        {c: F.coalesce(c, f"lookup_{c}", f"authority_{c}") for c in ("genus", "species")}
    ).select(*columns)


def completion_counts(df: DataFrame, authority: DataFrame | None = None) -> DataFrame:
    """One row: rows missing at the start, filled exactly, filled by authority, left.

    Rows are first counted per (name, genus missing, species missing); the lookups
    are joined to those few counts, not to the fact table.
    """
    state = df.groupBy(
        "scientificName",
        F.col("genus").isNull().alias("no_genus"),
        F.col("species").isNull().alias("no_species"),
    ).agg(F.count(F.lit(1)).alias("n"))
    joined = state.join(exact_lookup(df), ["scientificName"], "left")
    if authority is None:
        joined = joined.withColumn("authority_genus", F.lit(None).cast("string"))
    else:
        joined = joined.join(accepted_authority(authority), ["scientificName"], "left")
    start = F.col("no_genus") | F.col("no_species")
    exact = start & F.col("lookup_genus").isNotNull()
    by_authority = start & ~exact & F.col("authority_genus").isNotNull()
    rejected = start & ~exact & F.col("authority_genus").isNull()
    rejected = rejected & F.col("scientificName").isNotNull() & F.lit(authority is not None)

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input_rows"),
        rows(start).alias("initial_missing_rows"),
        rows(exact).alias("exact_fill_rows"),
        rows(by_authority).alias("authority_fill_rows"),
        rows(start & ~exact & ~by_authority).alias("remaining_missing_rows"),
        F.count_distinct(F.when(rejected, F.col("scientificName"))).alias("rejected_lookup_count"),
    )


def _fill(joined: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"{prefix}_{c}")) for c in ("genus", "species")}
    ).select(*columns)


def month_counts(df: DataFrame) -> DataFrame:
    """Rows per month, null last."""
    counts = df.groupBy("month").agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.col("month").asc_nulls_last())


def facet_counts(
    df: DataFrame, field: str, offset: int = 0, limit: int | None = None
) -> DataFrame:
    """Label, count and filter text of a field's values.

    One page of them, most frequent first; without ``limit`` all of them, unordered.
    """
    label = F.col(field).cast("string")
    counts = (
        df.where(F.col(field).isNotNull())
        .groupBy(label.alias("label"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("fq", filter_text(field, F.col("label")))
    )
    if limit is None:
        return counts
    page = counts.orderBy(F.col("count").desc(), F.col("label"))
    return page.offset(offset).limit(limit) if offset else page.limit(limit)


def filter_text(field: str, value: Column) -> Column:
    """``field:"value"`` with quotes escaped."""
    escaped = F.replace(value, F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit(f'{field}:"'), escaped, F.lit('"'))


def distinct_labels(facets: DataFrame) -> DataFrame:
    """Valid labels, the first one (by count) for each key."""
    valid = facets.where((F.col("count") > 0) & is_valid_facet_label("label"))
    keyed = valid.withColumn("key", safe_key("label")).where(F.col("key") != "")
    first = top_n(keyed, ["key"], [F.col("count").desc(), F.col("label")], 1)
    return first.select("label", "count", "key")


def discover_orders(df: DataFrame, taxon_class: str, class_column: str = "classs") -> DataFrame:
    """The orders of a class."""
    return distinct_labels(facet_counts(df.where(F.col(class_column) == taxon_class), "order", limit=None))


def discover_families(
    df: DataFrame, taxon_class: str, order: str, class_column: str = "classs"
) -> DataFrame:
    """The families of an order."""
    rows = df.where((F.col(class_column) == taxon_class) & (F.col("order") == order))
    return distinct_labels(facet_counts(rows, "family", limit=None))


def name_facets(
    df: DataFrame, fields: Sequence[str] = ("species", "subspecies"), strict: bool = True
) -> DataFrame:
    """X9 input: name facets of each field within class, order and family, from one scan."""
    place = ["class", "order", "family"]
    df = ensure_columns(df, {"classs": "string"}).withColumn("class", F.col("classs"))
    present = [f for f in fields if f in df.columns]
    pairs = F.array(
        *[F.struct(F.lit(f).alias("facet_field"), F.col(f).alias("scientific_name")) for f in present]
    )
    return (
        df.select(*place, F.explode(pairs).alias("p"))
        .select(*place, "p.*")
        .where(F.col("scientific_name").isNotNull())
        .groupBy(*place, "facet_field", "scientific_name")
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
        .where(is_probable_scientific_name("scientific_name", strict=strict))
        .withColumn(
            "facet_fq",
            F.concat(
                F.col("facet_field"),
                F.lit(':"'),
                F.replace("scientific_name", F.lit('"'), F.lit('\\"')),
                F.lit('"'),
            ),
        )
    )


def merge_taxa(facets: DataFrame, by_family: bool = False) -> DataFrame:
    """A5: one row per name; sorted sets joined by `` | ``, counts added up.

    ``by_family`` is the family-scoped variant, where class, order and family are plain
    values of the name and not sets.
    """
    facets = ensure_columns(facets, {"class": "string"})

    def joined(c: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit("")))), " | ")

    key = safe_key("scientific_name")
    sets = [joined("facet_field"), joined("facet_fq")]
    total = F.sum("occurrence_count").alias("occurrence_count")
    if by_family:
        place = [F.min(F.struct("order", "family", "class")).alias("_place")]
        grouped = facets.groupBy("scientific_name").agg(
            *place, sets[0].alias("facet_fields"), total, sets[1].alias("facet_fq")
        )
        return grouped.select(
            key.alias("key"),
            "scientific_name",
            F.col("_place.class").alias("class"),
            F.col("_place.order").alias("order"),
            F.col("_place.family").alias("family"),
            "facet_fields",
            "occurrence_count",
            "facet_fq",
        ).orderBy("family", "scientific_name", "key")
    grouped = facets.groupBy("scientific_name").agg(
        joined("order").alias("order"),
        joined("family").alias("family"),
        sets[0].alias("facet_fields"),
        total,
        sets[1].alias("facet_fq"),
    )
    return grouped.select(key.alias("species_key"), *grouped.columns).orderBy(
        "order", "scientific_name", "species_key"
    )
