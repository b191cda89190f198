"""Fixed table layouts, fixed vocabularies, and schema-conforming projections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: names and order of the stored tables -----------------------

BASE_FIELDS = (
    "query_species_key query_scientific_name query_common_name query_taxon_lsid "
    "target_match_suspect uuid scientificName raw_scientificName vernacularName taxonRank "
    "taxonConceptID kingdom phylum classs order family genus species country stateProvince "
    "decimalLatitude decimalLongitude coordinateUncertaintyInMeters spatiallyValid "
    "geospatialKosher eventDate eventDate_iso year month day basisOfRecord raw_basisOfRecord "
    "dataProviderUid dataProviderName dataResourceUid dataResourceName license "
    "identificationVerificationStatus recordNumber assertions speciesGroups latLong"
).split()

USER_DATA_FIELDS = (
    "occurrenceID recordedBy collectors collector image images imageUrl largeImageUrl "
    "smallImageUrl thumbnailUrl imageUrls references occurrenceDetails"
).split()

QUERY_FIELDS = BASE_FIELDS[:5]
DOUBLE_FIELDS = {"decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters"}
LONG_FIELDS = {"eventDate", "year"}
BOOLEAN_FIELDS = {"target_match_suspect", "spatiallyValid"}

CANONICAL_FIELDS = (
    "source source_jurisdiction source_dataset source_record_id source_record_url "
    "source_updated_at ingested_at_utc occurrence_id catalog_number scientific_name "
    "vernacular_name taxon_rank kingdom class_name order family genus specific_epithet "
    "infraspecific_epithet country country_code state_province decimal_latitude "
    "decimal_longitude coordinate_uncertainty_m coordinate_precision geodetic_datum event_date "
    "event_date_start event_date_end year basis_of_record occurrence_status record_status "
    "individual_count observation_type establishment_means state_conservation "
    "country_conservation sensitive_record spatially_generalised data_generalizations "
    "information_withheld license rights_holder raw_source_payload raw_record_hash "
    "canonical_record_hash"
).split()
CANONICAL_DOUBLES = {
    "decimal_latitude",
    "decimal_longitude",
    "coordinate_uncertainty_m",
    "individual_count",
}
CANONICAL_LONGS = {"year"}
CANONICAL_BOOLEANS = {"sensitive_record", "spatially_generalised"}

CONSERVATION_REFERENCE_FIELDS = (
    "accepted_taxon match_names rank common_name epbc_status epbc_listed_id epbc_sprat_url "
    "epbc_conservation_advice_url epbc_recovery_plan_url epbc_protected_matters_url "
    "state_status state_status_jurisdiction state_source_url source_dataset source_date notes"
).split()

# The conservation columns that the grid and area cubes carry.
CUBE_CONSERVATION_FIELDS = (
    "Status state_status state_status_level state_status_for_occurrence "
    "state_status_jurisdiction_matched state_status_qualifier epbc_listed_taxon "
    "state_listed_taxon epbc_sprat_url epbc_conservation_advice_url epbc_recovery_plan_url "
    "epbc_protected_matters_url"
).split()

# --- Fixed values: vocabularies -----------------------------------------------

INVALID_TAXON_LABELS = (
    "not supplied",
    "not provided",
    "not recorded",
    "unknown",
    "unidentified",
    "other values",
)
INVALID_LEADING_WORDS = ("not", "unknown", "unidentified")

BUTTERFLY_FAMILIES = (
    "Hesperiidae",
    "Papilionidae",
    "Pieridae",
    "Nymphalidae",
    "Riodinidae",
    "Lycaenidae",
)

STATE_CODES = {
    "Australian Capital Territory": "ACT",
    "New South Wales": "NSW",
    "Northern Territory": "NT",
    "Queensland": "QLD",
    "South Australia": "SA",
    "Tasmania": "TAS",
    "Victoria": "VIC",
    "Western Australia": "WA",
    "ACT": "ACT",
    "NSW": "NSW",
    "NT": "NT",
    "QLD": "QLD",
    "SA": "SA",
    "TAS": "TAS",
    "VIC": "VIC",
    "WA": "WA",
}

# --- Fixed values: limits -------------------------------------------------------

SEARCH_WINDOW = 5_000
PAGE_SIZE = 500
FACET_PAGE_SIZE = 1_000
DEFAULT_GRID_DECIMALS = 2
SINCE_YEAR = 1950
NULL_LABEL = "not supplied"


def _type_of(name: str, doubles: set, longs: set, booleans: set) -> T.DataType:
    if name in doubles:
        return T.DoubleType()
    if name in longs:
        return T.LongType()
    if name in booleans:
        return T.BooleanType()
    return T.StringType()


def occurrence_schema(include_user_data: bool = False) -> T.StructType:
    names = BASE_FIELDS + (USER_DATA_FIELDS if include_user_data else [])
    return T.StructType(
        [
            T.StructField(n, _type_of(n, DOUBLE_FIELDS, LONG_FIELDS, BOOLEAN_FIELDS))
            for n in names
        ]
    )


OCCURRENCE_SCHEMA = occurrence_schema()
CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField(n, _type_of(n, CANONICAL_DOUBLES, CANONICAL_LONGS, CANONICAL_BOOLEANS))
        for n in CANONICAL_FIELDS
    ]
)


def check_privacy(include_user_data: bool, keep_raw_pages: bool) -> None:
    """Raw pages hold observer and media fields, so keeping them needs the opt-in."""
    if keep_raw_pages and not include_user_data:
        raise ValueError("Keeping raw pages requires include_user_data=True.")


def ensure_columns(df: DataFrame, columns: Mapping[str, str] | Iterable[str]) -> DataFrame:
    """Add each absent column as a typed null (P5)."""
    wanted = columns if isinstance(columns, Mapping) else {c: "string" for c in columns}
    missing = {c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: absent columns become null, extra ones go."""
    present = set(df.columns)

    def column(field: T.StructField) -> Column:
        source = F.col(f"`{field.name}`") if field.name in present else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select([column(f) for f in schema.fields])


def project_fields(df: DataFrame, include_user_data: bool = False) -> DataFrame:
    """The stored occurrence columns, with observer fields only on opt-in."""
    return conform(df, occurrence_schema(include_user_data))


def empty_table(spark: SparkSession, schema: T.StructType = OCCURRENCE_SCHEMA) -> DataFrame:
    """An empty table that still carries its types."""
    return spark.createDataFrame([], schema)
