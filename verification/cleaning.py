"""Dedupe, taxonomy, conservation, profile and impact queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occspark.functions.keys import dedupe_key, fingerprint
from occspark.operators import conservation, impact, profile, taxonomy
from occspark.operators.dedupe import dedupe, dedupe_metrics, union_tables
from occspark.plans.tables import target_list
from occspark.schema import CONSERVATION_REFERENCE_FIELDS, ensure_columns
from occspark.sources.star_view import LINE_KEY, OCCURRENCE_VIEW_COLUMNS, occurrences, read_table
from verification.inputs import (
    ENRICHED,
    OCC,
    REFERENCE,
    enriched,
    with_occ,
)
from verification.registry import query

KEYS = list(LINE_KEY)
KEY_COLUMNS = (
    "uuid scientificName raw_scientificName species query_scientific_name query_species_key "
    "decimalLatitude decimalLongitude eventDate dataResourceUid recordNumber basisOfRecord "
    "raw_basisOfRecord"
).split()
_KEYS_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

# --- dedupe ------------------------------------------------------------------------

_FINGERPRINT = """coalesce("scientificName", "raw_scientificName", species, query_scientific_name, '')
    || '|' || coalesce(CAST("decimalLatitude" AS VARCHAR), '')
    || '|' || coalesce(CAST("decimalLongitude" AS VARCHAR), '')
    || '|' || coalesce(CAST("eventDate" AS VARCHAR), '') || '|' || coalesce("dataResourceUid", '') || '|'
    || '|' || coalesce("recordNumber", '') || '|' || coalesce("basisOfRecord", "raw_basisOfRecord", '')"""
_KEY = f"CASE WHEN uuid IS NOT NULL AND uuid <> '' THEN 'uuid:' || uuid ELSE 'fp:' || {_FINGERPRINT} END"
_RANK = f"""row_number() OVER (PARTITION BY {_KEY} ORDER BY "eventDate" NULLS LAST, query_species_key NULLS LAST,
    uuid NULLS LAST, {', '.join(k + ' NULLS LAST' for k in KEYS)})"""


@query(
    "w1_dedupe",
    with_occ(
        f"""SELECT {_KEYS_SQL}, uuid, "scientificName", "eventDate" FROM
        (SELECT *, {_RANK} AS rk FROM occ) WHERE rk = 1"""
    ),
)
def w1_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, [*KEY_COLUMNS, *KEYS])
    return dedupe(rows, KEYS).select(*KEYS, "uuid", "scientificName", "eventDate")


@query("w1_dedupe_switched_off", with_occ(f"SELECT {_KEYS_SQL}, uuid FROM occ"))
def w1_dedupe_switched_off(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe(occurrences(spark, folder, [*KEYS, "uuid"]), enabled=False)


@query(
    "f15_f16_dedupe_key_groups",
    with_occ(
        f"""SELECT n, starts, count(*) AS keys, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT count(*) AS n,
        substr({_KEY}, 1, 3) AS starts FROM occ GROUP BY {_KEY}, 2) GROUP BY n, starts"""
    ),
)
def f15_f16_dedupe_key_groups(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, KEY_COLUMNS).withColumn("dataResourceName", F.lit(None).cast("string"))
    per_key = rows.groupBy(dedupe_key().alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("n", F.substring("key", 1, 3).alias("starts")).agg(
        F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")
    )


@query(
    "f15_fingerprints",
    with_occ(f"SELECT {_FINGERPRINT} AS fingerprint, count(*) AS n FROM occ GROUP BY 1"),
)
def f15_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, KEY_COLUMNS).withColumn("dataResourceName", F.lit(None).cast("string"))
    return rows.groupBy(fingerprint().alias("fingerprint")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a32_dedupe_metrics_by_family",
    with_occ(
        f"""SELECT family, CAST(sum(n) AS BIGINT) AS input_rows, count(*) AS output_rows,
        CAST(sum(n) - count(*) AS BIGINT) AS dropped_rows
        FROM (SELECT family, count(*) AS n FROM occ GROUP BY family, {_KEY}) GROUP BY family"""
    ),
)
def a32_dedupe_metrics_by_family(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe_metrics(occurrences(spark, folder, [*KEY_COLUMNS, "family"]), "family")


@query(
    "u1_s3_union_by_name",
    with_occ(
        """SELECT uuid, "scientificName", CAST(NULL AS VARCHAR) AS month FROM occ
        UNION ALL SELECT uuid, NULL, month FROM occ"""
    ),
)
def u1_s3_union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    return union_tables(
        [
            occurrences(spark, folder, ["uuid", "scientificName"]),
            occurrences(spark, folder, ["uuid", "month"]),
        ]
    )


# --- taxonomy ----------------------------------------------------------------------

TAXON_COLUMNS = "scientificName taxonRank genus species family month".split()
_LOOKUP = """lk AS (SELECT "scientificName", min(genus) AS lg, min(species) AS ls FROM occ
  WHERE genus IS NOT NULL AND species IS NOT NULL GROUP BY 1
  HAVING count(DISTINCT genus) = 1 AND count(DISTINCT species) = 1)"""
# The authority: one row per brand of part name, from the part and nation tables.
_AUTHORITY = """au AS (SELECT DISTINCT "scientificName",
    CASE WHEN "scientificName" LIKE '%SMALL%' THEN 'genus' WHEN "scientificName" LIKE '%PROMO%' THEN ' Subspecies '
      ELSE 'SPECIES' END AS rank,
    CASE WHEN "scientificName" LIKE '%LARGE%' THEN 'DOUBTFUL' WHEN "scientificName" LIKE '%PROMO%' THEN 'synonym'
      ELSE 'ACCEPTED' END AS status,
    CASE WHEN "scientificName" LIKE '%MEDIUM%' THEN 80 ELSE 95 END AS confidence,
    split_part("scientificName", ' ', 1) AS genus,
    split_part("scientificName", ' ', 1) || ' ' || split_part("scientificName", ' ', 2) AS species FROM occ),
ok AS (SELECT * FROM au WHERE lower(trim(rank)) IN ('species', 'subspecies')
  AND upper(status) IN ('ACCEPTED', 'SYNONYM') AND confidence >= 90)"""


def _authority(rows: DataFrame) -> DataFrame:
    name = F.col("scientificName")
    first, second = F.substring_index(name, " ", 1), F.substring_index(name, " ", 2)
    return rows.select(
        name,
        F.when(name.contains("SMALL"), "genus")
        .when(name.contains("PROMO"), " Subspecies ")
        .otherwise("SPECIES")
        .alias("rank"),
        F.when(name.contains("LARGE"), "DOUBTFUL")
        .when(name.contains("PROMO"), "synonym")
        .otherwise("ACCEPTED")
        .alias("status"),
        F.when(name.contains("MEDIUM"), 80).otherwise(95).alias("confidence"),
        first.alias("genus"),
        second.alias("species"),
    ).distinct()


@query("a4_exact_lookup", with_occ('SELECT "scientificName", lg AS lookup_genus, ls AS lookup_species FROM lk', _LOOKUP))
def a4_exact_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return taxonomy.exact_lookup(occurrences(spark, folder, TAXON_COLUMNS))


@query(
    "j1_exact_fills",
    with_occ(
        f"""SELECT {_KEYS_SQL}, coalesce(genus, lg) AS genus, coalesce(species, ls) AS species
        FROM occ LEFT JOIN lk USING ("scientificName")""",
        _LOOKUP,
    ),
)
def j1_exact_fills(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, [*KEYS, *TAXON_COLUMNS])
    return taxonomy.apply_exact_fills(rows).select(*KEYS, "genus", "species")


@query(
    "j2_authority_fills",
    with_occ(
        f"""SELECT {_KEYS_SQL}, coalesce(occ.genus, ok.genus) AS genus, coalesce(occ.species, ok.species) AS species
        FROM occ LEFT JOIN ok USING ("scientificName")""",
        _AUTHORITY,
    ),
)
def j2_authority_fills(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, [*KEYS, *TAXON_COLUMNS])
    return taxonomy.apply_authority_fills(rows, _authority(rows)).select(*KEYS, "genus", "species")


@query(
    "j2_authority_rejections",
    with_occ(
        """SELECT DISTINCT "scientificName" FROM occ WHERE (genus IS NULL OR species IS NULL)
        AND "scientificName" NOT IN (SELECT "scientificName" FROM ok)""",
        _AUTHORITY,
    ),
)
def j2_authority_rejections(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, TAXON_COLUMNS)
    return taxonomy.authority_rejections(rows, _authority(rows))


@query(
    "x3_complete_taxonomy",
    with_occ(
        f"""SELECT {_KEYS_SQL}, coalesce(occ.genus, lg, ok.genus) AS genus, coalesce(occ.species, ls, ok.species) AS species
        FROM occ LEFT JOIN lk USING ("scientificName") LEFT JOIN ok USING ("scientificName")""",
        _LOOKUP,
        _AUTHORITY,
    ),
)
def x3_complete_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, [*KEYS, *TAXON_COLUMNS])
    return taxonomy.complete_taxonomy(rows, _authority(rows)).select(*KEYS, "genus", "species")


@query(
    "x3_completion_counts",
    with_occ(
        """SELECT count(*) AS input_rows, count(*) FILTER (miss) AS initial_missing_rows,
        count(*) FILTER (miss AND lg IS NOT NULL) AS exact_fill_rows,
        count(*) FILTER (miss AND lg IS NULL AND og IS NOT NULL) AS authority_fill_rows,
        count(*) FILTER (miss AND lg IS NULL AND og IS NULL) AS remaining_missing_rows,
        count(DISTINCT CASE WHEN miss AND lg IS NULL AND og IS NULL THEN "scientificName" END) AS rejected_lookup_count
        FROM (SELECT occ."scientificName", occ.genus IS NULL OR occ.species IS NULL AS miss, lg, ok.genus AS og
          FROM occ LEFT JOIN lk USING ("scientificName") LEFT JOIN ok USING ("scientificName"))""",
        _LOOKUP,
        _AUTHORITY,
    ),
)
def x3_completion_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, TAXON_COLUMNS)
    return taxonomy.completion_counts(rows, _authority(rows))


@query(
    "p20_missing_taxonomy_rows",
    with_occ(
        """SELECT uuid, "scientificName", "taxonRank", genus, species, family, "taxonConceptID", month, year
        FROM occ WHERE genus IS NULL OR species IS NULL"""
    ),
)
def p20_missing_taxonomy_rows(spark: SparkSession, folder: str) -> DataFrame:
    return taxonomy.missing_taxonomy_rows(
        occurrences(spark, folder, taxonomy.MISSING_REPORT_COLUMNS)
    )


@query(
    "p21_unresolved_names",
    with_occ('SELECT DISTINCT "scientificName" FROM occ WHERE genus IS NULL OR species IS NULL'),
)
def p21_unresolved_names(spark: SparkSession, folder: str) -> DataFrame:
    return taxonomy.unresolved_names(occurrences(spark, folder, TAXON_COLUMNS))


@query("a9_month_counts", with_occ("SELECT month, count(*) AS rows FROM occ GROUP BY month"))
def a9_month_counts(spark: SparkSession, folder: str) -> DataFrame:
    return taxonomy.month_counts(occurrences(spark, folder, ["month"]))


_FACETS = """SELECT "{0}" AS label, count(*) AS count,
    '{0}:"' || replace("{0}", '"', '\\"') || '"' AS fq FROM occ WHERE "{0}" IS NOT NULL GROUP BY "{0}" """


@query(
    "a7_facet_counts_page",
    with_occ(_FACETS.format("scientificName") + " ORDER BY count DESC, label LIMIT 500 OFFSET 1000"),
)
def a7_facet_counts_page(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, ["scientificName"])
    return taxonomy.facet_counts(rows, "scientificName", offset=1000, limit=500)


@query(
    "a8_discover_orders",
    with_occ(
        """SELECT "order" AS label, count(*) AS count, replace(lower("order"), ' ', '_') AS key
        FROM occ WHERE classs = 'ASIA' GROUP BY "order" """
    ),
)
def a8_discover_orders(spark: SparkSession, folder: str) -> DataFrame:
    return taxonomy.discover_orders(occurrences(spark, folder, ["classs", "order", "family"]), "ASIA")


@query(
    "a8_discover_families",
    with_occ(
        """SELECT family AS label, count(*) AS count, replace(lower(family), ' ', '_') AS key
        FROM occ WHERE classs = 'MIDDLE EAST' AND "order" = 'Order LARGE' GROUP BY family"""
    ),
)
def a8_discover_families(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, ["classs", "order", "family"])
    return taxonomy.discover_families(rows, "MIDDLE EAST", "Order LARGE")


# Names as a data provider writes them: "Nation blue bolt", a genus and two epithets.
_NAMED = """named AS (SELECT classs, "order", family, 'Nation ' || lower("vernacularName") AS species,
    CASE WHEN l_linenumber % 2 = 0 THEN 'Nation ' || "vernacularName" || ' ' || lower(r) END AS subspecies
  FROM (SELECT *, replace(family, ' ', '-') AS r FROM occ))"""


def _named(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, ["classs", "order", "family", "vernacularName", "l_linenumber"])
    name = F.concat(F.lit("Nation "), F.col("vernacularName"))
    epithet = F.lower(F.replace(F.col("family"), F.lit(" "), F.lit("-")))
    return rows.select(
        "classs",
        "order",
        "family",
        F.concat(F.lit("Nation "), F.lower("vernacularName")).alias("species"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat_ws(" ", name, epithet)).alias("subspecies"),
    )


_TAXA = """fc AS (SELECT classs, "order", family, 'species' AS f, species AS n, count(*) AS c FROM named GROUP BY ALL
  UNION ALL SELECT classs, "order", family, 'subspecies', subspecies, count(*) FROM named WHERE subspecies IS NOT NULL GROUP BY ALL),
named_ok AS (SELECT * FROM fc WHERE regexp_matches(n, '^[A-Z][a-zA-Z-]+( [a-z][a-z-]+)+$'))"""


@query(
    "a5_merge_taxa",
    with_occ(
        """SELECT regexp_replace(lower(n), '[^a-z0-9]+', '_', 'g') AS species_key, n AS scientific_name,
        string_agg(DISTINCT "order", ' | ' ORDER BY "order") AS "order",
        string_agg(DISTINCT family, ' | ' ORDER BY family) AS family,
        string_agg(DISTINCT f, ' | ' ORDER BY f) AS facet_fields, CAST(sum(c) AS BIGINT) AS occurrence_count,
        string_agg(DISTINCT f || ':"' || n || '"', ' | ' ORDER BY f || ':"' || n || '"') AS facet_fq
        FROM named_ok GROUP BY n""",
        _NAMED,
        _TAXA,
    ),
)
def a5_merge_taxa(spark: SparkSession, folder: str) -> DataFrame:
    return taxonomy.merge_taxa(taxonomy.name_facets(_named(spark, folder)))


@query(
    "x9_family_target_list",
    with_occ(
        """SELECT regexp_replace(lower(n), '[^a-z0-9]+', '_', 'g') AS key, n AS scientific_name,
        min(classs) AS class, min("order") AS "order", min(family) AS family, string_agg(DISTINCT f, ' | ' ORDER BY f) AS facet_fields,
        CAST(sum(c) AS BIGINT) AS occurrence_count,
        string_agg(DISTINCT f || ':"' || n || '"', ' | ' ORDER BY f || ':"' || n || '"') AS facet_fq
        FROM fc WHERE "order" = 'Order SMALL' AND family = 'EUROPE' GROUP BY n""",
        _NAMED,
        _TAXA,
    ),
)
def x9_family_target_list(spark: SparkSession, folder: str) -> DataFrame:
    return target_list(_named(spark, folder), "Order SMALL", "EUROPE")


# --- conservation --------------------------------------------------------------------


@query(
    "u4_f21_match_names",
    """SELECT match_name, arg_min(accepted_taxon, place) AS accepted_taxon FROM (
      SELECT s_name AS match_name, s_name AS accepted_taxon, (s_suppkey, 0) AS place FROM supplier
      UNION ALL SELECT 'Group ' || s_suppkey % 7, s_name, (s_suppkey, 1) FROM supplier
      UNION ALL SELECT s_name, 'Early ' || s_suppkey, (-s_suppkey, 1) FROM supplier WHERE s_suppkey % 3 = 0
      UNION ALL SELECT 'Early ' || s_suppkey, 'Early ' || s_suppkey, (-s_suppkey, 0) FROM supplier WHERE s_suppkey % 3 = 0)
    GROUP BY match_name""",
)
def u4_f21_match_names(spark: SparkSession, folder: str) -> DataFrame:
    """A reference row per supplier; group names are listed by many rows, some names by an earlier one as well."""
    suppliers, key = read_table(spark, folder, "supplier"), F.col("s_suppkey")
    group = F.concat(F.lit("Group "), (key % 7).cast("string"))
    listed = suppliers.select(F.col("s_name").alias("accepted_taxon"), group.alias("match_names"), key.alias("row_order"))
    early = suppliers.where(key % 3 == 0).select(
        F.concat(F.lit("Early "), key.cast("string")).alias("accepted_taxon"), F.col("s_name").alias("match_names"), -key
    )
    rows = ensure_columns(listed.union(early), dict.fromkeys(CONSERVATION_REFERENCE_FIELDS, "string"))
    matches = conservation.match_table(rows, "row_order")
    return matches.select("match_name", F.col("ref.accepted_taxon").alias("accepted_taxon"))


@query(
    "j3_j4_x4_conservation_status",
    f"""WITH {OCC},\n{REFERENCE},\n{ENRICHED}
    SELECT {_KEYS_SQL}, "Status", epbc_listed_taxon, state_status, state_status_level, state_status_for_occurrence,
      state_status_jurisdiction_matched, state_status_qualifier, state_listed_taxon,
      CASE WHEN epbc_status IS NOT NULL THEN match_name END AS epbc_match_name,
      CASE WHEN epbc_status IS NOT NULL THEN common_name END AS epbc_common_name,
      CASE WHEN epbc_status IS NOT NULL THEN
        match_field || CASE WHEN match_name <> accepted_taxon THEN '_synonym' ELSE '' END END AS epbc_match_type,
      CASE WHEN state_status_level IS NOT NULL THEN CASE
        WHEN match_field = 'scientificName' AND match_name = accepted_taxon THEN 1.0
        WHEN match_field = 'scientificName' THEN 0.95
        WHEN match_name = accepted_taxon THEN 0.9 ELSE 0.85 END END::DOUBLE AS state_match_confidence
    FROM enriched""",
)
def j3_j4_x4_conservation_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = enriched(spark, folder, [*KEYS, "scientificName", "species", "stateProvince"])
    return rows.select(
        *KEYS,
        *"Status epbc_listed_taxon state_status state_status_level state_status_for_occurrence "
        "state_status_jurisdiction_matched state_status_qualifier state_listed_taxon epbc_match_name "
        "epbc_common_name epbc_match_type state_match_confidence".split(),
    )


@query(
    "x4_enrichment_counts",
    f"""WITH {OCC},\n{REFERENCE},\n{ENRICHED}
    SELECT count(*) AS row_count, count("Status") AS epbc_matched_rows,
      count(state_status_level) AS state_matched_rows FROM enriched""",
)
def x4_enrichment_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = enriched(spark, folder, ["scientificName", "species", "stateProvince"])
    return conservation.enrichment_counts(rows)


# --- profile -------------------------------------------------------------------------

PROFILE_COLUMNS = list(OCCURRENCE_VIEW_COLUMNS)


def _profile_input(spark: SparkSession, folder: str) -> DataFrame:
    return occurrences(spark, folder, PROFILE_COLUMNS)


def _per_column(template: str) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in PROFILE_COLUMNS)


_BASICS = _per_column(
    """SELECT '{c}' AS "column", count(*) AS row_count, count(*) - count("{c}") AS null_count,
    CAST(count(DISTINCT "{c}") + max(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_count FROM occ"""
)


@query("a10_column_basics", with_occ(_BASICS))
def a10_column_basics(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_basics(profile.value_counts(_profile_input(spark, folder)))


@query(
    "a11_column_profile",
    with_occ(
        """SELECT "column", null_count, round(null_count / row_count * 100.0, 4) AS null_percent,
        row_count - null_count AS non_null_count, distinct_count,
        concat_ws('|', CASE WHEN null_count = row_count THEN 'empty_column' END,
          CASE WHEN null_count / row_count * 100.0 >= 90 THEN 'high_null' END,
          CASE WHEN distinct_count <= 1 THEN 'single_value' END) AS flags FROM basics""",
        f"basics AS ({_BASICS})",
    ),
)
def a11_column_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_profile(_profile_input(spark, folder)).drop("dtype")


_TEXT_COLUMNS = [
    c for c in PROFILE_COLUMNS if c not in ("decimalLatitude", "decimalLongitude", "eventDate", "year")
]


@query(
    "a12_top_values",
    with_occ(
        """SELECT "column", rank, value, count FROM (SELECT *, row_number() OVER (PARTITION BY "column"
          ORDER BY count DESC, value NULLS LAST) AS rank, count(*) OVER (PARTITION BY "column") AS d FROM vc)
        WHERE d <= 1000 AND rank <= 10""",
        "vc AS ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", "{c}" AS value, count(*) AS count FROM occ GROUP BY "{c}" """
            for c in _TEXT_COLUMNS
        )
        + ")",
    ),
)
def a12_top_values(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(_profile_input(spark, folder), max_categories=1_000)


@query(
    "a12_all_top_values",
    with_occ(
        """SELECT "column", rank, value, count FROM (SELECT *, row_number() OVER (PARTITION BY "column"
          ORDER BY count DESC, value NULLS LAST) AS rank FROM vc) WHERE rank <= 10""",
        "vc AS ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", "{c}" AS value, count(*) AS count FROM occ GROUP BY "{c}" """
            for c in _TEXT_COLUMNS
        )
        + ")",
    ),
)
def a12_all_top_values(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(_profile_input(spark, folder))


@query(
    "a13_species_counts",
    with_occ('SELECT "scientificName" AS name, count(*) AS count FROM occ GROUP BY 1'),
)
def a13_species_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.species_counts(_profile_input(spark, folder))


@query(
    "a14_duplicate_ids",
    with_occ("SELECT count(uuid) - count(DISTINCT uuid) AS duplicate_uuid_count FROM occ"),
)
def a14_duplicate_ids(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duplicate_ids(occurrences(spark, folder, ["uuid"]))


@query(
    "a15_coordinate_issues",
    with_occ(
        """SELECT count(*) FILTER ("decimalLatitude" * 3 < -90 OR "decimalLatitude" * 3 > 90)
        + count(*) FILTER ("decimalLongitude" + 40 < -180 OR "decimalLongitude" + 40 > 180)
        AS coordinate_issue_count FROM occ"""
    ),
)
def a15_coordinate_issues(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, ["decimalLatitude", "decimalLongitude"])
    shifted = rows.select(
        (F.col("decimalLatitude") * 3).alias("decimalLatitude"),
        (F.col("decimalLongitude") + 40).alias("decimalLongitude"),
    )
    return profile.coordinate_issues(shifted)


@query(
    "a16_year_coverage",
    with_occ(
        "SELECT min(year) AS min_year, max(year) AS max_year, count(DISTINCT year) AS distinct_year_count FROM occ"
    ),
)
def a16_year_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return profile.year_coverage(occurrences(spark, folder, ["year"]))


@query(
    "a17_a18_x11_profile_summary_by_family",
    with_occ(
        """SELECT family, count(*) AS row_count, CAST(0 AS BIGINT) AS coordinate_issue_count, min(year) AS min_year,
        max(year) AS max_year, count(uuid) - count(DISTINCT uuid) AS duplicate_uuid_count,
        count(DISTINCT "scientificName") AS species_count, count(DISTINCT year) AS distinct_year_count,
        CAST(7 AS BIGINT) AS column_count, 'duplicate_uuid|single_value' AS flags
        FROM occ GROUP BY family"""
    ),
)
def a17_a18_x11_profile_summary_by_family(spark: SparkSession, folder: str) -> DataFrame:
    columns = "family uuid scientificName decimalLatitude decimalLongitude year month classs".split()
    report = profile.profile(occurrences(spark, folder, columns), ["family"])
    flags = F.array_join("quality_flags", "|").alias("flags")
    summary = report.summary
    return summary.select(
        *[c for c in summary.columns if c not in ("quality_flags", "column_count")],
        F.col("column_count").cast("long").alias("column_count"),
        flags,
    )


@query(
    "x11_column_profile_by_family",
    with_occ(
        " UNION ALL ".join(
            f"""SELECT family, '{c}' AS "column", count(*) - count("{c}") AS null_count,
            CAST(count(DISTINCT "{c}") + max(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_count
            FROM occ GROUP BY family"""
            for c in ("uuid", "genus", "species", "month")
        )
    ),
)
def x11_column_profile_by_family(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, ["family", "uuid", "genus", "species", "month"])
    report = profile.column_profile(rows, keys=["family"])
    return report.select("family", "column", "null_count", "distinct_count")


# --- impact of a second source ---------------------------------------------------------

# The second source: the same records with every third day moved, under canonical names.
_SOURCE = """src AS (SELECT upper("scientificName") AS scientific_name, family,
    CASE WHEN l_linenumber % 3 = 0 THEN '1990-01-01' ELSE substr("eventDate_iso", 1, 10) END AS event_date_start,
    "decimalLatitude" AS decimal_latitude, "decimalLongitude" AS decimal_longitude, l_linenumber AS line FROM occ)"""
_BASE = "base AS (SELECT * FROM occ WHERE \"taxonRank\" <> 'genus')"
FAMILIES = ("ASIA", "EUROPE", "AFRICA")
_IN = "family IN ('ASIA', 'EUROPE', 'AFRICA')"


def _key_sql(name: str, date: str, lat: str, lon: str) -> str:
    return f"""lower(coalesce({name}, '')) || '|' || coalesce(substr({date}, 1, 10), '') || '|'
    || coalesce(CAST(round({lat}, 5) AS VARCHAR), '') || '|' || coalesce(CAST(round({lon}, 5) AS VARCHAR), '')"""


_SOURCE_KEY = _key_sql("scientific_name", "event_date_start", "decimal_latitude", "decimal_longitude")
_BASE_KEY = _key_sql('"scientificName"', '"eventDate_iso"', '"decimalLatitude"', '"decimalLongitude"')


def _impact_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    columns = "scientificName family eventDate_iso decimalLatitude decimalLongitude taxonRank l_linenumber"
    rows = occurrences(spark, folder, columns.split())
    source = rows.select(
        F.upper("scientificName").alias("scientific_name"),
        "family",
        F.when(F.col("l_linenumber") % 3 == 0, "1990-01-01")
        .otherwise(F.substring("eventDate_iso", 1, 10))
        .alias("event_date_start"),
        F.col("decimalLatitude").alias("decimal_latitude"),
        F.col("decimalLongitude").alias("decimal_longitude"),
        F.col("l_linenumber").alias("line"),
    )
    return source, rows.where(F.col("taxonRank") != "genus").drop("l_linenumber")


@query("f14_f26_match_keys", with_occ(f"SELECT {_BASE_KEY} AS match_key, count(*) AS n FROM occ GROUP BY 1"))
def f14_f26_match_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(
        spark, folder, ["scientificName", "eventDate_iso", "decimalLatitude", "decimalLongitude"]
    )
    return impact.base_keys(rows).groupBy("match_key").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j10_candidate_duplicates",
    with_occ(f"SELECT * FROM src WHERE {_SOURCE_KEY} IN (SELECT {_BASE_KEY} FROM base)", _SOURCE, _BASE),
)
def j10_candidate_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return impact.candidate_duplicates(*_impact_inputs(spark, folder))


@query(
    "j10_u5_candidate_new",
    with_occ(f"SELECT * FROM src WHERE {_SOURCE_KEY} NOT IN (SELECT {_BASE_KEY} FROM base)", _SOURCE, _BASE),
)
def j10_u5_candidate_new(spark: SparkSession, folder: str) -> DataFrame:
    return impact.candidate_new(*_impact_inputs(spark, folder))


@query(
    "p8_a6_family_counts",
    with_occ(f"SELECT family, count(*) AS count FROM occ WHERE {_IN} GROUP BY family"),
)
def p8_a6_family_counts(spark: SparkSession, folder: str) -> DataFrame:
    return impact.value_totals(impact.in_families(occurrences(spark, folder, ["family"]), FAMILIES))


@query(
    "a28_x5_impact_summary",
    with_occ(
        """SELECT b AS existing_rows_considered, s AS source_rows, d AS candidate_duplicate_rows,
        s - d AS candidate_new_rows, round(d::DOUBLE / s, 6) AS candidate_duplicate_ratio,
        b + s AS expected_rows_without_dedupe, b + s - d AS expected_rows_after_dedupe FROM counts""",
        _SOURCE,
        _BASE,
        f"""counts AS (SELECT (SELECT count(*) FROM base WHERE {_IN}) AS b, count(*) AS s,
          count(*) FILTER ({_SOURCE_KEY} IN (SELECT {_BASE_KEY} FROM base WHERE {_IN})) AS d FROM src WHERE {_IN})""",
    ),
)
def a28_x5_impact_summary(spark: SparkSession, folder: str) -> DataFrame:
    source, base = _impact_inputs(spark, folder)
    summary = impact.impact_summary(source, base, FAMILIES)
    return summary.drop("base_table_found", "base_table_readable", "base_read_error")


@query(
    "a28_impact_family_counts",
    with_occ(
        f"""SELECT 'source' AS side, family, count(*) AS count FROM src WHERE {_IN} GROUP BY ALL
        UNION ALL SELECT 'base', family, count(*) FROM base WHERE {_IN} GROUP BY ALL""",
        _SOURCE,
        _BASE,
    ),
)
def a28_impact_family_counts(spark: SparkSession, folder: str) -> DataFrame:
    source, base = _impact_inputs(spark, folder)
    return impact.impact_family_counts(source, base, FAMILIES)
