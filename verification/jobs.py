"""Jobs and file operators: every query writes tables to a folder of its own and returns what it reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from occspark.operators import slicer
from occspark.operators.dedupe import union_tables
from occspark.operators.rownumber import row_numbers
from occspark.operators.slicer import SlicerState
from occspark.operators.taxonomy import MISSING_REPORT_COLUMNS
from occspark.plans import cubes
from occspark.plans import tables as jobs
from occspark.schema import CUBE_CONSERVATION_FIELDS, OCCURRENCE_SCHEMA, conform, empty_table, project_fields
from occspark.session import checkpoint_dir
from occspark.sources import reference, tables
from occspark.sources.star_view import occurrences, read_table
from verification.cleaning import _KEY, KEYS, TAXON_COLUMNS, _authority
from verification.inputs import (
    AREA_LEVEL,
    AREAS,
    CUBE,
    CUBE_COLUMNS,
    OCC,
    boundary_features,
    conservation_reference,
    cube_sql,
    plain_cube,
    with_occ,
)
from verification.registry import ORACLES, query


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _shards(spark: SparkSession, folder: str, base: str) -> list[str]:
    """The occurrence table as three shards, by year, and the path of one that doesn't exist."""
    rows = conform(occurrences(spark, folder), OCCURRENCE_SCHEMA)
    shard = (F.coalesce("year", F.lit(0)) % 3).alias("shard")
    tables.write_table(rows.select("*", shard), f"{base}/shards", partition_by=["shard"])
    return [f"{base}/shards/shard={n}" for n in range(4)]


_KEPT = f"""kept AS (SELECT "eventDate", query_species_key, uuid FROM (SELECT *, row_number() OVER (
    PARTITION BY {_KEY} ORDER BY "eventDate" NULLS LAST, query_species_key NULLS LAST, uuid NULLS LAST) AS rk FROM occ)
  WHERE rk = 1)"""


@query(
    "x1_s2_s11_s12_s13_merge_tables",
    with_occ(
        """SELECT kept.*, origin, (SELECT count(*) FROM occ) AS input_rows, (SELECT count(*) FROM kept) AS output_rows
        FROM kept, (VALUES ('csv'), ('view')) AS o(origin)""",
        _KEPT,
    ),
)
def x1_merge_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Shards, one of them absent, into one table, its CSV copy and a view over it."""
    base = scratch(spark, "merge")
    view = f"merged_{uuid.uuid4().hex}"
    counts = jobs.merge_tables(spark, _shards(spark, folder, base), f"{base}/table", f"{base}/csv", view)
    columns = ("eventDate", "query_species_key", "uuid")
    # The file tells an empty text ("") from a null (nothing); the reader does so with another mark for null.
    reader = spark.read.schema(OCCURRENCE_SCHEMA).option("header", True).option("nullValue", "\0")
    from_csv = reader.csv(f"{base}/csv")
    parts = [(spark.table(view), "view"), (from_csv, "csv")]
    return union_tables([p.select(*columns, F.lit(o).alias("origin")) for p, o in parts]).withColumns(
        {"input_rows": F.lit(counts.input_rows), "output_rows": F.lit(counts.output_rows)}
    )


@query("s1_read_shards", with_occ('SELECT uuid, "scientificName", year, "decimalLatitude", month FROM occ'))
def s1_read_shards(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch(spark, "shards")
    _shards(spark, folder, base)
    rows = tables.read_shards(spark, f"{base}/shards")
    return rows.select("uuid", "scientificName", "year", "decimalLatitude", "month")


@query(
    "s3_read_by_name",
    with_occ(
        """SELECT uuid, year, CASE WHEN year % 2 = 0 THEN month END AS month, CASE WHEN year % 2 = 1 THEN day END AS day
        FROM occ"""
    ),
)
def s3_read_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Tables that lack a column each, matched by name."""
    base = scratch(spark, "by-name")
    rows = occurrences(spark, folder, ["uuid", "year", "month", "day"])
    tables.write_table(rows.where("year % 2 = 0").select("month", "uuid", "year"), f"{base}/even")
    tables.write_table(rows.where("year % 2 = 1").select("uuid", "day", "year"), f"{base}/odd")
    return tables.read_by_name(spark, [f"{base}/even", f"{base}/odd"]).select("uuid", "year", "month", "day")


@query("s4_s11_table_round_trip", with_occ(f"SELECT {', '.join(KEYS)}, uuid, \"eventDate\", genus FROM occ"))
def s4_table_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "table")
    tables.write_table(occurrences(spark, folder, [*KEYS, "uuid", "eventDate", "genus"]), path, row_group_rows=5_000)
    return tables.read_table(spark, path)


@query(
    "s10_empty_table",
    with_occ("SELECT uuid, year, 'stored' AS origin FROM occ"),
)
def s10_empty_table(spark: SparkSession, folder: str) -> DataFrame:
    """Absent files and an empty data set add no rows, but all columns with their types."""
    absent = tables.read_files(spark, [scratch(spark, "absent")])
    rows = occurrences(spark, folder, ["uuid", "year"]).withColumn("origin", F.lit("stored"))
    empty = union_tables([absent, empty_table(spark)]).withColumn("origin", F.lit("empty"))
    assert [f.dataType for f in absent.schema] == [f.dataType for f in OCCURRENCE_SCHEMA]
    return union_tables([empty, rows]).select("uuid", "year", "origin")


@query(
    "s15_write_guard",
    with_occ("SELECT uuid, year, TRUE AS refused FROM occ WHERE year >= 1996"),
)
def s15_write_guard(spark: SparkSession, folder: str) -> DataFrame:
    """A second write is refused, and replaces the table only where asked to."""
    path = scratch(spark, "guarded")
    rows = occurrences(spark, folder, ["uuid", "year"])
    tables.check_outputs(spark, [path], overwrite=False)
    tables.write_table(rows, path)
    try:
        tables.check_outputs(spark, [path], overwrite=False)
        refused = False
    except FileExistsError:
        refused = True
    tables.write_table(rows.where("year >= 1996"), path, overwrite=True)
    return tables.read_table(spark, path).withColumn("refused", F.lit(refused))


@query(
    "x2_s14_join_families",
    with_occ(
        f"""SELECT part, count(*) AS input_rows, any_value(total) AS total_input_rows, any_value(kept) AS total_output_rows,
        any_value(total - kept) AS total_dropped_rows, any_value(kept) AS profiled_rows
        FROM (SELECT CASE WHEN year % 2 = 0 THEN 'even' ELSE 'odd' END AS part FROM occ),
          (SELECT count(*) AS total, count(DISTINCT {_KEY}) AS kept FROM occ) GROUP BY part"""
    ),
)
def x2_join_families(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables that lack a column each, joined; the report's counts and the profile's."""
    base = scratch(spark, "join")
    rows = conform(occurrences(spark, folder), OCCURRENCE_SCHEMA)
    tables.write_table(rows.where("year % 2 = 0").drop("genus"), f"{base}/even")
    tables.write_table(rows.where("year % 2 = 1").drop("month"), f"{base}/odd")
    jobs.join_families(spark, [f"{base}/even", f"{base}/odd"], f"{base}/joined", f"{base}/reports")
    part = F.regexp_extract("source_file", "/(even|odd)/", 1)
    # The summary of a whole table is one row.
    profiled = spark.read.json(f"{base}/reports/quality_summary").first()["row_count"]
    return (
        spark.read.json(f"{base}/reports/join_metadata")
        .groupBy(part.alias("part"), "total_input_rows", "total_output_rows", "total_dropped_rows")
        .agg(F.sum("input_rows").alias("input_rows"))
        .withColumn("profiled_rows", F.lit(profiled))
    )


_REFERENCE_FIELDS = (
    "accepted_taxon match_names rank common_name epbc_status epbc_listed_id epbc_sprat_url state_status "
    "state_source_url source_dataset source_date notes"
).split()


@query(
    "s7_conservation_reference",
    """SELECT row_number() OVER (ORDER BY s_suppkey) AS place, s_name AS accepted_taxon, s_name || '| Synonym ' || s_suppkey || ' |' AS match_names,
      'species' AS rank, 'Common ' || s_name AS common_name,
      CASE s_suppkey % 4 WHEN 0 THEN 'Endangered' WHEN 1 THEN 'Vulnerable' WHEN 3 THEN 'Critically Endangered' END
        AS epbc_status,
      CAST(s_suppkey AS VARCHAR) AS epbc_listed_id, CAST(NULL AS VARCHAR) AS epbc_sprat_url,
      CASE s_suppkey % 5 WHEN 0 THEN 'NSW: Critically Endangered; QLD: Vulnerable' WHEN 1 THEN 'Endangered'
        WHEN 2 THEN 'VIC: Rare - under review; Extinct' WHEN 4 THEN 'TAS: Presumed Extinct' END AS state_status,
      'https://example.org/' || s_suppkey AS state_source_url, 'derived' AS source_dataset,
      '2026-01-01' AS source_date, 'two' || chr(10) || 'lines' AS notes FROM supplier""",
)
def s7_conservation_reference(spark: SparkSession, folder: str) -> DataFrame:
    """A reference row per supplier through CSV files with multi-line and blank cells, numbered in file order."""
    path, n = scratch(spark, "reference"), F.col("s_suppkey")
    text = n.cast("string")
    listed = read_table(spark, folder, "supplier").repartitionByRange(5, n).sortWithinPartitions(n).select(
        F.concat(F.lit(" "), "s_name").alias("accepted_taxon"),
        F.concat("s_name", F.lit("| Synonym "), text, F.lit(" |")).alias("match_names"),
        F.lit("species").alias("rank"),
        F.concat(F.lit("Common "), "s_name").alias("common_name"),
        F.when(n % 4 == 0, "Endangered").when(n % 4 == 1, "Vulnerable").when(n % 4 == 3, "Critically Endangered").alias("epbc_status"),
        text.alias("epbc_listed_id"),
        F.lit("  ").alias("epbc_sprat_url"),
        F.when(n % 5 == 0, "NSW: Critically Endangered; QLD: Vulnerable")
        .when(n % 5 == 1, "Endangered")
        .when(n % 5 == 2, "VIC: Rare - under review; Extinct")
        .when(n % 5 == 4, "TAS: Presumed Extinct")
        .alias("state_status"),
        F.concat(F.lit("https://example.org/"), text).alias("state_source_url"),
        F.lit("derived").alias("source_dataset"),
        F.lit("2026-01-01").alias("source_date"),
        F.lit(" two\nlines ").alias("notes"),
    )
    tables.write_csv(listed, path)
    read = reference.read_conservation_reference(spark, path)
    return row_numbers(read, ["row_order"], "place").select(F.col("place").cast("long"), *_REFERENCE_FIELDS)


@query(
    "s8_targets",
    r"""SELECT DISTINCT regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g') AS key, p_brand AS scientific_name,
      'Common ' || p_brand AS common_name, 'Insecta' AS source_class,
      'species:"' || p_brand || '"' || ' & ' || 'subspecies:"x"' AS filters, p_brand LIKE '%1' AS target_match_suspect
    FROM part""",
)
def s8_targets(spark: SparkSession, folder: str) -> DataFrame:
    """One target per brand through a JSON list: keys derived, filters given as one text."""
    path = scratch(spark, "targets")
    target = F.struct(
        F.concat(F.lit(" "), "p_brand").alias("scientific_name"),
        F.concat(F.lit("Common "), "p_brand").alias("common_name"),
        F.lit("Insecta").alias("class"),
        F.concat(F.lit('species:"'), "p_brand", F.lit('" | subspecies:"x"')).alias("facet_fq"),
        F.col("p_brand").endswith("1").alias("target_match_suspect"),
    )
    # Brands are a fixed list of at most 25, so one JSON list holds them.
    brands = read_table(spark, folder, "part").select("p_brand").distinct()
    brands.agg(F.to_json(F.collect_list(target))).write.text(path)
    return reference.read_targets(spark, path).select(
        "key",
        "scientific_name",
        "common_name",
        "source_class",
        F.array_join("facet_fq_filters", " & ").alias("filters"),
        "target_match_suspect",
    )


@query(
    "s9_family_tables",
    with_occ(
        """SELECT 'insecta' AS class_key, 'all_orders' AS order_key, k AS family_key, count(*) AS n,
          count(uuid) AS named, scope
        FROM (SELECT *, replace(lower(family), ' ', '_') AS k FROM occ), (VALUES ('all'), ('europe')) AS s(scope)
        WHERE scope = 'all' OR k = 'europe' GROUP BY k, scope"""
    ),
)
def s9_family_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Family tables under one root beside tables that are none; all of them, and one family."""
    root = f"{scratch(spark, 'families')}/taxa"
    rows = occurrences(spark, folder, ["family", "uuid", "year"])
    for region in read_table(spark, folder, "region").collect():
        key = region["r_name"].lower().replace(" ", "_")
        own = rows.where(F.col("family") == region["r_name"])
        tables.write_table(own, f"{root}/insecta/all_orders/{key}/{key}.parquet")
    tables.write_table(rows, f"{root}/species/all_orders/asia/asia.parquet")
    tables.write_table(rows, f"{root}/insecta/all_orders/asia/other.parquet")

    def counted(found: DataFrame, scope: str) -> DataFrame:
        counts = [F.count(F.lit(1)).alias("n"), F.count("uuid").alias("named")]
        return found.groupBy("class_key", "order_key", "family_key").agg(*counts).withColumn("scope", F.lit(scope))

    every = tables.read_family_tables(spark, root)
    one = tables.read_family_tables(spark, root, "Insecta", "All orders", "EUROPE")
    return counted(every, "all").union(counted(one, "europe"))


@query(
    "p4_privacy_projection",
    with_occ(
        """SELECT uuid, year, CASE WHEN opted THEN 'observer ' || day END AS observer, opted
        FROM occ, (VALUES (TRUE), (FALSE)) AS o(opted)"""
    ),
)
def p4_privacy_projection(spark: SparkSession, folder: str) -> DataFrame:
    """Observer fields are kept only on opt-in."""
    rows = occurrences(spark, folder, ["uuid", "year", "day"])
    rows = rows.withColumn("recordedBy", F.concat(F.lit("observer "), "day"))

    def projected(opted: bool) -> DataFrame:
        kept = project_fields(rows, include_user_data=opted)
        observer = F.col("recordedBy") if "recordedBy" in kept.columns else F.lit(None).cast("string")
        return kept.select("uuid", "year", observer.alias("observer"), F.lit(opted).alias("opted"))

    return projected(True).union(projected(False))


@query(
    "p15_p16_year_bounds_and_presets",
    f"""WITH {CUBE} SELECT chosen, year, CAST(sum(record_count) AS BIGINT) AS record_count
    FROM cube, (VALUES ('all years'), ('two years')) AS c(chosen)
    WHERE "stateProvince" IN ('Victoria', 'New South Wales', 'Queensland')
      AND (chosen = 'all years' OR year BETWEEN 1994 AND 1995) GROUP BY chosen, year""",
)
def p15_p16_year_bounds_and_presets(spark: SparkSession, folder: str) -> DataFrame:
    """The whole range filters nothing; a preset names those of its states that occur."""
    # The cube is built once and stored; the summaries below need these columns of it.
    path = scratch(spark, "presets")
    tables.write_table(plain_cube(spark, folder).select("stateProvince", "year", "record_count"), path)
    cube = tables.read_table(spark, path)
    # One row per year and one per state of the map's fixed list.
    years = [r["year"] for r in slicer.year_summary(cube, SlicerState()).collect() if r["year"] is not None]
    states = [r[0] for r in cube.select("stateProvince").where("stateProvince is not null").distinct().collect()]
    preset = slicer.state_preset("East coast", states)

    def summary(selected: tuple[int, int], name: str) -> DataFrame:
        low, high = slicer.active_year_bounds(years, selected)
        state = SlicerState(include_states=preset, year_min=low, year_max=high)
        return slicer.year_summary(cube, state).withColumn("chosen", F.lit(name))

    return summary((min(years), max(years)), "all years").unionByName(summary((1994, 1995), "two years"))


@query("x6_build_grid_cube", f"WITH {OCC},\n{cube_sql(decimals=1)}\nSELECT * FROM cube")
def x6_build_grid_cube(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch(spark, "grid")
    tables.write_table(occurrences(spark, folder, CUBE_COLUMNS), f"{base}/rows")
    cubes.build_grid_cube(spark, f"{base}/rows", f"{base}/grid", decimals=1)
    return tables.read_table(spark, f"{base}/grid/grid_bins").drop(*CUBE_CONSERVATION_FIELDS)


@query("x7_s16_build_area_cubes", with_occ("SELECT * FROM area_cube", AREAS))
def x7_build_area_cubes(spark: SparkSession, folder: str) -> DataFrame:
    """Boundaries through a file of features, rows through a table, the cube read back."""
    base = scratch(spark, "areas")
    features = boundary_features(spark, folder)
    properties = F.to_json(F.struct(*[c for c in features.columns if c != "geometry"]))
    parts = [F.lit('{"type":"Feature","geometry":'), "geometry", F.lit(',"properties":'), properties, F.lit("}")]
    tables.write_features(features.select(F.concat(*parts).alias("feature")), f"{base}/features")
    tables.write_table(occurrences(spark, folder, CUBE_COLUMNS), f"{base}/rows")
    cubes.build_area_cubes(spark, f"{base}/rows", {AREA_LEVEL: f"{base}/features"}, f"{base}/cubes")
    return tables.read_table(spark, f"{base}/cubes/{AREA_LEVEL.lower()}/bins").drop(*CUBE_CONSERVATION_FIELDS)


@query("x3_complete_taxonomy_job", ORACLES["x3_complete_taxonomy"])
def x3_complete_taxonomy_job(spark: SparkSession, folder: str) -> DataFrame:
    """The job's way: the lookup stored first, then joined."""
    base = scratch(spark, "complete")
    columns = dict.fromkeys([*KEYS, *TAXON_COLUMNS, *MISSING_REPORT_COLUMNS])
    tables.write_table(occurrences(spark, folder, list(columns)), f"{base}/rows")
    authority = _authority(tables.read_table(spark, f"{base}/rows"))
    jobs.complete_taxonomy_table(spark, f"{base}/rows", f"{base}/filled", f"{base}/reports", authority)
    return tables.read_table(spark, f"{base}/filled").select(*KEYS, "genus", "species")


@query("x4_s7_enrich_job", ORACLES["j3_j4_x4_conservation_status"])
def x4_enrich_job(spark: SparkSession, folder: str) -> DataFrame:
    """Rows through a table and the reference through a CSV file."""
    base = scratch(spark, "enrich")
    rows = occurrences(spark, folder, [*KEYS, "scientificName", "species", "stateProvince"])
    tables.write_table(rows, f"{base}/rows")
    tables.write_csv(conservation_reference(spark, folder).drop("row_order"), f"{base}/reference")
    jobs.enrich_conservation_table(spark, f"{base}/rows", f"{base}/reference", f"{base}/enriched", f"{base}/report")
    return tables.read_table(spark, f"{base}/enriched").select(
        *KEYS,
        *"Status epbc_listed_taxon state_status state_status_level state_status_for_occurrence "
        "state_status_jurisdiction_matched state_status_qualifier state_listed_taxon epbc_match_name "
        "epbc_common_name epbc_match_type state_match_confidence".split(),
    )
