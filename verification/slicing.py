"""Cubes and cross-filter queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occspark.operators import grid, slicer
from occspark.operators.rownumber import row_numbers
from occspark.operators.slicer import SlicerState
from occspark.session import checkpoint_dir
from occspark.sources import clustered, tables
from occspark.sources.star_view import occurrences
from verification.inputs import (
    CUBE,
    CUBE_COLUMNS,
    ENRICHED,
    ENRICHED_CUBE,
    OCC,
    REFERENCE,
    cube_sql,
    enriched,
    enriched_cube,
    plain_cube,
    with_occ,
)
from verification.registry import query

_TOTALS = """CAST(sum(record_count) AS BIGINT) AS record_count,
    CAST(sum(distinct_scientific_names) AS BIGINT) AS distinct_scientific_names,
    CAST(sum(distinct_taxon_concepts) AS BIGINT) AS distinct_taxon_concepts,
    min(min_year) AS min_year, max(max_year) AS max_year"""
_RANGE = """CASE WHEN min_year = max_year THEN CAST(min_year AS VARCHAR)
    ELSE min_year || '-' || max_year END AS year_range"""
_MAPPED = '"decimalLatitude" IS NOT NULL AND "decimalLongitude" IS NOT NULL'

MIXED = SlicerState(
    include_families=["ASIA", "EUROPE", "AFRICA"],
    exclude_genera=["NATION_1", "NATION_7"],
    exclude_species=["NATION_2 SMALL"],
    include_states=["Victoria", "Queensland", "Overseas"],
    year_min=1996,
    year_max=2000,
)
MIXED_SQL = """family IN ('ASIA', 'EUROPE', 'AFRICA')
  AND (genus IS NULL OR genus NOT IN ('NATION_1', 'NATION_7'))
  AND (species IS NULL OR species NOT IN ('NATION_2 SMALL'))
  AND "stateProvince" IN ('Victoria', 'Queensland', 'Overseas') AND year >= 1996 AND year <= 2000"""


@query(
    "a1_grid_cube",
    f"WITH {OCC},\n{cube_sql(decimals=2)}\nSELECT * FROM cube",
)
def a1_grid_cube(spark: SparkSession, folder: str) -> DataFrame:
    cube = plain_cube(spark, folder, 2)
    return cube.drop(*[c for c in cube.columns if c in grid.CUBE_CONSERVATION_FIELDS])


@query(
    "a1_grid_cube_enriched",
    f"WITH {ENRICHED_CUBE}\nSELECT * FROM cube",
)
def a1_grid_cube_enriched(spark: SparkSession, folder: str) -> DataFrame:
    cube = enriched_cube(spark, folder)
    return cube.drop(*[c for c in cube.columns if c.startswith("epbc_") and c != "epbc_listed_taxon"])


@query(
    "o1_cube_order",
    f"""WITH {CUBE} SELECT row_number() OVER (ORDER BY lat_bin NULLS LAST, lon_bin NULLS LAST,
      family NULLS LAST, genus NULLS LAST, species NULLS LAST, "scientificName" NULLS LAST,
      year NULLS LAST, "stateProvince" NULLS LAST) AS place, lat_bin, lon_bin, family, genus, species, "scientificName",
      year, "stateProvince", record_count FROM cube""",
)
def o1_cube_order(spark: SparkSession, folder: str) -> DataFrame:
    """The cube in its stored order, with each row's place in it."""
    placed = row_numbers(plain_cube(spark, folder), grid.CUBE_ORDER, "place")
    return placed.select("place", "lat_bin", "lon_bin", *grid.CUBE_DIMENSIONS, "record_count")


@query(
    "w6_row_numbers",
    with_occ(
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY family NULLS LAST,
        genus NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_number FROM occ"""
    ),
)
def w6_row_numbers(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = occurrences(spark, folder, [*keys, "family", "genus"])
    return row_numbers(rows, ["family", "genus", *keys]).select(*keys, "row_number")


@query(
    "p6_p7_mapped_recent_rows",
    with_occ(
        f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, year FROM occ
        WHERE {_MAPPED} AND year >= 1998"""
    ),
)
def p6_p7_mapped_recent_rows(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = occurrences(spark, folder, [*keys, "year", "decimalLatitude", "decimalLongitude"])
    return grid.since(grid.mapped_rows(rows), 1998).select(*keys, "year")


@query(
    "p5_missing_columns",
    with_occ(
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, family,
        CAST(NULL AS VARCHAR) AS "Status", CAST(NULL AS DOUBLE) AS score FROM occ"""
    ),
)
def p5_missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    from occspark.schema import ensure_columns

    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = occurrences(spark, folder, [*keys, "family"])
    return ensure_columns(rows, {"family": "string", "Status": "string", "score": "double"})


@query(
    "a3_rebin",
    f"""WITH {CUBE}
    SELECT round(lat_bin, 0) + 0.0 AS lat_bin, round(lon_bin, 0) + 0.0 AS lon_bin, family, genus, species,
      "scientificName", year, "stateProvince", {_TOTALS} FROM cube GROUP BY ALL""",
)
def a3_rebin(spark: SparkSession, folder: str) -> DataFrame:
    return grid.rebin(plain_cube(spark, folder), 0).drop(*grid.CUBE_CONSERVATION_FIELDS)


@query(
    "f13_round_coordinates",
    with_occ(
        """SELECT round("decimalLatitude", 1) + 0.0 AS lat1, round_even("decimalLatitude", 1) + 0.0 AS lat1_even,
        round("decimalLongitude", 0) + 0.0 AS lon0, count(*) AS n FROM occ GROUP BY ALL"""
    ),
)
def f13_round_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    from occspark.functions.keys import round_coordinate

    rows = occurrences(spark, folder, ["decimalLatitude", "decimalLongitude"])
    return rows.groupBy(
        round_coordinate("decimalLatitude", 1).alias("lat1"),
        round_coordinate("decimalLatitude", 1, half_even=True).alias("lat1_even"),
        round_coordinate("decimalLongitude", 0).alias("lon0"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a19_source_counts",
    with_occ(
        f"""SELECT count(*) AS source_row_count, count(*) FILTER (year >= 1998) AS since_year_row_count,
        count(*) FILTER (year >= 1998 AND {_MAPPED}) AS coordinate_row_count FROM occ"""
    ),
)
def a19_source_counts(spark: SparkSession, folder: str) -> DataFrame:
    return grid.source_counts(occurrences(spark, folder, CUBE_COLUMNS), 1998)


_INVENTORY_SQL = " UNION ALL ".join(
    f"SELECT '{label}' AS dimension, CAST(\"{column}\" AS VARCHAR) AS value FROM enriched"
    for label, column in grid.INVENTORY.items()
)


@query(
    "a20_dimension_values",
    f"""WITH {OCC},\n{REFERENCE},\n{ENRICHED}
    SELECT DISTINCT dimension, value FROM ({_INVENTORY_SQL}) WHERE value IS NOT NULL""",
)
def a20_dimension_values(spark: SparkSession, folder: str) -> DataFrame:
    return grid.dimension_values(enriched(spark, folder))


@query(
    "a20_dimension_bounds",
    with_occ(
        f"""SELECT count(*) AS row_count, count(*) FILTER ({_MAPPED}) AS mapped_row_count,
        min(year) AS min_year, max(year) AS max_year FROM occ"""
    ),
)
def a20_dimension_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return grid.dimension_bounds(occurrences(spark, folder, CUBE_COLUMNS))


def _grid_bins_sql(where: str, level: str, shown: list[str], limit: int | None = None, cube: str = CUBE) -> str:
    names = ["family", "genus", "species", "scientificName"]
    group = ["lat_bin", "lon_bin", *shown, "stateProvince"]
    selected = ", ".join(f'"{c}"' for c in group)
    blank = ", ".join(f'CAST(NULL AS VARCHAR) AS "{c}"' for c in names if c not in shown)
    order = ", ".join(f'"{c}" NULLS LAST' for c in group)
    largest = f"LIMIT {limit}" if limit else ""
    return f"""WITH {cube}, t AS (SELECT {selected}, {_TOTALS} FROM cube WHERE {where} GROUP BY ALL
      ORDER BY record_count DESC, {order} {largest})
    SELECT *{', ' + blank if blank else ''}, {_RANGE}, '{level}' AS color_level,
      coalesce("{level}", 'not supplied') AS color_value FROM t"""


@query("a21_grid_bins_by_family", _grid_bins_sql("TRUE", "family", ["family"]))
def a21_grid_bins_by_family(spark: SparkSession, folder: str) -> DataFrame:
    return slicer.grid_bins(plain_cube(spark, folder), SlicerState())


@query(
    "p9_p10_p11_a21_filtered_bins",
    _grid_bins_sql(MIXED_SQL, "scientificName", ["family", "genus", "species", "scientificName"]),
)
def p9_p10_p11_a21_filtered_bins(spark: SparkSession, folder: str) -> DataFrame:
    return slicer.grid_bins(plain_cube(spark, folder), MIXED)


@query(
    "o2_top_bins_by_genus",
    _grid_bins_sql("family IN ('ASIA')", "genus", ["family", "genus"], 500),
)
def o2_top_bins_by_genus(spark: SparkSession, folder: str) -> DataFrame:
    return slicer.grid_bins(
        plain_cube(spark, folder), SlicerState(include_families=["ASIA"]), limit=500
    )


@query(
    "p12_national_status_bins",
    _grid_bins_sql(
        "\"Status\" IN ('Endangered', 'Vulnerable')", "species", ["family", "genus", "species"],
        cube=ENRICHED_CUBE,
    ),
)
def p12_national_status_bins(spark: SparkSession, folder: str) -> DataFrame:
    state = SlicerState(
        conservation_scope="national", include_conservation_statuses=["Endangered", "Vulnerable"]
    )
    return slicer.grid_bins(enriched_cube(spark, folder), state)


@query(
    "p12_state_status_options",
    f"""WITH {ENRICHED_CUBE} SELECT coalesce(species, 'not supplied') AS value,
      CAST(sum(record_count) AS BIGINT) AS record_count FROM cube
    WHERE state_status_level IN ('Rare', 'Endangered', 'Presumed Extinct') GROUP BY 1""",
)
def p12_state_status_options(spark: SparkSession, folder: str) -> DataFrame:
    state = SlicerState(
        conservation_scope="state",
        include_conservation_statuses=["Rare", "Endangered", "Presumed Extinct"],
    )
    return slicer.color_options(enriched_cube(spark, folder), state)


@query(
    "p13_skip_one_dimension",
    f"""WITH {CUBE} SELECT "stateProvince", CAST(sum(record_count) AS BIGINT) AS record_count FROM cube
    WHERE {MIXED_SQL.replace('''AND "stateProvince" IN ('Victoria', 'Queensland', 'Overseas') ''', '')}
    GROUP BY ALL""",
)
def p13_skip_one_dimension(spark: SparkSession, folder: str) -> DataFrame:
    rows = plain_cube(spark, folder).where(slicer.predicate(MIXED, skip="stateProvince"))
    return rows.groupBy("stateProvince").agg(F.sum("record_count").alias("record_count"))


@query(
    "a22_color_options",
    f"""WITH {CUBE} SELECT coalesce(genus, 'not supplied') AS value,
      CAST(sum(record_count) AS BIGINT) AS record_count FROM cube WHERE family IN ('ASIA', 'EUROPE')
    GROUP BY 1 ORDER BY record_count DESC, value LIMIT 5""",
)
def a22_color_options(spark: SparkSession, folder: str) -> DataFrame:
    state = SlicerState(include_families=["ASIA", "EUROPE"])
    return slicer.color_options(plain_cube(spark, folder), state, limit=5)


def _share_sql(focus: str, level: str, shown: list[str], limit: int, n: int) -> str:
    """A value's part of every cell it occurs in: all values of a cell are one row each, seen through windows."""
    bounds = ", ".join(f'min("{c}") AS "least_{c}", max("{c}") AS "most_{c}"' for c in shown)
    one = {c: f"""CASE WHEN "least_{c}" <> "most_{c}" THEN 'multiple' ELSE "least_{c}" END""" for c in shown}
    columns = ", ".join(
        f'{one.get(c, "CAST(NULL AS VARCHAR)")} AS "{c}"' for c in ("family", "genus", "species", "scientificName", "stateProvince")
    )
    return f"""WITH {CUBE}, valued AS (
      SELECT round(lat_bin, 0) + 0.0 AS lat_bin, round(lon_bin, 0) + 0.0 AS lon_bin, coalesce({level}, 'not supplied') AS v,
        CAST(sum(record_count) AS BIGINT) AS n, {bounds}
      FROM cube WHERE family IN ('ASIA', 'EUROPE') GROUP BY 1, 2, 3),
    seen AS (SELECT *, CAST(sum(n) OVER cell AS BIGINT) AS total_cell_records, list({{'less': -n, 'v': v}}) OVER cell AS others
      FROM valued WINDOW cell AS (PARTITION BY lat_bin, lon_bin))
    SELECT lat_bin, lon_bin, {columns}, n AS record_count, total_cell_records, n::DOUBLE / total_cell_records AS share,
      '{level}' AS color_level, v AS color_value, array_to_string(list_transform(list_sort(others)[1:{n}],
        lambda o: o.v || ': ' || format('{{:,}}', -o.less)), chr(10)) AS composition_text
    FROM seen WHERE v = '{focus}' QUALIFY row_number() OVER (ORDER BY n DESC, lat_bin, lon_bin) <= {limit}"""


@query(
    "a23_a24_w3_share_bins",
    _share_sql("NATION_8", "genus", ["family", "genus", "stateProvince"], 250000, 3),
)
def a23_a24_w3_share_bins(spark: SparkSession, folder: str) -> DataFrame:
    state = SlicerState(include_families=["ASIA", "EUROPE"])
    return slicer.share_bins(
        plain_cube(spark, folder), state, "NATION_8", decimals=0, top_competitors=3
    )


@query("j7_focus_cells_limited", _share_sql("not supplied", "genus", ["family", "genus", "stateProvince"], 40, 5))
def j7_focus_cells_limited(spark: SparkSession, folder: str) -> DataFrame:
    state = SlicerState(include_families=["ASIA", "EUROPE"])
    return slicer.share_bins(plain_cube(spark, folder), state, "not supplied", limit=40, decimals=0)


@query(
    "o6_w4_j6_all_share_bins",
    f"""WITH {CUBE}, per AS (SELECT lat_bin, lon_bin, coalesce(genus, 'not supplied') AS v,
        CAST(sum(record_count) AS BIGINT) AS record_count FROM cube WHERE family IN ('ASIA', 'EUROPE') GROUP BY ALL),
    whole AS (SELECT *, CAST(sum(record_count) OVER (PARTITION BY lat_bin, lon_bin) AS BIGINT) AS total_cell_records,
        CAST(sum(record_count) OVER (PARTITION BY v) AS BIGINT) AS category_total_records FROM per),
    s AS (SELECT *, record_count::DOUBLE / total_cell_records AS share FROM whole
        QUALIFY dense_rank() OVER (ORDER BY category_total_records DESC, v) <= 6
        AND row_number() OVER (PARTITION BY v ORDER BY record_count DESC, lat_bin, lon_bin) <= 50)
    SELECT lat_bin, lon_bin, record_count, total_cell_records, category_total_records, share,
      'genus' AS color_level, v AS color_value, format('{{:.1f}}%', share * 100) AS share_percent,
      v || ': ' || format('{{:,}}', record_count) || ' / ' || format('{{:,}}', total_cell_records)
        || ' (' || format('{{:.1f}}%', share * 100) || ')' AS composition_text FROM s""",
)
def o6_w4_j6_all_share_bins(spark: SparkSession, folder: str) -> DataFrame:
    return slicer.all_share_bins(
        plain_cube(spark, folder),
        SlicerState(include_families=["ASIA", "EUROPE"]),
        limit_per_category=50,
        max_categories=6,
    )


# The tail of a cell is what its two leading values leave of the cell's total.
_MARKER_CTES = f"""{CUBE}, per AS (SELECT round(lat_bin, 0) + 0.0 AS lat_bin, round(lon_bin, 0) + 0.0 AS lon_bin,
        coalesce(genus, 'not supplied') AS color_value, CAST(sum(record_count) AS BIGINT) AS record_count
        FROM cube WHERE family IN ('ASIA', 'EUROPE', 'AFRICA') GROUP BY ALL),
    whole AS (SELECT *, CAST(sum(record_count) OVER (PARTITION BY lat_bin, lon_bin) AS BIGINT) AS total_record_count,
        row_number() OVER (PARTITION BY lat_bin, lon_bin ORDER BY record_count DESC, color_value) AS category_order FROM per),
    leading_two AS (SELECT * FROM whole WHERE category_order <= 2
        QUALIFY dense_rank() OVER (ORDER BY total_record_count DESC, lat_bin, lon_bin) <= 300),
    flat AS (SELECT lat_bin, lon_bin, total_record_count, color_value, record_count, category_order FROM leading_two
        UNION ALL SELECT lat_bin, lon_bin, any_value(total_record_count), 'Other',
        CAST(any_value(total_record_count) - sum(record_count) AS BIGINT), 3 FROM leading_two
        GROUP BY lat_bin, lon_bin HAVING any_value(total_record_count) > sum(record_count))"""


@query(
    "o3_o4_composition_rows",
    f"""WITH {_MARKER_CTES} SELECT *, record_count::DOUBLE / total_record_count AS share, 'genus' AS color_level
    FROM flat""",
)
def o3_o4_composition_rows(spark: SparkSession, folder: str) -> DataFrame:
    state = SlicerState(include_families=["ASIA", "EUROPE", "AFRICA"])
    return slicer.composition_rows(plain_cube(spark, folder), state, limit=300, decimals=0, top=2)


@query(
    "o5_composition_markers",
    f"""WITH {_MARKER_CTES} SELECT lat_bin, lon_bin, total_record_count, 'genus' AS color_level,
      string_agg(color_value || ': ' || format('{{:,}}', record_count) || ' ('
        || format('{{:.1f}}%', record_count::DOUBLE / total_record_count * 100) || ')', chr(10)
        ORDER BY category_order, color_value) AS composition_text FROM flat GROUP BY ALL""",
)
def o5_composition_markers(spark: SparkSession, folder: str) -> DataFrame:
    state = SlicerState(include_families=["ASIA", "EUROPE", "AFRICA"])
    markers = slicer.composition_markers(
        plain_cube(spark, folder), state, limit=300, decimals=0, top=2
    )
    return markers.drop("composition")


@query(
    "j5_cell_shares",
    f"""WITH {CUBE}, c AS (SELECT lat_bin, lon_bin, family, CAST(sum(record_count) AS BIGINT) AS n FROM cube GROUP BY ALL),
    t AS (SELECT lat_bin, lon_bin, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY ALL)
    SELECT lat_bin, lon_bin, family, n, total, n::DOUBLE / total AS share FROM c JOIN t USING (lat_bin, lon_bin)""",
)
def j5_cell_shares(spark: SparkSession, folder: str) -> DataFrame:
    shares = slicer.cell_shares(plain_cube(spark, folder), "family")
    names = {"color_value": "family", "record_count": "n", "total_record_count": "total"}
    return shares.withColumnsRenamed(names)


@query(
    "o5_composition_array",
    f"""WITH {_MARKER_CTES} SELECT lat_bin, lon_bin, row_number() OVER (PARTITION BY lat_bin, lon_bin
      ORDER BY category_order, color_value) AS place, color_value AS value, record_count,
      record_count::DOUBLE / total_record_count AS share FROM flat""",
)
def o5_composition_array(spark: SparkSession, folder: str) -> DataFrame:
    """The nested compositions of cells, element by element."""
    state = SlicerState(include_families=["ASIA", "EUROPE", "AFRICA"])
    markers = slicer.composition_markers(plain_cube(spark, folder), state, limit=300, decimals=0, top=2)
    rows = markers.select("lat_bin", "lon_bin", F.posexplode("composition").alias("place", "c"))
    return rows.select("lat_bin", "lon_bin", (F.col("place") + 1).cast("long").alias("place"), "c.*")


@query(
    "a25_matching_records",
    f"WITH {CUBE} SELECT CAST(coalesce(sum(record_count), 0) AS BIGINT) AS record_count FROM cube WHERE {MIXED_SQL}",
)
def a25_matching_records(spark: SparkSession, folder: str) -> DataFrame:
    return slicer.matching_records(plain_cube(spark, folder), MIXED)


@query(
    "a25_matching_records_none",
    f"""WITH {CUBE} SELECT CAST(coalesce(sum(record_count), 0) AS BIGINT) AS record_count FROM cube
    WHERE family IN ('NOWHERE')""",
)
def a25_matching_records_none(spark: SparkSession, folder: str) -> DataFrame:
    return slicer.matching_records(
        plain_cube(spark, folder), SlicerState(include_families=["NOWHERE"])
    )


_OPTIONS_SQL = " UNION ALL ".join(
    f"SELECT '{option}' AS option, CAST(\"{column}\" AS VARCHAR) AS value FROM kept"
    for option, column in slicer.OPTION_COLUMNS.items()
)


@query(
    "a26_option_values",
    f"""WITH {ENRICHED_CUBE}, kept AS (SELECT * FROM cube WHERE {MIXED_SQL})
    SELECT DISTINCT option, value FROM ({_OPTIONS_SQL}) WHERE value IS NOT NULL""",
)
def a26_option_values(spark: SparkSession, folder: str) -> DataFrame:
    return slicer.option_values(enriched_cube(spark, folder), MIXED)


def _stored_cube(spark: SparkSession, folder: str) -> str:
    path = f"{checkpoint_dir(spark)}/cube-{uuid.uuid4().hex}"
    # As many files as a shuffle has partitions, and some even for a small cube.
    files = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    clustered.write_clustered(enriched_cube(spark, folder), path, files=files)
    return path


@query(
    "x8_stored_options",
    f"""WITH {ENRICHED_CUBE}, kept AS (SELECT * FROM cube)
    SELECT DISTINCT option, value FROM ({_OPTIONS_SQL}) WHERE value IS NOT NULL""",
)
def x8_stored_options(spark: SparkSession, folder: str) -> DataFrame:
    """All option lists of a stored cube, from its inventory."""
    return clustered.stored_options(spark, _stored_cube(spark, folder), SlicerState())


@query(
    "x8_stored_slice",
    f"""WITH {ENRICHED_CUBE} SELECT family, genus, year, CAST(sum(record_count) AS BIGINT) AS record_count FROM cube
    WHERE family = 'EUROPE' AND genus IN ('NATION_8', 'NATION_3') AND year >= 1996 GROUP BY ALL""",
)
def x8_stored_slice(spark: SparkSession, folder: str) -> DataFrame:
    """A narrow slice of a stored cube, which must not read all of its files."""
    path = _stored_cube(spark, folder)
    state = SlicerState(include_families=["EUROPE"], include_genera=["NATION_8", "NATION_3"], year_min=1996)
    rows = clustered.read_slice(spark, path, state)
    if len(rows.inputFiles()) >= len(tables.read_table(spark, f"{path}/rows").inputFiles()):
        raise AssertionError("The slice reads every file.")
    return rows.groupBy("family", "genus", "year").agg(F.sum("record_count").alias("record_count"))


def _cascade_sql() -> str:
    conservation = "\"Status\" IN ('Endangered', 'Vulnerable')"
    family, genus = "family IN ('ASIA', 'EUROPE')", "(genus IS NULL OR genus NOT IN ('NATION_8'))"
    state = "\"stateProvince\" IN ('Victoria', 'Tasmania')"
    levels = [
        ("national_statuses", "Status", "TRUE"),
        ("state_status_levels", "state_status_level", "TRUE"),
        ("families", "family", conservation),
        ("genera", "genus", f"{conservation} AND {family}"),
        ("species", "species", f"{conservation} AND {family} AND {genus}"),
        ("states", "stateProvince", f"{conservation} AND {family} AND {genus}"),
        ("years", "year", f"{conservation} AND {family} AND {genus} AND {state}"),
    ]
    parts = " UNION ".join(
        f"SELECT '{o}' AS option, CAST(\"{c}\" AS VARCHAR) AS value FROM cube WHERE {w} AND \"{c}\" IS NOT NULL"
        for o, c, w in levels
    )
    return f"WITH {ENRICHED_CUBE} {parts}"


@query("x12_cascading_options", _cascade_sql())
def x12_cascading_options(spark: SparkSession, folder: str) -> DataFrame:
    state = SlicerState(
        include_families=["ASIA", "EUROPE"],
        exclude_genera=["NATION_8"],
        include_states=["Victoria", "Tasmania"],
        conservation_scope="national",
        include_conservation_statuses=["Endangered", "Vulnerable"],
    )
    return slicer.cascading_options(enriched_cube(spark, folder), state)


@query(
    "a27_year_summary",
    f"""WITH {CUBE} SELECT year, CAST(sum(record_count) AS BIGINT) AS record_count FROM cube
    WHERE (genus IS NULL OR genus NOT IN ('NATION_1')) GROUP BY year""",
)
def a27_year_summary(spark: SparkSession, folder: str) -> DataFrame:
    return slicer.year_summary(plain_cube(spark, folder), SlicerState(exclude_genera=["NATION_1"]))


@query(
    "f23_f24_f25_labels",
    f"""WITH {CUBE}, t AS (SELECT coalesce(species, 'not supplied') AS species, CAST(sum(record_count) AS BIGINT) AS n,
      min(year) AS min_year, max(year) AS max_year FROM cube GROUP BY 1)
    SELECT species, {_RANGE}, format('{{:,}}', n * 1000) AS n_text,
      format('{{:.1f}}%', n::DOUBLE / 7000 * 100) AS share_text FROM t""",
)
def f23_f24_f25_labels(spark: SparkSession, folder: str) -> DataFrame:
    from occspark.functions.text import count_text, null_label, percent_text, year_range

    totals = (
        plain_cube(spark, folder)
        .groupBy(null_label("species").alias("species"))
        .agg(F.sum("record_count").alias("n"), F.min("year").alias("lo"), F.max("year").alias("hi"))
    )
    return totals.select(
        "species",
        year_range(F.col("lo"), F.col("hi")).alias("year_range"),
        count_text(F.col("n") * 1000).alias("n_text"),
        percent_text(F.col("n").cast("double") / 7000).alias("share_text"),
    )
