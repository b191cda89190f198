"""Area queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occspark.operators import areas, slicer
from occspark.operators.grid import CUBE_CONSERVATION_FIELDS, CUBE_DIMENSIONS
from occspark.operators.slicer import SlicerState
from occspark.sources.star_view import LINE_KEY, occurrences, read_table
from verification.inputs import (
    AREA_LEVEL,
    AREAS,
    CUBE_COLUMNS,
    ENRICHED,
    OCC,
    REFERENCE,
    boundaries,
    enriched,
    with_occ,
)
from verification.registry import query

_CODE, _NAME = "sa3_code_2021", "sa3_name_2021"
_KEYS = list(LINE_KEY)


def _cube(spark: SparkSession, folder: str) -> DataFrame:
    return areas.area_cube(
        occurrences(spark, folder, CUBE_COLUMNS), boundaries(spark, folder), AREA_LEVEL
    )


@query(
    "s16_boundaries",
    f"""WITH {OCC},\n{AREAS}
    SELECT sa3_code_2021, sa3_name_2021, min(least(x1, x2)) AS min_lon, max(greatest(x1, x2)) AS max_lon,
      min(least(y1, y2)) AS min_lat, max(greatest(y1, y2)) AS max_lat, count(*) AS edges,
      any_value((r - x) * (t - y)) AS area_albers_sqkm
    FROM edges GROUP BY 1, 2""",
)
def s16_boundaries(spark: SparkSession, folder: str) -> DataFrame:
    return boundaries(spark, folder).select(
        _CODE,
        _NAME,
        "min_lon",
        "max_lon",
        "min_lat",
        "max_lat",
        F.size("edges").cast("long").alias("edges"),
        "area_albers_sqkm",
    )


@query(
    "j9_w2_assign_areas",
    with_occ(
        f"""SELECT {', '.join(_KEYS)}, sa3_code_2021, sa3_name_2021 FROM occ
        JOIN located ON "decimalLongitude" = px AND "decimalLatitude" = py""",
        AREAS,
    ),
)
def j9_w2_assign_areas(spark: SparkSession, folder: str) -> DataFrame:
    points = occurrences(spark, folder, [*_KEYS, "decimalLatitude", "decimalLongitude"])
    assigned = areas.assign_areas(points, boundaries(spark, folder), AREA_LEVEL)
    return assigned.select(*_KEYS, _CODE, _NAME)


@query("a2_x7_area_cube", with_occ("SELECT * FROM area_cube", AREAS))
def a2_x7_area_cube(spark: SparkSession, folder: str) -> DataFrame:
    return _cube(spark, folder).drop(*CUBE_CONSERVATION_FIELDS)


def _combs(spark: SparkSession, folder: str) -> DataFrame:
    """A polygon per customer: a base line and teeth above it, some of them wide. Overlaps are common."""
    k = F.col("c_custkey")
    x, y, teeth, step = 113 + k * 7 % 340 / 10, -44 + k * 11 % 260 / 10, 2 + k % 5, 1 + k % 7
    tooth = F.transform(
        F.sequence(F.lit(0).cast("long"), 2 * teeth),
        lambda i: F.struct(
            (x + (2 * teeth - i) * step / 10).alias("x"), (y + F.when(i % 2 == 0, 0.2).otherwise(1.5)).alias("y")
        ),
    )
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    right = x + 2 * teeth * step / 10
    ring = F.concat(F.array(corner(x, y), corner(right, y)), tooth, F.array(corner(x, y)))
    texts = F.transform(ring, lambda p: F.concat(F.lit("["), p["x"].cast("string"), F.lit(","), p["y"].cast("string"), F.lit("]")))
    geometry = F.concat(F.lit('{"type":"Polygon","coordinates":[['), F.array_join(texts, ","), F.lit("]]}"))
    features = read_table(spark, folder, "customer").select(
        F.lpad(k.cast("string"), 9, "0").alias("SA1_CODE21"), geometry.alias("geometry")
    )
    return areas.boundary_table(features, "SA1")


_COMBS = """comb AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS code, 2 + c_custkey % 5 AS teeth, 1 + c_custkey % 7 AS step,
    113 + c_custkey * 7 % 340 / 10.0::DOUBLE AS x, -44 + c_custkey * 11 % 260 / 10.0::DOUBLE AS y FROM customer),
tip AS (SELECT code, x, y, i, x + (2 * teeth - i) * step / 10.0::DOUBLE AS tx,
    y + CASE WHEN i % 2 = 0 THEN 0.2::DOUBLE ELSE 1.5::DOUBLE END AS ty, x + 2 * teeth * step / 10.0::DOUBLE AS r
  FROM (SELECT *, unnest(range(0, 2 * teeth + 1)) AS i FROM comb)),
comb_edge AS (
  SELECT code, x AS x1, y AS y1, r AS x2, y AS y2 FROM tip WHERE i = 0
  UNION ALL SELECT code, r, y, tx, ty FROM tip WHERE i = 0
  UNION ALL SELECT a.code, a.tx, a.ty, b.tx, b.ty FROM tip a JOIN tip b ON a.code = b.code AND b.i = a.i + 1
  UNION ALL SELECT code, arg_max(tx, i), arg_max(ty, i), any_value(x), any_value(y) FROM tip GROUP BY code),
comb_box AS (SELECT code, min(least(x1, x2)) AS l, max(greatest(x1, x2)) AS r, min(least(y1, y2)) AS b, max(greatest(y1, y2)) AS t
  FROM comb_edge GROUP BY code),
spot AS (SELECT DISTINCT "decimalLongitude" AS px, "decimalLatitude" AS py FROM occ
  WHERE "decimalLatitude" IS NOT NULL AND "decimalLongitude" IS NOT NULL),
close AS (SELECT px, py, code FROM spot JOIN comb_box ON px BETWEEN l AND r AND py BETWEEN b AND t),
hit AS (SELECT px, py, code FROM close JOIN comb_edge USING (code) GROUP BY px, py, code
  HAVING count(*) FILTER ((y1 > py) <> (y2 > py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1)) % 2 = 1
    OR bool_or((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) = 0 AND px BETWEEN least(x1, x2) AND greatest(x1, x2)
      AND py BETWEEN least(y1, y2) AND greatest(y1, y2))),
comb_of AS (SELECT px, py, min(code) AS sa1_code_2021 FROM hit GROUP BY px, py)"""


def _assign_combs(spark: SparkSession, folder: str, in_place: bool) -> DataFrame:
    points = occurrences(spark, folder, [*_KEYS, "decimalLatitude", "decimalLongitude"])
    assigned = areas.assign_areas(points, _combs(spark, folder), "SA1", in_place=in_place)
    return assigned.select(*_KEYS, "sa1_code_2021")


_COMB_SQL = with_occ(
    f"""SELECT {', '.join(_KEYS)}, sa1_code_2021 FROM occ
    JOIN comb_of ON "decimalLongitude" = px AND "decimalLatitude" = py""",
    _COMBS,
)


@query("j9_by_place", _COMB_SQL)
def j9_by_place(spark: SparkSession, folder: str) -> DataFrame:
    return _assign_combs(spark, folder, in_place=False)


@query("j9_in_place_crowded", _COMB_SQL)
def j9_in_place_crowded(spark: SparkSession, folder: str) -> DataFrame:
    return _assign_combs(spark, folder, in_place=True)


def _comb_cube(spark: SparkSession, folder: str, level: str) -> DataFrame:
    """The enriched rows over the customers' polygons, as boundaries of any size are joined."""
    code, name = areas.area_columns(level)
    shapes = _combs(spark, folder).withColumnsRenamed({"sa1_code_2021": code, "sa1_name_2021": name})
    return areas.area_cube(enriched(spark, folder), shapes, level, in_place=False)


def _comb_cube_sql(level: str) -> str:
    code, name = areas.area_columns(level)
    # The reference of these queries lists no addresses.
    dims = ", ".join(
        f'CAST(NULL AS VARCHAR) AS "{c}"' if c.endswith("_url") else f'"{c}"'
        for c in (*CUBE_DIMENSIONS, *CUBE_CONSERVATION_FIELDS)
    )
    return f"""WITH {OCC},\n{REFERENCE},\n{ENRICHED},\n{_COMBS}
    SELECT sa1_code_2021 AS {code}, sa1_code_2021 AS {name}, {dims}, count(*) AS record_count,
      count(DISTINCT "scientificName") AS distinct_scientific_names,
      count(DISTINCT "taxonConceptID") AS distinct_taxon_concepts, min(year) AS min_year, max(year) AS max_year
    FROM enriched JOIN comb_of ON "decimalLongitude" = px AND "decimalLatitude" = py
    WHERE year >= 1950 GROUP BY ALL"""


@query("a2_by_place", _comb_cube_sql("SA1"))
def a2_by_place(spark: SparkSession, folder: str) -> DataFrame:
    return _comb_cube(spark, folder, "SA1")


@query("a2_x7_enriched_sa2", _comb_cube_sql("SA2"))
def a2_x7_enriched_sa2(spark: SparkSession, folder: str) -> DataFrame:
    return _comb_cube(spark, folder, "SA2")


@query(
    "j7_occupied_boundaries",
    with_occ(
        """SELECT sa3_code_2021, sa3_name_2021, (r - x) * (t - y) AS area_albers_sqkm FROM box
        WHERE sa3_code_2021 IN (SELECT sa3_code_2021 FROM area_cube)""",
        AREAS,
    ),
)
def j7_occupied_boundaries(spark: SparkSession, folder: str) -> DataFrame:
    rows = boundaries(spark, folder)
    occupied = areas.occupied_boundaries(rows, _cube(spark, folder), AREA_LEVEL)
    return occupied.select(_CODE, _NAME, "area_albers_sqkm")


@query(
    "a20_area_counts",
    with_occ(
        """SELECT c AS coordinate_row_count, m AS matched_record_count, o AS occupied_area_count,
        b AS boundary_area_count, c - m AS unmatched_coordinate_count FROM (SELECT
          (SELECT count(*) FROM occ WHERE year >= 1950 AND "decimalLatitude" IS NOT NULL
            AND "decimalLongitude" IS NOT NULL) AS c,
          (SELECT CAST(sum(record_count) AS BIGINT) FROM area_cube) AS m,
          (SELECT count(DISTINCT sa3_code_2021) FROM area_cube) AS o, (SELECT count(*) FROM box) AS b)""",
        AREAS,
    ),
)
def a20_area_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, CUBE_COLUMNS)
    return areas.area_counts(rows, _cube(spark, folder), boundaries(spark, folder), AREA_LEVEL)


def _composition_sql(level: str, where: str, limit: int) -> str:
    return f"""per AS (SELECT sa3_code_2021 AS code, coalesce({level}, 'not supplied') AS v,
        CAST(sum(record_count) AS BIGINT) AS n FROM area_cube WHERE {where} GROUP BY ALL),
    whole AS (SELECT *, CAST(sum(n) OVER (PARTITION BY code) AS BIGINT) AS total_record_count,
        row_number() OVER (PARTITION BY code ORDER BY n DESC, v) AS rn FROM per),
    rk AS (SELECT * FROM whole QUALIFY dense_rank() OVER (ORDER BY total_record_count DESC, code) <= {limit})"""


@query(
    "o7_j8_area_compositions",
    with_occ(
        """SELECT code AS area_code_2021, sa3_name_2021 AS area_name_2021, 'SA3' AS area_level, total_record_count,
        'family' AS color_level, string_agg(v || ': ' || format('{:,}', n) || ' ('
          || format('{:.1f}%', n::DOUBLE / total_record_count * 100) || ')', chr(10) ORDER BY rn) AS composition_text,
        arg_min(v, rn) AS dominant_value, arg_min(n, rn) AS dominant_record_count,
        arg_min(n::DOUBLE / total_record_count, rn) AS dominant_share
        FROM rk JOIN box ON code = sa3_code_2021 GROUP BY ALL""",
        AREAS,
        _composition_sql("family", '"stateProvince" IN (\'Victoria\', \'Queensland\')', 20),
    ),
)
def o7_j8_area_compositions(spark: SparkSession, folder: str) -> DataFrame:
    state = SlicerState(include_states=["Victoria", "Queensland"])
    shapes = slicer.area_compositions(
        _cube(spark, folder), boundaries(spark, folder), state, AREA_LEVEL, limit=20
    )
    return shapes.drop("composition", "geometry_geojson")


@query(
    "o7_composition_array",
    with_occ(
        """SELECT code AS area_code_2021, rn AS place, v AS value, n AS record_count,
        n::DOUBLE / total_record_count AS share FROM rk JOIN box ON code = sa3_code_2021""",
        AREAS,
        _composition_sql("genus", '"stateProvince" IN (\'Victoria\', \'Queensland\') AND family = \'ASIA\'', 20),
    ),
)
def o7_composition_array(spark: SparkSession, folder: str) -> DataFrame:
    """The nested compositions of areas, element by element."""
    state = SlicerState(include_states=["Victoria", "Queensland"], include_families=["ASIA"])
    shapes = slicer.area_compositions(_cube(spark, folder), boundaries(spark, folder), state, AREA_LEVEL, limit=20)
    rows = shapes.select("area_code_2021", F.posexplode("composition").alias("place", "c"))
    return rows.select("area_code_2021", (F.col("place") + 1).cast("long").alias("place"), "c.*")


@query(
    "w5_o4_area_composition_top",
    with_occ(
        """SELECT code AS area_code_2021, sa3_name_2021 AS area_name_2021, total_record_count, color_value,
        record_count, category_order FROM (SELECT code, total_record_count,
          CASE WHEN rn <= 3 THEN v ELSE 'Other' END AS color_value, CAST(sum(n) AS BIGINT) AS record_count,
          min(least(rn, 4)) AS category_order FROM rk GROUP BY ALL) JOIN box ON code = sa3_code_2021""",
        AREAS,
        _composition_sql("species", "family IN ('ASIA', 'EUROPE') AND genus IN ('NATION_8', 'NATION_2', 'NATION_3')", 500),
    ),
)
def w5_o4_area_composition_top(spark: SparkSession, folder: str) -> DataFrame:
    state = SlicerState(
        include_families=["ASIA", "EUROPE"], include_genera=["NATION_8", "NATION_2", "NATION_3"]
    )
    rows = slicer.area_composition_rows(
        _cube(spark, folder), boundaries(spark, folder), state, AREA_LEVEL, top=3
    )
    return rows.select(
        "area_code_2021",
        "area_name_2021",
        "total_record_count",
        "color_value",
        "record_count",
        "category_order",
    )


@query(
    "x13_hidden_records",
    with_occ(
        """SELECT CAST(sum(n) FILTER (rk <= 5) AS BIGINT) AS visible_records, CAST(sum(n) AS BIGINT) AS matching_records,
        CAST(sum(n) FILTER (rk > 5) AS BIGINT) AS hidden_records FROM (SELECT *, row_number() OVER (ORDER BY n DESC, code) AS rk
          FROM (SELECT sa3_code_2021 AS code, sum(record_count) AS n FROM area_cube WHERE year >= 1998 GROUP BY 1))""",
        AREAS,
    ),
)
def x13_hidden_records(spark: SparkSession, folder: str) -> DataFrame:
    return slicer.hidden_records(
        _cube(spark, folder), boundaries(spark, folder), SlicerState(year_min=1998), AREA_LEVEL, 5
    )


def _geometry_sql(number: str, head: str, tail: str) -> str:
    """The GeoJSON text of a box, with its coordinates printed as ``number``."""

    def ring(*points: str) -> str:
        texts = []
        for point in [*points, points[0]]:
            px, py = (f"CAST({c} AS {number})" for c in point.split(","))
            texts.append(f"'[' || {px} || ',' || {py} || ']'")
        return "'[' || " + " || ',' || ".join(texts) + " || ']'"

    hole = ring("x + 1,y + 1", "x + 2,y + 1", "x + 2,y + 2", "x + 1,y + 2")
    outer = ring("x,y", "r,y", "r,t", "x,t")
    return f"""'{head}' || CASE WHEN triangle THEN {ring('x,y', 'r,y', 'r,t')} ELSE {outer} END
      || CASE WHEN holed THEN ',' || {hole} ELSE '' END || '{tail}'"""


# Every corner of these shapes is farther from its neighbours' line than the tolerance,
# so thinning keeps all of them.
_PLAIN = _geometry_sql("DOUBLE", '{"type":"Polygon","coordinates":[', "]}")
_SORTED = _geometry_sql("BIGINT", '{"coordinates":[', '],"type":"Polygon"}')


@query(
    "x14_simplified_boundaries",
    with_occ(
        f"""SELECT sa3_code_2021, sa3_name_2021, area_albers_sqkm, geometry_geojson FROM (SELECT *,
          (r - x) * (t - y) AS area_albers_sqkm, {_PLAIN} AS geometry_geojson FROM box)
        WHERE sa3_code_2021 IN (SELECT sa3_code_2021 FROM area_cube)""",
        AREAS,
    ),
)
def x14_simplified_boundaries(spark: SparkSession, folder: str) -> DataFrame:
    rows = boundaries(spark, folder)
    occupied = areas.occupied_boundaries(rows, _cube(spark, folder), AREA_LEVEL)
    return areas.simplify_boundaries(occupied).select(
        _CODE, _NAME, "area_albers_sqkm", "geometry_geojson"
    )


@query(
    "s17_area_features",
    with_occ(
        f"""SELECT '{{"type":"Feature","geometry":' || {_SORTED} || ',"properties":{{"sa3_code_2021":"' || sa3_code_2021
          || '","record_count":' || n || '}}}}' AS feature
        FROM box JOIN (SELECT sa3_code_2021, CAST(sum(record_count) AS BIGINT) AS n FROM area_cube GROUP BY 1)
          USING (sa3_code_2021)""",
        AREAS,
    ),
)
def s17_area_features(spark: SparkSession, folder: str) -> DataFrame:
    totals = _cube(spark, folder).groupBy(_CODE).agg(F.sum("record_count").alias("record_count"))
    shapes = boundaries(spark, folder).select(_CODE, "geometry_geojson")
    return areas.geojson_features(totals.join(shapes, [_CODE]))
