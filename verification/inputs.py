"""Inputs that both Spark and the SQL side derive from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occspark.operators.areas import boundary_table
from occspark.operators.conservation import annotate_conservation
from occspark.operators.grid import grid_cube
from occspark.sources.star_view import occurrences, read_table

CUBE_COLUMNS = (
    "family genus species scientificName year stateProvince taxonConceptID decimalLatitude "
    "decimalLongitude"
).split()

# --- SQL: the occurrence view -----------------------------------------------------

OCC = """occ AS (
  SELECT replace(lower(p_brand), '#', '_') AS query_species_key,
    p_brand AS query_scientific_name,
    CASE WHEN l_linenumber % 4 = 0 THEN NULL WHEN l_linenumber = 7 THEN ''
         ELSE 'u' || l_orderkey END AS uuid,
    n_name || ' ' || p_type || ' ' || p_brand AS "scientificName",
    CASE WHEN l_linenumber <> 3 THEN n_name || ' ' || p_type || ' ' || p_name END AS "raw_scientificName",
    p_name AS "vernacularName",
    CASE l_linenumber WHEN 1 THEN 'genus' WHEN 2 THEN 'subspecies' ELSE 'species' END AS "taxonRank",
    CASE WHEN l_suppkey % 7 <> 0 THEN 'tc' || (l_partkey % 50) END AS "taxonConceptID",
    r_name AS classs, 'Order ' || p_type AS "order", r_name AS family,
    CASE WHEN l_partkey % 13 <> 0 THEN n_name END AS genus,
    CASE WHEN l_partkey % 11 <> 0 THEN n_name || ' ' || p_type END AS species,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'New South Wales' WHEN 'BUILDING' THEN 'Victoria'
      WHEN 'FURNITURE' THEN 'Queensland' WHEN 'HOUSEHOLD' THEN 'Tasmania'
      WHEN 'MACHINERY' THEN 'Overseas' END AS "stateProvince",
    CASE WHEN l_orderkey % 17 <> 0 THEN (l_partkey * 37 % 3400 - 4400) / 100.0::DOUBLE END AS "decimalLatitude",
    CASE WHEN l_orderkey % 17 <> 0 THEN (l_suppkey * 53 % 4000 + 11300) / 100.0::DOUBLE END AS "decimalLongitude",
    epoch_ms(l_shipdate) AS "eventDate",
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "eventDate_iso",
    CAST(year(l_shipdate) AS BIGINT) AS year,
    CASE WHEN l_linenumber <> 6 THEN strftime(l_shipdate, '%m') END AS month,
    strftime(l_shipdate, '%d') AS day,
    CASE WHEN l_linenumber <> 5 THEN l_returnflag END AS "basisOfRecord",
    l_linestatus AS "raw_basisOfRecord",
    'dr' || l_suppkey AS "dataResourceUid", 'rn' || l_partkey AS "recordNumber",
    l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def with_occ(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([OCC, *ctes]) + "\n" + body


# --- the conservation reference: one row per nation --------------------------------

_STATE_STATUS = {
    0: "NSW: Critically Endangered; QLD: Vulnerable",
    1: "Endangered",
    2: "VIC: Rare - under review; Extinct",
    4: "TAS: Presumed Extinct",
}
_NATIONAL_STATUS = {0: "Endangered", 1: "Vulnerable", 3: "Critically Endangered"}
_TYPES = ("ECONOMY", "SMALL", "PROMO")


def _case(n: Column, values: dict[int, str]) -> Column:
    result = F.lit(None).cast("string")
    for value, text in values.items():
        result = F.when(n == value, text).otherwise(result)
    return result


def conservation_reference(spark: SparkSession, folder: str) -> DataFrame:
    n, name = F.col("n_nationkey"), F.col("n_name")
    accepted = F.concat_ws(" ", name, _case(n % 3, dict(enumerate(_TYPES))))
    brand = F.concat(F.lit("Brand#"), (n % 25 + 1).cast("string"))
    synonym = F.concat_ws(" ", name, F.lit("LARGE"), brand)
    return read_table(spark, folder, "nation").select(
        accepted.alias("accepted_taxon"),
        F.concat(accepted, F.lit("| "), synonym, F.lit(" |")).alias("match_names"),
        F.lit("species").alias("rank"),
        F.concat(F.lit("Common "), name).alias("common_name"),
        _case(n % 4, _NATIONAL_STATUS).alias("epbc_status"),
        n.cast("string").alias("epbc_listed_id"),
        F.lit(None).cast("string").alias("epbc_sprat_url"),
        F.lit(None).cast("string").alias("epbc_conservation_advice_url"),
        F.lit(None).cast("string").alias("epbc_recovery_plan_url"),
        F.lit(None).cast("string").alias("epbc_protected_matters_url"),
        _case(n % 5, _STATE_STATUS).alias("state_status"),
        F.lit("mixed").alias("state_status_jurisdiction"),
        F.concat(F.lit("https://example.org/"), n.cast("string")).alias("state_source_url"),
        F.lit("derived").alias("source_dataset"),
        F.lit("2026-01-01").alias("source_date"),
        F.lit(None).cast("string").alias("notes"),
        n.alias("row_order"),
    )


def _sql_case(values: dict[int, str], modulus: int) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in values.items())
    return f"CASE n_nationkey % {modulus} {whens} END"


REFERENCE = f"""ref AS (
  SELECT n_name || ' ' || {_sql_case(dict(enumerate(_TYPES)), 3)} AS accepted_taxon,
    n_name || ' LARGE Brand#' || (n_nationkey % 25 + 1) AS synonym,
    'Common ' || n_name AS common_name,
    {_sql_case(_NATIONAL_STATUS, 4)} AS epbc_status,
    CAST(n_nationkey AS VARCHAR) AS epbc_listed_id,
    {_sql_case(_STATE_STATUS, 5)} AS state_status,
    'https://example.org/' || n_nationkey AS state_source_url
  FROM nation),
names AS (
  SELECT accepted_taxon AS match_name, * FROM ref
  UNION ALL SELECT synonym AS match_name, * FROM ref)"""

CODES = """CASE "stateProvince" WHEN 'New South Wales' THEN 'NSW' WHEN 'Victoria' THEN 'VIC'
  WHEN 'Queensland' THEN 'QLD' WHEN 'Tasmania' THEN 'TAS' END"""

ENRICHED = f"""matched AS (
  SELECT occ.*, coalesce(a.match_name, b.match_name) AS match_name,
    CASE WHEN a.match_name IS NOT NULL THEN 'scientificName' ELSE 'species' END AS match_field,
    CASE WHEN a.match_name IS NOT NULL THEN a.accepted_taxon ELSE b.accepted_taxon END AS accepted_taxon,
    CASE WHEN a.match_name IS NOT NULL THEN a.epbc_status ELSE b.epbc_status END AS epbc_status,
    CASE WHEN a.match_name IS NOT NULL THEN a.state_status ELSE b.state_status END AS state_status,
    CASE WHEN a.match_name IS NOT NULL THEN a.common_name ELSE b.common_name END AS common_name,
    {CODES} AS code
  FROM occ LEFT JOIN names a ON occ."scientificName" = a.match_name
  LEFT JOIN names b ON occ.species = b.match_name),
entry AS (
  SELECT *, list_filter(list_transform(string_split(state_status, ';'), lambda x: trim(x)),
    lambda x: NOT contains(x, ':') OR trim(split_part(x, ':', 1)) = code)[1] AS e FROM matched),
parsed AS (
  SELECT *, CASE WHEN contains(e, ':') THEN trim(split_part(e, ':', 1)) ELSE code END AS juris,
    CASE WHEN contains(e, ':') THEN trim(substr(e, instr(e, ':') + 1)) ELSE e END AS txt FROM entry),
enriched AS (
  SELECT *, epbc_status AS "Status",
    CASE WHEN epbc_status IS NOT NULL THEN accepted_taxon END AS epbc_listed_taxon,
    CASE WHEN e IS NOT NULL THEN coalesce(nullif(regexp_extract(txt,
      '^(Critically Endangered|Endangered|Vulnerable|Rare)(.*)$', 1), ''), txt) END AS state_status_level,
    CASE WHEN e IS NOT NULL AND juris IS NOT NULL THEN juris || ': ' || txt ELSE txt END
      AS state_status_for_occurrence,
    CASE WHEN e IS NOT NULL THEN juris END AS state_status_jurisdiction_matched,
    nullif(trim(regexp_extract(txt,
      '^(Critically Endangered|Endangered|Vulnerable|Rare)(.*)$', 2), ' -;'), '') AS state_status_qualifier,
    CASE WHEN e IS NOT NULL THEN accepted_taxon END AS state_listed_taxon
  FROM parsed)"""


def enriched(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    rows = occurrences(spark, folder, columns or CUBE_COLUMNS)
    return annotate_conservation(rows, conservation_reference(spark, folder), "row_order")


# --- the grid cube -------------------------------------------------------------------

_CONSERVATION = (
    '"Status", state_status, state_status_level, state_status_for_occurrence, '
    "state_status_jurisdiction_matched, state_status_qualifier, epbc_listed_taxon, state_listed_taxon"
)


def cube_sql(source: str = "occ", conservation: bool = False, decimals: int = 1) -> str:
    """The grid cube as a CTE; conservation columns that are always null are left out."""
    extra = ", " + _CONSERVATION if conservation else ""
    return f"""cube AS (
  SELECT round_even("decimalLatitude", {decimals}) + 0.0 AS lat_bin,
    round_even("decimalLongitude", {decimals}) + 0.0 AS lon_bin,
    family, genus, species, "scientificName", year, "stateProvince"{extra},
    count(*) AS record_count, 1::BIGINT AS distinct_scientific_names,
    CAST(count(DISTINCT "taxonConceptID") + max(CASE WHEN "taxonConceptID" IS NULL THEN 1 ELSE 0 END) AS BIGINT)
      AS distinct_taxon_concepts,
    min(year) AS min_year, max(year) AS max_year
  FROM {source} WHERE "decimalLatitude" IS NOT NULL AND "decimalLongitude" IS NOT NULL
  GROUP BY ALL)"""


CUBE = ",\n".join([OCC, cube_sql()])
ENRICHED_CUBE = ",\n".join([OCC, REFERENCE, ENRICHED, cube_sql("enriched", conservation=True)])


def plain_cube(spark: SparkSession, folder: str, decimals: int = 1) -> DataFrame:
    return grid_cube(occurrences(spark, folder, CUBE_COLUMNS), decimals)


def enriched_cube(spark: SparkSession, folder: str, decimals: int = 1) -> DataFrame:
    return grid_cube(enriched(spark, folder), decimals)


# --- boundaries: one polygon per nation, overlapping, some triangles, some holes ------

AREA_LEVEL = "SA3"


def boundary_features(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("n_nationkey")
    x, y = 113 + n * 3 % 34, -44 + n * 5 % 26
    right, top = x + 4 + n % 5, y + 3 + n % 4

    def ring(*points: tuple[Column, Column]) -> Column:
        texts = [
            F.concat(F.lit("["), a.cast("string"), F.lit(","), b.cast("string"), F.lit("]"))
            for a, b in [*points, points[0]]
        ]
        return F.concat(F.lit("["), F.concat_ws(",", *texts), F.lit("]"))

    triangle = n % 3 == 0
    outer = F.when(triangle, ring((x, y), (right, y), (right, top))).otherwise(
        ring((x, y), (right, y), (right, top), (x, top))
    )
    hole = ring((x + 1, y + 1), (x + 2, y + 1), (x + 2, y + 2), (x + 1, y + 2))
    rings = F.when(~triangle & (n % 2 == 0), F.concat_ws(",", outer, hole)).otherwise(outer)
    geometry = F.concat(F.lit('{"type":"Polygon","coordinates":['), rings, F.lit("]}"))
    return read_table(spark, folder, "nation").select(
        F.concat(F.lit("A"), F.lpad(n.cast("string"), 3, "0")).alias("SA3_CODE21"),
        F.col("n_name").alias("SA3_NAME21"),
        F.col("n_regionkey").cast("string").alias("STE_CODE21"),
        F.lit("State").alias("STE_NAME21"),
        ((right - x) * (top - y)).cast("double").alias("AREASQKM21"),
        geometry.alias("geometry"),
    )


def boundaries(spark: SparkSession, folder: str) -> DataFrame:
    return boundary_table(boundary_features(spark, folder), AREA_LEVEL)


AREAS = """box AS (
  SELECT 'A' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS sa3_code_2021, n_name AS sa3_name_2021,
    n_nationkey % 3 = 0 AS triangle, n_nationkey % 2 = 0 AND n_nationkey % 3 <> 0 AS holed,
    CAST(113 + n_nationkey * 3 % 34 AS DOUBLE) AS x, CAST(-44 + n_nationkey * 5 % 26 AS DOUBLE) AS y,
    CAST(113 + n_nationkey * 3 % 34 + 4 + n_nationkey % 5 AS DOUBLE) AS r,
    CAST(-44 + n_nationkey * 5 % 26 + 3 + n_nationkey % 4 AS DOUBLE) AS t
  FROM nation),
edges AS (
  SELECT *, x AS x1, y AS y1, r AS x2, y AS y2 FROM box
  UNION ALL SELECT *, r, y, r, t FROM box
  UNION ALL SELECT *, r, t, x, t FROM box WHERE NOT triangle
  UNION ALL SELECT *, x, t, x, y FROM box WHERE NOT triangle
  UNION ALL SELECT *, r, t, x, y FROM box WHERE triangle
  UNION ALL SELECT *, x + 1, y + 1, x + 2, y + 1 FROM box WHERE holed
  UNION ALL SELECT *, x + 2, y + 1, x + 2, y + 2 FROM box WHERE holed
  UNION ALL SELECT *, x + 2, y + 2, x + 1, y + 2 FROM box WHERE holed
  UNION ALL SELECT *, x + 1, y + 2, x + 1, y + 1 FROM box WHERE holed),
places AS (
  SELECT DISTINCT "decimalLongitude" AS px, "decimalLatitude" AS py FROM occ
  WHERE "decimalLatitude" IS NOT NULL AND "decimalLongitude" IS NOT NULL),
tests AS (
  SELECT px, py, sa3_code_2021, sa3_name_2021,
    sum(CASE WHEN (y1 > py) <> (y2 > py) AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) THEN 1 ELSE 0 END) AS crossings,
    bool_or((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) = 0
      AND px BETWEEN least(x1, x2) AND greatest(x1, x2)
      AND py BETWEEN least(y1, y2) AND greatest(y1, y2)) AS on_edge
  FROM places JOIN edges ON px BETWEEN x AND r AND py BETWEEN y AND t GROUP BY ALL),
located AS (
  SELECT px, py, min(sa3_code_2021) AS sa3_code_2021, arg_min(sa3_name_2021, sa3_code_2021) AS sa3_name_2021
  FROM tests WHERE on_edge OR crossings % 2 = 1 GROUP BY px, py),
area_cube AS (
  SELECT sa3_code_2021, sa3_name_2021, family, genus, species, "scientificName", year, "stateProvince",
    count(*) AS record_count, count(DISTINCT "scientificName") AS distinct_scientific_names,
    count(DISTINCT "taxonConceptID") AS distinct_taxon_concepts, min(year) AS min_year, max(year) AS max_year
  FROM occ JOIN located ON "decimalLongitude" = px AND "decimalLatitude" = py
  WHERE year >= 1950 GROUP BY ALL)"""
