"""Fetch planning and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occspark.operators import planning
from occspark.operators.dedupe import dedupe_metrics
from occspark.plans.cubes import run_report
from occspark.sources.star_view import LINE_KEY, occurrences, read_table
from verification.inputs import with_occ
from verification.registry import query

_SPECIES = "query_species_key"
_WINDOW = 20
#: A species none of whose pages land in the run report.
_NEVER = "NATION_7"
_SIZE = 8

# Species differ in what their dates lack, so that every way to split or fail occurs.
_ROWS = """rws AS (SELECT split_part("scientificName", ' ', 1) AS sp, family,
    CASE WHEN family = 'EUROPE' OR (family = 'AFRICA' AND l_linenumber = 6 AND "scientificName" LIKE 'NATION_1%')
      THEN NULL ELSE CAST(year AS VARCHAR) END AS y,
    CASE WHEN family = 'ASIA' THEN month ELSE substr("eventDate_iso", 6, 2) END AS m,
    CASE WHEN family IN ('AMERICA', 'MIDDLE EAST') THEN '15' ELSE day END AS d,
    CASE WHEN "decimalLatitude" IS NOT NULL THEN "decimalLatitude" || ',' || "decimalLongitude"
      WHEN family = 'AMERICA' THEN '0,0' END AS ll FROM occ)"""

_PLAN = f"""tot AS (SELECT sp, count(*) AS n, count(y) AS yf FROM rws GROUP BY sp),
yr AS (SELECT sp, y, count(*) AS n FROM rws WHERE y IS NOT NULL GROUP BY ALL),
mo AS (SELECT sp, y, m, count(*) AS n FROM rws WHERE y IS NOT NULL AND m IS NOT NULL GROUP BY ALL),
da AS (SELECT sp, y, m, d, count(*) AS n FROM rws WHERE y IS NOT NULL AND m IS NOT NULL AND d IS NOT NULL GROUP BY ALL),
pl AS (SELECT sp, y, m, ll, count(*) AS n FROM rws WHERE y IS NOT NULL AND m IS NOT NULL AND ll IS NOT NULL GROUP BY ALL),
dst AS (SELECT sp, y, m, max(n) AS dmax, sum(n) AS dsum FROM da GROUP BY ALL),
pst AS (SELECT sp, y, m, max(n) AS pmax, sum(n) AS psum FROM pl GROUP BY ALL),
ms AS (SELECT mo.*, yr.n AS yn, dmax, yr.n > {_WINDOW} AND mo.n > {_WINDOW} AS big,
    yr.n > {_WINDOW} AND mo.n > {_WINDOW} AND dmax > {_WINDOW} AS spread,
    CASE WHEN NOT (yr.n > {_WINDOW} AND mo.n > {_WINDOW}) THEN TRUE
      WHEN dmax > {_WINDOW} THEN coalesce(psum = mo.n AND pmax <= {_WINDOW}, FALSE)
      ELSE coalesce(dsum = mo.n, FALSE) END AS ok
  FROM mo JOIN yr USING (sp, y) LEFT JOIN dst USING (sp, y, m) LEFT JOIN pst USING (sp, y, m)),
ys AS (SELECT yr.sp, yr.y, yr.n, yr.n <= {_WINDOW} OR (coalesce(sum(ms.n), 0) = yr.n AND coalesce(bool_and(ok), FALSE)) AS ok
  FROM yr LEFT JOIN ms USING (sp, y) GROUP BY yr.sp, yr.y, yr.n),
st AS (SELECT tot.sp, tot.n, CASE WHEN tot.n <= {_WINDOW} THEN 'complete' WHEN yf = 0 THEN 'truncated_no_year_facets'
    WHEN NOT (SELECT bool_and(ok) FROM ys WHERE ys.sp = tot.sp) THEN 'truncated_partition_split_failed'
    WHEN yf <> tot.n THEN 'partition_total_mismatch' ELSE 'complete' END AS status FROM tot),
live AS (SELECT * FROM st WHERE n > {_WINDOW} AND status NOT LIKE 'truncated%'),
plan AS (
  SELECT sp, 'all' AS label, least(n, {_WINDOW}) AS total, status FROM st WHERE n <= {_WINDOW} OR status LIKE 'truncated%'
  UNION ALL SELECT sp, 'year=' || y, yr.n, status FROM yr JOIN live USING (sp) WHERE yr.n <= {_WINDOW}
  UNION ALL SELECT sp, 'year=' || y || ';month=' || m, ms.n, status FROM ms JOIN live USING (sp) WHERE yn > {_WINDOW} AND NOT big
  UNION ALL SELECT sp, 'year=' || y || ';month=' || m || ';day=' || d, da.n, status FROM da JOIN ms USING (sp, y, m)
    JOIN live USING (sp) WHERE big AND NOT spread
  UNION ALL SELECT sp, 'year=' || y || ';month=' || m || ';lat_long=' || ll, pl.n, status FROM pl JOIN ms USING (sp, y, m)
    JOIN live USING (sp) WHERE spread)"""

_REASON = f"""misses AS (
  SELECT yr.sp, yr.y, '~' AS m, CASE WHEN sum(ms.n) IS NULL THEN 'year=' || yr.y || ': ' || format('{{:,}}', yr.n) || ' records and no month values'
      ELSE 'year=' || yr.y || ': months sum to ' || format('{{:,}}', sum(ms.n)::BIGINT) || ', expected ' || format('{{:,}}', yr.n) END AS why
    FROM yr LEFT JOIN ms USING (sp, y) WHERE yr.n > {_WINDOW} GROUP BY yr.sp, yr.y, yr.n HAVING coalesce(sum(ms.n), 0) <> yr.n
  UNION ALL SELECT ms.sp, ms.y, ms.m, CASE WHEN dsum IS NULL THEN 'year=' || ms.y || ';month=' || ms.m || ': ' || format('{{:,}}', ms.n)
      || ' records and no day values' WHEN NOT spread THEN 'year=' || ms.y || ';month=' || ms.m || ': days sum to '
      || format('{{:,}}', dsum::BIGINT) || ', expected ' || format('{{:,}}', ms.n)
      ELSE 'year=' || ms.y || ';month=' || ms.m || ': largest day ' || format('{{:,}}', ms.dmax) || ', places sum to '
      || format('{{:,}}', coalesce(psum, 0)::BIGINT) || ' (largest ' || format('{{:,}}', coalesce(pmax, 0)) || '), expected '
      || format('{{:,}}', ms.n) END
    FROM ms LEFT JOIN dst USING (sp, y, m) LEFT JOIN pst USING (sp, y, m) WHERE big AND NOT ok),
reason AS (SELECT sp, arg_min(why, (y, m)) AS why FROM misses GROUP BY sp)"""

_TASKS = f"""numbered AS (SELECT *, CAST(ceil(total / {_SIZE}) AS BIGINT) AS pages FROM plan),
before AS (SELECT *, CAST(coalesce(sum(pages) OVER (PARTITION BY sp ORDER BY label
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS b FROM numbered),
tasks AS (SELECT sp, b + p AS page_index, label, p * {_SIZE} AS start, least({_SIZE}, total - p * {_SIZE}) AS page_size, status
  FROM (SELECT *, unnest(range(0, pages)) AS p FROM before)),
landed AS (SELECT *, CASE page_index % 7 WHEN 0 THEN 0 WHEN 1 THEN page_size - 1
    ELSE page_size END AS got FROM tasks),
checked AS (SELECT *, CASE WHEN got = 0 THEN 'fetch_failed' WHEN got <> page_size THEN 'partial_row_count'
    ELSE 'complete' END AS v FROM landed)"""


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    names = "scientificName family year month day eventDate_iso l_linenumber decimalLatitude decimalLongitude"
    rows = occurrences(spark, folder, names.split())
    family = F.col("family")
    undated = (family == "EUROPE") | (
        (family == "AFRICA") & (F.col("l_linenumber") == 6) & F.col("scientificName").startswith("NATION_1")
    )
    place = F.concat_ws(",", "decimalLatitude", "decimalLongitude")
    return rows.select(
        F.substring_index("scientificName", " ", 1).alias(_SPECIES),
        "family",
        F.when(~undated, F.col("year")).alias("year"),
        F.when(family == "ASIA", F.col("month"))
        .otherwise(F.substring("eventDate_iso", 6, 2))
        .alias("month"),
        F.when(family.isin("AMERICA", "MIDDLE EAST"), "15").otherwise(F.col("day")).alias("day"),
        F.when(F.col("decimalLatitude").isNotNull(), place)
        .when(family == "AMERICA", "0,0")
        .alias("latLong"),
    )


def _plan(spark: SparkSession, folder: str) -> DataFrame:
    return planning.partition_plan(_rows(spark, folder), window=_WINDOW)


def _tasks(spark: SparkSession, folder: str) -> DataFrame:
    return planning.page_tasks(_plan(spark, folder), size=_SIZE)


def _landed_size() -> Column:
    remainder = F.col("page_index") % 7
    return (
        F.when(remainder == 0, 0).when(remainder == 1, F.col("page_size") - 1).otherwise(F.col("page_size"))
    )


def _landed(tasks: DataFrame) -> DataFrame:
    """One row per landed record; some pages are short and some are missing."""
    sized = tasks.withColumn("_n", _landed_size().cast("int")).where(F.col("_n") > 0)
    return sized.select(_SPECIES, "page_index", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("row"))


@query(
    "k1_partition_plan",
    with_occ(
        "SELECT sp AS query_species_key, label, total AS total_records, status AS coverage_status FROM plan",
        _ROWS,
        _PLAN,
    ),
)
def k1_partition_plan(spark: SparkSession, folder: str) -> DataFrame:
    return _plan(spark, folder).select(_SPECIES, "label", "total_records", "coverage_status")


@query(
    "k1_coverage_detail",
    with_occ(
        """SELECT plan.sp AS query_species_key, plan.status AS coverage_status, st.n AS expected_total_records,
        CAST(sum(total) AS BIGINT) AS planned_partition_records, count(*) AS partitions,
        CASE plan.status WHEN 'truncated_no_year_facets' THEN 'no year values to split by'
          WHEN 'truncated_partition_split_failed' THEN 'partition split failed: ' || why
          WHEN 'partition_total_mismatch' THEN 'year partition coverage total=' || format('{:,}', sum(total)::BIGINT)
            || ', expected=' || format('{:,}', st.n) END AS coverage_detail
        FROM plan JOIN st USING (sp) LEFT JOIN reason USING (sp) GROUP BY plan.sp, plan.status, st.n, why""",
        _ROWS,
        _PLAN,
        _REASON,
    ),
)
def k1_coverage_detail(spark: SparkSession, folder: str) -> DataFrame:
    return planning.coverage_detail(_plan(spark, folder))


@query(
    "k2_page_tasks",
    with_occ(
        """SELECT sp AS query_species_key, page_index, label AS partition_label, start,
        CAST(page_size AS BIGINT) AS page_size FROM tasks""",
        _ROWS,
        _PLAN,
        _TASKS,
    ),
)
def k2_page_tasks(spark: SparkSession, folder: str) -> DataFrame:
    return _tasks(spark, folder)


@query(
    "k3_page_validation",
    with_occ(
        """SELECT sp AS query_species_key, page_index, CAST(got AS BIGINT) AS rows_written, v AS validation_status,
        CASE WHEN v <> 'complete' THEN 'page=' || page_index || ' start=' || start || ' rows=' || got
          || ', expected=' || page_size END AS validation_detail FROM checked""",
        _ROWS,
        _PLAN,
        _TASKS,
    ),
)
def k3_page_validation(spark: SparkSession, folder: str) -> DataFrame:
    tasks = _tasks(spark, folder)
    return planning.page_validation(tasks, _landed(tasks)).select(
        _SPECIES, "page_index", "rows_written", "validation_status", "validation_detail"
    )


@query(
    "k4_pages_to_fetch",
    with_occ(
        """SELECT sp AS query_species_key, page_index, CAST(page_size AS BIGINT) AS page_size FROM checked
        WHERE v <> 'complete' OR sp = 'NATION_5'""",
        _ROWS,
        _PLAN,
        _TASKS,
    ),
)
def k4_pages_to_fetch(spark: SparkSession, folder: str) -> DataFrame:
    tasks = _tasks(spark, folder).withColumn("version", F.lit(2))
    tasks = tasks.withColumn(
        "config_fingerprint", planning.config_fingerprint(_SPECIES, "version")
    )
    # One species was fetched under an older configuration.
    older = F.when(F.col(_SPECIES) == "NATION_5", 1).otherwise(2)
    landed = tasks.withColumn("version", older).select(
        _SPECIES,
        "page_index",
        planning.config_fingerprint(_SPECIES, "version").alias("config_fingerprint"),
        _landed_size().alias("rows_written"),
    )
    return planning.pages_to_fetch(tasks, landed).select(_SPECIES, "page_index", "page_size")


_KEYS = ", ".join(LINE_KEY)


@query(
    "k5_cap_per_species",
    with_occ(
        f"""SELECT sp, {_KEYS} FROM (SELECT *, split_part("scientificName", ' ', 1) AS sp,
          row_number() OVER (PARTITION BY split_part("scientificName", ' ', 1) ORDER BY "eventDate", {_KEYS}) AS r FROM occ)
        WHERE r <= 2000"""
    ),
)
def k5_cap_per_species(spark: SparkSession, folder: str) -> DataFrame:
    rows = occurrences(spark, folder, [*LINE_KEY, "scientificName", "eventDate"])
    rows = rows.withColumn("sp", F.substring_index("scientificName", " ", 1))
    capped = planning.cap_per_species(rows, ["eventDate", *LINE_KEY], 2000, "sp")
    return capped.select("sp", *LINE_KEY)


@query(
    "a31_j11_species_manifest",
    with_occ(
        """SELECT sp AS key, 'Region ' || n_regionkey AS common_name, r.issues AS page_validation_issue_count,
        r.rows AS rows_written, r.pages AS pages_written, r.detail AS page_validation_detail,
        st.n AS reported_total_records, st.status AS partition_coverage_status,
        format('{:.1f}s', (n_nationkey + 0.5)::DOUBLE) AS elapsed_human
        FROM st JOIN nation ON sp = n_name JOIN (SELECT sp, count(*) FILTER (v <> 'complete') AS issues,
          CAST(sum(got) AS BIGINT) AS rows, count(*) AS pages, string_agg(CASE WHEN v <> 'complete' THEN
            'page=' || page_index || ' start=' || start || ' rows=' || got || ', expected=' || page_size END, ' | '
            ORDER BY page_index) AS detail FROM checked GROUP BY sp) r USING (sp)""",
        _ROWS,
        _PLAN,
        _TASKS,
    ),
)
def a31_j11_species_manifest(spark: SparkSession, folder: str) -> DataFrame:
    plan = _plan(spark, folder)
    tasks = planning.page_tasks(plan, size=_SIZE)
    results = planning.species_results(planning.page_validation(tasks, _landed(tasks)), plan)
    targets = read_table(spark, folder, "nation").select(
        F.col("n_name").alias("key"),
        F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("common_name"),
        (F.col("n_nationkey") + 0.5).alias("elapsed_seconds"),
    )
    return planning.manifest(results, targets).select(
        *"key common_name page_validation_issue_count rows_written pages_written page_validation_detail "
        "reported_total_records partition_coverage_status elapsed_human".split()
    )


@query(
    "a31_page_issues",
    with_occ(
        """SELECT sp AS query_species_key, row_number() OVER (PARTITION BY sp ORDER BY page_index) AS issue, page_index,
        'page=' || page_index || ' start=' || start || ' rows=' || got || ', expected=' || page_size AS detail
        FROM checked WHERE v <> 'complete'""",
        _ROWS,
        _PLAN,
        _TASKS,
    ),
)
def a31_page_issues(spark: SparkSession, folder: str) -> DataFrame:
    tasks = _tasks(spark, folder)
    return planning.page_issues(planning.page_validation(tasks, _landed(tasks)))


@query(
    "k2_one_species",
    with_occ(
        f"""SELECT sp, before + unnest(range(0, pages)) AS page_index, label FROM (SELECT *, CAST(coalesce(sum(pages) OVER (
          PARTITION BY sp ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
          FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'one' ELSE family END AS sp,
            'order=' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS label, CAST(ceil(count(*) / 2.0) AS BIGINT) AS pages
            FROM occ GROUP BY ALL))"""
    ),
)
def k2_one_species(spark: SparkSession, folder: str) -> DataFrame:
    """A partition per order, a third of them of one species."""
    rows = occurrences(spark, folder, ["l_orderkey", "family"])
    sp = F.when(F.col("l_orderkey") % 3 == 0, "one").otherwise(F.col("family"))
    label = F.concat(F.lit("order="), F.lpad(F.col("l_orderkey").cast("string"), 12, "0"))
    plan = rows.groupBy(sp.alias("sp"), label.alias("label")).agg(F.count(F.lit(1)).alias("total_records"))
    return planning.page_tasks(plan, "sp", 2).select("sp", "page_index", F.col("partition_label").alias("label"))


@query(
    "a29_a30_x10_run_report",
    with_occ(
        """SELECT family AS source_family, CAST(sum(n) AS BIGINT) AS records_reported, CAST(sum(rows) AS BIGINT) AS rows_fetched,
        count(*) FILTER (rows = 0) AS failed_species_count, CAST(sum(issues) AS BIGINT) AS failed_page_count,
        kept AS rows_kept_after_dedupe, input - kept AS rows_dropped,
        CASE WHEN bool_or(rows = 0) THEN 'incomplete_failed_species' WHEN sum(issues) > 0 THEN 'incomplete_failed_or_partial_pages' WHEN bool_or(status <> 'complete')
          THEN 'best_effort_partition_limited' ELSE 'complete' END AS coverage_status,
        string_agg(DISTINCT status, ' | ' ORDER BY status) AS partition_coverage_statuses
        FROM st JOIN (SELECT sp, count(*) FILTER (v <> 'complete') AS issues, sum(got) AS rows FROM checked GROUP BY sp)
          USING (sp) JOIN (SELECT DISTINCT sp, family FROM rws) USING (sp)
          JOIN (SELECT family, count(*) AS input, count(DISTINCT CASE WHEN uuid <> '' THEN 'u' || uuid ELSE
            "scientificName" || '|' || "eventDate" END) AS kept FROM occ GROUP BY family) USING (family)
        GROUP BY family, input, kept""",
        _ROWS,
        _PLAN,
        _TASKS.replace("CASE page_index % 7 WHEN 0", f"CASE WHEN sp = '{_NEVER}' THEN 0 ELSE CASE page_index % 7 WHEN 0").replace(
            "ELSE page_size END AS got", "ELSE page_size END END AS got"
        ),
    ),
)
def a29_a30_x10_run_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = _rows(spark, folder)
    plan = planning.partition_plan(rows, window=_WINDOW)
    tasks = planning.page_tasks(plan, size=_SIZE)
    targets = rows.select(F.col(_SPECIES).alias("key"), F.col("family").alias("source_family")).distinct()
    records = occurrences(spark, folder, ["uuid", "scientificName", "eventDate", "family"])
    merged = dedupe_metrics(records.withColumn("source_family", F.col("family")), "source_family")
    landed = _landed(tasks).where(F.col(_SPECIES) != _NEVER)
    return run_report(tasks, landed, plan, targets, merged=merged)
