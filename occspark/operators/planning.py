"""Size-capped fetch planning, page validation, and run roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.functions.text import count_text, duration_text
from occspark.operators.rownumber import running_sums
from occspark.operators.skew import lookup_join, top_n
from occspark.operators.taxonomy import filter_text
from occspark.schema import PAGE_SIZE, SEARCH_WINDOW, ensure_columns
from occspark.session import cut_lineage

NO_YEARS = "truncated_no_year_facets"
SPLIT_FAILED = "truncated_partition_split_failed"
MISMATCH = "partition_total_mismatch"
COMPLETE = "complete"


_FACETS = ("year", "month", "day", "lat_long")


def calendar_totals(df: DataFrame, species: str = "query_species_key") -> DataFrame:
    """K1: records per species, year, month and day in one grouping-sets aggregate, written once.

    ``level`` is 0 for a species, 1 to 3 for its years, months and days. ``named`` counts the records
    whose value of the next level is known, ``largest_day`` the largest known day.
    """
    keys = [species, "year", "month", "day"]
    days = (
        df.groupBy(species, *[F.col(c).cast("string").alias(c) for c in keys[1:]])
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col(species).isNotNull())
    )
    level = F.lit(3) - F.bit_count(F.grouping_id())
    known = [F.sum(F.when(F.col(c).isNotNull(), F.col("n"))) for c in keys[1:]]
    totals = days.groupingSets([keys[: i + 1] for i in range(4)], *keys).agg(
        level.alias("level"),
        F.sum("n").alias("total"),
        F.coalesce(F.when(level == 0, known[0]).when(level == 1, known[1]).when(level == 2, known[2]), F.lit(0)).alias("named"),
        F.max(F.when(F.col("day").isNotNull(), F.col("n"))).alias("largest_day"),
    )
    return cut_lineage(totals)


def _label(*facets: str) -> Column:
    return F.concat_ws(";", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in facets])


def partition_plan(
    df: DataFrame,
    species: str = "query_species_key",
    place: str = "latLong",
    window: int = SEARCH_WINDOW,
) -> DataFrame:
    """K1: fetch partitions of at most ``window`` records per species.

    A species that fits is one partition. Else each year is one, an oversized year is
    split by month, an oversized month by day, and a month with an oversized day by
    exact place. Values a facet cannot name (nulls) break the sums: parts that miss
    their parent's total make the split fail, and years that miss the species' total
    are reported. Failed or impossible splits fall back to the first ``window`` rows;
    ``split_failure`` names the level, value and totals of the first that failed.

    The levels are rows of one aggregate and joined from it; the table is counted per place
    only for the months that need it. The plan is checkpointed for its consumers.
    """
    s, y, m = [species], [species, "year"], [species, "year", "month"]
    totals = calendar_totals(df, species)
    whole = totals.where("level = 0").select(*s, F.col("total").alias("species_total"), F.col("named").alias("in_years"))
    years = totals.where("level = 1 AND year IS NOT NULL").select(*y, "total", "named")
    months = totals.where("level = 2 AND year IS NOT NULL AND month IS NOT NULL").select(*m, "total", "named", "largest_day")
    days = totals.where("level = 3 AND year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL").select(*m, "day", "total")

    years = years.join(whole.where(F.col("species_total") > window), s, "left_semi")
    large_years = years.where(F.col("total") > window)
    months = months.join(large_years, y, "left_semi")
    large_months = months.where(F.col("total") > window)
    crowded = large_months.where(F.col("largest_day") > window)
    placed = df.select(
        species, *[F.col(c).cast("string").alias(c) for c in ("year", "month")], F.col(place).alias("lat_long")
    ).where("lat_long IS NOT NULL")
    places = (
        lookup_join(placed, crowded.select(*m), m, "left_semi").groupBy(*m, "lat_long").agg(F.count(F.lit(1)).alias("total"))
    )
    divided = places.groupBy(*m).agg(F.sum("total").alias("in_places"), F.max("total").alias("largest_place"))

    def failed(rows: DataFrame, text: Column) -> DataFrame:
        place_of = F.struct(F.col("year"), F.col("month").isNull().alias("whole_year"), F.col("month"))
        return rows.select(*s, place_of.alias("at"), text.alias("text"))

    def missed(part: str, parts: str, *facets: str) -> Column:
        none = F.concat(_label(*facets), F.lit(": "), count_text(F.col("total")), F.lit(f" records and no {part} values"))
        some = F.concat(
            _label(*facets), F.lit(f": {parts} sum to "), count_text(F.col("named")), F.lit(", expected "), count_text(F.col("total"))
        )
        return F.when(F.col("named") == 0, none).otherwise(some)

    of_years = large_years.where("named <> total").withColumn("month", F.lit(None).cast("string"))
    by_day = large_months.where((F.col("largest_day") <= window) | F.col("largest_day").isNull()).where("named <> total")
    fits = (F.col("in_places") == F.col("total")) & (F.col("largest_place") <= window)
    by_place = crowded.join(divided, m, "left").where(~F.coalesce(fits, F.lit(False)))
    too_large = F.concat(
        _label("year", "month"),
        F.lit(": largest day "),
        count_text(F.col("largest_day")),
        F.lit(", places sum to "),
        count_text(F.coalesce("in_places", F.lit(0))),
        F.lit(" (largest "),
        count_text(F.coalesce("largest_place", F.lit(0))),
        F.lit("), expected "),
        count_text(F.col("total")),
    )
    failures = (
        failed(of_years, missed("month", "months", "year"))
        .unionByName(failed(by_day, missed("day", "days", "year", "month")))
        .unionByName(failed(by_place, too_large))
    )
    reasons = failures.groupBy(*s).agg(F.min_by("text", "at").alias("split_failure"))
    status = (
        F.when(F.col("species_total") <= window, COMPLETE)
        .when(F.col("in_years") == 0, NO_YEARS)
        .when(F.col("split_failure").isNotNull(), SPLIT_FAILED)
        .when(F.col("in_years") != F.col("species_total"), MISMATCH)
        .otherwise(COMPLETE)
    )
    states = whole.join(reasons, s, "left").select(
        *s, "species_total", status.alias("coverage_status"), F.when(status == SPLIT_FAILED, F.col("split_failure")).alias("split_failure")
    )
    split = (F.col("species_total") > window) & ~F.col("coverage_status").isin(NO_YEARS, SPLIT_FAILED)

    def parts(rows: DataFrame) -> DataFrame:
        named = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in _FACETS]
        return rows.select(*s, *named, "total")

    plain = large_months.where((F.col("largest_day") <= window) | F.col("largest_day").isNull())
    split_parts = (
        parts(years.where(F.col("total") <= window))
        .unionByName(parts(months.where(F.col("total") <= window)))
        .unionByName(parts(days.join(plain, m, "left_semi")))
        .unionByName(parts(places))
        .join(states.where(split), s)
    )
    first = states.where(~split).select(
        *s,
        *[F.lit(None).cast("string").alias(c) for c in _FACETS],
        F.least("species_total", F.lit(window)).alias("total"),
        "species_total",
        "coverage_status",
        "split_failure",
    )
    label = _label(*_FACETS)
    filters = F.array_compact(F.array(*[filter_text(c, F.col(c)) for c in _FACETS]))
    plan = split_parts.unionByName(first).select(
        *s,
        F.when(label == "", "all").otherwise(label).alias("label"),
        filters.alias("filters"),
        F.col("total").alias("total_records"),
        "coverage_status",
        "species_total",
        "split_failure",
    )
    return cut_lineage(plan)


def coverage_detail(plan: DataFrame, species: str = "query_species_key") -> DataFrame:
    """K1: planned and expected totals per species, with a status text."""
    totals = ensure_columns(plan, {"split_failure": "string"}).groupBy(species, "coverage_status").agg(
        F.max("species_total").alias("expected_total_records"),
        F.sum("total_records").alias("planned_partition_records"),
        F.count(F.lit(1)).alias("partitions"),
        F.max("split_failure").alias("_failure"),
    )
    detail = (
        F.when(F.col("coverage_status") == NO_YEARS, F.lit("no year values to split by"))
        .when(F.col("coverage_status") == SPLIT_FAILED, F.concat_ws(": ", F.lit("partition split failed"), "_failure"))
        .when(
            F.col("coverage_status") == MISMATCH,
            F.concat(
                F.lit("year partition coverage total="),
                count_text(F.col("planned_partition_records")),
                F.lit(", expected="),
                count_text(F.col("expected_total_records")),
            ),
        )
    )
    return totals.withColumn("coverage_detail", detail).drop("_failure")


def page_tasks(
    plan: DataFrame, species: str = "query_species_key", size: int = PAGE_SIZE
) -> DataFrame:
    """K2: pages of at most ``size`` rows; the page index runs on across partitions.

    The index is a running sum over range partitions, so a species with most of all
    partitions is numbered by many tasks.
    """
    pages = plan.withColumn("_pages", F.ceil(F.col("total_records") / size).cast("long"))
    indexed = running_sums(pages, [species], ["label"], "_pages", "_before")
    numbered = indexed.where(F.col("_pages") > 0).withColumn(
        "_page", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pages") - 1))
    )
    start = F.col("_page") * size
    return numbered.select(
        species,
        (F.col("_before") + F.col("_page")).alias("page_index"),
        F.col("label").alias("partition_label"),
        start.alias("start"),
        F.least(F.lit(size).cast("long"), F.col("total_records") - start).alias("page_size"),
    )


def page_validation(
    tasks: DataFrame, landed: DataFrame, species: str = "query_species_key"
) -> DataFrame:
    """K3: landed rows of every planned page against its size.

    ``landed`` holds a row per landed record with its species and ``page_index``; a
    page without any row at all has not been fetched.
    """
    keys = [species, "page_index"]
    counts = landed.groupBy(*keys).agg(F.count(F.lit(1)).alias("landed_rows"))
    joined = tasks.join(counts, keys, "left")
    status = (
        F.when(F.col("landed_rows").isNull(), "fetch_failed")
        .when(F.col("landed_rows") != F.col("page_size"), "partial_row_count")
        .otherwise("complete")
    )
    rows = F.coalesce("landed_rows", F.lit(0).cast("long"))
    detail = F.format_string(
        "page=%d start=%d rows=%s, expected=%s",
        F.col("page_index"),
        F.col("start"),
        count_text(rows),
        count_text(F.col("page_size")),
    )
    return joined.select(
        *tasks.columns,
        rows.alias("rows_written"),
        status.alias("validation_status"),
        F.when(status != "complete", detail).alias("validation_detail"),
    )


def config_fingerprint(*columns: str) -> Column:
    """K4: digest of a run configuration, its keys sorted."""
    ordered = F.struct(*sorted(columns))
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def pages_to_fetch(
    tasks: DataFrame, landed_pages: DataFrame, species: str = "query_species_key"
) -> DataFrame:
    """K4: planned pages without a valid landed page.

    A landed page is valid when it has the planned size and was fetched under the same
    ``config_fingerprint`` (the fingerprint leaves the program version out).
    """
    valid = landed_pages.select(
        species, "page_index", "config_fingerprint", F.col("rows_written").alias("page_size")
    ).distinct()
    return tasks.join(valid, [species, "page_index", "config_fingerprint", "page_size"], "left_anti")


def cap_per_species(
    df: DataFrame, order: Sequence[str], n: int | None, species: str = "query_species_key"
) -> DataFrame:
    """K5: at most ``n`` records per species, in event order."""
    if n is None:
        return df
    if n < 1:
        raise ValueError("The cap per species must be positive.")
    ranked = top_n(df, [species], [F.col(c).asc_nulls_last() for c in order], n, "_rank")
    return ranked.drop("_rank")


def page_issues(validated: DataFrame, species: str = "query_species_key") -> DataFrame:
    """Every page that isn't complete as a row, numbered per species in page order; none is left out."""
    bad = validated.where("validation_status <> 'complete'").withColumn("_one", F.lit(1).cast("long"))
    numbered = running_sums(bad, [species], ["page_index"], "_one", "_before")
    return numbered.select(
        species,
        (F.col("_before") + 1).alias("issue"),
        "page_index",
        F.coalesce("validation_detail", "validation_status").alias("detail"),
    )


def species_results(
    validated: DataFrame, plan: DataFrame, species: str = "query_species_key"
) -> DataFrame:
    """One row per species with its page issues, written rows and pages.

    The text names every issue in page order, some 45 bytes each; ``page_issues`` has them as rows.
    """
    bad = F.col("validation_status") != "complete"
    issue = F.struct("page_index", F.coalesce("validation_detail", "validation_status").alias("text"))
    listed = F.transform(F.array_sort(F.collect_list(F.when(bad, issue))), lambda i: i["text"])
    pages = validated.groupBy(species).agg(
        F.count_if(bad).alias("page_validation_issue_count"),
        F.nullif(F.array_join(listed, " | "), F.lit("")).alias("page_validation_detail"),
        F.sum("rows_written").alias("rows_written"),
        F.count(F.lit(1)).alias("pages_written"),
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("page_validation_issue_count", "rows_written", "pages_written")}
    return (
        coverage_detail(plan, species)
        .join(pages, [species], "left")
        .withColumns(zero)
        .withColumnsRenamed(
            {
                "coverage_status": "partition_coverage_status",
                "coverage_detail": "partition_coverage_detail",
                "expected_total_records": "reported_total_records",
            }
        )
    )


def manifest(results: DataFrame, targets: DataFrame, species: str = "query_species_key") -> DataFrame:
    """A31 + J11: species results with their target's names and a readable duration."""
    named = results.join(targets, results[species] == targets["key"]).drop(results[species])
    return named.withColumn("elapsed_human", duration_text("elapsed_seconds"))


def coverage_rollup(results: DataFrame, group: str = "family") -> DataFrame:
    """A29 + A30: run metrics and coverage status per family."""
    failed = F.col("fetch_status") != "complete"
    issues = F.col("page_validation_issue_count")
    partial = F.col("partition_coverage_status") != "complete"
    status = (
        F.when(F.bool_or(failed), "incomplete_failed_species")
        .when(F.bool_or(issues > 0), "incomplete_failed_or_partial_pages")
        .when(F.bool_or(partial), "best_effort_partition_limited")
        .otherwise("complete")
    )
    return results.groupBy(group).agg(
        F.sum("reported_total_records").alias("records_reported"),
        F.sum("rows_written").alias("rows_fetched"),
        F.count_if(failed).alias("failed_species_count"),
        F.sum(issues).alias("failed_page_count"),
        status.alias("coverage_status"),
        F.array_join(F.array_sort(F.collect_set("partition_coverage_status")), " | ").alias(
            "partition_coverage_statuses"
        ),
    )
