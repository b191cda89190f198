"""Fetch planning, validation, resume and roll-ups."""

from __future__ import annotations

import pytest
from conftest import records
from pyspark.sql import functions as F

from occspark.operators import planning
from occspark.plans.cubes import run_report

SPECIES = "query_species_key"


def dated(spark, *groups):
    """Groups of (species, year, month, day, place, rows), expanded to rows."""
    counts = spark.createDataFrame(
        groups, f"{SPECIES} string, year long, month string, day string, latLong string, n int"
    )
    return counts.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n", "i")


def plan_of(spark, *groups):
    rows = records(planning.partition_plan(dated(spark, *groups)))
    return {r["label"]: r["total_records"] for r in rows}, {r["coverage_status"] for r in rows}


def test_small_species_is_one_partition(spark):
    assert plan_of(spark, ("s", None, None, None, None, 4999)) == ({"all": 4999}, {"complete"})


def test_oversized_year_splits_by_month(spark):
    got, status = plan_of(
        spark,
        ("s", 2019, "1", "1", None, 10),
        ("s", 2020, "01", None, None, 3000),
        ("s", 2020, "02", "1", None, 2646),
    )
    assert got == {"year=2019": 10, "year=2020;month=01": 3000, "year=2020;month=02": 2646}
    assert status == {"complete"}


def test_oversized_month_splits_by_day(spark):
    got, status = plan_of(
        spark, ("s", 2020, "01", "1", None, 2500), ("s", 2020, "01", "2", None, 2819)
    )
    assert got == {"year=2020;month=01;day=1": 2500, "year=2020;month=01;day=2": 2819}
    assert status == {"complete"}


def test_oversized_day_splits_by_place(spark):
    got, status = plan_of(
        spark, ("s", 2020, "01", "1", "-1,2", 3000), ("s", 2020, "01", "1", "-3,4", 2319)
    )
    assert got == {"year=2020;month=01;lat_long=-1,2": 3000, "year=2020;month=01;lat_long=-3,4": 2319}
    assert status == {"complete"}
    rows = dated(spark, ("s", 2020, "01", "1", 'a"b', 3000), ("s", 2020, "01", "1", "c", 2319))
    filters = {tuple(r["filters"]) for r in records(planning.partition_plan(rows))}
    assert ('year:"2020"', 'month:"01"', 'lat_long:"a\\"b"') in filters


@pytest.mark.parametrize(
    "groups",
    [
        [("s", 2020, "01", "1", "p", 5319)],  # one place too large
        [("s", 2020, "01", "1", "p", 3000), ("s", 2020, "01", "1", None, 2319)],  # place missing
        [("s", 2020, "01", None, "p", 1), ("s", 2020, "01", "2", "p", 5000)],  # day missing
        [("s", 2020, None, "1", "p", 5319)],  # no month at all
    ],
)
def test_failed_split_falls_back_to_the_first_window(spark, groups):
    got, status = plan_of(spark, *groups)
    assert got == {"all": 5000} and status == {"truncated_partition_split_failed"}


def test_missing_years(spark):
    got, status = plan_of(spark, ("s", None, None, None, None, 5646))
    assert got == {"all": 5000} and status == {"truncated_no_year_facets"}
    rows = dated(spark, ("s", 2019, None, None, None, 4000), ("s", None, None, None, None, 1500))
    plan = planning.partition_plan(rows)
    (detail,) = records(planning.coverage_detail(plan))
    assert detail == {
        SPECIES: "s",
        "coverage_status": "partition_total_mismatch",
        "expected_total_records": 5500,
        "planned_partition_records": 4000,
        "partitions": 1,
        "coverage_detail": "year partition coverage total=4,000, expected=5,500",
    }


def _plan_frame(spark, *rows):
    return spark.createDataFrame(
        [(*r, "complete", sum(x[2] for x in rows)) for r in rows],
        f"{SPECIES} string, label string, total_records long, coverage_status string, species_total long",
    )


def test_pages_run_on_across_partitions(spark):
    plan = _plan_frame(spark, ("s", "year=2019", 1001), ("s", "year=2020", 500))
    pages = planning.page_tasks(plan).orderBy("page_index")
    assert [(r["page_index"], r["start"], r["page_size"]) for r in records(pages)] == [
        (0, 0, 500),
        (1, 500, 500),
        (2, 1000, 1),
        (3, 0, 500),
    ]


def test_validation_report_and_resume(spark):
    plan = _plan_frame(spark, ("s", "year=2019", 1200))
    tasks = planning.page_tasks(plan)
    landed = spark.range(1100).select(
        F.lit("s").alias(SPECIES), F.when(F.col("id") < 500, 0).otherwise(2).alias("page_index")
    )
    checked = {r["page_index"]: r for r in records(planning.page_validation(tasks, landed))}
    assert [checked[i]["validation_status"] for i in range(3)] == [
        "complete",
        "fetch_failed",
        "partial_row_count",
    ]
    assert checked[2]["validation_detail"] == "page=2 start=1000 rows=600, expected=200"

    targets = spark.createDataFrame([("s", "Pieridae")], "key string, source_family string")
    (report,) = records(run_report(tasks, landed, plan, targets))
    assert report["coverage_status"] == "incomplete_failed_or_partial_pages"
    assert (report["failed_page_count"], report["rows_fetched"]) == (2, 1100)
    (empty,) = records(run_report(tasks, landed.limit(0), plan, targets))
    assert (empty["coverage_status"], empty["failed_species_count"]) == ("incomplete_failed_species", 1)

    marked = tasks.withColumn("config_fingerprint", F.lit("v1"))
    done = spark.createDataFrame(
        [("s", 0, "v1", 500), ("s", 1, "v0", 500), ("s", 2, "v1", 199)],
        f"{SPECIES} string, page_index long, config_fingerprint string, rows_written long",
    )
    left = planning.pages_to_fetch(marked, done)
    assert sorted(r["page_index"] for r in records(left)) == [1, 2]


@pytest.mark.parametrize(
    ("rows", "status"),
    [
        ([("complete", 0, "complete")], "complete"),
        ([("complete", 0, "partition_total_mismatch")], "best_effort_partition_limited"),
        ([("complete", 1, "partition_total_mismatch")], "incomplete_failed_or_partial_pages"),
        ([("failed", 1, "complete"), ("complete", 0, "complete")], "incomplete_failed_species"),
    ],
)
def test_coverage_rollup(spark, rows, status):
    df = spark.createDataFrame(
        [("F", *r, 10, 9) for r in rows],
        "family string, fetch_status string, page_validation_issue_count long, partition_coverage_status string, "
        "reported_total_records long, rows_written long",
    )
    (got,) = records(planning.coverage_rollup(df))
    assert got["coverage_status"] == status and got["records_reported"] == 10 * len(rows)


def test_run_cap(spark):
    rows = spark.range(100).select((F.col("id") % 2).cast("string").alias(SPECIES), F.col("id").alias("eventDate"))
    kept = planning.cap_per_species(rows, ["eventDate"], 3)
    assert sorted(r["eventDate"] for r in records(kept)) == [0, 1, 2, 3, 4, 5]
    assert planning.cap_per_species(rows, ["eventDate"], None) is rows
    for bad in (0, -1):
        with pytest.raises(ValueError):
            planning.cap_per_species(rows, ["eventDate"], bad)


def test_fingerprint_ignores_column_order(spark):
    df = spark.createDataFrame([(1, "x", None)], "a int, b string, c string")
    first = planning.config_fingerprint("a", "b", "c")
    assert df.select(first == planning.config_fingerprint("c", "b", "a")).first()[0]
    assert df.select(first != planning.config_fingerprint("a", "b")).first()[0]


def test_reason_of_a_failed_split_names_level_value_and_totals(spark):
    def reason(*groups):
        (row,) = records(planning.coverage_detail(planning.partition_plan(dated(spark, *groups))))
        return row["coverage_detail"]

    head = "partition split failed: "
    assert reason(("s", 2020, None, "1", "p", 5319)) == f"{head}year=2020: 5,319 records and no month values"
    months = [("s", 2019, "1", "1", "p", 1), ("s", 2020, "01", "1", "p", 5000), ("s", 2020, None, "1", "p", 319)]
    assert reason(*months) == f"{head}year=2020: months sum to 5,000, expected 5,319"
    days = [("s", 2020, "01", None, "p", 1), ("s", 2020, "01", "2", "p", 5000)]
    assert reason(*days) == f"{head}year=2020;month=01: days sum to 5,000, expected 5,001"
    assert reason(("s", 2020, "01", None, "p", 5001)) == f"{head}year=2020;month=01: 5,001 records and no day values"
    places = [("s", 2020, "01", "1", "p", 5100), ("s", 2020, "01", "1", None, 219)]
    assert reason(*places) == (
        f"{head}year=2020;month=01: largest day 5,319, places sum to 5,100 (largest 5,100), expected 5,319"
    )


def test_every_page_issue_is_a_row(spark):
    tasks = planning.page_tasks(_plan_frame(spark, ("s", "all", 12_000), ("t", "all", 5)), size=1)
    landed = spark.createDataFrame([("t", 0)], f"{SPECIES} string, page_index long")
    issues = records(planning.page_issues(planning.page_validation(tasks, landed)))
    of_s = sorted((r["issue"], r["page_index"]) for r in issues if r[SPECIES] == "s")
    assert of_s == [(i + 1, i) for i in range(12_000)]
    assert sorted((r["issue"], r["page_index"]) for r in issues if r[SPECIES] == "t") == [(i, i) for i in range(1, 5)]


def test_species_results_name_every_page_issue(spark):
    plan = _plan_frame(spark, ("s", "year=2019", 40), ("t", "all", 2))
    tasks = planning.page_tasks(plan, size=2)
    landed = spark.createDataFrame([("t", 0), ("t", 0)], f"{SPECIES} string, page_index long")
    results = planning.species_results(planning.page_validation(tasks, landed), plan)
    details = {r[SPECIES]: r["page_validation_detail"] for r in records(results)}
    wanted = [f"page={i} start={2 * i} rows=0, expected=2" for i in range(20)]
    assert details == {"s": " | ".join(wanted), "t": None}


def test_run_report_with_kept_and_dropped_rows(spark):
    plan = _plan_frame(spark, ("s", "year=2019", 1200))
    targets = spark.createDataFrame([("s", "Pieridae")], "key string, source_family string")
    merged = spark.createDataFrame([("Pieridae", 1100, 300)], "source_family string, output_rows long, dropped_rows long")
    landed = spark.range(1200).select(F.lit("s").alias(SPECIES), F.floor(F.col("id") / 500).alias("page_index"))
    (report,) = records(run_report(planning.page_tasks(plan), landed, plan, targets, merged=merged))
    assert (report["rows_kept_after_dedupe"], report["rows_dropped"], report["coverage_status"]) == (1100, 300, "complete")
