"""End-to-end jobs that build the cubes and answer a dashboard page."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occspark.operators import areas, grid, planning, slicer
from occspark.schema import DEFAULT_GRID_DECIMALS, SINCE_YEAR
from occspark.sources import tables
from occspark.sources.reference import read_boundaries


def build_grid_cube(
    spark: SparkSession,
    source: str,
    output: str,
    decimals: int = DEFAULT_GRID_DECIMALS,
    overwrite: bool = False,
) -> None:
    """Grid bins, the dimension values and the bounds, each a table under ``output``."""
    tables.check_inputs(spark, [source])
    rows = tables.read_table(spark, source)
    cube = grid.grid_cube(rows, decimals, ordered=True)
    tables.write_table(grid.cube_order(cube), f"{output}/grid_bins", overwrite)
    tables.write_table(grid.dimension_values(rows), f"{output}/grid_dimension_values", overwrite)
    bounds = grid.dimension_bounds(rows).withColumn("grid_decimals", F.lit(decimals))
    tables.write_json(bounds, f"{output}/grid_bounds", overwrite)


def build_area_cubes(
    spark: SparkSession,
    source: str,
    boundary_paths: dict[str, str],
    output: str,
    year: int = SINCE_YEAR,
    tolerance: float = areas.SIMPLIFY_TOLERANCE,
    overwrite: bool = False,
) -> None:
    """Area bins, occupied boundaries thinned for display, and counts, per level.

    Each level has its own folder: its key columns carry the level's name, and a
    slice always asks for exactly one level.
    """
    tables.check_inputs(spark, [source, *boundary_paths.values()])
    rows = tables.read_table(spark, source)
    for level, path in boundary_paths.items():
        folder = f"{output}/{level.lower()}"
        boundaries = read_boundaries(spark, path, level)
        cube = areas.area_cube(rows, boundaries, level, year)
        ordered = grid.cube_order(cube, [areas.area_columns(level)[0]])
        tables.write_table(ordered, f"{folder}/bins", overwrite)
        stored = tables.read_table(spark, f"{folder}/bins")
        shown = areas.simplify_boundaries(areas.occupied_boundaries(boundaries, stored, level), tolerance)
        tables.write_table(shown, f"{folder}/boundaries", overwrite)
        tables.write_table(grid.dimension_values(stored), f"{folder}/dimension_values", overwrite)
        counts = areas.area_counts(rows, stored, boundaries, level, year)
        tables.write_json(counts, f"{folder}/counts", overwrite)


@dataclass(frozen=True)
class DashboardPage:
    """The data behind one page view."""

    options: DataFrame
    areas: DataFrame
    years: DataFrame
    records: DataFrame


def dashboard_page(
    cube: DataFrame,
    boundaries: DataFrame,
    state: slicer.SlicerState,
    level: str = "SA2",
    limit: int | None = None,
    locked: str | None = None,
    top: int | None = None,
) -> DashboardPage:
    return DashboardPage(
        options=slicer.cascading_options(cube, state),
        areas=slicer.area_compositions(
            cube, boundaries, state, level, limit=limit, locked=locked, top=top
        ),
        years=slicer.year_summary(cube, state),
        records=slicer.hidden_records(cube, boundaries, state, level, limit),
    )


def run_report(
    tasks: DataFrame,
    landed: DataFrame,
    plan: DataFrame,
    targets: DataFrame,
    group: Sequence[str] = ("source_family",),
    merged: DataFrame | None = None,
) -> DataFrame:
    """Run metrics and coverage status per family, from plan and landed rows.

    A species none of whose pages landed counts as failed. ``merged`` (A32: group,
    ``output_rows``, ``dropped_rows``) adds what the dedupe of the run kept and dropped.
    """
    validated = planning.page_validation(tasks, landed)
    results = planning.species_results(validated, plan)
    failed = (F.col("rows_written") == 0) & (F.col("reported_total_records") > 0)
    results = results.withColumn("fetch_status", F.when(failed, "failed").otherwise("complete"))
    named = results.join(
        targets.select(F.col("key").alias("query_species_key"), *group), ["query_species_key"], "left"
    )
    report = planning.coverage_rollup(named, *group)
    if merged is None:
        return report
    kept = {"output_rows": "rows_kept_after_dedupe", "dropped_rows": "rows_dropped"}
    counts = merged.select(*group, *kept).withColumnsRenamed(kept)
    zero = {c: F.coalesce(c, F.lit(0)) for c in kept.values()}
    return report.join(counts, [*group], "left").withColumns(zero)
