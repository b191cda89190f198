"""End-to-end jobs that make tables: merge, join, complete, enrich."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from occspark.operators import conservation, impact, profile, taxonomy
from occspark.operators.dedupe import observed_dedupe
from occspark.schema import BUTTERFLY_FAMILIES, OCCURRENCE_SCHEMA
from occspark.sources import reference as references
from occspark.sources import merged, tables


@dataclass(frozen=True)
class MergeCounts:
    input_rows: int
    output_rows: int

    @property
    def dropped_rows(self) -> int:
        return self.input_rows - self.output_rows


def merge_tables(
    spark: SparkSession,
    inputs: Sequence[str],
    output: str,
    csv: str | None = None,
    view: str | None = None,
    overwrite: bool = False,
) -> MergeCounts:
    """Deduplicate shards, species tables or families into one table.

    Counting and writing are one job: observations on both sides of the dedupe fill
    while the table is written. The CSV copy is of gzip files, which hold the same text in a fourth of the room.
    """
    tables.check_outputs(spark, [output, *([csv] if csv else [])], overwrite)
    kept, before, after = observed_dedupe(tables.read_files(spark, inputs))
    tables.write_table(kept, output, overwrite)
    counts = MergeCounts(before.get["rows"], after.get["rows"])
    stored = tables.read_table(spark, output)
    if csv:
        tables.write_csv(stored, csv, overwrite, compression="gzip")
    if view:
        tables.publish_view(stored, view)
    return counts


def merge_into(
    spark: SparkSession, inputs: Sequence[str], table: str, stream: str, batch: int, buckets: int = merged.BUCKETS
) -> MergeCounts:
    """X1 for a table that stays: merge new shards into what is there, touching only their buckets.

    ``stream`` and ``batch`` name the step; a step that is run again changes nothing and counts nothing.
    """
    tables.check_inputs(spark, inputs)
    rows = Observation("rows_merged")
    batch_rows = tables.read_files(spark, inputs).observe(rows, F.count(F.lit(1)).alias("rows"))
    held = merged.current(spark, table, buckets)
    before = merged.read_merged(spark, table).count()
    done = merged.merge_batch(batch_rows, table, stream, batch, buckets)
    added = rows.get["rows"] if done.version > held.version else 0
    return MergeCounts(before + added, merged.read_merged(spark, table).count())


def write_profile(report: profile.QualityProfile, folder: str, overwrite: bool) -> None:
    """The profile's four tables as files."""
    tables.write_json(report.summary, f"{folder}/quality_summary", overwrite)
    tables.write_csv(report.column_profile, f"{folder}/column_profile", overwrite)
    tables.write_csv(report.top_values, f"{folder}/categorical_top_values", overwrite)
    tables.write_csv(report.species_counts, f"{folder}/species_counts", overwrite)


def join_families(
    spark: SparkSession, inputs: Sequence[str], output: str, reports: str, overwrite: bool = False
) -> MergeCounts:
    """Family tables (columns matched by name) into one table, with its profile."""
    tables.check_inputs(spark, inputs)
    report_paths = [f"{reports}/{n}" for n in ("join_metadata", "quality_summary")]
    tables.check_outputs(spark, [output, *report_paths], overwrite)
    union = tables.with_source_file(tables.read_by_name(spark, inputs))
    kept, before, after = observed_dedupe(union)
    tables.write_table(kept.select(*OCCURRENCE_SCHEMA.fieldNames()), output, overwrite)
    counts = MergeCounts(before.get["rows"], after.get["rows"])
    per_file = union.groupBy("source_file").agg(F.count(F.lit(1)).alias("input_rows"))
    metadata = per_file.withColumns(
        {
            "total_input_rows": F.lit(counts.input_rows),
            "total_output_rows": F.lit(counts.output_rows),
            "total_dropped_rows": F.lit(counts.dropped_rows),
        }
    )
    tables.write_json(metadata, report_paths[0], overwrite)
    write_profile(profile.profile(tables.read_table(spark, output)), reports, overwrite)
    return counts


def complete_taxonomy_table(
    spark: SparkSession,
    source: str,
    output: str,
    reports: str,
    authority: DataFrame | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """Fill genus and species, store the table and its reports; returns the counts."""
    tables.check_inputs(spark, [source])
    tables.check_outputs(spark, [output], overwrite)
    rows = tables.read_table(spark, source)
    # The lookup is stored first: its size is then known, and when it is small the
    # fact table is filled without being shuffled.
    lookup_path = f"{reports}/taxonomy_lookup"
    tables.write_table(taxonomy.fill_lookup(rows, authority), lookup_path, overwrite)
    lookup = tables.read_table(spark, lookup_path)
    tables.write_table(taxonomy.apply_fill_lookup(rows, lookup), output, overwrite)
    done = tables.read_table(spark, output)
    counts = taxonomy.completion_counts(rows, authority)
    tables.write_json(counts, f"{reports}/taxonomy_fill", overwrite)
    tables.write_csv(taxonomy.missing_taxonomy_rows(done), f"{reports}/missing_taxonomy_rows", overwrite)
    tables.write_csv(taxonomy.month_counts(done), f"{reports}/month_counts", overwrite)
    return counts


def enrich_conservation_table(
    spark: SparkSession,
    source: str,
    reference: str,
    output: str,
    report: str | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """Add the conservation columns, store the table; returns the match counts."""
    tables.check_inputs(spark, [source, reference])
    tables.check_outputs(spark, [output], overwrite)
    listed = references.read_conservation_reference(spark, reference)
    rows = tables.read_table(spark, source)
    enriched = conservation.annotate_conservation(rows, listed, row_order="row_order")
    tables.write_table(enriched, output, overwrite)
    counts = conservation.enrichment_counts(tables.read_table(spark, output))
    if report:
        tables.write_json(counts, report, overwrite)
    return counts


def source_impact(
    spark: SparkSession,
    base: str,
    source: str,
    families: Sequence[str] = BUTTERFLY_FAMILIES,
    report: str | None = None,
    overwrite: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Counts and family counts of a second source against the existing table.

    A missing or unreadable base table is reported and counts as empty.
    """
    rows = tables.read_table(spark, source)
    found, existing, error = tables.path_exists(spark, base), None, None
    if found:
        try:
            existing = tables.read_table(spark, base)
            # The summary reads all that it needs of the table; it is one row.
            read = impact.impact_summary(rows, existing, families, found, None)
            summary = spark.createDataFrame(read.collect(), read.schema)
        except Exception as problem:  # any read error makes the table unreadable
            existing, error = None, str(problem).split("\n", 1)[0]
    if existing is None:
        summary = impact.impact_summary(rows, None, families, found, error)
    counts = impact.impact_family_counts(rows, existing, families)
    if report:
        tables.write_json(summary, f"{report}/summary", overwrite)
        tables.write_csv(counts, f"{report}/family_counts", overwrite)
    return summary, counts


def target_list(
    df: DataFrame,
    order: str,
    family: str | None = None,
    fields: Sequence[str] = ("species", "subspecies"),
) -> DataFrame:
    """Species targets of an order, or of one of its families, from the data."""
    rows = df.where(F.col("order") == order)
    if family is not None:
        rows = rows.where(F.col("family") == family)
    facets = taxonomy.name_facets(rows, fields, strict=family is None)
    return taxonomy.merge_taxa(facets, by_family=family is not None)


def profile_families(
    spark: SparkSession,
    root: str,
    reports: str | None = None,
    taxon_class: str | None = None,
    order: str | None = None,
    family: str | None = None,
    overwrite: bool = False,
) -> profile.QualityProfile:
    """X11: profile every family table under a root in one job, grouped by its keys."""
    rows = tables.read_family_tables(spark, root, taxon_class, order, family)
    report = profile.profile(rows, ("class_key", "order_key", "family_key"))
    if reports:
        write_profile(report, reports, overwrite)
    return report


