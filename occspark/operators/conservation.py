"""Attachment of conservation status by name and jurisdiction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.functions.status import (
    match_confidence,
    match_names,
    match_type,
    status_in_state,
    statuses_by_code,
)
from occspark.functions.text import clean_text, strip
from occspark.operators.skew import lookup_join, small_enough
from occspark.schema import CONSERVATION_REFERENCE_FIELDS, STATE_CODES

STATE_STATUS_FIELDS = (
    "state_status_level state_status_for_occurrence state_status_jurisdiction_matched "
    "state_status_qualifier"
).split()


def match_table(reference: DataFrame, row_order: str | None = None) -> DataFrame:
    """U4: one row per match name; the first reference row that lists a name wins.

    ``row_order`` is a column that ranks the reference rows (file order). Without it
    the rows are ranked by their own text, which is stable across runs.
    """
    body = F.struct(*CONSERVATION_REFERENCE_FIELDS)
    rank = F.col(row_order) if row_order else F.to_json(body)
    names = reference.select(
        rank.alias("row_rank"),
        F.posexplode(match_names("accepted_taxon", "match_names")).alias("name_rank", "match_name"),
        body.alias("ref"),
    )
    return names.groupBy("match_name").agg(
        F.min_by("ref", F.struct("row_rank", "name_rank")).alias("ref")
    )


def _candidate(field: str) -> Column:
    """What a match on ``field`` yields; null when the reference has no such name."""
    ref, name = F.col(f"_{field}_ref"), F.col(f"_{field}_name")
    return F.when(
        ref.isNotNull(),
        F.struct(
            ref.alias("ref"),
            name.alias("match_name"),
            match_type(field, name, ref["accepted_taxon"]).alias("match_type"),
            match_confidence(field, name, ref["accepted_taxon"]).alias("match_confidence"),
        ),
    )


def _with_match(df: DataFrame, matches: DataFrame, field: str, broadcast: bool) -> DataFrame:
    name = f"_{field}_name"
    named = df.withColumn(name, F.nullif(strip(field), F.lit("")))
    side = matches.select(F.col("match_name").alias(name), F.col("ref").alias(f"_{field}_ref"))
    if broadcast:
        return named.join(F.broadcast(side), [name], "left")
    return lookup_join(named, side, [name])


def annotate_conservation(
    df: DataFrame,
    reference: DataFrame,
    row_order: str | None = None,
    state_codes: Mapping[str, str] = STATE_CODES,
) -> DataFrame:
    """J3 + J4: every source row with the 29 conservation columns.

    Match names are unique, so two left joins find both candidates and the
    scientific name simply takes precedence: no row numbers, no re-attachment.
    """
    matches = match_table(reference, row_order)
    broadcast = small_enough(matches)
    by_code = statuses_by_code(F.col("ref.state_status"), state_codes)
    matches = matches.withColumn("ref", F.col("ref").withField("_by_code", by_code))
    joined = df
    for field in ("scientificName", "species"):
        joined = _with_match(joined, matches, field, broadcast)
    best = joined.withColumn("_best", F.coalesce(_candidate("scientificName"), _candidate("species")))
    ref = F.col("_best.ref")
    best = best.withColumn("_state", status_in_state("stateProvince", ref["_by_code"], state_codes))

    national = ref["epbc_status"].isNotNull()
    listed = F.col("_state.state_status_level").isNotNull()
    columns = {
        "Status": ref["epbc_status"],
        "epbc_status": ref["epbc_status"],
        "epbc_listed_taxon": F.when(national, ref["accepted_taxon"]),
        "epbc_common_name": F.when(national, ref["common_name"]),
    }
    for field in CONSERVATION_REFERENCE_FIELDS:
        if field.startswith("epbc_") and field != "epbc_status":
            columns[field] = F.when(national, ref[field])
    columns |= {
        "epbc_source_dataset": F.when(national, ref["source_dataset"]),
        "epbc_source_date": F.when(national, ref["source_date"]),
        "epbc_match_type": F.when(national, F.col("_best.match_type")),
        "epbc_match_name": F.when(national, F.col("_best.match_name")),
        "epbc_match_confidence": F.when(national, F.col("_best.match_confidence")),
        "epbc_notes": F.when(national, ref["notes"]),
        "state_status": ref["state_status"],
        "state_status_jurisdiction": F.when(
            ref["state_status"].isNotNull(), ref["state_status_jurisdiction"]
        ),
    }
    columns |= {field: F.col(f"_state.{field}") for field in STATE_STATUS_FIELDS}
    columns |= {
        "state_listed_taxon": F.when(listed, ref["accepted_taxon"]),
        "state_common_name": F.when(listed, ref["common_name"]),
        "state_source_url": F.when(listed, ref["state_source_url"]),
        "state_source_date": F.when(listed, ref["source_date"]),
        "state_match_type": F.when(listed, F.col("_best.match_type")),
        "state_match_name": F.when(listed, F.col("_best.match_name")),
        "state_match_confidence": F.when(listed, F.col("_best.match_confidence")),
        "state_notes": F.when(listed, ref["notes"]),
    }
    kept = [c for c in df.columns if c not in columns]
    return best.select(*kept, *[c.alias(n) for n, c in columns.items()])


def clean_reference(df: DataFrame) -> DataFrame:
    """S7 body: fixed columns, all text, stripped, blank becomes null."""
    present = set(df.columns)
    return df.select(
        *[
            (clean_text(c) if c in present else F.lit(None).cast("string")).alias(c)
            for c in CONSERVATION_REFERENCE_FIELDS
        ],
        *[c for c in df.columns if c not in CONSERVATION_REFERENCE_FIELDS],
    )


def enrichment_counts(enriched: DataFrame) -> DataFrame:
    """Rows, nationally matched rows and state matched rows of an enriched table."""
    return enriched.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("Status").alias("epbc_matched_rows"),
        F.count("state_status_level").alias("state_matched_rows"),
    )
