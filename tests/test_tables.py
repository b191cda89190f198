"""Dedupe, taxonomy, conservation, profile, impact, sources and jobs on small tables."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from conftest import records
from pyspark.sql import functions as F

from occspark.operators import conservation, impact, profile, taxonomy
from occspark.operators.dedupe import dedupe
from occspark.operators.skew import lookup_join, top_n
from occspark.plans import tables as jobs
from occspark.schema import (
    BASE_FIELDS,
    CANONICAL_FIELDS,
    OCCURRENCE_SCHEMA,
    check_privacy,
    empty_table,
    ensure_columns,
    occurrence_schema,
    project_fields,
)
from occspark.sources import merged, pages, reference, tables
from occspark.streaming import ingest

# --- schema ------------------------------------------------------------------------


def test_schema_rules(spark):
    assert empty_table(spark).columns == BASE_FIELDS
    assert len(occurrence_schema(True)) == 55 and len(CANONICAL_FIELDS) == 48
    assert project_fields(spark.range(1).withColumn("image", F.lit("x"))).columns == BASE_FIELDS
    assert "image" in project_fields(spark.range(1), include_user_data=True).columns
    with pytest.raises(ValueError):
        check_privacy(include_user_data=False, keep_raw_pages=True)
    assert ensure_columns(spark.range(1), {"id": "long", "x": "double"}).dtypes == [
        ("id", "bigint"),
        ("x", "double"),
    ]


# --- dedupe ------------------------------------------------------------------------


def test_earliest_event_wins(occurrences):
    rows = occurrences(
        {"uuid": "dup", "eventDate": 2000},
        {"uuid": "dup", "eventDate": 1000},
        {"uuid": "dup", "eventDate": None},
        {"uuid": "unique", "eventDate": 3000},
    )
    kept = dedupe(rows)
    assert kept.columns == BASE_FIELDS
    assert {(r["uuid"], r["eventDate"]) for r in records(kept)} == {("dup", 1000), ("unique", 3000)}


def test_records_without_identifier_use_their_fingerprint(occurrences):
    same = {
        "scientificName": "A b",
        "decimalLatitude": -37.1,
        "decimalLongitude": 145.2,
        "eventDate": 1000,
        "dataResourceUid": "dr1",
        "recordNumber": "rn1",
        "basisOfRecord": "HUMAN",
    }
    other_basis = {k: v for k, v in same.items() if k != "basisOfRecord"} | {"raw_basisOfRecord": "HUMAN"}
    rows = occurrences(same, same | {"uuid": ""}, other_basis, same | {"scientificName": "C d"})
    assert dedupe(rows).count() == 2
    assert dedupe(rows, enabled=False).count() == 4


def test_dedupe_against_brute_force_with_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("uuid"),
        (F.xxhash64("id") % 1000).alias("eventDate"),
        F.col("id").cast("string").alias("query_species_key"),
    )
    best: dict[str, tuple] = {}
    for r in records(rows):
        candidate = (r["eventDate"], r["query_species_key"])
        best[r["uuid"]] = min(best.get(r["uuid"], candidate), candidate)
    kept = {r["uuid"]: (r["eventDate"], r["query_species_key"]) for r in records(dedupe(rows))}
    assert kept == best
    plan = dedupe(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one of them before the shuffle


def test_top_n_beyond_the_group_limit_is_exact(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("k"), "id")
    ranked = top_n(rows, ["k"], [F.col("id").desc()], 1500)
    got = {(r["k"], r["rank"], r["id"]) for r in records(ranked)}
    wanted = set()
    for key in ("hot", "cold"):
        ids = sorted((i for i in range(6000) if ("hot" if i % 3 < 2 else "cold") == key), reverse=True)
        wanted |= {(key, n, i) for n, i in enumerate(ids[:1500], 1)}
    assert got == wanted


def test_lookup_join_keeps_row_counts_and_nulls(spark):
    facts = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, v int")
    lookup = spark.createDataFrame([("a", "A")], "k string, w string")
    got = sorted((str(r["k"]), r["v"], r["w"]) for r in records(lookup_join(facts, lookup, ["k"])))
    assert got == [("None", 3, None), ("a", 1, "A"), ("a", 1, "A"), ("b", 2, None)]
    assert lookup_join(facts, lookup, ["k"], "left_anti").count() == 2


# --- jobs on files --------------------------------------------------------------------


def test_merge_across_tables_counts_in_one_pass(spark, occurrences, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    tables.write_table(
        occurrences({"uuid": "shared", "eventDate": 2000}, {"uuid": "first", "eventDate": 3000}), first
    )
    tables.write_table(
        occurrences({"uuid": "shared", "eventDate": 1000}, {"uuid": "second", "eventDate": 4000}), second
    )
    output = str(tmp_path / "all")
    counts = jobs.merge_tables(
        spark, [first, second, str(tmp_path / "absent")], output, csv=str(tmp_path / "csv"), view="merged"
    )
    assert (counts.input_rows, counts.output_rows, counts.dropped_rows) == (4, 3, 1)
    shared = spark.table("merged").where("uuid = 'shared'").first()
    assert shared["eventDate"] == 1000
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3
    with pytest.raises(FileExistsError):
        jobs.merge_tables(spark, [first], output)
    nothing = jobs.merge_tables(spark, [str(tmp_path / "absent")], str(tmp_path / "none"))
    assert nothing.output_rows == 0


def test_row_groups_and_codec(spark, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "t"
    tables.write_table(spark.range(0, 5000, 1, 1), str(path), row_group_rows=2000)
    part = next(p for p in path.iterdir() if p.suffix == ".parquet")
    metadata = pq.ParquetFile(part).metadata
    assert metadata.row_group(0).column(0).compression == "ZSTD"
    assert max(metadata.row_group(i).num_rows for i in range(metadata.num_row_groups)) <= 2000


def test_join_families(spark, occurrences, tmp_path):
    inputs = []
    for i in range(6):
        uuid, date = ("shared", 2000 - i * 200) if i in (1, 4) else (f"u{i}", 100 * i)
        path = str(tmp_path / f"f{i}")
        rows = occurrences({"uuid": uuid, "eventDate": date, "family": f"F{i}", "scientificName": "A b"})
        tables.write_table(rows.drop("license") if i == 2 else rows, path)
        inputs.append(path)
    output, reports = str(tmp_path / "joined"), str(tmp_path / "reports")
    counts = jobs.join_families(spark, inputs, output, reports)
    assert (counts.input_rows, counts.output_rows, counts.dropped_rows) == (6, 5, 1)
    joined = tables.read_table(spark, output)
    assert joined.columns == BASE_FIELDS
    assert joined.where("uuid = 'shared'").first()["eventDate"] == 1200
    assert spark.read.json(f"{reports}/join_metadata").count() == 6
    with pytest.raises(FileNotFoundError, match="gone"):
        jobs.join_families(spark, [*inputs, str(tmp_path / "gone")], output, reports, overwrite=True)


def test_family_tables_under_a_root(spark, occurrences, tmp_path):
    root = tmp_path / "datasets"
    for parts in (
        ("insecta", "lepidoptera", "pieridae", "pieridae.parquet"),
        ("insecta", "lepidoptera", "lycaenidae", "lycaenidae.parquet"),
        ("insecta", "lepidoptera", "species", "species.parquet"),
        ("insecta", "lepidoptera", "pieridae", "other.parquet"),
    ):
        rows = occurrences({"uuid": "/".join(parts), "scientificName": "A b", "family": parts[2]})
        tables.write_table(rows, str(root.joinpath(*parts)))
    found = tables.read_family_tables(spark, str(root), taxon_class="Insecta", order=" Lepidoptera ")
    assert {r["family_key"] for r in records(found.select("family_key"))} == {"pieridae", "lycaenidae"}
    report = jobs.profile_families(spark, str(root), str(tmp_path / "reports"), family="Pieridae")
    (summary,) = records(report.summary)
    assert (summary["family_key"], summary["row_count"], summary["species_count"]) == ("pieridae", 1, 1)


# --- taxonomy --------------------------------------------------------------------------

TAXA = [
    ("1", "Exactus alpha", "species", "Exactus", "Exactus alpha", "01"),
    ("2", "Exactus alpha", "species", None, None, "13"),
    ("3", "Lookup beta", "species", None, None, None),
    ("4", "GenusOnly", "genus", "GenusOnly", None, "01"),
    ("5", "FAMILYONLY", "family", None, None, "02"),
]
TAXA_SCHEMA = "uuid string, scientificName string, taxonRank string, genus string, species string, month string"
AUTHORITY_SCHEMA = (
    "scientificName string, rank string, status string, confidence int, genus string, species string"
)


def test_complete_taxonomy_job(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.createDataFrame(TAXA, TAXA_SCHEMA).write.parquet(source)
    authority = spark.createDataFrame(
        [("Lookup beta", "species", "accepted", 95, "Lookup", "Lookup beta")], AUTHORITY_SCHEMA
    )
    output, reports = str(tmp_path / "out"), str(tmp_path / "reports")
    (counts,) = records(jobs.complete_taxonomy_table(spark, source, output, reports, authority))
    assert counts == {
        "input_rows": 5,
        "initial_missing_rows": 4,
        "exact_fill_rows": 1,
        "authority_fill_rows": 1,
        "remaining_missing_rows": 2,
        "rejected_lookup_count": 2,
    }
    done = {r["uuid"]: (r["genus"], r["species"]) for r in records(tables.read_table(spark, output))}
    assert done["2"] == ("Exactus", "Exactus alpha") and done["3"] == ("Lookup", "Lookup beta")
    assert done["4"] == ("GenusOnly", None)
    months = [tuple(r.values()) for r in records(taxonomy.month_counts(tables.read_table(spark, output)))]
    assert months == [("01", 2), ("02", 1), ("13", 1), (None, 1)]
    missing = records(taxonomy.missing_taxonomy_rows(tables.read_table(spark, output)))
    assert [r["uuid"] for r in missing] == ["5", "4"]


@pytest.mark.parametrize(
    "row",
    [
        ("Lookup beta", "genus", "ACCEPTED", 99, "Lookup", "Lookup beta"),
        ("Lookup beta", "species", "DOUBTFUL", 99, "Lookup", "Lookup beta"),
        ("Lookup beta", "species", "SYNONYM", 89, "Lookup", "Lookup beta"),
        ("Lookup beta", "species", "ACCEPTED", 99, "Lookup", None),
    ],
)
def test_unacceptable_authority_rows_fill_nothing(spark, row):
    taxa = taxonomy.apply_exact_fills(spark.createDataFrame(TAXA, TAXA_SCHEMA))
    authority = spark.createDataFrame([row], AUTHORITY_SCHEMA)
    filled = taxonomy.apply_authority_fills(taxa, authority)
    assert filled.where(taxonomy.missing_taxonomy()).count() == 3
    rejected = taxonomy.authority_rejections(taxa, authority)
    assert {r[0] for r in rejected.collect()} == {"Lookup beta", "GenusOnly", "FAMILYONLY"}


def test_ambiguous_names_are_not_filled(spark):
    rows = [("A b", "A", "A b"), ("A b", "A", "A c"), ("A b", None, None)]
    df = spark.createDataFrame(rows, "scientificName string, genus string, species string")
    assert taxonomy.exact_lookup(df).count() == 0


def test_merge_taxa(spark):
    rows = [
        ("Lepidoptera", "Pieridae", "species", "Sarona tumida", 5, 'species:"Sarona tumida"'),
        ("Lepidoptera", None, "subspecies", "Sarona tumida", 2, None),
        ("Lepidoptera", "Pieridae", "species", "Aporia agathon", 1, 'species:"Aporia agathon"'),
    ]
    schema = (
        "order string, family string, facet_field string, scientific_name string, "
        "occurrence_count long, facet_fq string"
    )
    merged = records(taxonomy.merge_taxa(spark.createDataFrame(rows, schema)))
    assert [r["species_key"] for r in merged] == ["aporia_agathon", "sarona_tumida"]
    assert merged[1]["facet_fields"] == "species | subspecies"
    assert merged[1]["occurrence_count"] == 7
    assert (merged[1]["family"], merged[1]["facet_fq"]) == ("Pieridae", 'species:"Sarona tumida"')


def test_facet_labels_keep_the_first_of_a_key(occurrences):
    rows = [{"classs": "Insecta", "order": o} for o in ["Lepidoptera"] * 3 + ["LEPIDOPTERA", "Diptera", "unknown"]]
    found = records(taxonomy.discover_orders(occurrences(*rows), "Insecta"))
    assert {(r["label"], r["count"]) for r in found} == {("Lepidoptera", 3), ("Diptera", 1)}


# --- conservation ------------------------------------------------------------------------


def test_enrichment_job(spark, tmp_path):
    rows = [
        ("1", "Antipodia chaostola leucophaea", "Antipodia chaostola", "Tasmania"),
        ("2", "Paralucia spinifera", "Paralucia spinifera", "New South Wales"),
        ("3", "Jalmenus eubulus subsp", " Jalmenus eubulus ", "Queensland"),
        ("4", "Oreisplanus munionga larana", "Oreisplanus munionga", "Tasmania"),
        ("5", "Junonia villida", "Junonia villida", "Victoria"),
    ]
    source = str(tmp_path / "source")
    spark.createDataFrame(rows, "uuid string, scientificName string, species string, stateProvince string").write.parquet(
        source
    )
    csv = tmp_path / "reference.csv"
    csv.write_text(
        "accepted_taxon,match_names,common_name,epbc_status,state_status,notes\n"
        "Antipodia chaostola leucophaea,Antipodia chaostola leucophaea,Skipper,Endangered,Endangered,n1\n"
        "Paralucia spinifera,Paralucia spinifera, Purple Copper ,Vulnerable,Endangered,n2\n"
        "Jalmenus eubulus,Jalmenus eubulus,Hairstreak,,NSW: Critically Endangered; QLD: Vulnerable,n3\n"
        "Hesperilla munionga larana,Hesperilla munionga larana|Oreisplanus munionga larana,Marrawah,Vulnerable,Endangered,n4\n"
        "Late entry,Paralucia spinifera,Never used,Extinct,,n5\n"
    )
    output = str(tmp_path / "out")
    (counts,) = records(jobs.enrich_conservation_table(spark, source, str(csv), output, str(tmp_path / "r")))
    assert counts == {"row_count": 5, "epbc_matched_rows": 3, "state_matched_rows": 4}
    got = {r["uuid"]: r for r in records(tables.read_table(spark, output))}
    assert (got["1"]["Status"], got["1"]["epbc_match_type"]) == ("Endangered", "scientificName")
    assert (got["1"]["epbc_match_confidence"], got["1"]["state_status_for_occurrence"]) == (1.0, "TAS: Endangered")
    assert (got["2"]["Status"], got["2"]["epbc_common_name"]) == ("Vulnerable", "Purple Copper")
    third = got["3"]
    assert third["Status"] is None and third["epbc_notes"] is None and third["state_notes"] == "n3"
    assert third["state_status"] == "NSW: Critically Endangered; QLD: Vulnerable"
    assert (third["state_status_level"], third["state_status_jurisdiction_matched"]) == ("Vulnerable", "QLD")
    assert (third["state_match_type"], third["state_match_confidence"]) == ("species", 0.9)
    assert got["4"]["epbc_match_type"] == "scientificName_synonym"
    assert (got["4"]["epbc_listed_taxon"], got["4"]["epbc_match_confidence"]) == ("Hesperilla munionga larana", 0.95)
    assert all(v is None for k, v in got["5"].items() if k.startswith(("epbc_", "state_", "Status")))
    assert len(got["5"]) == 4 + 29


def test_first_listed_name_wins(spark):
    rows = [("B", "X|Y", 1), ("A", "Y|Z", 0)]
    df = conservation.clean_reference(
        spark.createDataFrame(rows, "accepted_taxon string, match_names string, row_order int")
    )
    table = conservation.match_table(df, "row_order").select("match_name", "ref.accepted_taxon")
    assert dict(table.collect()) == {"A": "A", "Y": "A", "Z": "A", "B": "B", "X": "B"}


# --- profile -----------------------------------------------------------------------------

PROFILE_SCHEMA = (
    "uuid string, scientificName string, species string, family string, order string, basisOfRecord string, "
    "decimalLatitude double, decimalLongitude double, year long"
)


def test_profile(spark):
    rows = [
        ("u1", "Testus alpha", "Testus alpha", "F", "O", "HUMAN", -37.0, 146.3, 2000),
        ("u1", "Testus alpha", "Testus alpha", "F", "O", "HUMAN", -37.0, 146.3, 2001),
        ("u3", "Testus beta", None, "F", "O", None, 95.0, 181.0, None),
        (None, None, None, "F", "O", None, None, None, 2001),
    ]
    report = profile.profile(spark.createDataFrame(rows, PROFILE_SCHEMA))
    (summary,) = records(report.summary)
    assert summary == {
        "row_count": 4,
        "coordinate_issue_count": 2,
        "min_year": 2000,
        "max_year": 2001,
        "duplicate_uuid_count": 1,
        "species_count": 2,
        "distinct_year_count": 2,
        "column_count": 9,
        "quality_flags": ["coordinate_range_issue", "duplicate_uuid", "single_value"],
    }
    columns = {r["column"]: r for r in records(report.column_profile)}
    name = columns["scientificName"]
    assert (name["null_count"], name["distinct_count"], name["null_percent"]) == (1, 3, 25.0)
    assert columns["family"]["flags"] == "single_value"
    assert records(report.species_counts) == [
        {"name": "Testus alpha", "count": 2},
        {"name": "Testus beta", "count": 1},
    ]
    top = [r for r in records(report.top_values) if r["column"] == "basisOfRecord"]
    assert sorted((r["rank"], r["value"], r["count"]) for r in top) == [(1, "HUMAN", 2), (2, None, 2)]


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "uuid string, scientificName string, year long")
    report = profile.profile(empty)
    (summary,) = records(report.summary)
    assert (summary["row_count"], summary["column_count"]) == (0, 3)
    assert summary["quality_flags"] == ["missing_species_counts"]
    columns = {r["column"]: r for r in records(report.column_profile)}
    assert columns["year"] == {
        "column": "year",
        "dtype": "bigint",
        "null_count": 0,
        "null_percent": 0.0,
        "non_null_count": 0,
        "distinct_count": 0,
        "flags": "",
    }
    assert report.species_counts.count() == 0


# --- impact ------------------------------------------------------------------------------


def _impact_tables(spark):
    base = spark.createDataFrame(
        [
            ("1", "Sarona tumida", "Pieridae", -33.123456, 151.0, "2020-01-02T00:00:00+00:00"),
            ("2", "Sarona nigrina", "Pieridae", -33.0, 151.0, "2020-01-03T00:00:00+00:00"),
        ],
        "uuid string, scientificName string, family string, decimalLatitude double, decimalLongitude double, "
        "eventDate_iso string",
    )
    source = spark.createDataFrame(
        [
            ("SARONA tumida", "Pieridae", "2020-01-02", -33.123459, 151.0),
            ("Sarona aganippe", "Pieridae", "2021-05-06", -34.0, 150.0),
        ],
        "scientific_name string, family string, event_date_start string, decimal_latitude double, "
        "decimal_longitude double",
    )
    return base, source


def test_impact_report(spark, tmp_path):
    base, source = _impact_tables(spark)
    base.write.parquet(str(tmp_path / "base"))
    source.write.parquet(str(tmp_path / "source"))
    report = str(tmp_path / "report")
    summary, counts = jobs.source_impact(spark, str(tmp_path / "base"), str(tmp_path / "source"), report=report)
    (got,) = records(summary)
    assert (got["candidate_duplicate_rows"], got["candidate_new_rows"]) == (1, 1)
    assert (got["expected_rows_without_dedupe"], got["expected_rows_after_dedupe"]) == (4, 3)
    assert got["candidate_duplicate_ratio"] == 0.5 and got["base_table_readable"]
    assert {tuple(r.values()) for r in records(counts)} == {("source", "Pieridae", 2), ("base", "Pieridae", 2)}

    (missing,) = records(jobs.source_impact(spark, str(tmp_path / "no"), str(tmp_path / "source"))[0])
    assert not missing["base_table_found"] and missing["candidate_new_rows"] == 2
    (tmp_path / "broken.parquet").write_text("not parquet")
    (broken,) = records(
        jobs.source_impact(spark, str(tmp_path / "broken.parquet"), str(tmp_path / "source"))[0]
    )
    assert broken["base_table_found"] and not broken["base_table_readable"] and broken["base_read_error"]


def test_impact_without_a_family_column(spark):
    base, source = _impact_tables(spark)
    (got,) = records(impact.impact_summary(source.drop("family"), base))
    assert (got["source_rows"], got["candidate_duplicate_rows"]) == (2, 0)
    (other,) = records(impact.impact_summary(source.withColumn("family", F.lit("Other")), base))
    assert (other["source_rows"], other["existing_rows_considered"]) == (0, 2)
    assert other["candidate_duplicate_ratio"] == 0.0


# --- landed pages ------------------------------------------------------------------------


def test_pages_to_records(spark, tmp_path):
    page = {
        "totalRecords": 1,
        "occurrences": [
            {
                "uuid": "record-1",
                "scientificName": "Testus species",
                "decimalLatitude": "-36.41",
                "eventDate": "1000",
                "spatiallyValid": "true",
                "unusedExtraField": "ignored",
            }
        ],
    }
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "p0.json").write_text(json.dumps(page, indent=1))
    found = pages.page_records(pages.read_pages(spark, str(tmp_path)))
    tagged = found.withColumn("query_species_key", F.lit("testus"))
    (row,) = records(pages.normalise_records(tagged))
    assert row["query_species_key"] == "testus" and row["target_match_suspect"] is False
    assert (row["decimalLatitude"], row["eventDate"], row["spatiallyValid"]) == (-36.41, 1000, True)
    assert row["eventDate_iso"] == "1970-01-01T00:00:01+00:00" and row["vernacularName"] is None
    assert "unusedExtraField" not in row


def test_suspect_flag_follows_the_first_record(spark):
    rows = [
        ("a", "Ornitha vexans", None, "f0", 0, '{"species": "Ornitha (Lirida) vexans"}'),
        ("a", "Ornitha vexans", None, "f0", 1, '{"species": "Other"}'),
        ("b", "Ornitha vexans", None, "f0", 1, '{"species": "Ornitha vexans"}'),
        ("b", "Ornitha vexans", None, "f0", 0, '{"species": "Other"}'),
        ("c", "Ornitha vexans", "id", "f0", 0, '{"species": "Other"}'),
    ]
    df = spark.createDataFrame(
        rows,
        "query_species_key string, query_scientific_name string, query_taxon_lsid string, page_file string, "
        "position int, record string",
    )
    flagged = pages.flag_suspect_targets(df)
    flags = {(r["query_species_key"], r["target_match_suspect"]) for r in records(flagged)}
    assert flags == {("a", False), ("b", True), ("c", False)} and flagged.count() == 5


def test_second_source_in_catalogue_order(spark, tmp_path):
    base = {"class": "Insecta", "order": "Lepidoptera", "stateProvince": "NSW", "family": "Pieridae"}
    made = [
        base | {"catalogNumber": "c3", "eventDate": "2008-10-01", "decimalLatitude": -33.0},
        base | {"catalogNumber": "c1", "sensitivityClass": "Sensitive", "zz": 1, "country": None},
        base | {"catalogNumber": "c2", "family": "Lycaenidae", "dataGeneralizations": "Location hidden"},
        base | {"catalogNumber": "c4", "family": "Noctuidae"},
    ]
    (tmp_path / "p0.json").write_text(json.dumps({"value": made[:2]}))
    (tmp_path / "p1.json").write_text(json.dumps({"value": made[2:]}))
    rows = pages.ingest_second_source(spark, str(tmp_path))
    assert rows.columns == CANONICAL_FIELDS and rows.count() == 3
    got = {r["catalog_number"]: r for r in records(rows)}
    assert got["c3"]["year"] == 2008 and not got["c3"]["spatially_generalised"]
    assert got["c1"]["sensitive_record"] and got["c1"]["spatially_generalised"]
    assert not got["c2"]["sensitive_record"] and got["c2"]["spatially_generalised"]
    payload = {k: v for k, v in made[1].items() if k != "zz"}
    assert got["c1"]["raw_source_payload"] == json.dumps(payload, sort_keys=True, separators=(",", ":"))
    assert '"decimalLatitude":-33.0' in got["c3"]["raw_source_payload"]
    capped = pages.ingest_second_source(spark, str(tmp_path), max_records=2)
    assert [r["catalog_number"] for r in records(capped)] == ["c1", "c2"]


def test_second_source_of_pages_on_lines_and_of_pages_as_files(spark, tmp_path):
    base = {"class": " Insecta", "order": "Lepidoptera ", "stateProvince": "NSW", "family": "Pieridae", "decimalLatitude": 1}
    odd = [{"class": 1, "order": None}, {"class": "Insecta", "stateProvince": {"NSW": "NSW"}}, {}]
    made = [base | {"catalogNumber": f"c{i % 7}", "eventDate": f"20{i:02}-01-01"} for i in range(30)] + odd
    texts = [json.dumps({"value": made[i : i + 4]}) for i in range(0, len(made), 4)]
    for folder, held in {"files": texts, "lines": ["\n".join(texts)]}.items():
        (tmp_path / folder).mkdir()
        for i, text in enumerate(held):
            (tmp_path / folder / f"p{i}").write_text(text)
    given = {"families": ["Pieridae"], "ingested_at": "2026-01-01"}
    whole = records(pages.ingest_second_source(spark, str(tmp_path / "files"), **given))
    order = sorted(whole, key=lambda r: (r["catalog_number"], r["canonical_record_hash"]))
    assert len(order) == 30
    for limit in (0, 11, 100):
        capped = pages.ingest_second_source(spark, str(tmp_path / "lines"), max_records=limit, per_line=True, **given)
        assert records(capped) == order[:limit]


def test_targets(spark, tmp_path):
    path = tmp_path / "targets.json"
    given = [
        {"scientific_name": " Sarona tumida ", "facet_fq": 'species:"a" | subspecies:"b"', "order": "L"},
        {"scientific_name": "Sarona nigrina", "key": "nig", "taxon_class": "Insecta"},
    ]
    path.write_text(json.dumps(given))
    got = {r["key"]: r for r in records(reference.read_targets(spark, str(path)))}
    assert got["sarona_tumida"]["facet_fq_filters"] == ['species:"a"', 'subspecies:"b"']
    assert got["nig"]["source_class"] == "Insecta" and got["nig"]["facet_fq_filters"] == []
    path.write_text(json.dumps([{"scientific_name": "A b", "facet_fq": ["x", " "]}]))
    assert records(reference.read_targets(spark, str(path)))[0]["facet_fq_filters"] == ["x"]
    for bad in ([given[1], given[1]], [], [{"scientific_name": " "}], [{"key": "x"}]):
        path.write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            reference.read_targets(spark, str(path))


# --- streaming ---------------------------------------------------------------------------


def test_incremental_ingest(spark, tmp_path):
    landed, table, checkpoint = (str(tmp_path / n) for n in ("pages", "table", "checkpoint"))
    folder = tmp_path / "pages" / "testus"
    folder.mkdir(parents=True)
    targets = spark.createDataFrame([("testus", "testus")], "page_folder string, query_species_key string")

    def land(name, *rows):
        (folder / name).write_text(json.dumps({"occurrences": list(rows)}))
        stream = ingest.ingest_stream(spark, landed, table, checkpoint, targets)
        stream.awaitTermination()
        assert stream.exception() is None

    land("p0.json", {"uuid": "a", "eventDate": 2000}, {"uuid": "a", "eventDate": 3000}, {"uuid": "b"})
    land("p1.json", {"uuid": "a", "eventDate": 1000}, {"uuid": "c", "eventDate": 5})
    current = ingest.current_table(spark, table)
    assert current.columns == OCCURRENCE_SCHEMA.fieldNames()
    got = {(r["uuid"], r["eventDate"], r["query_species_key"]) for r in records(current)}
    assert got == {("a", 1000, "testus"), ("b", None, "testus"), ("c", 5, "testus")}
    # Replaying a batch changes nothing, whatever it holds.
    held = merged.current(spark, table)
    ((stream, last),) = held.merged.items()
    assert ingest.write_batch(current.limit(1), last, table, stream).version == held.version
    assert merged.current(spark, table) == held


def _event(uuid, date, name="x"):
    return {"uuid": uuid, "eventDate": date, "scientificName": name}


def test_merge_equals_a_dedupe_of_the_whole_history(spark, occurrences, tmp_path):
    draw = random.Random(4)
    root, history = str(tmp_path / "t"), []
    for batch in range(6):
        rows = [_event(f"u{draw.randrange(60)}", draw.choice([None, *range(50)]), f"n{draw.randrange(4)}") for _ in range(25)]
        rows.append(_event(None, None, f"n{batch % 2}"))
        history += rows
        done = merged.merge_batch(occurrences(*rows), root, "s", batch, buckets=8, parts=3)
        assert done.version == batch + 1
        whole = {(r["uuid"], r["eventDate"]) for r in records(dedupe(occurrences(*history)))}
        found = records(merged.read_merged(spark, root))
        assert {(r["uuid"], r["eventDate"]) for r in found} == whole
        assert len({(r["uuid"], r["scientificName"]) if r["uuid"] is None else r["uuid"] for r in found}) == len(found)
    held = merged.current(spark, root)
    assert held.merged == {"s": 5} and max(map(len, held.parts.values())) <= 3


def test_a_merge_writes_only_what_it_touches(spark, occurrences, tmp_path):
    root = str(tmp_path / "t")
    first = merged.merge_batch(occurrences(*[_event(f"u{i}", 10) for i in range(200)]), root, "s", 0, buckets=16)
    assert len(first.added) == 16 and not first.rewritten
    before = merged.current(spark, root)
    later = merged.merge_batch(occurrences(_event("u3", 99), _event("u3", 12)), root, "s", 1, buckets=16)
    assert (later.added, later.rewritten) == ([], [])  # both lose
    new = merged.merge_batch(occurrences(_event("new", 1)), root, "other", 0, buckets=16)
    assert len(new.added) == 1 and not new.rewritten
    early = merged.merge_batch(occurrences(_event("u7", 1)), root, "s", 2, buckets=16)
    assert not early.added and len(early.rewritten) == 1
    after = merged.current(spark, root)
    changed = {b for b in before.parts if before.parts[b] != after.parts[b]}
    assert changed == {*new.added, *early.rewritten}
    assert merged.read_merged(spark, root).where("uuid = 'u7'").first()["eventDate"] == 1


def test_of_two_writers_the_second_merges_upon_the_first(spark, occurrences, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    merged.merge_batch(occurrences(_event("a", 5)), root, "s", 0, buckets=2)
    publish, met = merged._Files.publish, []

    def late(files, name, text):
        if not met:
            met.append(name)
            merged.merge_batch(occurrences(_event("a", 1), _event("b", 1)), root, "other", 0, buckets=2)
        return publish(files, name, text)

    monkeypatch.setattr(merged._Files, "publish", late)
    assert merged.merge_batch(occurrences(_event("a", 3), _event("c", 3)), root, "s", 1, buckets=2).version == 3
    got = {(r["uuid"], r["eventDate"]) for r in records(merged.read_merged(spark, root))}
    assert got == {("a", 1), ("b", 1), ("c", 3)}
    assert merged.current(spark, root).merged == {"s": 1, "other": 0}


def test_merge_of_an_empty_batch_and_reading_nothing(spark, occurrences, tmp_path):
    root = str(tmp_path / "t")
    assert merged.read_merged(spark, root).count() == 0
    assert merged.merge_batch(occurrences(_event("a", 5)).limit(0), root, "s", 0).version == 1
    assert merged.read_merged(spark, root).columns == OCCURRENCE_SCHEMA.fieldNames()


def test_merge_into_counts(spark, occurrences, tmp_path):
    shards = [str(tmp_path / n) for n in ("one", "two")]
    occurrences(_event("a", 5), _event("b", 5)).write.parquet(shards[0])
    occurrences(_event("a", 1), _event("c", 5)).write.parquet(shards[1])
    root = str(tmp_path / "t")
    assert jobs.merge_into(spark, shards[:1], root, "s", 0) == jobs.MergeCounts(2, 2)
    assert jobs.merge_into(spark, shards[1:], root, "s", 1) == jobs.MergeCounts(4, 3)
    assert jobs.merge_into(spark, shards[1:], root, "s", 1) == jobs.MergeCounts(3, 3)


def test_conservation_reference_in_the_order_of_its_files(spark, tmp_path):
    """A later file is larger, so a scan may take it first; the order is that of the names."""
    from occspark.sources.reference import read_conservation_reference

    names = [f"T{i:03d}" for i in range(60)]
    for part, rows in enumerate((names[:2], names[2:20], names[20:])):
        lines = ["accepted_taxon,notes", *[f'{n},"two\nlines"' for n in rows]]
        (tmp_path / f"part-{part:05d}.csv").write_text("\n".join(lines) + "\n")
    read = read_conservation_reference(spark, str(tmp_path))
    assert [r["accepted_taxon"] for r in read.orderBy("row_order").collect()] == names


def test_first_merge_writes_a_bucket_once(spark, tmp_path):
    """The staged files of empty buckets become their first parts; later merges add to them."""
    from occspark.schema import OCCURRENCE_SCHEMA, conform
    from occspark.sources import merged

    def batch(first: int, last: int):
        return conform(spark.range(first, last).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("uuid")), OCCURRENCE_SCHEMA)

    root = str(tmp_path / "table")
    done = merged.merge_batch(batch(0, 50), root, "a", 0, buckets=4)
    assert done.added == done.first == [0, 1, 2, 3] and done.rewritten == []
    assert len(list(tmp_path.rglob("part-*.parquet"))) == 4
    again = merged.merge_batch(batch(25, 80), root, "b", 0, buckets=4)
    assert again.first == [] and again.added and not list(tmp_path.rglob(f"{again.version}/staged"))
    stored = [r["uuid"] for r in merged.read_merged(spark, root).collect()]
    assert sorted(stored) == sorted(f"u{i}" for i in range(80))


def test_presets_build_the_cube_once(spark, monkeypatch):
    from verification import jobs

    built = []
    cube = spark.createDataFrame(
        [("Victoria", 1994, 2), ("Queensland", 1996, 3), ("Overseas", 1995, 4)], "stateProvince string, year long, record_count long"
    )
    executed = spark.sparkContext.accumulator(0)

    def counted(*_):
        built.append(1)
        return cube.mapInPandas(lambda batches: (executed.add(len(b)) or b for b in batches), cube.schema)

    monkeypatch.setattr(jobs, "plain_cube", counted)
    rows = records(jobs.p15_p16_year_bounds_and_presets(spark, "unused"))
    assert built == [1] and executed.value == 3
    wanted = [("all years", 1994, 2), ("all years", 1996, 3), ("two years", 1994, 2)]
    assert sorted((r["chosen"], r["year"], r["record_count"]) for r in rows) == wanted
