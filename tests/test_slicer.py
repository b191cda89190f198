"""Grid cube and cross-filter queries on small cubes."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import records
from pyspark.sql import functions as F

from occspark.operators import grid, slicer
from occspark.operators.slicer import SlicerState
from occspark.sources import clustered

CUBE_SCHEMA = (
    "lat_bin double, lon_bin double, family string, genus string, species string, scientificName string, "
    "year long, stateProvince string, record_count long, distinct_scientific_names long, "
    "distinct_taxon_concepts long, min_year long, max_year long"
)


def cube(spark, *rows):
    """Rows of (lat, lon, family, genus, species, year, state, count)."""
    full = [
        (lat, lon, f, g, s, s, year, state, n, 1, 1, year, year)
        for lat, lon, f, g, s, year, state, n in rows
    ]
    return spark.createDataFrame(full, CUBE_SCHEMA)


@pytest.fixture
def shares(spark):
    return cube(
        spark,
        (-36.4, 146.3, "A", "Norba", "Norba prima", 2010, "Victoria", 6),
        (-36.4, 146.3, "A", "Norba", "Norba sexta", 2011, "Victoria", 1),
        (-36.4, 146.3, "B", "Tessa", "Tessa minor", 2010, "Victoria", 3),
        (-31.2, 152.7, "A", "Norba", "Norba prima", 2010, "New South Wales", 5),
    )


def many_genera(spark, n=10):
    rows = [(-36.4, 146.3, "A", f"Genus {i}", f"Genus {i} x", 2010, "Victoria", n - i) for i in range(n)]
    return cube(spark, *rows)


# --- building ------------------------------------------------------------------------


def test_grid_cube_counts_mapped_rows(spark):
    rows = [
        ("A", "Norba", "Norba prima", "Norba prima", "t1", "Victoria", 2010, -36.411, 146.261),
        ("A", "Norba", "Norba prima", "Norba prima", None, "Victoria", 2010, -36.412, 146.262),
        ("A", "Norba", "Norba prima", "Norba prima", "t1", "Victoria", 2011, -36.411, 146.261),
        ("B", None, None, None, None, None, None, 0.001, -0.001),
        ("B", None, None, None, None, None, None, None, 146.3),
    ]
    df = spark.createDataFrame(
        rows,
        "family string, genus string, species string, scientificName string, taxonConceptID string, "
        "stateProvince string, year long, decimalLatitude double, decimalLongitude double",
    )
    got = {(r["lat_bin"], r["year"]): r for r in records(grid.grid_cube(df))}
    assert len(got) == 3
    first = got[-36.41, 2010]
    assert (first["record_count"], first["distinct_taxon_concepts"]) == (2, 2)  # null counts here
    assert (first["distinct_scientific_names"], first["Status"]) == (1, None)
    assert str(got[0.0, None]["lon_bin"]) == "0.0"
    ordered = records(grid.cube_order(grid.grid_cube(df)))
    assert [r["lat_bin"] for r in ordered] == [-36.41, -36.41, 0.0]
    values = {(r["dimension"], r["value"]) for r in records(grid.dimension_values(df))}
    assert ("year_values", "2011") in values and ("state_values", "Victoria") in values
    (bounds,) = records(grid.dimension_bounds(df))
    assert bounds == {"row_count": 5, "mapped_row_count": 4, "min_year": 2010, "max_year": 2011}


def test_rebin(spark):
    fine = cube(
        spark,
        (-36.41, 146.26, "A", "g", "s", 2010, "V", 2),
        (-36.42, 146.27, "A", "g", "s", 2010, "V", 3),
        (-31.16, 152.71, "A", "g", "s", 2010, "N", 5),
    )
    cells = {d: grid.rebin(fine, d).select("lat_bin", "lon_bin", "record_count").collect() for d in (2, 1, 0)}
    assert {d: len(rows) for d, rows in cells.items()} == {2: 3, 1: 2, 0: 2}
    assert {tuple(r) for r in cells[1]} == {(-36.4, 146.3, 5), (-31.2, 152.7, 5)}
    merged = grid.rebin(fine, 1).where("lat_bin = -36.4").first()
    assert merged["distinct_scientific_names"] == 2  # measures of bins are added up


# --- selection -------------------------------------------------------------------------


def test_color_dimension():
    assert slicer.color_dimension(SlicerState()) == "family"
    assert slicer.color_dimension(SlicerState(include_families=["A"])) == "genus"
    assert slicer.color_dimension(SlicerState(include_families=["A"], exclude_genera=["b"])) == "species"
    assert slicer.color_dimension(SlicerState(include_species=["s"])) == "scientificName"
    assert slicer.color_dimension(SlicerState(include_states=["V"], year_min=1)) == "family"
    assert slicer.color_dimension(SlicerState(include_families=["A"]), "family") == "family"
    assert slicer.color_dimension(SlicerState(), "kingdom") == "family"
    listed = SlicerState(conservation_scope="state", include_conservation_statuses=["Rare"])
    assert slicer.color_dimension(listed, "family") == "species"
    unknown = SlicerState(conservation_scope="global", include_conservation_statuses=["Rare"])
    assert slicer.color_dimension(unknown) == "family"


def test_year_bounds_and_presets():
    assert slicer.active_year_bounds([2000, 2005], (2000, 2005)) == (None, None)
    assert slicer.active_year_bounds([2000, 2005], (2001, 2005)) == (2001, 2005)
    assert slicer.active_year_bounds([], (0, 0)) == (None, None)
    states = ["Queensland", "Tasmania", "Victoria"]
    assert slicer.state_preset("East coast", states) == ["Victoria", "Queensland"]
    assert slicer.state_preset("Mainland", states) == ["Queensland", "Victoria"]
    assert slicer.state_preset("All", states) == states
    assert slicer.state_preset("Custom", states) == []


def test_exclusion_keeps_nulls(spark):
    rows = cube(
        spark,
        (1.0, 1.0, "A", "g", "s", 2010, "V", 1),
        (1.0, 1.0, "B", "g", "s", 2010, "V", 2),
        (1.0, 1.0, None, "g", "s", None, None, 4),
    )

    def total(state):
        return slicer.matching_records(rows, state).first()[0]

    assert total(SlicerState()) == 7
    assert total(SlicerState(exclude_families=["A"])) == 6
    assert total(SlicerState(include_families=["A"])) == 1
    assert total(SlicerState(year_min=2000)) == 3
    assert total(SlicerState(include_families=["none"])) == 0
    inert = SlicerState(conservation_scope="national")
    assert total(inert) == 7
    kept = rows.where(slicer.predicate(SlicerState(include_families=["A"]), skip="family"))
    assert kept.count() == 3


@pytest.fixture
def listed(spark):
    rows = cube(
        spark,
        (-33.49, 150.11, "L", "P", "P spinifera", 2020, "New South Wales", 2),
        (-33.51, 150.12, "L", "P", "P spinifera", 2021, "New South Wales", 3),
        (-41.0, 146.3, "H", "A", "A chaostola", 2020, "Tasmania", 4),
        (-27.0, 153.0, "L", "J", "J eubulus", 2020, "Queensland", 5),
    )
    national = F.when(F.col("genus") == "P", "Vulnerable").when(F.col("genus") == "A", "Endangered")
    level = F.when(F.col("genus") == "J", "Critically Endangered").otherwise("Endangered")
    return rows.withColumns({"Status": national, "state_status_level": level})


def test_conservation_filters(listed):
    national = SlicerState(conservation_scope="national", include_conservation_statuses=["Endangered"])
    (row,) = records(slicer.grid_bins(listed, national))
    assert (row["color_level"], row["color_value"], row["record_count"]) == ("species", "A chaostola", 4)
    state = SlicerState(conservation_scope="state", include_conservation_statuses=["Endangered"])
    assert slicer.grid_bins(listed, state).count() == 3
    coarse = SlicerState(conservation_scope="national", include_conservation_statuses=["Vulnerable"])
    (marker,) = records(slicer.composition_markers(listed, coarse, decimals=1))
    assert marker == {
        "lat_bin": -33.5,
        "lon_bin": 150.1,
        "total_record_count": 5,
        "color_level": "species",
        "composition": [{"value": "P spinifera", "record_count": 5, "share": 1.0}],
        "composition_text": "P spinifera: 5 (100.0%)",
    }


def test_option_values(listed, shares):
    def options(frame, state, of):
        return [r["value"] for r in records(slicer.option_values(frame, state)) if r["option"] == of]

    assert options(listed, SlicerState(), "national_statuses") == ["Endangered", "Vulnerable"]
    assert options(listed, SlicerState(), "state_status_levels") == ["Critically Endangered", "Endangered"]
    assert options(shares, SlicerState(), "national_statuses") == []
    # A slicer's own column is filtered too.
    assert options(shares, SlicerState(include_families=["B"]), "families") == ["B"]
    cascade = slicer.cascading_options(shares, SlicerState(include_families=["B"], year_min=2010))
    got = defaultdict(list)
    for r in records(cascade):
        got[r["option"]].append(r["value"])
    assert got["families"] == ["A", "B"] and got["genera"] == ["Tessa"] and got["years"] == ["2010"]


# --- results ---------------------------------------------------------------------------


def test_grid_bins_group_to_the_color_level(shares):
    rows = records(slicer.grid_bins(shares, SlicerState()))
    assert [(r["family"], r["genus"], r["record_count"]) for r in rows] == [
        ("A", None, 7),
        ("A", None, 5),
        ("B", None, 3),
    ]
    assert rows[0]["year_range"] == "2010-2011" and rows[1]["year_range"] == "2010"
    assert slicer.grid_bins(shares, SlicerState(), limit=1).count() == 1


def test_share_bins(shares):
    state = SlicerState(include_states=["Victoria"])
    (row,) = records(slicer.share_bins(shares, state, "A", locked="family"))
    assert row == {
        "lat_bin": -36.4,
        "lon_bin": 146.3,
        "family": "A",
        "genus": None,
        "species": None,
        "scientificName": None,
        "stateProvince": "Victoria",
        "record_count": 7,
        "total_cell_records": 10,
        "share": 0.7,
        "color_level": "family",
        "color_value": "A",
        "composition_text": "A: 7\nB: 3",
    }
    (species,) = records(slicer.share_bins(shares, state, "Norba", locked="genus", top_competitors=1))
    assert species["composition_text"] == "Norba: 7"
    assert slicer.share_bins(shares, state, "").count() == 0
    filtered = SlicerState(include_families=["A"], include_states=["Victoria"], year_min=2011, year_max=2011)
    (late,) = records(slicer.share_bins(shares, filtered, "Norba"))
    assert (late["color_level"], late["record_count"], late["share"]) == ("genus", 1, 1.0)


def test_share_display_collapses_to_multiple(spark):
    rows = cube(
        spark,
        (1.0, 1.0, "A", "g1", "s1", 2010, "V", 1),
        (1.0, 1.0, "A", "g1", "s2", 2010, "N", 1),
        (1.0, 1.0, "A", "g2", "s3", 2010, None, 9),
    )
    (row,) = records(slicer.share_bins(rows, SlicerState(), "g1", locked="genus"))
    assert (row["family"], row["stateProvince"], row["species"]) == ("A", "multiple", None)


def test_all_share_bins(shares, spark):
    rows = records(slicer.all_share_bins(shares, SlicerState(include_states=["Victoria"]), locked="family"))
    assert [(r["color_value"], r["record_count"], r["share_percent"]) for r in rows] == [
        ("A", 7, "70.0%"),
        ("B", 3, "30.0%"),
    ]
    assert rows[0]["composition_text"] == "A: 7 / 10 (70.0%)"
    capped = records(
        slicer.all_share_bins(
            many_genera(spark), SlicerState(include_families=["A"]), max_categories=3, limit_per_category=1
        )
    )
    assert [(r["color_value"], r["category_total_records"]) for r in capped] == [
        ("Genus 0", 10),
        ("Genus 1", 9),
        ("Genus 2", 8),
    ]
    assert {r["total_cell_records"] for r in capped} == {55}


def test_tail_is_gathered_as_other(spark):
    (marker,) = records(
        slicer.composition_markers(many_genera(spark), SlicerState(include_families=["A"]), top=8)
    )
    assert [c["value"] for c in marker["composition"]] == [f"Genus {i}" for i in range(8)] + ["Other"]
    assert marker["composition"][-1] == {"value": "Other", "record_count": 3, "share": 3 / 55}
    assert marker["total_record_count"] == 55


def test_a_category_named_other_merges_with_the_tail(spark):
    rows = cube(
        spark,
        *[(1.0, 1.0, "A", g, g, 2010, "V", n) for g, n in (("Other", 5), ("x", 3), ("y", 2), ("z", 1))],
    )
    got = records(slicer.composition_rows(rows, SlicerState(include_families=["A"]), top=2))
    assert {(r["color_value"], r["record_count"], r["category_order"]) for r in got} == {
        ("Other", 8, 1),
        ("x", 3, 2),
    }


def test_compositions_against_brute_force(spark):
    draw = random.Random(7)
    rows = [
        (float(draw.randint(0, 3)), 0.0, "A", f"g{draw.randint(0, 12)}", "s", 2010, "V", draw.randint(1, 9))
        for _ in range(400)
    ]
    counts: dict[float, Counter] = defaultdict(Counter)
    for lat, _, _, genus, *_, n in rows:
        counts[lat][genus] += n
    wanted = set()
    for lat, found in counts.items():
        ranked = sorted(found.items(), key=lambda kv: (-kv[1], kv[0]))
        wanted |= {(lat, g, n) for g, n in ranked[:4]}
        wanted.add((lat, "Other", sum(n for _, n in ranked[4:])))
    got = slicer.composition_rows(cube(spark, *rows), SlicerState(include_families=["A"]), top=4)
    assert {(r["lat_bin"], r["color_value"], r["record_count"]) for r in records(got)} == wanted


def test_year_summary_and_color_options(shares, spark):
    with_null = shares.unionByName(cube(spark, (1.0, 1.0, None, None, None, None, None, 2)))
    assert [tuple(r) for r in slicer.year_summary(with_null, SlicerState()).collect()] == [
        (2010, 14),
        (2011, 1),
        (None, 2),
    ]
    assert [tuple(r) for r in slicer.color_options(with_null, SlicerState()).collect()] == [
        ("A", 12),
        ("B", 3),
        ("not supplied", 2),
    ]


def test_slices_of_a_stored_cube_read_only_their_files(spark, tmp_path):
    draw = random.Random(8)
    rows = [
        (float(i % 40), float(i % 30), f"F{i % 6}", draw.choice([None, f"G{i % 6}{i % 3}"]), f"S{i % 50}", 1990 + i % 20, draw.choice("VQN"), 1)
        for i in range(1_200)
    ]
    names = "lat_bin double, lon_bin double, family string, genus string, species string, year long, stateProvince string, record_count long"
    cube, path = spark.createDataFrame(rows, names), str(tmp_path / "cube")
    clustered.write_clustered(cube, path, files=12)
    every = clustered.files_of(spark, path, SlicerState())
    assert len(every) > 8
    states = [
        SlicerState(include_families=["F2"]),
        SlicerState(include_families=["F2"], include_genera=["G20"], year_min=1995, year_max=1996),
        SlicerState(include_families=["F1"], exclude_genera=["G11"], include_states=["V"]),
        SlicerState(include_families=["none"]),
        SlicerState(exclude_families=["F0"]),
        SlicerState(),
    ]
    for state in states:
        part = clustered.read_slice(spark, path, state)
        assert sorted(map(repr, part.collect())) == sorted(map(repr, cube.where(slicer.predicate(state)).collect()))
        options = sorted(map(tuple, clustered.stored_options(spark, path, state).collect()))
        assert options == sorted(map(tuple, slicer.option_values(cube, state).collect()))
    assert len(clustered.read_slice(spark, path, states[0]).inputFiles()) <= 4
    assert len(clustered.files_of(spark, path, states[1])) <= len(clustered.files_of(spark, path, states[0]))
    assert clustered.files_of(spark, path, states[3]) == []


def test_sql_of_unlimited_bins_has_no_limit():
    from verification import slicing  # noqa: F401
    from verification.registry import ORACLES

    for name in ("a21_grid_bins_by_family", "p12_national_status_bins", "p9_p10_p11_a21_filtered_bins"):
        assert "LIMIT" not in ORACLES[name]
    assert "LIMIT 500" in ORACLES["o2_top_bins_by_genus"]
