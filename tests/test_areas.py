"""Polygon join, area cube and area compositions."""

from __future__ import annotations

import json
import random

import pytest
from conftest import records
from pyspark.sql import functions as F

from occspark.operators import areas, cells, slicer
from occspark.operators.slicer import SlicerState
from occspark.plans import cubes
from occspark.sources import tables
from occspark.sources.reference import read_boundaries


def square(x0, y0, x1, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


def star(x, y, n, draw):
    """A closed ring of n points around a centre, wiggly but not crossing itself."""
    import math

    points = []
    for i in range(n):
        radius, angle = draw.uniform(0.3, 2.5), 2 * math.pi * i / n
        points.append([round(x + radius * math.cos(angle), 3), round(y + radius * math.sin(angle), 3)])
    return [*points, points[0]]


SHAPES = {
    "C2": {"type": "Polygon", "coordinates": [square(0, 0, 4, 4), square(1, 1, 2, 2)]},  # with a hole
    "C1": {"type": "Polygon", "coordinates": [square(4, 0, 6, 4)]},  # shares an edge with C2
    "C3": {"type": "Polygon", "coordinates": [square(3, 3, 5, 5)]},  # overlaps both
    "C4": {
        "type": "MultiPolygon",
        "coordinates": [[square(-3, -3, -2, -2)], [[[-6, -6], [-5, -6], [-5, -5], [-6, -6]]]],
    },
}


def boundary_rows(spark, shapes=SHAPES, level="SA2"):
    rows = [(c, f"Area {c}", "2", "Victoria", 1.5, json.dumps(g)) for c, g in shapes.items()]
    features = spark.createDataFrame(
        rows,
        f"{level}_CODE21 string, {level}_NAME21 string, STE_CODE21 string, STE_NAME21 string, "
        "AREASQKM21 double, geometry string",
    )
    return areas.boundary_table(features, level)


def contains(shape, x, y):
    polygons = shape["coordinates"] if shape["type"] == "MultiPolygon" else [shape["coordinates"]]
    edges = [e for p in polygons for ring in p for e in zip(ring, ring[1:])]
    odd = False
    for (x1, y1), (x2, y2) in edges:
        on_line = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0
        if on_line and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return True
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def point_frame(spark, points):
    return spark.createDataFrame(
        [(i, float(x), float(y)) for i, (x, y) in enumerate(points)],
        "id int, decimalLongitude double, decimalLatitude double",
    )


POINTS = [(0.5, 0.5), (1.5, 1.5), (1, 1.5), (4, 2), (4, 0), (3.5, 3.5), (4.5, 4.5), (5, 2), (9, 9), (-2.5, -2.5), (-5.2, -5.8), (-5.8, -5.2), (0, 0), (2, 2)]


@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
def test_points_in_holes_on_edges_and_in_overlaps(spark, cell):
    got = areas.assign_areas(point_frame(spark, POINTS), boundary_rows(spark), "SA2", cell)
    found = {r["id"]: r["sa2_code_2021"] for r in records(got)}
    wanted = {}
    for i, (x, y) in enumerate(POINTS):
        codes = sorted(c for c, shape in SHAPES.items() if contains(shape, x, y))
        if codes:
            wanted[i] = codes[0]
    assert found == wanted
    assert 1 not in found and found[3] == "C1" and found[2] == "C2"  # hole, shared edge, hole's edge


@pytest.mark.parametrize("in_place", [True, False])
@pytest.mark.parametrize("most", [4, 64])
def test_polygon_join_against_brute_force(spark, monkeypatch, in_place, most):
    monkeypatch.setattr(cells.area_cells, "__defaults__", (cells.CELL_DEGREES, most))
    draw = random.Random(11)
    shapes = {
        f"P{i:02d}": {"type": "Polygon", "coordinates": [star(draw.uniform(-4, 4), draw.uniform(-4, 4), 9, draw)]}
        for i in range(30)
    }
    points = [(draw.randint(-600, 600) / 100, draw.randint(-600, 600) / 100) for _ in range(800)]
    points += [(0.25, 0.25)] * 400  # one place holds a third of the rows
    got = areas.assign_areas(point_frame(spark, points), boundary_rows(spark, shapes), "SA2", in_place=in_place)
    found = {r["id"]: r["sa2_code_2021"] for r in records(got)}
    wanted = {}
    for i, (x, y) in enumerate(points):
        codes = [c for c, shape in shapes.items() if contains(shape, x, y)]
        if codes:
            wanted[i] = min(codes)
    assert found == wanted and len(wanted) > 200


def test_inner_cells_carry_no_edges(spark):
    big = {"B": {"type": "Polygon", "coordinates": [square(0, 0, 10, 10)]}}
    held = cells.area_cells(boundary_rows(spark, big), "sa2_code_2021", "sa2_name_2021", 1.0)
    inner = held.cells.where("edges IS NULL")
    assert inner.count() == 81 and inner.where("NOT corner").count() == 0
    assert held.edges == 44 and held.depths == [0]  # 11 cells along each side, corners have two edges


def test_edges_held_follow_the_boundary_not_the_width(spark):
    """East of a wiggly western coast a cell needs none of the coast's edges."""
    coast = [[-(i % 2) / 100, i / 100] for i in range(1_001)]
    wide = {"W": {"type": "Polygon", "coordinates": [[*coast, [60, 10], [60, 0], coast[0]]]}}
    held = cells.area_cells(boundary_rows(spark, wide), "sa2_code_2021", "sa2_name_2021", 1.0, 20)
    assert held.edges < 2 * 1_001 + 400 and len(held.depths) > 1
    crowded = held.cells.where(F.size("edges") > 20).count()
    assert crowded == 0


@pytest.mark.parametrize("in_place", [True, False])
def test_areas_upon_each_other_do_not_multiply_cells(spark, in_place):
    """Copies of a shape and areas behind one that covers the cell whole are not held; results stay those of all areas."""
    draw = random.Random(3)
    tops = {f"A{i}": {"type": "Polygon", "coordinates": [star(0, 0, 9, draw)]} for i in range(3)}
    behind = {f"B{i:02d}": {"type": "Polygon", "coordinates": [square(-6, -6, 6, 6 if i % 2 else 5)]} for i in range(40)}
    rows = boundary_rows(spark, tops | behind)
    few = boundary_rows(spark, tops | {k: behind[k] for k in ("B00", "B01")})
    names = ("sa2_code_2021", "sa2_name_2021", 1.0)
    all_held, few_held = cells.area_cells(rows, *names), cells.area_cells(few, *names)
    assert (all_held.rows, all_held.edges) == (few_held.rows, few_held.edges)
    points = [(x / 2, y / 2) for x in range(-13, 14) for y in range(-13, 14)]
    got = areas.assign_areas(point_frame(spark, points), rows, "SA2", 1.0, in_place=in_place)
    wanted = {}
    for i, (x, y) in enumerate(points):
        codes = [c for c, shape in (tops | behind).items() if contains(shape, x, y)]
        if codes:
            wanted[i] = min(codes)
    assert {r["id"]: r["sa2_code_2021"] for r in records(got)} == wanted and len(wanted) > 400


def test_cells_and_their_parts_are_disjoint(spark):
    draw = random.Random(5)
    shapes = {f"P{i}": {"type": "Polygon", "coordinates": [star(0, 0, 80, draw)]} for i in range(3)}
    held = cells.area_cells(boundary_rows(spark, shapes), "sa2_code_2021", "sa2_name_2021", 2.0, 12)
    keys = {(r["depth"], r["ix"], r["iy"]) for r in held.cells.select(*cells.KEY).distinct().collect()}
    assert len({d for d, _, _ in keys}) > 1
    for depth, ix, iy in keys:
        assert not any((d, ix >> (depth - d), iy >> (depth - d)) in keys for d in range(depth))


def test_same_shape_twice_and_same_code_on_two_shapes(spark):
    rows = boundary_rows(spark, {"A": {"type": "Polygon", "coordinates": [square(0, 0, 4, 4)]}})
    other = boundary_rows(spark, {"A": {"type": "Polygon", "coordinates": [square(2, 2, 6, 6)]}})
    points = point_frame(spark, [(1, 1), (3, 3), (5, 5), (7, 7), (float("nan"), 1)])
    got = areas.assign_areas(points, rows.union(rows).union(other), "SA2")
    assert sorted(r["id"] for r in records(got)) == [0, 1, 2]


@pytest.mark.parametrize("cell", [0.25, 0.5, 1.0])
def test_slanted_sides_through_round_coordinates(spark, cell):
    shapes = {
        "D": {"type": "Polygon", "coordinates": [[[0, 0], [5, 0], [5, 5], [0, 0]]]},
        "E": {"type": "Polygon", "coordinates": [[[-6, 0], [0, 3], [-6, 3], [-6, 0]]]},
        "F": {"type": "Polygon", "coordinates": [[[0, -4], [4, -1], [0, -1], [0, -4]]]},
    }
    points = [(x / 20 + 0.01, y / 20) for x in range(-130, 110, 3) for y in range(-90, 110, 3)]
    got = areas.assign_areas(point_frame(spark, points), boundary_rows(spark, shapes), "SA2", cell)
    wanted = {i: c for i, (x, y) in enumerate(points) for c in shapes if contains(shapes[c], x, y)}
    assert {r["id"]: r["sa2_code_2021"] for r in records(got)} == wanted


def test_no_boundaries(spark):
    empty = boundary_rows(spark).limit(0)
    for in_place in (True, False):
        assert areas.assign_areas(point_frame(spark, POINTS), empty, "SA2", in_place=in_place).count() == 0


def test_unknown_level():
    with pytest.raises(ValueError, match="SA9"):
        areas.area_columns("SA9")
    assert areas.area_columns("sa1") == ("sa1_code_2021", "sa1_name_2021")


def _area_bins(spark):
    rows = [
        ("20101", "Ballarat", "A", "Norba", "Norba prima", 2010, "Victoria", 6),
        ("20101", "Ballarat", "A", "Norba", "Norba sexta", 2011, "Victoria", 2),
        ("20101", "Ballarat", "B", "Tessa", "Tessa minor", 2010, "Victoria", 3),
        ("20102", "Bendigo", "B", None, None, 2012, "Victoria", 4),
        ("30101", "Cairns", "A", "Norba", "Norba prima", 2010, "Queensland", 9),
    ]
    bins = spark.createDataFrame(
        rows,
        "sa3_code_2021 string, sa3_name_2021 string, family string, genus string, species string, year long, "
        "stateProvince string, record_count long",
    ).withColumn("scientificName", F.col("species"))
    shapes = [(c, n, json.dumps({"type": "Polygon", "coordinates": [square(0, 0, 1, 1)]})) for c, n in
              (("20101", "Ballarat"), ("20102", "Bendigo"))]
    return bins, spark.createDataFrame(
        shapes, "sa3_code_2021 string, sa3_name_2021 string, geometry_geojson string"
    )


def test_area_compositions(spark):
    bins, shapes = _area_bins(spark)
    state = SlicerState(include_states=["Victoria"])
    rows = records(slicer.area_compositions(bins, shapes, state))
    assert [(r["area_code_2021"], r["total_record_count"]) for r in rows] == [("20101", 11), ("20102", 4)]
    first = rows[0]
    assert first["composition"] == [
        {"value": "A", "record_count": 8, "share": 8 / 11},
        {"value": "B", "record_count": 3, "share": 3 / 11},
    ]
    assert (first["dominant_value"], first["dominant_share"]) == ("A", 8 / 11)
    assert first["composition_text"] == "A: 8 (72.7%)\nB: 3 (27.3%)"
    assert (first["area_level"], json.loads(first["geometry_geojson"])["type"]) == ("SA3", "Polygon")
    genus = records(slicer.area_compositions(bins, shapes, SlicerState(include_families=["B"])))
    assert [(r["color_level"], r["dominant_value"]) for r in genus] == [
        ("genus", "not supplied"),
        ("genus", "Tessa"),
    ]
    (top,) = records(slicer.area_compositions(bins, shapes, state, locked="species", top=1, limit=1))
    assert [c["value"] for c in top["composition"]] == ["Norba prima", "Other"]
    with pytest.raises(ValueError, match="identifier"):
        slicer.area_compositions(bins, shapes, state, code_column="x; drop")


def test_hidden_records(spark):
    bins, shapes = _area_bins(spark)
    (row,) = records(slicer.hidden_records(bins, shapes, SlicerState(include_states=["Victoria"]), limit=1))
    assert row == {"visible_records": 11, "matching_records": 15, "hidden_records": 4}


def test_area_cube_job(spark, tmp_path):
    points = [(0.5, 0.5, 2000), (0.5, 0.5, 2000), (0.5, 0.5, 1900), (5, 1, 2001), (9, 9, 2001), (0.5, 0.5, None)]
    df = point_frame(spark, [(x, y) for x, y, _ in points])
    years = spark.createDataFrame([(i, y) for i, (*_, y) in enumerate(points)], "id int, year long")
    source = str(tmp_path / "source")
    df.join(years, "id").withColumn("family", F.lit("A")).write.parquet(source)
    features = [
        {
            "type": "Feature",
            "geometry": g,
            "properties": {"SA2_CODE21": c, "SA2_NAME21": c.lower(), "STE_NAME21": "V", "AREASQKM21": 2.5},
        }
        for c, g in SHAPES.items()
    ]
    path = tmp_path / "boundaries.ndjson"
    path.write_text("\n".join(json.dumps(f) for f in [*features, {"type": "Feature", "geometry": None}]))
    assert read_boundaries(spark, str(path), "SA2").count() == 4
    cubes.build_area_cubes(spark, source, {"SA2": str(path)}, str(tmp_path / "out"))
    bins = records(tables.read_table(spark, str(tmp_path / "out/sa2/bins")))
    assert [(r["sa2_code_2021"], r["year"], r["record_count"]) for r in bins] == [("C1", 2001, 1), ("C2", 2000, 2)]
    assert bins[0]["distinct_scientific_names"] == 0  # null does not count here
    shown = records(tables.read_table(spark, str(tmp_path / "out/sa2/boundaries")))
    assert [r["sa2_code_2021"] for r in shown] == ["C1", "C2"]
    assert json.loads(shown[1]["geometry_geojson"]) == SHAPES["C2"]
    (counts,) = records(spark.read.json(str(tmp_path / "out/sa2/counts")))
    assert counts == {
        "boundary_area_count": 4,
        "coordinate_row_count": 4,
        "matched_record_count": 3,
        "occupied_area_count": 2,
        "unmatched_coordinate_count": 1,
    }
    page = cubes.dashboard_page(
        tables.read_table(spark, str(tmp_path / "out/sa2/bins")),
        tables.read_table(spark, str(tmp_path / "out/sa2/boundaries")),
        SlicerState(),
    )
    assert page.areas.count() == 2 and page.records.first()["hidden_records"] == 0
    features = records(areas.geojson_features(page.areas.drop("composition")))
    first = json.loads(features[0]["feature"])
    assert first["type"] == "Feature" and first["geometry"]["type"] == "Polygon"
    assert first["properties"]["area_code_2021"] == "C2"


def test_simplification_drops_small_detours(spark):
    ring = [[0, 0], [1, 0.001], [2, 0], [2, 2], [1, 2.5], [0, 2], [0, 0]]
    shape = {"D": {"type": "Polygon", "coordinates": [ring]}}
    (row,) = records(areas.simplify_boundaries(boundary_rows(spark, shape), 0.005))
    thinned = json.loads(row["geometry_geojson"])["coordinates"][0]
    assert [1, 0.001] not in thinned and [1, 2.5] in thinned and thinned[0] == thinned[-1]


def test_names_are_shuffled_for_the_groups_of_the_area_cube_only(spark, occurrences):
    rows = [{"uuid": str(i), "scientificName": f"N{i % 3}", "taxonConceptID": f"t{i % 2}", "year": 2000,
             "decimalLatitude": 0.5 + i % 4, "decimalLongitude": 0.5} for i in range(24)]
    cube = areas.area_cube(occurrences(*rows), boundary_rows(spark), "SA2", in_place=False)
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in x and "scientificName" in x for x in plan.split("\n")) == 2
    found = {(r["scientificName"], r["record_count"], r["distinct_taxon_concepts"]) for r in records(cube)}
    assert found == {(f"N{i}", 8, 2) for i in range(3)}
