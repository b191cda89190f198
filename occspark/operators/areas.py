"""Assignment of points to areas and the area cube.

Boundaries are cut into quadtree cells (``operators/cells.py``). A point only meets the
areas of its own cell, so the polygon join is an equi-join on the cell.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.operators.cells import CELL_DEGREES, KEY, Held, area_cells, corner_of, covers, located
from occspark.operators.grid import CUBE_DIMENSIONS, aggregate_cube, mapped_rows, since, with_cube_columns
from occspark.operators.skew import DEFAULT_SALTS, lookup_join
from occspark.schema import CUBE_CONSERVATION_FIELDS, SINCE_YEAR

AREA_LEVELS = ("SA1", "SA2", "SA3")
SIMPLIFY_TOLERANCE = 0.005
_BROADCAST_CELLS = 200_000
_BROADCAST_EDGES = 1_000_000

_RING = "array<array<array<double>>>"
_RINGS = f"array<{_RING}>"


def area_columns(level: str) -> tuple[str, str]:
    """Code and name column of an area level."""
    name = str(level).upper()
    if name not in AREA_LEVELS:
        raise ValueError(f"Unknown area level {level!r}. Expected one of: {', '.join(AREA_LEVELS)}.")
    return f"{name.lower()}_code_2021", f"{name.lower()}_name_2021"


def published_columns(level: str) -> dict[str, str]:
    """Boundary column to its published property; the smallest level has no names."""
    code, name = area_columns(level)
    prefix = level.upper()
    return {
        code: f"{prefix}_CODE21",
        name: f"{prefix}_CODE21" if prefix == "SA1" else f"{prefix}_NAME21",
        "state_code_2021": "STE_CODE21",
        "state_name_2021": "STE_NAME21",
        "area_albers_sqkm": "AREASQKM21",
    }


def polygon_rings(geometry: Column) -> Column:
    """All rings of a GeoJSON Polygon or MultiPolygon text."""
    kind = F.get_json_object(geometry, "$.type")
    coordinates = F.get_json_object(geometry, "$.coordinates")
    return F.when(kind == "Polygon", F.from_json(coordinates, _RING)).when(
        kind == "MultiPolygon", F.flatten(F.from_json(coordinates, _RINGS))
    )


def ring_edges(rings: Column) -> Column:
    """The edges of all rings; even-odd counting over them handles holes."""

    def edges(ring: Column) -> Column:
        def edge(i: Column) -> Column:
            a, b = F.get(ring, i - 1), F.get(ring, i)
            return F.struct(
                F.get(a, F.lit(0)).alias("x1"),
                F.get(a, F.lit(1)).alias("y1"),
                F.get(b, F.lit(0)).alias("x2"),
                F.get(b, F.lit(1)).alias("y2"),
            )

        last = F.greatest(F.size(ring) - 1, F.lit(0))
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), edge)).otherwise(
            F.transform(F.array().cast("array<int>"), edge)
        )

    return F.flatten(F.transform(rings, edges))


def boundary_table(features: DataFrame, level: str) -> DataFrame:
    """Boundary rows of one level: code, name, state, rings, edges, bounding box.

    Accepts feature properties under their published names (``SA3_CODE21`` ...) or
    under the names used here. Rows without geometry or code are dropped.
    """
    code, _ = area_columns(level)
    published = published_columns(level)
    types = {"area_albers_sqkm": "double"}
    present = set(features.columns)

    def source(target: str, given: str) -> Column:
        found = given if given in present else target if target in present else None
        value = F.col(found) if found else F.lit(None)
        return value.cast(types.get(target, "string")).alias(target)

    geometry = "geometry_geojson" if "geometry_geojson" in present else "geometry"
    rows = features.select(
        *[source(t, g) for t, g in published.items()],
        F.col(geometry).cast("string").alias("geometry_geojson"),
    ).where(F.col("geometry_geojson").isNotNull() & F.col(code).isNotNull())
    shaped = rows.withColumn("rings", polygon_rings(F.col("geometry_geojson")))
    edged = shaped.withColumn("edges", ring_edges(F.col("rings")))
    xs, ys = F.transform("edges", lambda e: e["x1"]), F.transform("edges", lambda e: e["y1"])
    return edged.withColumns(
        {
            "min_lon": F.array_min(xs),
            "max_lon": F.array_max(xs),
            "min_lat": F.array_min(ys),
            "max_lat": F.array_max(ys),
        }
    )


def _fits(held: Held) -> bool:
    """Checked size of the broadcast side: few cells and few edges in all."""
    return held.rows <= _BROADCAST_CELLS and held.edges <= _BROADCAST_EDGES


def _assign_in_place(points: DataFrame, held: Held, level: str, cell: float) -> DataFrame:
    """J9 + W2 without moving a point: its cell's areas, in code order, come to it.

    Only for cells of checked size. One row per cell holds the cell's few areas, so
    each point meets one row and takes the first area that covers it.
    """
    code, name = area_columns(level)
    # Structs sort by their first field, the code.
    area = F.struct(code, name, "corner", "edges")
    by_cell = held.cells.groupBy(*KEY).agg(F.array_sort(F.collect_list(area)).alias("_areas"))
    x, y = F.col("decimalLongitude"), F.col("decimalLatitude")
    right, top = corner_of(cell)
    hit = F.slice(F.filter("_areas", lambda a: covers(a, right, top, x, y)), 1, 1)
    named = F.transform(hit, lambda a: F.struct(a[code].alias(code), a[name].alias(name)))
    keyed = located(points, held.depths, cell, "decimalLongitude", "decimalLatitude")
    return keyed.join(F.broadcast(by_cell), list(KEY)).select(*points.columns, F.inline(named))


def _assign_by_place(
    points: DataFrame, held: Held, level: str, cell: float, salts: int = DEFAULT_SALTS
) -> DataFrame:
    """J9 + W2 for boundaries of any size.

    Each different coordinate pair is tested once, however many records share it, and
    crowded cells are spread by a hash of the coordinates. The smallest code among the
    covering areas is found by a combining aggregate, then joined back on the
    coordinates, which key the result: no row numbers are needed.
    """
    code, name = area_columns(level)
    pair = ["decimalLongitude", "decimalLatitude"]
    spread = F.pmod(F.xxhash64(*pair), F.lit(salts)).cast("int")
    places = located(points.select(*pair).distinct(), held.depths, cell, *pair).withColumn("_salt", spread)
    repeated = held.cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right, top = corner_of(cell)
    inside = covers(F.struct("corner", "edges"), right, top, F.col(pair[0]), F.col(pair[1]))
    first = (
        places.join(repeated, [*KEY, "_salt"])
        .where(inside)
        .groupBy(*pair)
        .agg(F.min(F.struct(code, name)).alias("_area"))
        .select(*pair, f"_area.{code}", f"_area.{name}")
    )
    return lookup_join(points, first, pair, "inner").select(*points.columns, code, name)


def assign_areas(
    points: DataFrame,
    boundaries: DataFrame,
    level: str,
    cell: float = CELL_DEGREES,
    in_place: bool | None = None,
) -> DataFrame:
    """J9 + W2: each mapped record inside an area, with the first such area by code.

    Unless ``in_place`` says so, the counted size of the cells decides whether they come to the points.
    """
    held = area_cells(boundaries, *area_columns(level), cell)
    way = _assign_in_place if (_fits(held) if in_place is None else in_place) else _assign_by_place
    return way(mapped_rows(points), held, level, cell)


def area_cube(
    df: DataFrame,
    boundaries: DataFrame,
    level: str,
    year: int = SINCE_YEAR,
    cell: float = CELL_DEGREES,
    in_place: bool | None = None,
) -> DataFrame:
    """A2: records per area and dimension. Nulls do not count as distinct values here.

    When the boundaries are small every record finds its area where it is. Otherwise each different
    coordinate pair does, and records meet their pair once, as they are: records that differ in a dimension
    are too many to gain by counting them first. A popular pair is split by adaptive execution, a popular
    area is counted before it is shuffled.
    """
    recent = since(mapped_rows(with_cube_columns(df)), year)
    held = area_cells(boundaries, *area_columns(level), cell)
    way = _assign_in_place if (_fits(held) if in_place is None else in_place) else _assign_by_place
    dims = ["decimalLongitude", "decimalLatitude", *CUBE_DIMENSIONS, "taxonConceptID", *CUBE_CONSERVATION_FIELDS]
    assigned = way(recent.select(*dict.fromkeys(dims)), held, level, cell)
    return aggregate_cube(assigned, area_columns(level), count_null=False)


def occupied_boundaries(boundaries: DataFrame, cube: DataFrame, level: str) -> DataFrame:
    """The boundaries of areas that have records."""
    code, name = area_columns(level)
    kept = boundaries.join(cube.select(code).distinct(), [code], "left_semi")
    return kept.select(
        code, name, "state_code_2021", "state_name_2021", "area_albers_sqkm", "geometry_geojson"
    ).orderBy(code)


def area_counts(df: DataFrame, cube: DataFrame, boundaries: DataFrame, level: str, year: int = SINCE_YEAR) -> DataFrame:
    """One row of matched, unmatched, boundary and occupied-area counts."""
    code, _ = area_columns(level)
    rows = [
        df.where((F.col("year") >= year)).transform(mapped_rows).agg(
            F.count(F.lit(1)).alias("coordinate_row_count")
        ),
        cube.groupBy(code).agg(F.sum("record_count").alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("matched_record_count"),
            F.count(F.lit(1)).alias("occupied_area_count"),
        ),
        boundaries.agg(F.count(F.lit(1)).alias("boundary_area_count")),
    ]
    stacked = rows[0]
    for part in rows[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    one = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    unmatched = F.col("coordinate_row_count") - F.col("matched_record_count")
    return one.withColumn("unmatched_coordinate_count", unmatched)


# --- X14: display simplification ---------------------------------------------------


def _simplify(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker on one closed ring, keeping at least a triangle."""
    keep = np.zeros(len(ring), dtype=bool)
    keep[[0, -1]] = True
    if len(ring) > 4:
        # A closed ring starts and ends at one point; its farthest point splits it.
        far = int(np.argmax(((ring - ring[0]) ** 2).sum(axis=1)))
        keep[far] = True
        pending = [(0, far), (far, len(ring) - 1)]
    else:
        keep[:] = True
        pending = []
    while pending:
        first, last = pending.pop()
        if last - first < 2:
            continue
        a, b = ring[first], ring[last]
        inner = ring[first + 1 : last] - a
        chord = b - a
        length = float(np.hypot(*chord))
        if length == 0.0:
            distance = np.hypot(inner[:, 0], inner[:, 1])
        else:
            distance = np.abs(chord[0] * inner[:, 1] - chord[1] * inner[:, 0]) / length
        worst = int(np.argmax(distance))
        if distance[worst] > tolerance:
            middle = first + 1 + worst
            keep[middle] = True
            pending += [(first, middle), (middle, last)]
    return ring[keep] if keep.sum() >= 4 else ring


def simplify_boundaries(boundaries: DataFrame, tolerance: float = SIMPLIFY_TOLERANCE) -> DataFrame:
    """Boundary geometry thinned for display, ring by ring.

    Gives no topology guarantee: neighbouring areas are thinned independently.
    """
    shape = F.get_json_object("geometry_geojson", "$.type")
    coordinates = F.get_json_object("geometry_geojson", "$.coordinates")
    polygons = F.when(shape == "Polygon", F.array(F.from_json(coordinates, _RING))).otherwise(
        F.from_json(coordinates, _RINGS)
    )
    others = [c for c in boundaries.columns if c not in ("geometry_geojson", "rings", "edges")]
    rows = boundaries.select(*others, shape.alias("_shape"), polygons.alias("_polygons"))

    def thin_ring(ring: np.ndarray) -> list[list[float]]:
        return _simplify(np.array([list(point) for point in ring]), tolerance).tolist()

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["_polygons"] = [
                [[thin_ring(ring) for ring in polygon] for polygon in polygons]
                for polygons in batch["_polygons"]
            ]
            yield batch

    thinned = rows.mapInPandas(thin, rows.schema)
    geometry = F.when(
        F.col("_shape") == "Polygon",
        F.to_json(F.struct(F.col("_shape").alias("type"), F.col("_polygons")[0].alias("coordinates"))),
    ).otherwise(
        F.to_json(F.struct(F.col("_shape").alias("type"), F.col("_polygons").alias("coordinates")))
    )
    return thinned.withColumn("geometry_geojson", geometry).drop("_shape", "_polygons")


def geojson_features(
    rows: DataFrame, geometry: str = "geometry_geojson", properties: Sequence[str] = ()
) -> DataFrame:
    """One GeoJSON feature text per row; all other columns become properties."""
    named = list(properties) or [c for c in rows.columns if c != geometry]
    feature = F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.parse_json(geometry).alias("geometry"),
            F.struct(*named).alias("properties"),
        ),
        {"ignoreNullFields": "false"},
    )
    return rows.select(feature.alias("feature"))
