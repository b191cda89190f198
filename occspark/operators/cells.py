"""Boundaries cut into quadtree cells, each with one carried parity and only the edges that touch it.

Whether a point is inside an area is the parity of the edges between it and the area's outside. Per
cell and area one such parity is kept, that of the cell's upper right corner. From a point the path
runs east to the cell's right side and along that side to the corner, so it never leaves the cell:
its crossings need no edge but those that touch the cell. Edges held over all cells therefore
follow the length of the boundaries, not the width of the areas.

Corners of the coarsest cells get their parity from counts of crossings per cell row, summed from
the east; a cell between two crossings with odd parity is inside and needs no edge. Cells with many
edges are split, and a part's corner is a point of the cell it comes from. Points find their cell
by an equi-join on (depth, column, row), one key per depth in use.

A point belongs to the first area by code that covers it. Of areas with the same edges only the first
is cut, and an area that covers a cell whole ends the cell's list: no area with a later code is held there
or in the cell's parts. Areas that lie upon each other therefore don't multiply cells and edges.

The grid is shifted by ``ORIGIN``, differently along both axes, so that coordinates with few decimals don't
lie on its lines, nor its corners on lines between such coordinates.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from occspark.operators.skew import lookup_join
from occspark.session import cut_lineage

CELL_DEGREES = 0.5
CELL_EDGES = 64
MAX_DEPTH = 16
ORIGIN = {"x": 0.001234567890123, "y": 0.002718281828459}
KEY = ("depth", "ix", "iy")
_MARGIN = 1e-9
_SPLIT = 3


class Held(NamedTuple):
    """Cells with what was counted about them."""

    cells: DataFrame
    rows: int
    edges: int
    depths: list[int]


def index(value: Column, size: Column, axis: str) -> Column:
    return F.floor((value - ORIGIN[axis]) / size)


def side(i: Column, size: Column, axis: str) -> Column:
    return i * size + ORIGIN[axis]


def _size(cell: float, depth: Column | int) -> Column:
    depth = depth if isinstance(depth, Column) else F.lit(depth)
    return F.lit(float(cell)) / F.pow(F.lit(2.0), depth)


def _x_at(e: Column, y: Column) -> Column:
    return e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])


def _y_at(e: Column, x: Column) -> Column:
    return e["y1"] + (x - e["x1"]) * (e["y2"] - e["y1"]) / (e["x2"] - e["x1"])


def _x_span(e: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """The edge's smallest and largest x between two heights."""

    def x(y: Column) -> Column:
        within = F.greatest(F.least(y, F.greatest(e["y1"], e["y2"])), F.least(e["y1"], e["y2"]))
        return _x_at(e, within)

    flat = e["y1"] == e["y2"]
    a, b = F.when(flat, e["x1"]).otherwise(x(low)), F.when(flat, e["x2"]).otherwise(x(high))
    return F.least(a, b) - _MARGIN, F.greatest(a, b) + _MARGIN


def on_edge(x: Column, y: Column, e: Column) -> Column:
    cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    return (
        (cross == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def _parity(corner: Column, edges: Column, right: Column, top: Column, x: Column, y: Column) -> Column:
    """Is the point inside, given the parity of the corner and the edges that touch the cell?

    An edge's upper end counts as above a level and its right end as right of a line, on both
    legs of the path, so a vertex is crossed once or not at all.
    """

    def crossings(e: Column) -> Column:
        east = F.when((e["y1"] > y) != (e["y2"] > y), (x < _x_at(e, y)) & (_x_at(e, y) <= right))
        north = F.when((e["x1"] > right) != (e["x2"] > right), (_y_at(e, right) > y) & (_y_at(e, right) <= top))
        return F.coalesce(east, F.lit(False)).cast("int") + F.coalesce(north, F.lit(False)).cast("int")

    total = F.aggregate(edges, F.lit(0), lambda n, e: n + crossings(e))
    return corner != (F.coalesce(total, F.lit(0)) % 2 == 1)


def covers(area: Column, right: Column, top: Column, x: Column, y: Column) -> Column:
    """Is the point inside the area or on its boundary? ``area`` has ``corner`` and ``edges`` of the point's cell."""
    touches = F.coalesce(F.exists(area["edges"], lambda e: on_edge(x, y, e)), F.lit(False))
    return _parity(area["corner"], area["edges"], right, top, x, y) | touches


def _until_whole(rows: DataFrame, whole: DataFrame, key: Sequence[str], code: str) -> DataFrame:
    """The rows that can hold a cell's first area: up to the smallest code of ``whole``, which covers it all."""
    least = whole.groupBy(*key).agg(F.min(code).alias("_least"))
    return lookup_join(rows, least, key).where(F.col("_least").isNull() | (F.col(code) <= F.col("_least"))).drop("_least")


def _base_cells(boundaries: DataFrame, code: str, name: str, cell: float) -> DataFrame:
    """The coarsest cells of every area, from its edges as rows: no task holds an area."""
    size = F.lit(float(cell))
    first_of = boundaries.groupBy("edges").agg(F.min(F.struct(code, name)).alias("area"))
    areas = first_of.select(f"area.{code}", f"area.{name}", "edges", F.xxhash64("edges").alias("shape"))
    owner = [code, "shape"]
    edges = areas.select(*owner, name, F.explode("edges").alias("e"))
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    rows = edges.withColumn("iy", F.explode(F.sequence(index(low - _MARGIN, size, "y"), index(high + _MARGIN, size, "y"))))
    bottom, top = side(F.col("iy"), size, "y"), side(F.col("iy") + 1, size, "y")
    first, last = _x_span(F.col("e"), bottom - _MARGIN, top + _MARGIN)
    placed = rows.withColumn("ix", F.explode(F.sequence(index(first, size, "x"), index(last, size, "x"))))
    # Edges that cross the upper line of a cell row: they count for every corner west of them.
    crossed = rows.where((F.col("e.y1") > top) != (F.col("e.y2") > top)).withColumn(
        "c", F.ceil((_x_at(F.col("e"), top) - ORIGIN["x"]) / size) - 1
    )
    events = crossed.groupBy(*owner, "iy", "c").agg(F.first(name).alias(name), F.count(F.lit(1)).alias("n"))
    of_row = Window.partitionBy(*owner, "iy")
    east = of_row.orderBy(F.col("c").desc()).rowsBetween(Window.unboundedPreceding, 0)
    between = events.withColumns({"odd": F.sum("n").over(east) % 2 == 1, "before": F.lag("c").over(of_row.orderBy("c"))})
    inside = between.where("odd AND before IS NOT NULL").select(
        *owner, F.explode(F.sequence("before", F.col("c") - 1)).alias("ix"), "iy", F.col(name).alias("_name")
    )
    # Keys alone tell which cells are covered whole, before any edges are collected.
    whole = inside.join(placed.select(*owner, "ix", "iy"), [*owner, "ix", "iy"], "left_anti")
    inside = _until_whole(inside, whole, ["ix", "iy"], code)
    touched = (
        _until_whole(placed, whole, ["ix", "iy"], code)
        .groupBy(*owner, "ix", "iy")
        .agg(F.first(name).alias(name), F.collect_list("e").alias("edges"))
    )
    joined = touched.join(inside.withColumn("corner", F.lit(True)), [*owner, "ix", "iy"], "full")
    return joined.select(
        F.lit(0).alias("depth"),
        "ix",
        "iy",
        code,
        F.coalesce(name, "_name").alias(name),
        F.coalesce("corner", F.lit(False)).alias("corner"),
        "edges",
    )


def _split(crowded: DataFrame, cell: float) -> DataFrame:
    """Cells with their number of edges cut into 4, 16 or 64 parts, by how far it exceeds the aim."""
    steps = F.greatest(F.lit(1), F.least(F.lit(_SPLIT), F.ceil(F.log(4.0, F.col("n") / CELL_EDGES)).cast("int")))
    size = _size(cell, F.col("depth"))
    rows = crowded.withColumns(
        {"steps": steps, "right": side(F.col("ix") + 1, size, "x"), "top": side(F.col("iy") + 1, size, "y")}
    )
    per_axis = F.pow(F.lit(2.0), F.col("steps")).cast("long")
    parts = F.sequence(F.lit(0).cast("long"), per_axis - 1)
    for c in ("ix", "iy"):
        rows = rows.withColumn("part", F.explode(parts)).withColumn(c, F.col(c) * per_axis + F.col("part"))
    # The parts' depth is a column of its own before it is used: a name given and used in one projection is ambiguous.
    rows = rows.withColumn("depth", F.col("depth") + F.col("steps"))
    part_size = _size(cell, F.col("depth"))
    left, bottom = side(F.col("ix"), part_size, "x"), side(F.col("iy"), part_size, "y")
    right, top = side(F.col("ix") + 1, part_size, "x"), side(F.col("iy") + 1, part_size, "y")

    def touches(e: Column) -> Column:
        first, last = _x_span(e, bottom - _MARGIN, top + _MARGIN)
        in_rows = (F.least(e["y1"], e["y2"]) <= top + _MARGIN) & (F.greatest(e["y1"], e["y2"]) >= bottom - _MARGIN)
        return in_rows & (first <= right + _MARGIN) & (last >= left - _MARGIN)

    corner = _parity(F.col("corner"), F.col("edges"), F.col("right"), F.col("top"), right, top)
    own = F.filter("edges", touches)
    cut = rows.withColumns({"inside": corner, "own": own})
    cut = cut.withColumn("edges", F.when(F.size("own") > 0, F.col("own")))
    return cut.where("inside OR edges IS NOT NULL").withColumn("corner", F.col("inside")).drop(
        "part", "steps", "right", "top", "n", "own", "inside"
    )


def area_cells(boundaries: DataFrame, code: str, name: str, cell: float = CELL_DEGREES, most: int = CELL_EDGES) -> Held:
    """The areas' cells: ``depth, ix, iy``, code, name, ``corner`` (its parity) and ``edges`` (null: none touches it).

    Every area is there that is the first by code for some point of the cell.

    A cell and its parts are never both present: a point lies in exactly one.
    """
    done, open_cells = None, _base_cells(boundaries, code, name, cell)
    while True:
        open_cells = cut_lineage(open_cells)
        open_cells = _until_whole(open_cells, open_cells.where("corner AND edges IS NULL"), KEY, code)
        counts = open_cells.groupBy(*KEY).agg(F.sum(F.coalesce(F.size("edges"), F.lit(0))).alias("n"))
        crowded = counts.where((F.col("n") > most) & (F.col("depth") + _SPLIT <= MAX_DEPTH))
        # Keys alone are counted and joined, never edges.
        if crowded.isEmpty():
            cells = open_cells if done is None else done.unionByName(open_cells)
            break
        settled = open_cells.join(crowded, list(KEY), "left_anti")
        done = settled if done is None else done.unionByName(settled)
        open_cells = _split(open_cells.join(crowded, list(KEY)), cell)
    found = cells.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.coalesce(F.size("edges"), F.lit(0))), F.lit(0)).alias("edges"),
        F.collect_set("depth").alias("depths"),
    ).first()
    return Held(cells, found["rows"], found["edges"], sorted(found["depths"]))


def located(points: DataFrame, depths: list[int], cell: float, x: str, y: str) -> DataFrame:
    """Points with the key of their cell at each depth in use; exactly one of them can have a cell."""

    def key(depth: int) -> Column:
        size = _size(cell, depth)
        return F.struct(
            F.lit(depth).alias("depth"), index(F.col(x), size, "x").alias("ix"), index(F.col(y), size, "y").alias("iy")
        )

    number = ~F.isnan(x) & ~F.isnan(y)
    return points.where(number).select("*", F.inline(F.array(*[key(d) for d in depths or [0]])))


def corner_of(cell: float) -> tuple[Column, Column]:
    """Right side and top of the cell of a row with the columns of ``KEY``."""
    size = _size(cell, F.col("depth"))
    return side(F.col("ix") + 1, size, "x"), side(F.col("iy") + 1, size, "y")
