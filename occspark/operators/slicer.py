"""Cross-filter queries over the cubes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.functions.keys import round_coordinate
from occspark.functions.text import count_text, null_label, percent_text, share, year_range
from occspark.operators.areas import area_columns
from occspark.operators.grid import TAXON_DIMENSIONS
from occspark.operators.rownumber import largest_rows
from occspark.operators.skew import lookup_join, top_n
from occspark.schema import CUBE_CONSERVATION_FIELDS, ensure_columns

OTHER = "Other"
CELL = ("lat_bin", "lon_bin")
DISPLAY_COLUMNS = (*TAXON_DIMENSIONS, "stateProvince")

# Polygon caps per area level that a display may pass as limits, state presets.
AREA_LIMITS = {"SA1": 8_000, "SA2": 3_000, "SA3": 500}
STATE_PRESETS = {
    "East coast": ["Victoria", "New South Wales", "Australian Capital Territory", "Queensland"],
    "Mainland": [
        "Australian Capital Territory",
        "New South Wales",
        "Northern Territory",
        "Queensland",
        "South Australia",
        "Victoria",
        "Western Australia",
    ],
}

OPTION_COLUMNS = {
    "families": "family",
    "genera": "genus",
    "species": "species",
    "states": "stateProvince",
    "years": "year",
    "national_statuses": "Status",
    "state_status_levels": "state_status_level",
}


@dataclass(frozen=True)
class SlicerState:
    """The user's selection. An empty list or ``None`` filters nothing."""

    include_families: Sequence[str] = ()
    exclude_families: Sequence[str] = ()
    include_genera: Sequence[str] = ()
    exclude_genera: Sequence[str] = ()
    include_species: Sequence[str] = ()
    exclude_species: Sequence[str] = ()
    include_states: Sequence[str] = ()
    exclude_states: Sequence[str] = ()
    year_min: int | None = None
    year_max: int | None = None
    conservation_scope: str | None = None
    include_conservation_statuses: Sequence[str] = ()

    def lists(self, dimension: str) -> tuple[Sequence[str], Sequence[str]]:
        plural = {"family": "families", "genus": "genera", "stateProvince": "states"}
        name = plural.get(dimension, dimension)
        return getattr(self, f"include_{name}"), getattr(self, f"exclude_{name}")

    @property
    def status_column(self) -> str | None:
        """The column an active conservation filter looks at."""
        columns = {"national": "Status", "state": "state_status_level"}
        return columns.get(self.conservation_scope or "") if self.include_conservation_statuses else None


def predicate(state: SlicerState, skip: str | None = None) -> Column:
    """P9-P13 as one condition. Exclusion keeps nulls; ``skip`` leaves one dimension out."""
    condition = F.lit(True)
    for dimension in ("family", "genus", "species", "stateProvince"):
        included, excluded = state.lists(dimension)
        if dimension == skip:
            continue
        value = F.col(dimension)
        if included:
            condition = condition & value.isin(*included)
        if excluded:
            condition = condition & (value.isNull() | ~value.isin(*excluded))
    if skip != "year":
        if state.year_min is not None:
            condition = condition & (F.col("year") >= int(state.year_min))
        if state.year_max is not None:
            condition = condition & (F.col("year") <= int(state.year_max))
    if skip != "conservation" and state.status_column:
        condition = condition & F.col(state.status_column).isin(*state.include_conservation_statuses)
    return condition


def color_dimension(state: SlicerState, locked: str | None = None) -> str:
    """The level that colours the map, one below the deepest taxon filter."""
    if state.status_column:
        return "species"
    if locked in TAXON_DIMENSIONS:
        return str(locked)
    levels = list(TAXON_DIMENSIONS)
    for filtered, shown in reversed(list(zip(levels, levels[1:]))):
        if any(state.lists(filtered)):
            return shown
    return "family"


def active_year_bounds(
    years: Sequence[int], selected: tuple[int, int]
) -> tuple[int | None, int | None]:
    """Selecting the full range means no year filter, so unknown years stay."""
    if not years or tuple(selected) == (min(years), max(years)):
        return None, None
    return selected


def state_preset(preset: str, states: Sequence[str]) -> list[str]:
    """A preset's states among the available ones."""
    if preset == "All":
        return list(states)
    return [s for s in STATE_PRESETS.get(preset, []) if s in states]


def _identifier(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_]\w*", name, flags=re.ASCII):
        raise ValueError(f"Not a column identifier: {name!r}")
    return name


def _at_precision(cube: DataFrame, decimals: int | None) -> DataFrame:
    """The cube with its coordinates rounded, ready to be grouped.

    All queries below add up counts, or take minima and maxima. Grouping rounded rows
    once gives what grouping a re-binned cube gives, without its wide shuffle.
    """
    full = ensure_columns(cube, CUBE_CONSERVATION_FIELDS)
    if decimals is None:
        return full
    return full.withColumns({c: round_coordinate(c, max(int(decimals), 0)) for c in CELL})


def _filtered(
    cube: DataFrame, state: SlicerState, color_by: str, place: Sequence[str], decimals: int | None
) -> DataFrame:
    """The placed cube rows of a selection, with their colour value.

    The joins further on drop rows without a place anyway. Saying so here keeps every
    branch of such a query alike, so that Spark computes their common part once.
    """
    source = _at_precision(cube, decimals).where(predicate(state))
    for column in place:
        source = source.where(F.col(column).isNotNull())
    return source.withColumn("color_value", null_label(color_by))


def _first(ordered: DataFrame, limit: int | None) -> DataFrame:
    """All rows, unless the caller asks for a limit."""
    return ordered if limit is None else ordered.limit(limit)


def _text(value: Column, count: Column) -> Column:
    return F.concat(value, F.lit(": "), count_text(count))


def grid_bins(
    cube: DataFrame,
    state: SlicerState,
    limit: int | None = None,
    locked: str | None = None,
    decimals: int | None = None,
) -> DataFrame:
    """Totals per cell, taxon down to the colour level, and state; largest first."""
    color_by = color_dimension(state, locked)
    shown = TAXON_DIMENSIONS[: TAXON_DIMENSIONS.index(color_by) + 1]
    group = [*CELL, *shown, "stateProvince"]
    measures = ("record_count", "distinct_scientific_names", "distinct_taxon_concepts")
    totals = (
        _at_precision(cube, decimals)
        .where(predicate(state))
        .groupBy(*group)
        .agg(
            *[F.sum(m).alias(m) for m in measures],
            F.min("min_year").alias("min_year"),
            F.max("max_year").alias("max_year"),
        )
    )
    displayed = [
        F.col(c) if c in group else F.lit(None).cast("string").alias(c) for c in DISPLAY_COLUMNS
    ]
    ties = [F.col(c).asc_nulls_last() for c in group]
    if limit is None:
        ranked = totals.orderBy(F.col("record_count").desc(), *ties)
    else:
        ranked = largest_rows(totals, "record_count", ties, limit)
    return ranked.select(
        *CELL,
        *displayed,
        *measures,
        "min_year",
        "max_year",
        year_range(F.col("min_year"), F.col("max_year")).alias("year_range"),
        F.lit(color_by).alias("color_level"),
        null_label(color_by).alias("color_value"),
    )


def color_options(
    cube: DataFrame, state: SlicerState, limit: int | None = None, locked: str | None = None
) -> DataFrame:
    """The colour values of a selection with their totals, largest first."""
    value = null_label(color_dimension(state, locked)).alias("value")
    totals = cube.where(predicate(state)).groupBy(value).agg(F.sum("record_count").alias("record_count"))
    return _first(totals.orderBy(F.col("record_count").desc(), "value"), limit)


def _one_or_multiple(column: str, focus: Column) -> Column:
    """The single value of a column among the focus rows, or ``multiple``.

    One minimum and one maximum tell this apart without a distinct count.
    """
    low, high = F.min(F.when(focus, F.col(column))), F.max(F.when(focus, F.col(column)))
    return F.when(low == high, low).when(low != high, F.lit("multiple"))


def share_bins(
    cube: DataFrame,
    state: SlicerState,
    focus_value: str,
    limit: int | None = None,
    locked: str | None = None,
    decimals: int | None = None,
    top_competitors: int = 5,
) -> DataFrame:
    """A23 + A24: share of one colour value per cell, with the cell's leading values.

    One aggregate per cell gives both total and focus counts, where a self-join of
    two aggregates would read and shuffle the cube twice.
    """
    color_by = color_dimension(state, locked)
    rows = _filtered(cube, state, color_by, CELL, decimals)
    focus = F.col("color_value") == F.lit(focus_value)
    shown = {*TAXON_DIMENSIONS[: TAXON_DIMENSIONS.index(color_by) + 1], "stateProvince"}
    displayed = [
        (_one_or_multiple(c, focus) if c in shown else F.lit(None).cast("string")).alias(c)
        for c in DISPLAY_COLUMNS
    ]
    cells = (
        rows.groupBy(*CELL)
        .agg(
            *displayed,
            F.sum(F.when(focus, F.col("record_count"))).alias("record_count"),
            F.sum("record_count").alias("total_cell_records"),
            F.count_if(focus).alias("_focus_rows"),
        )
        .where((F.col("_focus_rows") > 0) & F.lit(bool(focus_value)))
    )
    if limit is not None:
        cells = largest_rows(cells, "record_count", CELL, limit)
    texts = composition_text(rows, cells.select(*CELL), top_competitors)
    return cells.join(texts, list(CELL), "left").select(
        *CELL,
        *DISPLAY_COLUMNS,
        "record_count",
        "total_cell_records",
        (F.col("record_count").cast("double") / F.col("total_cell_records")).alias("share"),
        F.lit(color_by).alias("color_level"),
        F.lit(focus_value).alias("color_value"),
        F.coalesce("composition_text", F.lit("")).alias("composition_text"),
    )


def composition_text(rows: DataFrame, cells: DataFrame, n: int) -> DataFrame:
    """The first ``n`` colour values of each given cell as lines of text."""
    counts = (
        rows.join(cells, list(CELL), "left_semi")
        .groupBy(*CELL, "color_value")
        .agg(F.sum("record_count").alias("record_count"))
    )
    ranked = top_n(counts, CELL, [F.col("record_count").desc(), F.col("color_value")], n)
    line = F.struct("rank", _text(F.col("color_value"), F.col("record_count")).alias("line"))
    return ranked.groupBy(*CELL).agg(_lines(F.collect_list(line)).alias("composition_text"))


def _lines(items: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["line"]), "\n")


def all_share_bins(
    cube: DataFrame,
    state: SlicerState,
    limit_per_category: int | None = None,
    locked: str | None = None,
    decimals: int | None = None,
    max_categories: int | None = None,
) -> DataFrame:
    """Shares per cell and category; limits keep the largest categories and each one's top cells.

    The cube is aggregated once per (cell, category); cell totals, category totals and
    the ranking all start from that.
    """
    color_by = color_dimension(state, locked)
    counts = (
        _filtered(cube, state, color_by, CELL, decimals)
        .groupBy(*CELL, "color_value")
        .agg(F.sum("record_count").alias("record_count"))
    )
    cells = counts.groupBy(*CELL).agg(F.sum("record_count").alias("total_cell_records"))
    categories = (
        counts.groupBy("color_value")
        .agg(F.sum("record_count").alias("category_total_records"))
    )
    if max_categories is not None:
        largest = categories.orderBy(F.col("category_total_records").desc(), "color_value")
        categories = largest.limit(max(int(max_categories), 1))
    ranked = counts.join(categories, ["color_value"])
    if limit_per_category is not None:
        order = [F.col("record_count").desc(), *[F.col(c) for c in CELL]]
        ranked = top_n(ranked, ["color_value"], order, max(int(limit_per_category), 1), "point_rank")
    shared = ranked.join(cells, list(CELL)).withColumn(
        "share", share(F.col("record_count"), F.col("total_cell_records"))
    )
    percent = percent_text(F.col("share"))
    text = F.concat(
        _text(F.col("color_value"), F.col("record_count")),
        F.lit(" / "),
        count_text(F.col("total_cell_records")),
        F.lit(" ("),
        percent,
        F.lit(")"),
    )
    return shared.select(
        *CELL,
        "record_count",
        "total_cell_records",
        "category_total_records",
        "share",
        F.lit(color_by).alias("color_level"),
        "color_value",
        percent.alias("share_percent"),
        text.alias("composition_text"),
    ).orderBy(
        F.col("category_total_records").desc(), "color_value", F.col("record_count").desc(), *CELL
    )


def cell_shares(cube: DataFrame, color_by: str = "family", place: Sequence[str] = CELL) -> DataFrame:
    """Records per place and value beside the place's total, with the value's share of it.

    Totals are joined from the counts per (place, value), of which a place has one row per value.
    """
    counts = cube.groupBy(*place, F.col(color_by).alias("color_value")).agg(F.sum("record_count").alias("record_count"))
    totals = counts.groupBy(*place).agg(F.sum("record_count").alias("total_record_count"))
    joined = lookup_join(counts, totals, list(place), "inner")
    return joined.withColumn("share", share(F.col("record_count"), F.col("total_record_count")))


def _composition_rows(
    rows: DataFrame, place: Sequence[str], limit: int | None, top: int | None
) -> DataFrame:
    """O3 + O4: category rows of the largest places, the tail gathered as ``Other``.

    The tail is what the leading categories leave of the place's total. It is never
    listed, so a place with very many categories does not burden one task.
    """
    counts = rows.groupBy(*place, "color_value").agg(F.sum("record_count").alias("record_count"))
    places = (
        counts.groupBy(*place)
        .agg(F.sum("record_count").alias("total_record_count"), F.count(F.lit(1)).alias("_categories"))
    )
    if limit is not None:
        places = largest_rows(places, "total_record_count", place, limit)
    chosen = counts.join(places, list(place))
    if top is None:
        # Full mode lists every category anyway, in descending order of its count.
        return chosen.withColumn("category_order", -F.col("record_count")).drop("_categories")
    n = max(int(top), 1)
    order = [F.col("record_count").desc(), F.col("color_value")]
    leading = top_n(chosen, place, order, n, "category_order")
    fields = ("color_value", "record_count", "category_order")
    per_place = leading.groupBy(*place, "total_record_count", "_categories").agg(
        F.collect_list(F.struct(*fields)).alias("_leading"),  # at most n items
        F.sum("record_count").alias("_covered"),
    )
    tail = F.struct(
        F.lit(OTHER).alias("color_value"),
        (F.col("total_record_count") - F.col("_covered")).alias("record_count"),
        F.lit(n + 1).alias("category_order"),
    )
    items = F.when(
        F.col("_categories") > n, F.concat("_leading", F.array(tail))
    ).otherwise(F.col("_leading"))
    # A leading category that is itself called "Other" merges with the tail.
    return (
        per_place.select(*place, "total_record_count", F.explode(items).alias("i"))
        .select(*place, "total_record_count", "i.*")
        .groupBy(*place, "total_record_count", "color_value")
        .agg(F.sum("record_count").alias("record_count"), F.min("category_order").alias("category_order"))
    )


def composition_rows(
    cube: DataFrame,
    state: SlicerState,
    limit: int | None = None,
    locked: str | None = None,
    decimals: int | None = None,
    top: int = 8,
) -> DataFrame:
    """O4, flat form: one row per cell and leading category, ``Other`` last."""
    color_by = color_dimension(state, locked)
    rows = _filtered(cube, state, color_by, CELL, decimals)
    flat = _composition_rows(rows, CELL, limit, top)
    return _with_share(flat, color_by).select(
        *CELL, "total_record_count", "color_level", "color_value", "record_count", "share", "category_order"
    )


def _with_share(flat: DataFrame, color_by: str) -> DataFrame:
    return flat.withColumns(
        {
            "share": share(F.col("record_count"), F.col("total_record_count")),
            "color_level": F.lit(color_by),
        }
    )


def nest_composition(flat: DataFrame, place: Sequence[str]) -> DataFrame:
    """One row per place with its composition as an array, and its dominant value."""
    item = F.struct(
        F.col("category_order"),
        F.col("color_value").alias("value"),
        F.col("record_count"),
        F.col("share"),
    )
    nested = flat.groupBy(*place, "total_record_count", "color_level").agg(
        F.array_sort(F.collect_list(item)).alias("_items")
    )
    first = F.get("_items", F.lit(0))
    line = lambda x: F.concat(
        _text(x["value"], x["record_count"]), F.lit(" ("), percent_text(x["share"]), F.lit(")")
    )
    return nested.select(
        *place,
        "total_record_count",
        "color_level",
        F.transform(
            "_items",
            lambda x: F.struct(
                x["value"].alias("value"),
                x["record_count"].alias("record_count"),
                x["share"].alias("share"),
            ),
        ).alias("composition"),
        F.array_join(F.transform("_items", line), "\n").alias("composition_text"),
        first["value"].alias("dominant_value"),
        first["record_count"].alias("dominant_record_count"),
        first["share"].alias("dominant_share"),
    )


def composition_markers(cube: DataFrame, state: SlicerState, **options: object) -> DataFrame:
    """O4 + O5: one row per cell with its nested composition, largest first."""
    flat = composition_rows(cube, state, **options)  # type: ignore[arg-type]
    nested = nest_composition(flat, CELL).drop(
        "dominant_value", "dominant_record_count", "dominant_share"
    )
    return nested.orderBy(F.col("total_record_count").desc(), *CELL)


def area_composition_rows(
    cube: DataFrame,
    boundaries: DataFrame,
    state: SlicerState,
    level: str = "SA3",
    limit: int | None = None,
    locked: str | None = None,
    top: int | None = None,
    code_column: str | None = None,
    name_column: str | None = None,
) -> DataFrame:
    """O7, flat form: categories of the largest areas that have a boundary."""
    color_by = color_dimension(state, locked)
    code, name = area_columns(level)
    code, name = _identifier(code_column or code), _identifier(name_column or name)
    rows = _filtered(cube, state, color_by, (code,), None)
    rows = rows.select(F.col(code).alias("area_code_2021"), "color_value", "record_count")
    flat = _composition_rows(rows, ("area_code_2021",), limit, top)
    shapes = boundaries.select(
        F.col(code).alias("area_code_2021"), F.col(name).alias("area_name_2021"), "geometry_geojson"
    )
    return (
        _with_share(flat, color_by)
        .join(shapes, ["area_code_2021"])
        .withColumn("area_level", F.lit(level.upper()))
    )


def area_compositions(
    cube: DataFrame, boundaries: DataFrame, state: SlicerState, level: str = "SA3", **options: object
) -> DataFrame:
    """O7 + O5: one row per area with composition and dominant value, largest first."""
    flat = area_composition_rows(cube, boundaries, state, level, **options)  # type: ignore[arg-type]
    place = ("area_level", "area_code_2021", "area_name_2021", "geometry_geojson")
    # Nest on the code alone, then bring the wide geometry back once per area.
    slim = nest_composition(flat.drop("geometry_geojson"), place[:3])
    code, _ = area_columns(level)
    shapes = boundaries.select(
        F.col(str(options.get("code_column") or code)).alias("area_code_2021"), "geometry_geojson"
    )
    return slim.join(shapes, ["area_code_2021"]).orderBy(
        F.col("total_record_count").desc(), "area_code_2021"
    )


def matching_records(cube: DataFrame, state: SlicerState) -> DataFrame:
    """Number of records of a selection, zero when there are none."""
    total = F.coalesce(F.sum("record_count"), F.lit(0)).alias("record_count")
    return cube.where(predicate(state)).agg(total)


def option_values(
    cube: DataFrame, state: SlicerState, options: Sequence[str] = tuple(OPTION_COLUMNS)
) -> DataFrame:
    """The values each slicer can offer under the selection, one row per value.

    All lists come from one filtered scan. A column the cube lacks has no values.
    """
    wanted = {o: OPTION_COLUMNS[o] for o in options if OPTION_COLUMNS[o] in cube.columns}
    if not wanted:
        return cube.sparkSession.createDataFrame([], "option string, value string")
    pairs = F.array(
        *[
            F.struct(F.lit(o).alias("option"), F.col(c).cast("string").alias("value"))
            for o, c in wanted.items()
        ]
    )
    return (
        cube.where(predicate(state))
        .select(F.explode(pairs).alias("p"))
        .select("p.option", "p.value")
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("option", "value")
    )


def cascading_options(cube: DataFrame, state: SlicerState) -> DataFrame:
    """Each slicer's list under the selections above it, from one scan.

    The order is conservation, family, genus, species, state, year. Every row is
    checked against each prefix of the selection and offers its value where it passes.
    """
    empty = SlicerState()
    prefixes = {"national_statuses": empty, "state_status_levels": empty}
    chosen = replace(
        empty,
        conservation_scope=state.conservation_scope,
        include_conservation_statuses=state.include_conservation_statuses,
    )
    for option in ("families", "genera", "species", "states"):
        prefixes[option] = chosen
        both = {f"{mode}_{option}": getattr(state, f"{mode}_{option}") for mode in ("include", "exclude")}
        chosen = replace(chosen, **both)
    prefixes["years"] = chosen
    pairs = F.array(
        *[
            F.struct(
                F.lit(o).alias("option"),
                F.when(predicate(p), F.col(OPTION_COLUMNS[o]).cast("string")).alias("value"),
            )
            for o, p in prefixes.items()
            if OPTION_COLUMNS[o] in cube.columns
        ]
    )
    return (
        cube.select(F.explode(pairs).alias("p"))
        .select("p.option", "p.value")
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("option", "value")
    )


def year_summary(cube: DataFrame, state: SlicerState) -> DataFrame:
    """Records per year, unknown year last."""
    totals = cube.where(predicate(state)).groupBy("year").agg(F.sum("record_count").alias("record_count"))
    return totals.orderBy(F.col("year").asc_nulls_last())


def hidden_records(
    cube: DataFrame, boundaries: DataFrame, state: SlicerState, level: str = "SA3", limit: int | None = None
) -> DataFrame:
    """Visible and matching records, and how many the polygon cap hides."""
    code, _ = area_columns(level)
    rows = cube.where(predicate(state))
    shown = (
        rows.groupBy(code)
        .agg(F.sum("record_count").alias("n"))
    )
    if limit is not None:
        shown = shown.orderBy(F.col("n").desc(), code).limit(limit)
    shown = (
        shown.join(boundaries.select(code), [code], "left_semi")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("visible_records"))
    )
    both = shown.unionByName(
        matching_records(cube, state).withColumnRenamed("record_count", "matching_records"),
        allowMissingColumns=True,
    ).agg(
        F.max("visible_records").alias("visible_records"),
        F.max("matching_records").alias("matching_records"),
    )
    return both.withColumn("hidden_records", F.col("matching_records") - F.col("visible_records"))
