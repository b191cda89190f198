"""Coercion of JSON cells and free text into typed columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from occspark.functions.text import clean_text, col, normalise_taxon_name, strip

_TRUE_WORDS = ("true", "t", "1", "yes", "y")
_FALSE_WORDS = ("false", "f", "0", "no", "n")
_FIRST_MILLIS = -62_135_596_800_000
_LAST_MILLIS = 253_402_300_799_999
#: Levels of lists within lists; what lies deeper stays JSON text.
_NESTED_LISTS = 8


def _joined_list(text: Column, depth: int) -> Column:
    def item(text: Column, cell: Column) -> Column:
        kind = F.schema_of_variant(cell)
        shown = F.when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)
        if not depth:
            return shown
        # A text that merely begins with a bracket is no list.
        return F.when(kind.startswith("ARRAY"), _joined_list(text, depth - 1)).otherwise(shown)

    items = F.zip_with(F.from_json(text, "array<string>"), F.from_json(text, "array<variant>"), item)
    return F.array_join(F.filter(items, lambda x: x.isNotNull() & (x != "")), " | ")


def cell_text(text: Column, kind: Column) -> Column:
    """text of a JSON cell; lists are joined by `` | ``, objects stay compact JSON.

    ``text`` is the cell read as a string field, ``kind`` its ``schema_of_variant``:
    the text alone cannot tell the list ``[1]`` from the string ``"[1]"``.
    """
    return (
        F.when(
            text.startswith("["),
            F.when(kind.startswith("ARRAY"), _joined_list(text, _NESTED_LISTS)).otherwise(text),
        )
        .when(text.isin("true", "false") & (kind == "BOOLEAN"), F.initcap(text))
        .otherwise(text)
    )


def to_double(c: Column | str) -> Column:
    """number, or null for empty and malformed text."""
    text = strip(c)
    # A trailing d or f is a number suffix to the JVM only.
    return F.when(~text.rlike(r"[0-9.][dDfF]\z"), text.try_cast("double"))


def to_long(c: Column | str) -> Column:
    """F4 for text: ``"7.5"`` is not an integer."""
    text = strip(c)
    return F.when(text.rlike(r"^[+-]?\d+\z"), text.try_cast("bigint"))


def number_to_long(text: Column, kind: Column) -> Column:
    """F4 for a JSON cell: a *number* 7.5 truncates, the *text* ``"7.5"`` is null."""
    truncated = F.when(kind != "STRING", text.try_cast("double").try_cast("bigint"))
    return F.coalesce(to_long(text), truncated)


def to_boolean(c: Column | str) -> Column:
    """F5."""
    word = F.lower(strip(c))
    return F.when(word.isin(*_TRUE_WORDS), F.lit(True)).when(word.isin(*_FALSE_WORDS), F.lit(False))


def millis_to_iso(c: Column | str, whole: bool = False) -> Column:
    """UTC ISO text of epoch milliseconds; text that is no such number stays as it is.

    Works on TIMESTAMP_NTZ throughout, so the session time zone has no influence. ``whole`` says that
    the column is of type long, which needs no parsing.
    """
    text = col(c).cast("string")
    millis = col(c) if whole else to_long(text)
    moment = F.timestamp_add(
        "MILLISECOND", millis, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )
    fraction = F.pmod(millis, F.lit(1000))
    iso = F.concat(
        F.translate(F.substring(moment.cast("string"), 1, 19), " ", "T"),
        F.when(
            fraction != 0, F.concat(F.lit("."), F.lpad(fraction.cast("string"), 3, "0"), F.lit("000"))
        ).otherwise(F.lit("")),
        F.lit("+00:00"),
    )
    return F.when(millis.between(_FIRST_MILLIS, _LAST_MILLIS), iso).otherwise(
        F.nullif(text, F.lit(""))
    )


def event_date_start(c: Column | str) -> Column:
    """start of a date or ``start/end`` interval."""
    return clean_text(F.substring_index(clean_text(c), "/", 1))


def event_date_end(c: Column | str) -> Column:
    """end of an interval, null for a single date."""
    text = clean_text(c)
    return clean_text(F.get(F.split(text, "/", 2), F.lit(1)))


def event_date_year(c: Column | str) -> Column:
    """year from the first four characters of the start."""
    start = event_date_start(c)
    return F.when(F.length(start) >= 4, to_long(F.substring(start, 1, 4)))


def matches_query_name(query_name: Column, names: list[Column]) -> Column:
    """does any of the record's names normalise to the query name?"""
    expected = F.nullif(normalise_taxon_name(query_name), F.lit(""))
    hits = [F.coalesce(normalise_taxon_name(n) == expected, F.lit(False)) for n in names]
    return reduce(lambda a, b: a | b, hits)


def is_sensitive(sensitivity_class: Column | str) -> Column:
    """any class text other than "not sensitive"."""
    return F.coalesce(F.lower(clean_text(sensitivity_class)) != "not sensitive", F.lit(False))


def is_spatially_generalised(sensitivity_class: Column | str, generalisations: Column | str) -> Column:
    """sensitive, or the generalisation text speaks of places."""
    spatial = F.lower(clean_text(generalisations)).rlike(
        "coordinate|spatial|location|generalised|generalized"
    )
    return is_sensitive(sensitivity_class) | F.coalesce(spatial, F.lit(False))

