"""Hashes, match keys and dedupe keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from occspark.functions.text import col, date_prefix

def round_coordinate(c: Column | str, decimals: int, half_even: bool = False) -> Column:
    """rounded coordinate; adding zero turns -0.0 into 0.0."""
    rounded = F.bround(col(c), decimals) if half_even else F.round(col(c), decimals)
    return rounded + F.lit(0.0)


def json_number(c: Column) -> Column:
    """A double as JSON text: shortest digits, with an exponent only below 1e-4 and from 1e16."""
    text = c.cast("string")
    plain = F.regexp_replace(text.cast("decimal(38,20)").cast("string"), r"0+\z", "")
    plain = F.regexp_replace(plain, r"\.\z", ".0")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0\z", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(power < 0, "e-").otherwise("e+")
    scientific = F.concat(mantissa, sign, F.lpad(F.abs(power).cast("string"), 2, "0"))
    magnitude = F.abs(c)
    return F.when((magnitude == 0) | ((magnitude >= 1e-4) & (magnitude < 1e16)), plain).otherwise(
        scientific
    )


def json_string(c: Column) -> Column:
    """A text as a JSON string."""
    wrapped = F.to_json(F.array(c))
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def json_object(cells: dict[str, Column]) -> Column:
    """A compact JSON object of rendered cells, keys sorted; null cells are left out."""
    pairs = [F.concat(F.lit(f'"{name}":'), cells[name]) for name in sorted(cells)]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def hash_json(json_text: Column) -> Column:
    """SHA-256 of a compact JSON text whose keys are sorted."""
    return F.sha2(json_text, 256)


def canonical_hash() -> Column:
    """digest of the identifying fields of a canonical record, nulls included."""
    texts = (
        "source",
        "source_jurisdiction",
        "source_record_id",
        "scientific_name",
        "event_date_start",
    )
    numbers = ("decimal_latitude", "decimal_longitude")
    cells = {c: json_string(F.col(c)) for c in texts} | {c: json_number(F.col(c)) for c in numbers}
    null = F.lit("null")
    return hash_json(json_object({c: F.when(F.col(c).isNull(), null).otherwise(v) for c, v in cells.items()}))


def _text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def match_key(
    name: Column | str, date: Column | str, latitude: Column | str, longitude: Column | str
) -> Column:
    """name, day and five-decimal place of a record; nulls read as empty.

    Both sides of a comparison must come through here, so that numbers print alike.
    """
    return F.concat_ws(
        "|",
        F.lower(_text_or_empty(col(name))),
        _text_or_empty(date_prefix(date)),
        _text_or_empty(round_coordinate(latitude, 5)),
        _text_or_empty(round_coordinate(longitude, 5)),
    )


def fingerprint() -> Column:
    """what identifies a record that has no identifier."""
    name = F.coalesce("scientificName", "raw_scientificName", "species", "query_scientific_name")
    basis = F.coalesce("basisOfRecord", "raw_basisOfRecord")
    middle = (
        "decimalLatitude",
        "decimalLongitude",
        "eventDate",
        "dataResourceUid",
        "dataResourceName",
        "recordNumber",
    )
    parts = [name, *[F.col(c) for c in middle], basis]
    return F.concat_ws("|", *[_text_or_empty(p) for p in parts])


def dedupe_key() -> Column:
    """F16: the identifier when there is one, else the fingerprint."""
    return F.when(
        F.col("uuid").cast("string") != "", F.concat(F.lit("uuid:"), F.col("uuid").cast("string"))
    ).otherwise(F.concat(F.lit("fp:"), fingerprint()))
