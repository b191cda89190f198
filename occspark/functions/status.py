"""Conservation-status text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from occspark.functions.text import clean_text, col
from occspark.schema import STATE_CODES

# Status levels, longest first.
STATUS_LEVELS = ("Critically Endangered", "Endangered", "Vulnerable", "Rare")
_LEVEL = f"(?s)^({'|'.join(STATUS_LEVELS)})(.*)\\z"


def status_level(c: Column | str) -> Column:
    """the known level a status text starts with; other text is its own level."""
    status = clean_text(c)
    return F.coalesce(F.nullif(F.regexp_extract(status, _LEVEL, 1), F.lit("")), status)


def status_qualifier(c: Column | str) -> Column:
    """what follows a known level, without separators."""
    rest = F.regexp_extract(clean_text(c), _LEVEL, 2)
    return clean_text(F.regexp_replace(rest, r"^[ \-;]+|[ \-;]+\z", ""))


def status_entries(c: Column | str) -> Column:
    """``"NSW: X; QLD: Y"`` as an array of jurisdiction and status."""
    parts = F.filter(
        F.transform(F.split(col(c), ";"), clean_text), lambda p: p.isNotNull()
    )

    def entry(part: Column) -> Column:
        named = part.contains(":")
        after = F.substring(part, F.locate(":", part) + 1, F.length(part))
        status = F.when(named, F.coalesce(clean_text(after), F.lit(""))).otherwise(part)
        jurisdiction = F.when(named, clean_text(F.substring_index(part, ":", 1)))
        return F.struct(jurisdiction.alias("jurisdiction"), status.alias("status_text"))

    return F.transform(parts, entry)


def state_code(c: Column | str, codes: Mapping[str, str] = STATE_CODES) -> Column:
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), clean_text(c))


def state_status(
    province: Column | str, status: Column | str, codes: Mapping[str, str] = STATE_CODES
) -> Column:
    """the entry that applies to a record's state, as a struct of four texts.

    An entry without jurisdiction applies everywhere; an unknown state name only
    meets such entries. All four are null when no entry applies.
    """
    return _status_of(state_code(province, codes), status)


def _unknown(codes: Mapping[str, str]) -> str:
    """A text that is none of the codes."""
    return max(codes.values(), default="") + "?"


def statuses_by_code(status: Column | str, codes: Mapping[str, str] = STATE_CODES) -> Column:
    """F19 for every state at once, as a map: a status text is taken apart once and not for each record."""
    unknown = F.lit(_unknown(codes))
    listed = F.array(*[F.lit(c) for c in dict.fromkeys(codes.values())], unknown)
    return F.map_from_arrays(listed, F.transform(listed, lambda c: _status_of(F.nullif(c, unknown), status)))


def status_in_state(
    province: Column | str, by_code: Column, codes: Mapping[str, str] = STATE_CODES
) -> Column:
    """F19 out of the map of ``statuses_by_code``."""
    return F.try_element_at(by_code, F.coalesce(state_code(province, codes), F.lit(_unknown(codes))))


def _status_of(code: Column, status: Column | str) -> Column:
    applicable = F.filter(
        status_entries(status),
        lambda e: e["jurisdiction"].isNull() | F.coalesce(e["jurisdiction"] == code, F.lit(False)),
    )
    first = F.get(applicable, F.lit(0))
    text = first["status_text"]
    jurisdiction = F.coalesce(first["jurisdiction"], code)
    labelled = F.when(
        jurisdiction.isNotNull() & (text != ""), F.concat(jurisdiction, F.lit(": "), text)
    ).otherwise(text)
    found = F.size(applicable) > 0
    return F.struct(
        status_level(text).alias("state_status_level"),
        labelled.alias("state_status_for_occurrence"),
        F.when(found, jurisdiction).alias("state_status_jurisdiction_matched"),
        status_qualifier(text).alias("state_status_qualifier"),
    )


def match_type(field: str, name: Column, accepted: Column) -> Column:
    """the matched field, marked when the name is a synonym."""
    return F.when(name != accepted, F.lit(f"{field}_synonym")).otherwise(F.lit(field))


def match_confidence(field: str, name: Column, accepted: Column) -> Column:
    """1.0 / 0.95 for scientificName, 0.9 / 0.85 for species; 0.85 when undecided."""
    exact, synonym = (1.0, 0.95) if field == "scientificName" else (0.9, 0.85)
    return (
        F.when(name == accepted, F.lit(exact))
        .when(name != accepted, F.lit(synonym))
        .otherwise(F.lit(0.85))
    )


def match_names(accepted: Column | str, names: Column | str) -> Column:
    """the accepted name first, then the ``|``-separated ones, without repeats."""
    split_names = F.transform(F.split(F.coalesce(col(names), F.lit("")), r"\|"), clean_text)
    every = F.concat(F.array(clean_text(accepted)), split_names)
    return F.array_distinct(F.filter(every, lambda n: n.isNotNull()))
