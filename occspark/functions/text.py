"""Text clean-up, keys, labels and name predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from occspark.schema import INVALID_LEADING_WORDS, INVALID_TAXON_LABELS, NULL_LABEL

_SPACE = r"[\s\x1c-\x1f]"
#: The characters of that class under (?U), which is Unicode's White_Space.
_SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]))
_SPACES += "\u2028\u2029\u202f\u205f\u3000"
_ANY_SPACE = rf"(?U){_SPACE}+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Strip every kind of white space; ``trim`` would only strip blanks."""
    return F.btrim(col(c).cast("string"), F.lit(_SPACES))


def clean_text(c: Column | str) -> Column:
    """stripped text, empty becomes null."""
    return F.nullif(strip(c), F.lit(""))


def safe_key(c: Column | str) -> Column:
    """F8: lower-case key of letters, digits and single underscores."""
    key = F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "_")
    return F.regexp_replace(key, "^_+|_+$", "")


def words(c: Column | str) -> Column:
    """The white-space separated words of a text."""
    return F.filter(F.split(strip(c), _ANY_SPACE), lambda w: w != "")


def normalise_taxon_name(c: Column | str) -> Column:
    """lower-case a-z0-9 words, without parenthesised parts; empty text gives null."""
    text = F.regexp_replace(F.lower(F.nullif(col(c), F.lit(""))), r"\([^)]*\)", " ")
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def _binomial_words(c: Column | str) -> Column:
    parts = words(F.translate(col(c), "()", "  "))
    return F.filter(parts, lambda w, i: (i == 0) | (F.length(w) == 1) | ~w.rlike(r"^\p{Lu}"))


def binomial_genus(c: Column | str) -> Column:
    """F11, first part: the genus word."""
    return F.get(_binomial_words(c), F.lit(0))


def binomial_species(c: Column | str) -> Column:
    """F11, second part: genus and epithet, null when there is no epithet."""
    parts = _binomial_words(c)
    return F.when(F.size(parts) >= 2, F.concat_ws(" ", F.slice(parts, 1, 2)))


def null_label(c: Column | str) -> Column:
    """the text of a value, with a label for null."""
    return F.coalesce(col(c).cast("string"), F.lit(NULL_LABEL))


def year_range(low: Column, high: Column) -> Column:
    """one year, or ``low-high``."""
    return F.when(low == high, low.cast("string")).otherwise(
        F.concat(low.cast("string"), F.lit("-"), high.cast("string"))
    )


def share(part: Column, whole: Column) -> Column:
    """Share of a whole, zero for an empty whole."""
    return F.when(whole != 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def percent_text(c: Column) -> Column:
    """``70.0%``, rounded on the number's binary value with ties to even.

    ``format_string`` would round the printed decimal digits up instead (6.25 to 6.3).
    """
    return F.concat(_tenths_text(c * 100), F.lit("%"))


def _tenths_text(c: Column) -> Column:
    """One decimal of a number that isn't negative, ties to even."""
    whole = F.floor(c)
    tenths = whole * 10 + F.rint((c - whole) * 10).cast("long")
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def count_text(c: Column) -> Column:
    """thousands-separated count."""
    return F.format_number(c.cast("long"), 0)


def date_prefix(c: Column | str) -> Column:
    """the date part of an ISO timestamp."""
    return F.substring(col(c), 1, 10)


def duration_text(c: Column | str) -> Column:
    """``1h 2m 3.0s``."""
    seconds = col(c).cast("double")
    hours = F.floor(seconds / 3600)
    minutes = F.floor(F.pmod(seconds, F.lit(3600.0)) / 60)
    rest = F.pmod(seconds, F.lit(60.0))
    return (
        F.when(hours > 0, F.format_string("%dh %dm %ss", hours, minutes, _tenths_text(rest)))
        .when(minutes > 0, F.format_string("%dm %ss", minutes, _tenths_text(rest)))
        .otherwise(F.concat(_tenths_text(rest), F.lit("s")))
    )


def _names_a_taxon(c: Column) -> Column:
    first = F.lower(F.get(words(c), F.lit(0)))
    return ~F.lower(strip(c)).isin(*INVALID_TAXON_LABELS) & ~first.isin(*INVALID_LEADING_WORDS)


def is_probable_scientific_name(c: Column | str, strict: bool = False) -> Column:
    """P17 (loose) and P18 (strict): does a label look like a species name?"""
    tail = r"(\s+[a-z][a-z-]+)+" if strict else r"\s+\S.*"
    shape = strip(c).rlike(rf"(?Us)^[A-Z][a-zA-Z-]+{tail}\z")
    return F.coalesce(shape & _names_a_taxon(col(c)), F.lit(False))


def is_valid_facet_label(c: Column | str) -> Column:
    """A usable facet label."""
    usable = (F.size(words(c)) > 0) & _names_a_taxon(col(c))
    return F.coalesce(usable, F.lit(False))
