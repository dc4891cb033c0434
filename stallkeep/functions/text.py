"""Text helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case Latin letters with accents and their plain forms.
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüýÿçñ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuyycn"
# Accents that follow their letter as characters of their own.
COMBINING = "".join(map(chr, range(0x300, 0x370)))
# Characters a city comparison ignores.
IGNORED_IN_CITY = " -'"


def _column(name: Column | str) -> Column:
    return F.col(name) if isinstance(name, str) else name


def city_key(city: Column | str) -> Column:
    """Comparison key of a city name: case, accents, spaces, hyphens and apostrophes do not count.

    ``translate`` maps the accented letters and, for the characters that have
    no counterpart in the replacement, deletes them, all in one pass.
    """
    return F.translate(F.lower(F.trim(_column(city))), ACCENTED + IGNORED_IN_CITY + COMBINING, PLAIN)


def folded(text: Column | str) -> Column:
    """Lower case without accents and trailing blanks: a case- and accent-insensitive comparison key."""
    return F.translate(F.lower(F.rtrim(_column(text))), ACCENTED + COMBINING, PLAIN)


def is_blank(text: Column | str) -> Column:
    """Present but empty after trimming; unknown (not true) for NULL."""
    return F.trim(_column(text)) == ""


def text_length(text: Column | str) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(_column(text)))
