"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The release year is a parenthesised four-digit number.
TRAILING_YEAR = r"\((\d{4})\)\s*$"
FIRST_YEAR = r"\((\d{4})\)"
STRIP_TRAILING_YEAR = r"\s*\(\d{4}\)\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c, sep: str = "|") -> Column:
    """Split on a literal separator and drop empty elements."""
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return F.filter(F.split(_col(c), pattern), lambda x: x != F.lit(""))


def title_year(title, match: str = "trailing") -> Column:
    """Year in parentheses as INT, NULL when absent.

    ``match='trailing'`` anchors to the end of the title; ``'first'`` takes the
    first parenthesised year anywhere in it.
    """
    pattern = TRAILING_YEAR if match == "trailing" else FIRST_YEAR
    return F.regexp_extract(_col(title), pattern, 1).try_cast("int")


def strip_title_year(title) -> Column:
    """Title without its trailing parenthesised year."""
    return F.regexp_replace(_col(title), STRIP_TRAILING_YEAR, "")


def normalize_token(c) -> Column:
    """Lower-case then trim."""
    return F.trim(F.lower(_col(c)))
