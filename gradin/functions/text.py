"""Cleaning of raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value", compared without regard to case.
NULL_TOKENS = ("", "nan", "none", "null")


def trimmed(col: Column, chars: str | None = None) -> Column:
    """Strip blanks (U+0020 only, so tabs and no-break spaces stay) or the given characters."""
    return F.trim(col) if chars is None else F.btrim(col, F.lit(chars))


def null_if_token(col: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """NULL where the text is one of the null tokens."""
    return F.when(~F.lower(col).isin(*tokens), col)


def clean_text(
    col: Column, tokens: tuple[str, ...] = NULL_TOKENS, chars: str | None = None
) -> Column:
    return null_if_token(trimmed(col, chars), tokens)


def upper_code(col: Column) -> Column:
    return F.upper(col)


def blank_if_missing(col: Column, default: str = "") -> Column:
    """A value read from a nested path as text; a missing or null value gives the default."""
    return F.coalesce(col.cast("string"), F.lit(default))


def first_filled(*cols: Column) -> Column:
    """The first value that is neither NULL nor empty; the last one is taken as it is."""
    *preferred, last = cols
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in preferred], last)
