"""Tolerant typing: a malformed value becomes NULL whatever spark.sql.ansi.enabled says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of the landed texts.
DATE_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"

# What a number may be wrapped in (blanks and control characters), its sign and digits,
# and a fraction, which counts for nothing.
_PAD = r"[\x00-\x20\x7F]*"
_NUMBER = rf"^{_PAD}([+-]?\d+)(?:\.\d*)?{_PAD}\z"
_FRACTION = rf"^{_PAD}[+-]?\.\d*{_PAD}\z"
_PLAIN = r"^[0-9]+(?:\.[0-9]*)?\z"


def _to_integral(col: Column, type_name: str) -> Column:
    # "2.9" counts as 2 and ".5" as 0, as in a lenient cast. Only what looks like a number is
    # cast: under ANSI try_cast throws and catches on a malformed text, ten times the cost of
    # a match. The expression is the same in every session. Plain numbers, which most values are,
    # need one match and no extraction. The others go through a lambda, which is evaluated as it
    # is: written out for a dozen columns it makes a method that is too large for the JVM to compile.
    def number(text: Column) -> Column:
        digits = F.nullif(F.regexp_extract(text, _NUMBER, 1), F.lit(""))
        return F.coalesce(digits, F.when(text.rlike(_FRACTION), F.lit("0")))

    other = F.element_at(F.transform(F.array(col), number), 1)
    plain = F.substring_index(col, ".", 1)
    return F.when(col.rlike(_PLAIN), plain).when(col.isNotNull(), other).try_cast(type_name)


def to_int(col: Column) -> Column:
    return _to_integral(col, "int")


def to_long(col: Column) -> Column:
    return _to_integral(col, "bigint")


def to_date(col: Column, fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(col, fmt)


def to_timestamp(col: Column, fmt: str = SECOND_FORMAT) -> Column:
    return F.try_to_timestamp(col, F.lit(fmt))


def day_of(timestamp: Column) -> Column:
    return F.to_date(timestamp)


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def to_numeric(col: Column, precision: int = 5, scale: int = 2) -> Column:
    """Rounded half up to the scale; NULL where it does not fit the precision."""
    return col.try_cast(f"decimal({precision},{scale})")
