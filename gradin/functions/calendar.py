"""Calendar keys and parts, and the texts of points in time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradin.functions.typing import SECOND_FORMAT

# An ISO date, optionally with a time of day and an offset.
_ISO = (
    r"^(\d{4}-\d{2}-\d{2})"
    r"(?:[T ](\d{2}:\d{2})(:\d{2}(?:\.\d{3}(?:\d{3})?)?)?(?:Z|[+-]\d{2}:\d{2})?)?\z"
)


def date_key(day: Column) -> Column:
    """2026-06-11 -> 20260611."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_parts(day: Column) -> dict[str, Column]:
    """Columns of the calendar dimension. Weeks are ISO weeks; day 1 of a week is Sunday."""
    return {
        "jour": F.dayofmonth(day),
        "mois": F.month(day),
        "nom_mois": F.date_format(day, "MMMM"),
        "annee": F.year(day),
        "num_jour_semaine": F.dayofweek(day),
        "nom_jour_semaine": F.date_format(day, "EEEE"),
        "semaine_annee": F.weekofyear(day),
    }


def iso_to_minute(col: Column) -> Column:
    """'2026-06-11T19:00:00Z' -> '2026-06-11 19:00'; what is not an ISO time stays as it is.

    The offset is dropped without conversion: the wall-clock time of the text is kept.
    """
    day = F.regexp_extract(col, _ISO, 1)
    minute = F.nullif(F.regexp_extract(col, _ISO, 2), F.lit(""))
    second = F.regexp_extract(col, _ISO, 3)
    text = F.concat(day, F.lit(" "), F.coalesce(minute, F.lit("00:00")))
    exists = F.concat(text, second).try_cast("timestamp_ntz").isNotNull()
    return F.when(exists, text).otherwise(col)


def updated_at() -> Column:
    """The time of the run as text, to the second."""
    return F.date_format(F.current_timestamp(), SECOND_FORMAT)
