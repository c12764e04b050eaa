"""Business columns of matches, scorers and groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradin.functions.text import trimmed

# Fixed values.
HOME_WIN, AWAY_WIN, DRAW = "HOME_WIN", "AWAY_WIN", "DRAW"
PLAYED_STATUSES = ("FINISHED", "IN_PLAY", "PAUSED", "SUSPENDED", "AWARDED")
GROUP_LETTERS = "ABCDEFGHIJKL"
UNKNOWN_GROUP = "INCONNU"


def total(a: Column, b: Column) -> Column:
    """a + b, NULL if either is NULL or the sum does not fit."""
    return F.try_add(a, b)


def outcome(home: Column, away: Column, unknown: str | None = DRAW) -> Column:
    """HOME_WIN, AWAY_WIN or DRAW; `unknown` is the label when a score is NULL."""
    return (
        F.when(home > away, F.lit(HOME_WIN))
        .when(home < away, F.lit(AWAY_WIN))
        .when(home == away, F.lit(DRAW))
        .otherwise(F.lit(unknown))
    )


def winner(home: Column, away: Column, home_key: Column, away_key: Column) -> Column:
    """The key of the side with more; NULL on a tie or a missing score."""
    return F.when(home > away, home_key).when(away > home, away_key)


def safe_ratio(part: Column, whole: Column, scale: int = 2) -> Column:
    """part / whole rounded half up; 0.0 unless whole is positive."""
    return F.when(whole > 0, F.round(part / whole, scale)).otherwise(F.lit(0.0))


def is_played(status: Column) -> Column:
    """Whether the status says the match has begun; a missing status says no."""
    return F.coalesce(F.upper(trimmed(status)).isin(*PLAYED_STATUSES), F.lit(False))


def _group_letter(raw: Column) -> Column:
    # Empty unless the raw text is a known group, in any case, blank or underscore.
    return F.regexp_extract(F.upper(raw), rf"^GROUP[ _]([{GROUP_LETTERS}])\z", 1)


def group_label(raw: Column) -> Column:
    """'GROUP_A' or 'group a' -> 'Groupe A'; anything else unchanged."""
    letter = _group_letter(raw)
    return F.when(letter != "", F.concat(F.lit("Groupe "), letter)).otherwise(raw)


def group_slug(raw: Column) -> Column:
    """'GROUP_A' -> 'groupe_a'; anything else lower-cased with underscores for blanks."""
    letter = _group_letter(raw)
    return F.when(letter != "", F.concat(F.lit("groupe_"), F.lower(letter))).otherwise(
        F.replace(F.lower(raw), F.lit(" "), F.lit("_"))
    )


def group_or_stage(group: Column, stage: Column) -> Column:
    return F.coalesce(F.nullif(group, F.lit("")), stage, F.lit(UNKNOWN_GROUP))
