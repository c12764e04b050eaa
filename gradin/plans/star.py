"""Building the star schema from silver tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradin.functions.calendar import calendar_parts, date_key
from gradin.functions.keys import hash_key, venue_key
from gradin.operators.keymap import KeyMap
from gradin.operators.rows import (
    distinct_union,
    latest_per_key,
    require,
    require_any,
    union_aligned,
)
from gradin.plans.football import (
    DIM_EQUIPE,
    DIM_JOUEUR,
    FACT_BUTEUR,
    FACT_CLASSEMENT,
    FACT_MATCH,
    STAR,
)
from gradin.spec import StarTable


def projection_of(table: StarTable, silver: DataFrame) -> DataFrame:
    """The declared columns, which leaves the lineage behind."""
    return silver.select(*table.column_names)


#: The columns that name a venue.
VENUE = ("stade", "ville")


def venue_keys(spark: SparkSession, root: str) -> KeyMap:
    """The kept keys of venues below `root`: numbers without collisions that stay as they are."""
    return KeyMap(spark, root, VENUE, "stade_id")


def dim_venue(*matches: DataFrame, bits: int = 32, keys: KeyMap | None = None) -> DataFrame:
    """Stadium and city pairs of all matches, with a hash as key or the key that is kept for them."""
    pairs = require_any(distinct_union(matches, VENUE), *VENUE)
    if keys is not None:
        return keys.keyed(pairs).select("stade_id", F.col("stade").alias("nom_stade"), "ville")
    return pairs.select(
        hash_key(F.col("stade"), F.col("ville"), bits=bits).alias("stade_id"),
        F.col("stade").alias("nom_stade"),
        "ville",
    )


def dim_calendar(*matches: DataFrame) -> DataFrame:
    """The days on which there are matches, in order."""
    days = require(distinct_union(matches, ["match_date"]), "match_date")
    day = F.col("match_date")
    return days.select(
        date_key(day).alias("date_id"),
        day.alias("date_complete"),
        *[part.alias(name) for name, part in calendar_parts(day).items()],
    ).orderBy("date_id")


_COMPUTED = ("date_id", "stade_id")
_MATCH_INPUT = [
    *[c for c in FACT_MATCH.column_names if c not in _COMPUTED],
    "match_date",
    "stade",
    "ville",
]


def fact_match(
    *matches: DataFrame, one_per_match: bool = False, bits: int = 32, keys: KeyMap | None = None
) -> DataFrame:
    """All matches with keys to the calendar, the teams and the venues.

    A venue's key is computed from its names; with `keys` it is the one that is kept for them, which
    is looked up in the map. The frames may share a match, which the primary key check reports; with
    `one_per_match` the played one stays.
    """
    rows = union_aligned(matches, _MATCH_INPUT)
    if one_per_match:
        rows = latest_per_key(rows, ["match_id"], ["is_match_joue", "derniere_maj"])
    computed = {
        "date_id": date_key(F.col("match_date")),
        "stade_id": venue_key(F.col("stade"), F.col("ville"), bits=bits),
    }
    if keys is not None:
        rows, computed["stade_id"] = keys.keyed(rows), F.col("stade_id")
    return rows.select(
        *[computed[c].alias(c) if c in computed else F.col(c) for c in FACT_MATCH.column_names]
    )


def star_tables(bits: int = 32) -> dict[str, StarTable]:
    """The declared tables; with 64 bits the venue key is a bigint wherever it stands."""
    if bits == 32:
        return STAR
    return {
        name: replace(t, columns=tuple((c, "bigint" if c == "stade_id" else k) for c, k in t.columns))
        for name, t in STAR.items()
    }


def build_star(
    silver: dict[str, DataFrame], bits: int = 32, one_per_match: bool = False, keys: KeyMap | None = None
) -> dict[str, DataFrame]:
    """All dimensions and facts, in loading order; nothing runs yet but the keys of new venues,
    where these are kept."""
    matches = (silver["matchs_joues"], silver["matchs_non_joues"])
    if keys is not None:
        keys.assign(distinct_union(matches, VENUE))
    built = {
        "dim_equipe": projection_of(DIM_EQUIPE, silver["equipes"]),
        "dim_joueur": projection_of(DIM_JOUEUR, silver["joueurs"]),
        "dim_stade": dim_venue(*matches, bits=bits, keys=keys),
        "dim_date": dim_calendar(*matches),
        "fact_match": fact_match(*matches, one_per_match=one_per_match, bits=bits, keys=keys),
        "fact_buteur": projection_of(FACT_BUTEUR, silver["buteurs"]),
        "fact_classement": projection_of(FACT_CLASSEMENT, silver["classement_group_stage"]),
    }
    return {name: built[name] for name in STAR}
