"""Queries that build silver tables and the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradin.operators.rows import split_by_status
from gradin.plans import star
from gradin.plans.football import SILVER, STAR
from gradin.plans.silver import build_silver
from gradin.queries.columns import CALENDAR_SQL
from gradin.queries.raw import clean, day, latest, minute, raw_sql, raw_table, second, whole
from gradin.queries.registry import plain_times, register
from gradin.sources.lineage import PROCESSED_AT

PLAYED_SQL = (
    "coalesce(upper(trim(statut, ' ')) IN"
    " ('FINISHED', 'IN_PLAY', 'PAUSED', 'SUSPENDED', 'AWARDED'), FALSE)"
)


def raw_of(spark, sf, name: str):
    """The raw table of a silver table; matches are routed by their status."""
    if name not in ("matchs_joues", "matchs_non_joues"):
        return raw_table(spark, sf, name)
    played, upcoming = split_by_status(raw_table(spark, sf, "matchs"))
    return played if name == "matchs_joues" else upcoming


def silver_of(spark, sf, name: str):
    return build_silver(SILVER[name], raw_of(spark, sf, name))


def silver_tables(spark, sf):
    return {name: silver_of(spark, sf, name) for name in SILVER}


def _silver_sql(
    raw: str, values: dict[str, str], key: list[str], required: str, derived: str = ""
) -> str:
    typed = f"SELECT {', '.join(f'{v} AS {c}' for c, v in values.items())} FROM ({raw}) r"
    known = f"SELECT * FROM ({typed}) k WHERE {required} IS NOT NULL"
    unique = latest(known, list(values), key)
    return f"SELECT *{derived} FROM ({unique}) u"


_MATCH_VALUES = {
    "match_id": whole("match_id", "BIGINT"),
    "competition": clean("competition"),
    "journee": whole("journee"),
    "statut": f"upper({clean('statut')})",
    "date_heure": minute("date_heure"),
    "match_date": f"CAST({minute('date_heure')} AS DATE)",
    "equipe_domicile_id": whole("equipe_domicile_id", "BIGINT"),
    "equipe_domicile": clean("equipe_domicile"),
    "equipe_exterieur_id": whole("equipe_exterieur_id", "BIGINT"),
    "equipe_exterieur": clean("equipe_exterieur"),
    "score_domicile_mi_temps": whole("score_domicile_mi_temps"),
    "score_exterieur_mi_temps": whole("score_exterieur_mi_temps"),
    "score_domicile_final": whole("score_domicile_final"),
    "score_exterieur_final": whole("score_exterieur_final"),
    "stade": clean("stade"),
    "ville": clean("ville"),
    "arbitre": clean("arbitre"),
    "derniere_maj": second("derniere_maj"),
}
_H, _A = "score_domicile_final", "score_exterieur_final"

SILVER_SQL = {
    "equipes": _silver_sql(
        raw_sql("equipes"),
        {
            "equipe_id": whole("team_id", "BIGINT"),
            "nom_equipe": clean("nom"),
            "nom_court": clean("nom_court"),
            "code_tla": f"upper({clean('code_tla')})",
            "pays": clean("pays"),
            "code_pays": f"upper({clean('code_pays')})",
            "logo_url": clean("logo_url"),
            "couleurs_club": clean("couleurs_club"),
            "site_web": clean("site_web"),
            "selectionneur": clean("selectionneur"),
            "nationalite_selectionneur": clean("nationalite_selectionneur"),
            "derniere_maj": second("derniere_maj"),
        },
        ["equipe_id"],
        "equipe_id",
    ),
    "joueurs": _silver_sql(
        raw_sql("joueurs"),
        {
            "joueur_id": whole("joueur_id", "BIGINT"),
            "equipe_id": whole("team_id", "BIGINT"),
            "nom_equipe": clean("equipe"),
            "nom": clean("nom"),
            "prenom": clean("prenom"),
            "nom_complet": clean("nom_complet"),
            "date_naissance": day("date_naissance"),
            "nationalite": clean("nationalite"),
            "position": clean("position"),
            "numero_maillot": whole("numero_maillot"),
            "derniere_maj": second("derniere_maj"),
        },
        ["joueur_id"],
        "joueur_id",
    ),
    "buteurs": _silver_sql(
        raw_sql("buteurs"),
        {
            "joueur_id": whole("joueur_id", "BIGINT"),
            "nom_joueur": clean("nom"),
            "nationalite": clean("nationalite"),
            "position": clean("position"),
            "date_naissance": day("date_naissance"),
            "equipe_id": whole("equipe_id", "BIGINT"),
            "nom_equipe": clean("equipe"),
            "buts": f"coalesce({whole('buts')}, 0)",
            "assists": f"coalesce({whole('assists')}, 0)",
            "matchs_joues": f"coalesce({whole('matchs_joues')}, 0)",
            "penaltys": f"coalesce({whole('penaltys')}, 0)",
            "derniere_maj": second("derniere_maj"),
        },
        ["joueur_id", "equipe_id"],
        "joueur_id",
        ", CASE WHEN matchs_joues > 0 THEN round(CAST(buts AS DOUBLE) / matchs_joues, 2)"
        " ELSE 0.0 END AS buts_par_match",
    ),
    "matchs_joues": _silver_sql(
        f"SELECT * FROM ({raw_sql('matchs')}) s WHERE {PLAYED_SQL}",
        _MATCH_VALUES,
        ["match_id"],
        "match_id",
        f", TRUE AS is_match_joue, {_H} + {_A} AS total_buts,"
        f" CASE WHEN {_H} > {_A} THEN 'HOME_WIN' WHEN {_H} < {_A} THEN 'AWAY_WIN' ELSE 'DRAW' END"
        f" AS resultat_match, CASE WHEN {_H} > {_A} THEN equipe_domicile_id"
        f" WHEN {_H} < {_A} THEN equipe_exterieur_id END AS vainqueur_equipe_id",
    ),
    "matchs_non_joues": _silver_sql(
        f"SELECT * FROM ({raw_sql('matchs')}) s WHERE NOT {PLAYED_SQL}",
        _MATCH_VALUES,
        ["match_id"],
        "match_id",
        ", FALSE AS is_match_joue, CAST(NULL AS INTEGER) AS total_buts,"
        " CAST(NULL AS VARCHAR) AS resultat_match, CAST(NULL AS BIGINT) AS vainqueur_equipe_id",
    ),
    "classement_group_stage": _silver_sql(
        raw_sql("classement_group_stage"),
        {
            "groupe": clean("groupe"),
            "position": whole("position"),
            "equipe_id": whole("equipe_id", "BIGINT"),
            "nom_equipe": clean("equipe"),
            "matchs_joues": whole("matchs_joues"),
            "victoires": whole("victoires"),
            "nuls": whole("nuls"),
            "defaites": whole("defaites"),
            "buts_pour": whole("buts_pour"),
            "buts_contre": whole("buts_contre"),
            "difference_buts": whole("difference_buts"),
            "points": whole("points"),
            "forme": clean("forme"),
            "derniere_maj": second("derniere_maj"),
        },
        ["groupe", "equipe_id"],
        "equipe_id",
    ),
}

_BOTH = (
    f"SELECT * FROM ({SILVER_SQL['matchs_joues']}) p"
    f" UNION ALL SELECT * FROM ({SILVER_SQL['matchs_non_joues']}) q"
)
_DATE_ID = "CAST(strftime(match_date, '%Y%m%d') AS INTEGER)"

# The venue id is Spark's hash, which SQL lacks: it is compared by whether there is one,
# and venues by what they name.
STAR_SQL = {
    "dim_equipe": "SELECT equipe_id, nom_equipe, nom_court, code_tla, pays, code_pays, logo_url,"
    " couleurs_club, site_web, selectionneur, nationalite_selectionneur, derniere_maj"
    f" FROM ({SILVER_SQL['equipes']}) s",
    "dim_joueur": "SELECT joueur_id, equipe_id, nom, prenom, nom_complet, date_naissance,"
    f" nationalite, position, numero_maillot, derniere_maj FROM ({SILVER_SQL['joueurs']}) s",
    "dim_stade": f"SELECT DISTINCT stade AS nom_stade, ville FROM ({_BOTH}) m"
    " WHERE stade IS NOT NULL OR ville IS NOT NULL",
    "dim_date": f"SELECT {_DATE_ID} AS date_id, match_date AS date_complete,"
    f" {CALENDAR_SQL.format(d='match_date')} FROM (SELECT DISTINCT match_date FROM ({_BOTH}) m"
    " WHERE match_date IS NOT NULL) d",
    "fact_match": f"SELECT match_id, {_DATE_ID} AS date_id, equipe_domicile_id,"
    " equipe_exterieur_id, vainqueur_equipe_id, competition, journee, statut,"
    " date_heure, score_domicile_mi_temps, score_exterieur_mi_temps, score_domicile_final,"
    " score_exterieur_final, total_buts, resultat_match, is_match_joue, arbitre, derniere_maj,"
    f" (stade IS NOT NULL OR ville IS NOT NULL) AS has_venue FROM ({_BOTH}) m",
    "fact_buteur": "SELECT joueur_id, equipe_id, buts, assists, matchs_joues, penaltys,"
    f" buts_par_match, derniere_maj FROM ({SILVER_SQL['buteurs']}) s",
    "fact_classement": "SELECT equipe_id, groupe, position, matchs_joues, victoires, nuls,"
    " defaites, buts_pour, buts_contre, difference_buts, points, forme, derniere_maj"
    f" FROM ({SILVER_SQL['classement_group_stage']}) s",
}


def _register_silver(key: str, name: str) -> None:
    @register(key, SILVER_SQL[name])
    def query(spark, sf):
        return plain_times(silver_of(spark, sf, name).drop(PROCESSED_AT))


_register_silver("silver_teams", "equipes")
_register_silver("silver_players", "joueurs")
_register_silver("silver_scorers", "buteurs")
_register_silver("silver_played", "matchs_joues")
_register_silver("silver_upcoming", "matchs_non_joues")
_register_silver("silver_standings", "classement_group_stage")


def _register_projection(key: str, name: str, source: str) -> None:
    @register(key, STAR_SQL[name])
    def query(spark, sf):
        return plain_times(star.projection_of(STAR[name], silver_of(spark, sf, source)))


_register_projection("dim_team", "dim_equipe", "equipes")
_register_projection("dim_player", "dim_joueur", "joueurs")
_register_projection("fact_scorer", "fact_buteur", "buteurs")
_register_projection("fact_standing", "fact_classement", "classement_group_stage")


def _matches(spark, sf):
    return tuple(silver_of(spark, sf, name) for name in ("matchs_joues", "matchs_non_joues"))


@register("dim_calendar", STAR_SQL["dim_date"])
def dim_calendar(spark, sf):
    return star.dim_calendar(*_matches(spark, sf))


@register(
    "dim_venue",
    f"SELECT stade AS nom_stade, ville, count(*) AS matchs FROM ({_BOTH}) m"
    " WHERE stade IS NOT NULL OR ville IS NOT NULL GROUP BY stade, ville",
)
def dim_venue(spark, sf):
    """Venues with the matches whose key leads to them.

    Matches are counted per key before the join: there are few venues and many matches.
    """
    matches = _matches(spark, sf)
    per_key = star.fact_match(*matches).groupBy("stade_id").agg(F.count(F.lit(1)).alias("matchs"))
    return star.dim_venue(*matches).join(per_key, "stade_id").drop("stade_id")


def _without_hash(facts):
    known = F.col("stade_id").isNotNull().alias("has_venue")
    return plain_times(facts.select("*", known).drop("stade_id"))


@register("fact_match", STAR_SQL["fact_match"])
def fact_match(spark, sf):
    return _without_hash(star.fact_match(*_matches(spark, sf)))


@register(
    "fact_match_single",
    f"SELECT * FROM ({STAR_SQL['fact_match']}) f"
    " QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY is_match_joue DESC) = 1",
)
def fact_match_single(spark, sf):
    """One row per match where both match tables have it; the played one stays."""
    return _without_hash(star.fact_match(*_matches(spark, sf), one_per_match=True))
