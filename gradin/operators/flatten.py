"""Flat text tables from nested documents.

Every column of a result is text and a missing value is '', as the landing files hold it.
Documents are exploded where they lie; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradin.functions.calendar import iso_to_minute, updated_at
from gradin.functions.scores import group_label, group_or_stage
from gradin.functions.text import blank_if_missing, first_filled
from gradin.operators.rows import drop_blank

UPDATED = "derniere_maj"

# Landing column -> path below one element of the document's array.
TEAM_PATHS = {
    "team_id": "id",
    "nom": "name",
    "nom_court": "shortName",
    "code_tla": "tla",
    "pays": "area.name",
    "code_pays": "area.code",
    "logo_url": "crest",
    "couleurs_club": "clubColors",
    "site_web": "website",
    "selectionneur": "coach.name",
    "nationalite_selectionneur": "coach.nationality",
}
PLAYER_PATHS = {
    "nom": "lastName",
    "prenom": "firstName",
    "nom_complet": "name",
    "date_naissance": "dateOfBirth",
    "nationalite": "nationality",
    "position": "position",
    "numero_maillot": "shirtNumber",
}
SCORER_PATHS = {
    "joueur_id": "player.id",
    "nom": "player.name",
    "nationalite": "player.nationality",
    "position": "player.position",
    "date_naissance": "player.dateOfBirth",
    "equipe_id": "team.id",
    "equipe": "team.name",
    "buts": "goals",
    "assists": "assists",
    "matchs_joues": "playedMatches",
    "penaltys": "penalties",
}
STANDING_PATHS = {
    "position": "position",
    "equipe_id": "team.id",
    "equipe": "team.name",
    "matchs_joues": "playedGames",
    "victoires": "won",
    "nuls": "draw",
    "defaites": "lost",
    "buts_pour": "goalsFor",
    "buts_contre": "goalsAgainst",
    "difference_buts": "goalDifference",
    "points": "points",
    "forme": "form",
}


def path_or_blank(root: str, path: str) -> Column:
    """The text at a path, '' where any step is missing or null."""
    return blank_if_missing(F.col(f"{root}.{path}"))


def _paths(root: str, paths: dict[str, str]) -> list[Column]:
    return [path_or_blank(root, path).alias(name) for name, path in paths.items()]


def first_name(array: Column) -> Column:
    """The name in the first element, '' if there is none."""
    return blank_if_missing(F.get(array, F.lit(0)).getField("name"))


def flatten_teams(docs: DataFrame) -> DataFrame:
    """One row per team."""
    teams = docs.select(F.explode("teams").alias("t"))
    return teams.select(*_paths("t", TEAM_PATHS), updated_at().alias(UPDATED))


def team_names(teams: DataFrame) -> DataFrame:
    """(team_id, equipe) of the landed teams that have an id."""
    name = first_filled(F.col("nom"), F.col("nom_court"), F.col("team_id"))
    return drop_blank(teams, "team_id").select("team_id", name.alias("equipe"))


def flatten_squads(docs: DataFrame, teams: DataFrame) -> DataFrame:
    """One row per squad member of the landed teams, carrying the team's id and name.

    Teams are joined to whole documents, before the members multiply the rows.
    """
    members = (
        docs.join(team_names(teams), docs["id"] == F.col("team_id"))
        .select("team_id", "equipe", F.explode("squad").alias("p"))
    )
    return members.select(
        path_or_blank("p", "id").alias("joueur_id"),
        "team_id",
        "equipe",
        *_paths("p", PLAYER_PATHS),
        updated_at().alias(UPDATED),
    )


def flatten_scorers(docs: DataFrame) -> DataFrame:
    """One row per scorer."""
    scorers = docs.select(F.explode("scorers").alias("s"))
    return scorers.select(*_paths("s", SCORER_PATHS), updated_at().alias(UPDATED))


def flatten_standings(docs: DataFrame) -> DataFrame:
    """One row per table line of every group; `groupe_brut` keeps the group as delivered."""
    groups = docs.select(F.explode("standings").alias("g")).select(
        group_or_stage(F.col("g.group"), F.col("g.stage")).alias("groupe_brut"),
        F.explode("g.table").alias("e"),
    )
    return groups.select(
        group_label(F.col("groupe_brut")).alias("groupe"),
        *_paths("e", STANDING_PATHS),
        updated_at().alias(UPDATED),
        "groupe_brut",
    )


def flatten_matches(docs: DataFrame) -> DataFrame:
    """One row per match."""
    m = "m"
    columns = {
        "match_id": path_or_blank(m, "id"),
        "competition": path_or_blank(m, "competition.name"),
        "journee": path_or_blank(m, "matchday"),
        "statut": path_or_blank(m, "status"),
        "date_heure": iso_to_minute(path_or_blank(m, "utcDate")),
        "equipe_domicile_id": path_or_blank(m, "homeTeam.id"),
        "equipe_domicile": path_or_blank(m, "homeTeam.name"),
        "equipe_exterieur_id": path_or_blank(m, "awayTeam.id"),
        "equipe_exterieur": path_or_blank(m, "awayTeam.name"),
        "score_domicile_mi_temps": path_or_blank(m, "score.halfTime.home"),
        "score_exterieur_mi_temps": path_or_blank(m, "score.halfTime.away"),
        "score_domicile_final": path_or_blank(m, "score.fullTime.home"),
        "score_exterieur_final": path_or_blank(m, "score.fullTime.away"),
        "stade": path_or_blank(m, "venue"),
        "ville": path_or_blank(m, "area.name"),
        "arbitre": first_name(F.col("m.referees")),
        UPDATED: updated_at(),
    }
    matches = docs.select(F.explode("matches").alias(m))
    return matches.select(*[value.alias(name) for name, value in columns.items()])
