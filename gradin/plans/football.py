"""Declarations of the silver tables and the star schema of a football tournament.

The names, types, keys, limits and defaults in this module are fixed values: they are
the data model that landing files and the warehouse share.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gradin.functions import scores, typing
from gradin.operators.rules import in_range, non_negative, one_of
from gradin.spec import Field, ForeignKey, SilverTable, StarTable

# ---- landing -------------------------------------------------------------------------

# Files or folders of files. The wildcard takes a match table as a file of that name or as
# the folder that routing matches by status makes; standings are all files of all groups.
LANDING_FILES = {
    "equipes": "equipes.csv",
    "joueurs": "joueurs.csv",
    "buteurs": "buteurs.csv",
    "matchs_joues": "matchs/*matchs_joues*",
    "matchs_non_joues": "matchs/*matchs_non_joues*",
    "classement_group_stage": "classements",
}

_MATCH_COLUMNS = (
    "match_id", "competition", "journee", "statut", "date_heure",
    "equipe_domicile_id", "equipe_domicile", "equipe_exterieur_id", "equipe_exterieur",
    "score_domicile_mi_temps", "score_exterieur_mi_temps",
    "score_domicile_final", "score_exterieur_final",
    "stade", "ville", "arbitre", "derniere_maj",
)

LANDING_COLUMNS = {
    "equipes": (
        "team_id", "nom", "nom_court", "code_tla", "pays", "code_pays", "logo_url",
        "couleurs_club", "site_web", "selectionneur", "nationalite_selectionneur",
        "derniere_maj",
    ),
    "joueurs": (
        "joueur_id", "team_id", "equipe", "nom", "prenom", "nom_complet",
        "date_naissance", "nationalite", "position", "numero_maillot", "derniere_maj",
    ),
    "buteurs": (
        "joueur_id", "nom", "nationalite", "position", "date_naissance", "equipe_id",
        "equipe", "buts", "assists", "matchs_joues", "penaltys", "derniere_maj",
    ),
    "matchs_joues": _MATCH_COLUMNS,
    "matchs_non_joues": _MATCH_COLUMNS,
    "classement_group_stage": (
        "groupe", "position", "equipe_id", "equipe", "matchs_joues", "victoires", "nuls",
        "defaites", "buts_pour", "buts_contre", "difference_buts", "points", "forme",
        "derniere_maj",
    ),
}

# ---- silver --------------------------------------------------------------------------


def _fields(*rows: tuple[str, ...]) -> tuple[Field, ...]:
    return tuple(Field(*row) for row in rows)


EQUIPES = SilverTable(
    "equipes",
    _fields(
        ("equipe_id", "long", "team_id"),
        ("nom_equipe", "text", "nom"),
        ("nom_court", "text"),
        ("code_tla", "upper"),
        ("pays", "text"),
        ("code_pays", "upper"),
        ("logo_url", "text"),
        ("couleurs_club", "text"),
        ("site_web", "text"),
        ("selectionneur", "text"),
        ("nationalite_selectionneur", "text"),
        ("derniere_maj", "second"),
    ),
    required=("equipe_id",),
    unique_on=("equipe_id",),
    latest_by=("derniere_maj",),
)

JOUEURS = SilverTable(
    "joueurs",
    _fields(
        ("joueur_id", "long"),
        ("equipe_id", "long", "team_id"),
        ("nom_equipe", "text", "equipe"),
        ("nom", "text"),
        ("prenom", "text"),
        ("nom_complet", "text"),
        ("date_naissance", "date"),
        ("nationalite", "text"),
        ("position", "text"),
        ("numero_maillot", "int"),
        ("derniere_maj", "second"),
    ),
    required=("joueur_id",),
    unique_on=("joueur_id",),
    latest_by=("derniere_maj",),
)

BUTEURS = SilverTable(
    "buteurs",
    _fields(
        ("joueur_id", "long"),
        ("nom_joueur", "text", "nom"),
        ("nationalite", "text"),
        ("position", "text"),
        ("date_naissance", "date"),
        ("equipe_id", "long"),
        ("nom_equipe", "text", "equipe"),
        ("buts", "measure"),
        ("assists", "measure"),
        ("matchs_joues", "measure"),
        ("penaltys", "measure"),
        ("derniere_maj", "second"),
    ),
    required=("joueur_id",),
    unique_on=("joueur_id", "equipe_id"),
    latest_by=("derniere_maj",),
    derived=(
        ("buts_par_match", lambda: scores.safe_ratio(F.col("buts"), F.col("matchs_joues"))),
    ),
)

_MATCH_FIELDS = _fields(
    ("match_id", "long"),
    ("competition", "text"),
    ("journee", "int"),
    ("statut", "upper"),
    ("date_heure", "minute"),
    ("match_date", "minute_day", "date_heure"),
    ("equipe_domicile_id", "long"),
    ("equipe_domicile", "text"),
    ("equipe_exterieur_id", "long"),
    ("equipe_exterieur", "text"),
    ("score_domicile_mi_temps", "int"),
    ("score_exterieur_mi_temps", "int"),
    ("score_domicile_final", "int"),
    ("score_exterieur_final", "int"),
    ("stade", "text"),
    ("ville", "text"),
    ("arbitre", "text"),
    ("derniere_maj", "second"),
)

_FINAL = ("score_domicile_final", "score_exterieur_final")
_SIDES = ("equipe_domicile_id", "equipe_exterieur_id")

MATCHS_JOUES = SilverTable(
    "matchs_joues",
    _MATCH_FIELDS,
    required=("match_id",),
    unique_on=("match_id",),
    latest_by=("derniere_maj",),
    derived=(
        ("is_match_joue", lambda: F.lit(True)),
        ("total_buts", lambda: scores.total(*map(F.col, _FINAL))),
        ("resultat_match", lambda: scores.outcome(*map(F.col, _FINAL))),
        ("vainqueur_equipe_id", lambda: scores.winner(*map(F.col, _FINAL + _SIDES))),
    ),
)

MATCHS_NON_JOUES = SilverTable(
    "matchs_non_joues",
    _MATCH_FIELDS,
    required=("match_id",),
    unique_on=("match_id",),
    latest_by=("derniere_maj",),
    derived=(
        ("is_match_joue", lambda: F.lit(False)),
        ("total_buts", lambda: typing.typed_null("int")),
        ("resultat_match", lambda: typing.typed_null("string")),
        ("vainqueur_equipe_id", lambda: typing.typed_null("bigint")),
    ),
)

CLASSEMENT = SilverTable(
    "classement_group_stage",
    _fields(
        ("groupe", "text"),
        ("position", "int"),
        ("equipe_id", "long"),
        ("nom_equipe", "text", "equipe"),
        ("matchs_joues", "int"),
        ("victoires", "int"),
        ("nuls", "int"),
        ("defaites", "int"),
        ("buts_pour", "int"),
        ("buts_contre", "int"),
        ("difference_buts", "int"),
        ("points", "int"),
        ("forme", "text"),
        ("derniere_maj", "second"),
    ),
    required=("equipe_id",),
    unique_on=("groupe", "equipe_id"),
    latest_by=("derniere_maj",),
)

SILVER = {
    t.name: t
    for t in (EQUIPES, JOUEURS, BUTEURS, MATCHS_JOUES, MATCHS_NON_JOUES, CLASSEMENT)
}

# ---- star schema ---------------------------------------------------------------------

DIM_EQUIPE = StarTable(
    "dim_equipe",
    (
        ("equipe_id", "bigint"),
        ("nom_equipe", "varchar(100)"),
        ("nom_court", "varchar(50)"),
        ("code_tla", "varchar(3)"),
        ("pays", "varchar(100)"),
        ("code_pays", "varchar(10)"),
        ("logo_url", "string"),
        ("couleurs_club", "varchar(100)"),
        ("site_web", "varchar(200)"),
        ("selectionneur", "varchar(100)"),
        ("nationalite_selectionneur", "varchar(100)"),
        ("derniere_maj", "timestamp"),
    ),
    primary_key=("equipe_id",),
)

DIM_JOUEUR = StarTable(
    "dim_joueur",
    (
        ("joueur_id", "bigint"),
        ("equipe_id", "bigint"),
        ("nom", "varchar(100)"),
        ("prenom", "varchar(100)"),
        ("nom_complet", "varchar(200)"),
        ("date_naissance", "date"),
        ("nationalite", "varchar(100)"),
        ("position", "varchar(50)"),
        ("numero_maillot", "int"),
        ("derniere_maj", "timestamp"),
    ),
    primary_key=("joueur_id",),
    foreign_keys=(ForeignKey("equipe_id", "dim_equipe", "equipe_id", "set null"),),
)

DIM_STADE = StarTable(
    "dim_stade",
    (
        ("stade_id", "int"),
        ("nom_stade", "varchar(200)"),
        ("ville", "varchar(100)"),
    ),
    primary_key=("stade_id",),
)

DIM_DATE = StarTable(
    "dim_date",
    (
        ("date_id", "int"),
        ("date_complete", "date"),
        ("jour", "int"),
        ("mois", "int"),
        ("nom_mois", "varchar(20)"),
        ("annee", "int"),
        ("num_jour_semaine", "int"),
        ("nom_jour_semaine", "varchar(20)"),
        ("semaine_annee", "int"),
    ),
    primary_key=("date_id",),
    rules=(
        in_range("mois", 1, 12),
        in_range("jour", 1, 31),
        in_range("num_jour_semaine", 1, 7),
    ),
)

FACT_MATCH = StarTable(
    "fact_match",
    (
        ("match_id", "bigint"),
        ("date_id", "int"),
        ("equipe_domicile_id", "bigint"),
        ("equipe_exterieur_id", "bigint"),
        ("vainqueur_equipe_id", "bigint"),
        ("stade_id", "int"),
        ("competition", "varchar(100)"),
        ("journee", "int"),
        ("statut", "varchar(50)"),
        ("date_heure", "timestamp"),
        ("score_domicile_mi_temps", "int"),
        ("score_exterieur_mi_temps", "int"),
        ("score_domicile_final", "int"),
        ("score_exterieur_final", "int"),
        ("total_buts", "int"),
        ("resultat_match", "varchar(10)"),
        ("is_match_joue", "boolean"),
        ("arbitre", "varchar(100)"),
        ("derniere_maj", "timestamp"),
    ),
    primary_key=("match_id",),
    foreign_keys=(
        ForeignKey("date_id", "dim_date", "date_id", "set null"),
        ForeignKey("equipe_domicile_id", "dim_equipe", "equipe_id", "set null"),
        ForeignKey("equipe_exterieur_id", "dim_equipe", "equipe_id", "set null"),
        ForeignKey("vainqueur_equipe_id", "dim_equipe", "equipe_id", "set null"),
        ForeignKey("stade_id", "dim_stade", "stade_id", "set null"),
    ),
    rules=(one_of("resultat_match", (scores.HOME_WIN, scores.AWAY_WIN, scores.DRAW)),),
)

FACT_BUTEUR = StarTable(
    "fact_buteur",
    (
        ("joueur_id", "bigint"),
        ("equipe_id", "bigint"),
        ("buts", "int"),
        ("assists", "int"),
        ("matchs_joues", "int"),
        ("penaltys", "int"),
        ("buts_par_match", "decimal(5,2)"),
        ("derniere_maj", "timestamp"),
    ),
    primary_key=("joueur_id", "equipe_id"),
    foreign_keys=(
        ForeignKey("joueur_id", "dim_joueur", "joueur_id", "cascade"),
        ForeignKey("equipe_id", "dim_equipe", "equipe_id", "cascade"),
    ),
    rules=(non_negative("buts"), non_negative("assists"), non_negative("penaltys")),
    defaults=(
        ("buts", 0),
        ("assists", 0),
        ("matchs_joues", 0),
        ("penaltys", 0),
        ("buts_par_match", 0.0),
    ),
)

FACT_CLASSEMENT = StarTable(
    "fact_classement",
    (
        ("equipe_id", "bigint"),
        ("groupe", "varchar(50)"),
        ("position", "int"),
        ("matchs_joues", "int"),
        ("victoires", "int"),
        ("nuls", "int"),
        ("defaites", "int"),
        ("buts_pour", "int"),
        ("buts_contre", "int"),
        ("difference_buts", "int"),
        ("points", "int"),
        ("forme", "varchar(20)"),
        ("derniere_maj", "timestamp"),
    ),
    primary_key=("equipe_id", "groupe"),
    foreign_keys=(ForeignKey("equipe_id", "dim_equipe", "equipe_id", "cascade"),),
    rules=(non_negative("points"), non_negative("matchs_joues")),
    defaults=(
        ("matchs_joues", 0),
        ("victoires", 0),
        ("nuls", 0),
        ("defaites", 0),
        ("buts_pour", 0),
        ("buts_contre", 0),
        ("difference_buts", 0),
        ("points", 0),
    ),
)

# Tables others refer to come first: the order of loading.
STAR = {
    t.name: t
    for t in (
        DIM_EQUIPE,
        DIM_JOUEUR,
        DIM_STADE,
        DIM_DATE,
        FACT_MATCH,
        FACT_BUTEUR,
        FACT_CLASSEMENT,
    )
}
