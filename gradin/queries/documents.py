"""Queries that flatten nested JSON.

The documents are JSON texts made from the given tables, one per row and each with a
small fixed number of elements, so that making them shuffles nothing either.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gradin.operators import flatten
from gradin.queries.registry import register, table
from gradin.sources import documents


def _documents(spark, sf, source: str, expression: str, schema: str):
    """JSON texts from an expression over a table's rows, parsed by the given schema."""
    texts = table(spark, sf, source).selectExpr(f"to_json({expression}) AS json")
    return documents.parse_documents(texts, F.col("json"), schema)


# ---- teams ---------------------------------------------------------------------------

_TEAM_DOC = """
named_struct('teams', array(
  named_struct('id', c_custkey, 'name', c_name, 'shortName', IF(c_custkey % 2 = 0, '', c_mktsegment),
    'tla', 'TLA', 'area', named_struct('name', c_mktsegment, 'code', CAST(c_nationkey AS STRING)),
    'crest', 'http://example.org/c', 'clubColors', 'Red', 'website', CAST(NULL AS STRING),
    'coach', named_struct('name', concat('Coach ', c_nationkey), 'nationality', c_mktsegment)),
  named_struct('id', c_custkey + 1000000, 'name', CAST(NULL AS STRING), 'shortName', 'B',
    'tla', 'TLB', 'area', IF(c_custkey % 3 = 0, NULL,
      named_struct('name', c_mktsegment, 'code', CAST(NULL AS STRING))),
    'crest', 'http://example.org/d', 'clubColors', 'Blue', 'website', 'http://example.org',
    'coach', CAST(NULL AS STRUCT<name: STRING, nationality: STRING>))))
"""


def _teams(spark, sf):
    docs = _documents(spark, sf, "customer", _TEAM_DOC, documents.TEAMS)
    return flatten.flatten_teams(docs)


_TEAMS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS team_id, c_name AS nom,
  CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END AS nom_court, 'TLA' AS code_tla,
  c_mktsegment AS pays, CAST(c_nationkey AS VARCHAR) AS code_pays,
  'http://example.org/c' AS logo_url, 'Red' AS couleurs_club, '' AS site_web,
  'Coach ' || c_nationkey AS selectionneur, c_mktsegment AS nationalite_selectionneur
FROM customer
UNION ALL
SELECT CAST(c_custkey + 1000000 AS VARCHAR), '', 'B', 'TLB',
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END, '', 'http://example.org/d', 'Blue',
  'http://example.org', '', '' FROM customer
"""


@register("flatten_teams", _TEAMS_SQL)
def flatten_teams(spark, sf):
    return _teams(spark, sf).drop(flatten.UPDATED)


@register(
    "safe_path_get",
    "SELECT team_id, nationalite_selectionneur, pays, code_pays, site_web"
    f" FROM ({_TEAMS_SQL}) t",
)
def safe_path_get(spark, sf):
    docs = _documents(spark, sf, "customer", _TEAM_DOC, documents.TEAMS)
    paths = {
        "team_id": "id",
        "nationalite_selectionneur": "coach.nationality",
        "pays": "area.name",
        "code_pays": "area.code",
        "site_web": "website",
    }
    return docs.select(F.explode("teams").alias("t")).select(
        *[flatten.path_or_blank("t", path).alias(name) for name, path in paths.items()]
    )


# ---- squads --------------------------------------------------------------------------

_SQUAD_DOC = """
named_struct('id', o_custkey, 'squad', IF(o_orderstatus = 'P', NULL, array(
  named_struct('id', o_orderkey * 2, 'firstName', o_orderstatus, 'lastName', o_orderpriority,
    'name', concat(o_orderstatus, ' ', o_orderpriority),
    'dateOfBirth', substr(CAST(o_orderdate AS STRING), 1, 10), 'nationality', o_orderpriority,
    'position', 'Goalkeeper', 'shirtNumber', o_orderkey % 23),
  named_struct('id', o_orderkey * 2 + 1, 'firstName', CAST(NULL AS STRING), 'lastName', 'Second',
    'name', 'Second', 'dateOfBirth', CAST(NULL AS STRING), 'nationality', o_orderpriority,
    'position', CAST(NULL AS STRING), 'shirtNumber', CAST(NULL AS BIGINT)))))
"""


@register(
    "flatten_squads",
    f"""
WITH teams AS (
  SELECT team_id, coalesce(nullif(nom, ''), nullif(nom_court, ''), team_id) AS equipe
  FROM ({_TEAMS_SQL}) t WHERE team_id <> ''),
docs AS (
  SELECT o.*, t.team_id, t.equipe FROM orders o
  JOIN teams t ON t.team_id = CAST(o_custkey AS VARCHAR) WHERE o_orderstatus <> 'P')
SELECT CAST(o_orderkey * 2 AS VARCHAR) AS joueur_id, team_id, equipe, o_orderpriority AS nom,
  o_orderstatus AS prenom, o_orderstatus || ' ' || o_orderpriority AS nom_complet,
  strftime(o_orderdate, '%Y-%m-%d') AS date_naissance, o_orderpriority AS nationalite,
  'Goalkeeper' AS position, CAST(o_orderkey % 23 AS VARCHAR) AS numero_maillot FROM docs
UNION ALL
SELECT CAST(o_orderkey * 2 + 1 AS VARCHAR), team_id, equipe, 'Second', '', 'Second', '',
  o_orderpriority, '', '' FROM docs
""",
)
def flatten_squads(spark, sf):
    docs = _documents(spark, sf, "orders", _SQUAD_DOC, documents.SQUAD)
    return flatten.flatten_squads(docs, _teams(spark, sf)).drop(flatten.UPDATED)


# ---- scorers -------------------------------------------------------------------------

_SCORER_DOC = """
named_struct('scorers', array(named_struct(
  'player', named_struct('id', l_partkey, 'name', concat('P', l_partkey),
    'nationality', l_returnflag, 'dateOfBirth', substr(CAST(l_shipdate AS STRING), 1, 10)),
  'team', IF(l_orderkey % 5 = 0, NULL, named_struct('id', l_suppkey, 'name', l_linestatus)),
  'goals', CAST(l_quantity AS INT), 'assists', IF(l_linenumber = 1, NULL, l_linenumber),
  'playedMatches', l_linenumber, 'penalties', CAST(NULL AS INT))))
"""


@register(
    "flatten_scorers",
    """
SELECT CAST(l_partkey AS VARCHAR) AS joueur_id, 'P' || l_partkey AS nom,
  l_returnflag AS nationalite, '' AS position, strftime(l_shipdate, '%Y-%m-%d') AS date_naissance,
  CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS equipe_id,
  CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE l_linestatus END AS equipe,
  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS buts,
  CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS assists,
  CAST(l_linenumber AS VARCHAR) AS matchs_joues, '' AS penaltys
FROM lineitem
""",
)
def flatten_scorers(spark, sf):
    docs = _documents(spark, sf, "lineitem", _SCORER_DOC, documents.SCORERS)
    return flatten.flatten_scorers(docs).drop(flatten.UPDATED)


# ---- standings -----------------------------------------------------------------------

_LINE = """
named_struct('position', {n}, 'team', named_struct('id', o_custkey + {n}, 'name', o_orderstatus),
  'playedGames', 3, 'won', {n}, 'draw', 0, 'lost', 3 - {n}, 'goalsFor', o_orderkey % 9,
  'goalsAgainst', o_orderkey % 7, 'goalDifference', o_orderkey % 9 - o_orderkey % 7,
  'points', 3 * {n}, 'form', CAST(NULL AS STRING))
"""
_STANDING_DOC = f"""
named_struct('standings', array(
  named_struct('group', concat('GROUP_', chr(CAST(65 + o_custkey % 14 AS INT))),
    'stage', 'GROUP_STAGE', 'table', array({_LINE.format(n=1)}, {_LINE.format(n=2)})),
  named_struct('group', IF(o_orderkey % 2 = 0, '', NULL), 'stage', IF(o_orderkey % 3 = 0, NULL, 'LAST_16'),
    'table', IF(o_orderpriority = '5-LOW', NULL, array({_LINE.format(n=3)})))))
"""
_STANDING_LINE_SQL = """
SELECT {groupe} AS groupe, '{n}' AS position, CAST(o_custkey + {n} AS VARCHAR) AS equipe_id,
  o_orderstatus AS equipe, '3' AS matchs_joues, '{n}' AS victoires, '0' AS nuls,
  CAST(3 - {n} AS VARCHAR) AS defaites, CAST(o_orderkey % 9 AS VARCHAR) AS buts_pour,
  CAST(o_orderkey % 7 AS VARCHAR) AS buts_contre,
  CAST(o_orderkey % 9 - o_orderkey % 7 AS VARCHAR) AS difference_buts,
  CAST(3 * {n} AS VARCHAR) AS points, '' AS forme FROM orders
"""
_KNOWN_GROUP = (
    "CASE WHEN o_custkey % 14 < 12 THEN 'Groupe ' ELSE 'GROUP_' END"
    " || chr(CAST(65 + o_custkey % 14 AS INT))"
)
_NO_GROUP = "CASE WHEN o_orderkey % 3 = 0 THEN 'INCONNU' ELSE 'LAST_16' END"


@register(
    "flatten_standings",
    " UNION ALL ".join(
        [
            _STANDING_LINE_SQL.format(groupe=_KNOWN_GROUP, n=1),
            _STANDING_LINE_SQL.format(groupe=_KNOWN_GROUP, n=2),
            _STANDING_LINE_SQL.format(groupe=_NO_GROUP, n=3) + " WHERE o_orderpriority <> '5-LOW'",
        ]
    ),
)
def flatten_standings(spark, sf):
    docs = _documents(spark, sf, "orders", _STANDING_DOC, documents.STANDINGS)
    return flatten.flatten_standings(docs).drop(flatten.UPDATED, "groupe_brut")


# ---- matches -------------------------------------------------------------------------

_MATCH_DOC = """
named_struct('matches', array(named_struct(
  'id', o_orderkey, 'competition', named_struct('name', 'Cup'),
  'matchday', IF(o_orderkey % 8 = 0, NULL, o_orderkey % 8), 'status', o_orderstatus,
  'utcDate', IF(o_orderkey % 9 = 0, 'TBD', concat(replace(CAST(o_orderdate AS STRING), ' ', 'T'), 'Z')),
  'homeTeam', named_struct('id', o_custkey, 'name', concat('T', o_custkey)),
  'awayTeam', IF(o_orderkey % 7 = 0, NULL, named_struct('id', o_custkey + 1, 'name', 'Away')),
  'score', IF(o_orderstatus = 'O', NULL, named_struct(
    'halfTime', named_struct('home', 0, 'away', 1),
    'fullTime', named_struct('home', o_orderkey % 5, 'away', o_orderkey % 4))),
  'venue', IF(o_orderkey % 4 = 0, NULL, o_orderpriority),
  'area', named_struct('name', 'World'),
  'referees', CASE o_orderkey % 3 WHEN 0 THEN array(named_struct('name', 'First'),
    named_struct('name', 'Second')) WHEN 1 THEN array() END)))
"""


def _match_documents(spark, sf):
    return _documents(spark, sf, "orders", _MATCH_DOC, documents.MATCHES)


@register(
    "flatten_matches",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS match_id, 'Cup' AS competition,
  CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE CAST(o_orderkey % 8 AS VARCHAR) END AS journee,
  o_orderstatus AS statut,
  CASE WHEN o_orderkey % 9 = 0 THEN 'TBD' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS date_heure,
  CAST(o_custkey AS VARCHAR) AS equipe_domicile_id, 'T' || o_custkey AS equipe_domicile,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_custkey + 1 AS VARCHAR) END AS equipe_exterieur_id,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'Away' END AS equipe_exterieur,
  CASE WHEN o_orderstatus = 'O' THEN '' ELSE '0' END AS score_domicile_mi_temps,
  CASE WHEN o_orderstatus = 'O' THEN '' ELSE '1' END AS score_exterieur_mi_temps,
  CASE WHEN o_orderstatus = 'O' THEN '' ELSE CAST(o_orderkey % 5 AS VARCHAR) END AS score_domicile_final,
  CASE WHEN o_orderstatus = 'O' THEN '' ELSE CAST(o_orderkey % 4 AS VARCHAR) END AS score_exterieur_final,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END AS stade, 'World' AS ville,
  CASE WHEN o_orderkey % 3 = 0 THEN 'First' ELSE '' END AS arbitre
FROM orders
""",
)
def flatten_matches(spark, sf):
    return flatten.flatten_matches(_match_documents(spark, sf)).drop(flatten.UPDATED)


@register(
    "first_array_element",
    "SELECT CAST(o_orderkey AS VARCHAR) AS match_id,"
    " CASE WHEN o_orderkey % 3 = 0 THEN 'First' ELSE '' END AS arbitre FROM orders",
)
def first_array_element(spark, sf):
    matches = _match_documents(spark, sf).select(F.explode("matches").alias("m"))
    return matches.select(
        F.col("m.id").alias("match_id"), flatten.first_name(F.col("m.referees")).alias("arbitre")
    )
