"""Queries that read the star, and queries over batches that are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradin.operators import reads
from gradin.operators.keymap import KeyMap
from gradin.plans import layers, star
from gradin.queries.files import land_all
from gradin.queries.raw import raw_sql, raw_table
from gradin.queries.registry import plain_times, register, table
from gradin.queries.tables import _BOTH, _DATE_ID, STAR_SQL, silver_of
from gradin.session import scratch_path
from gradin.sources import ledger, snapshot, store


def _star(spark, sf, *names: str) -> dict[str, DataFrame]:
    matches = tuple(silver_of(spark, sf, n) for n in ("matchs_joues", "matchs_non_joues"))
    build = {
        "fact_match": lambda: star.fact_match(*matches),
        "dim_stade": lambda: star.dim_venue(*matches),
        "dim_date": lambda: star.dim_calendar(*matches),
        "dim_equipe": lambda: star.projection_of(star.DIM_EQUIPE, silver_of(spark, sf, "equipes")),
        "dim_joueur": lambda: star.projection_of(star.DIM_JOUEUR, silver_of(spark, sf, "joueurs")),
        "fact_buteur": lambda: star.projection_of(star.FACT_BUTEUR, silver_of(spark, sf, "buteurs")),
        "fact_classement": lambda: star.projection_of(star.FACT_CLASSEMENT, silver_of(spark, sf, "classement_group_stage")),
    }
    return {name: build[name]() for name in names}


_MATCH_READ = f"""
    WITH teams AS ({STAR_SQL['dim_equipe']})
    SELECT m.match_id, h.nom_equipe AS domicile, h.pays AS pays_domicile, a.nom_equipe AS exterieur,
        a.pays AS pays_exterieur, w.nom_equipe AS vainqueur, m.stade AS nom_stade, m.ville AS ville,
        m.match_date AS jour_match, CAST(month(m.match_date) AS INTEGER) AS mois,
        CAST(year(m.match_date) AS INTEGER) AS annee, m.resultat_match
    FROM ({_BOTH}) m LEFT JOIN teams h ON h.equipe_id = m.equipe_domicile_id
    LEFT JOIN teams a ON a.equipe_id = m.equipe_exterieur_id LEFT JOIN teams w ON w.equipe_id = m.vainqueur_equipe_id
"""
_READ_COLUMNS = (
    "match_id domicile pays_domicile exterieur pays_exterieur vainqueur nom_stade ville jour_match mois annee"
    " resultat_match"
).split()


def _match_read(spark, sf, where=None, large=False):
    parts = _star(spark, sf, "fact_match", "dim_equipe", "dim_stade", "dim_date")
    roles = reads.match_roles(parts["dim_equipe"], parts["dim_stade"], parts["dim_date"], where)
    return reads.star_read(parts["fact_match"], roles, large).select(*_READ_COLUMNS)


@register("match_star_read", _MATCH_READ)
def match_star_read(spark, sf):
    """Matches with both teams, the winner, the venue and the day."""
    return _match_read(spark, sf)


@register("match_star_read_large", _MATCH_READ)
def match_star_read_large(spark, sf):
    """The same with dimensions taken as too large to broadcast."""
    return _match_read(spark, sf, large=True)


_PRIORITY, _YEAR = "2-HIGH", 1995


@register(
    "match_star_read_filtered",
    f"SELECT * FROM ({_MATCH_READ}) r WHERE pays_domicile = '{_PRIORITY}' AND annee >= {_YEAR}",
)
def match_star_read_filtered(spark, sf):
    """Matches of home teams of one country from one year on."""
    where = {"home": F.col("pays") == _PRIORITY, "day": F.col("annee") >= _YEAR}
    return _match_read(spark, sf, where, large=True)


_STATUS, _DAYS = "FINISHED", (19940101, 19961231)


@register(
    "matches_by_status",
    f"SELECT match_id, {_DATE_ID} AS date_id, statut, total_buts FROM ({_BOTH}) m"
    f" WHERE statut = '{_STATUS}' AND {_DATE_ID} BETWEEN {_DAYS[0]} AND {_DAYS[1]}",
)
def matches_by_status(spark, sf):
    """Matches laid out by status and day, then those of one status and three years."""
    path = scratch_path(spark, "by-status")
    reads.write_by_status(_star(spark, sf, "fact_match")["fact_match"], path)
    return reads.matches_by_status(spark, path, _STATUS, _DAYS).select("match_id", "date_id", "statut", "total_buts")


@register(
    "scorers_by_goals",
    f"SELECT * FROM (SELECT joueur_id, equipe_id, buts, CAST(rank() OVER (ORDER BY buts DESC) AS INTEGER) AS rank"
    f" FROM ({STAR_SQL['fact_buteur']}) s) r WHERE rank <= 100",
)
def scorers_by_goals(spark, sf):
    """The hundred best scorers and all that tie with the last of them."""
    scorers = _star(spark, sf, "fact_buteur")["fact_buteur"].select("joueur_id", "equipe_id", "buts")
    return reads.first_with_ties(scorers, [], {"buts": False}, 100)


_STANDING = {"points": False, "difference_buts": False, "buts_pour": False}


@register(
    "standings_by_group",
    "SELECT groupe, equipe_id, points, difference_buts, buts_pour, CAST(rank() OVER (PARTITION BY groupe ORDER BY"
    " points DESC NULLS LAST, difference_buts DESC NULLS LAST, buts_pour DESC NULLS LAST) AS BIGINT) AS rang"
    f" FROM ({STAR_SQL['fact_classement']}) c",
)
def standings_by_group(spark, sf):
    """All teams with their rank in their group: points, goal difference, goals."""
    rows = _star(spark, sf, "fact_classement")["fact_classement"]
    return reads.ranked(rows.select("groupe", "equipe_id", *_STANDING), ["groupe"], _STANDING, "rang")


@register(
    "standings_first_two",
    "SELECT * FROM (SELECT groupe, equipe_id, points, CAST(rank() OVER (PARTITION BY groupe ORDER BY"
    f" points DESC NULLS LAST) AS INTEGER) AS rang FROM ({STAR_SQL['fact_classement']}) c) r WHERE rang <= 2",
)
def standings_first_two(spark, sf):
    """Of each group the teams whose points rank first or second, ties included."""
    rows = _star(spark, sf, "fact_classement")["fact_classement"].select("groupe", "equipe_id", "points")
    return reads.first_with_ties(rows, ["groupe"], {"points": False}, 2, "rang")


#: The given tables have no positions: shirt numbers stand for them.
_POSITION = (
    "CASE numero_maillot % 4 WHEN 0 THEN 'Goalkeeper' WHEN 1 THEN 'Defence' WHEN 2 THEN 'Midfield'"
    " WHEN 3 THEN 'Offence' END"
)


@register(
    "players_by_team",
    f"SELECT p.equipe_id, p.position, count(*) AS joueurs, min(date_naissance) AS aine,"
    " CAST(sum(numero_maillot) AS BIGINT) AS somme_maillots, any_value(t.nom_equipe) AS nom_equipe, any_value(t.pays) AS pays"
    f" FROM (SELECT * REPLACE ({_POSITION} AS position) FROM ({STAR_SQL['dim_joueur']}) j) p"
    f" JOIN ({STAR_SQL['dim_equipe']}) t ON t.equipe_id = p.equipe_id GROUP BY p.equipe_id, p.position",
)
def players_by_team(spark, sf):
    """Players counted by team and position, on tables in buckets of the team."""
    parts = _star(spark, sf, "dim_joueur", "dim_equipe")
    players = parts["dim_joueur"].withColumn("position", F.expr(_POSITION))
    return reads.players_by_team(*bucketed(spark, players, parts["dim_equipe"], buckets=8))


def bucketed(spark, players: DataFrame, teams: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    out = []
    for df, kind, then in ((players, "players", ["position"]), (teams, "teams", [])):
        path = scratch_path(spark, kind)
        name = path.rsplit("/", 1)[1].replace("-", "_")
        out.append(reads.write_bucketed(df, name, path, ["equipe_id"], then, buckets))
    return out[0], out[1]


@register(
    "calendar_rollup",
    f"SELECT CASE GROUPING(annee) + GROUPING(mois) WHEN 0 THEN 'month' WHEN 1 THEN 'year' ELSE 'all' END AS level,"
    " annee, mois, count(*) AS matchs, count(*) FILTER (is_match_joue) AS joues, CAST(sum(total_buts) AS BIGINT) AS buts,"
    " count(DISTINCT equipe_domicile_id) AS equipes, count(DISTINCT competition) AS competitions FROM"
    f" (SELECT *, CAST(year(match_date) AS INTEGER) AS annee, CAST(month(match_date) AS INTEGER) AS mois FROM ({_BOTH}) b) m"
    " GROUP BY ROLLUP (annee, mois)",
)
def calendar_rollup(spark, sf):
    """Matches, goals, teams and competitions per month, year and in all."""
    parts = _star(spark, sf, "fact_match", "dim_date")
    return reads.calendar_rollup(parts["fact_match"], parts["dim_date"])


@register(
    "venue_key_map",
    "WITH v AS (SELECT DISTINCT p_brand AS stade, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS ville,"
    " p_partkey % 2 AS lot FROM part), first AS (SELECT stade, ville, row_number() OVER (ORDER BY stade NULLS FIRST,"
    " ville NULLS FIRST) AS key FROM (SELECT DISTINCT stade, ville FROM v WHERE lot = 0)), more AS (SELECT stade, ville,"
    " row_number() OVER (ORDER BY stade NULLS FIRST, ville NULLS FIRST) + (SELECT count(*) FROM first) AS key FROM"
    " (SELECT DISTINCT stade, ville FROM v WHERE lot = 1) w WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.stade = w.stade"
    " AND f.ville IS NOT DISTINCT FROM w.ville)) SELECT * FROM first UNION ALL SELECT * FROM more",
)
def venue_key_map(spark, sf):
    """Keys of a first batch of values, then of a second that shares some, then the first again."""
    rows = table(spark, sf, "part").selectExpr(
        "p_brand AS stade", "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS ville", "p_partkey % 2 AS lot"
    )
    keys = KeyMap(spark, scratch_path(spark, "keys"), ["stade", "ville"])
    keys.assign(rows.where("lot = 0"))
    keys.assign(rows.where("lot = 1"))
    return keys.assign(rows.where("lot = 0"))


@register(
    "star_key_map",
    f"WITH m AS ({_BOTH}), v AS (SELECT stade, ville, row_number() OVER (ORDER BY stade NULLS FIRST, ville NULLS FIRST)"
    " AS stade_id FROM (SELECT DISTINCT stade, ville FROM m WHERE stade IS NOT NULL OR ville IS NOT NULL))"
    " SELECT match_id, v.stade_id, v.stade AS nom_stade, v.ville FROM m LEFT JOIN v ON v.stade IS NOT DISTINCT FROM m.stade"
    " AND v.ville IS NOT DISTINCT FROM m.ville",
)
def star_key_map(spark, sf):
    """Matches and the venues that their kept keys lead to."""
    silver = {n: silver_of(spark, sf, n) for n in ("matchs_joues", "matchs_non_joues")}
    out = scratch_path(spark, "silver")
    silver = layers.write_layer(spark, out, "silver", silver, "batch-1")
    matches, keys = tuple(silver.values()), star.venue_keys(spark, scratch_path(spark, "keys"))
    keys.assign(star.distinct_union(matches, star.VENUE))
    facts = star.fact_match(*matches, keys=keys).select("match_id", "stade_id")
    return facts.join(star.dim_venue(*matches, keys=keys), "stade_id", "left")


_SENT = ["groupe", "equipe_id", "points", "forme"]
_SENT_SQL = [f"nullif({c}, '') AS {c}" for c in _SENT]


@register(
    "csv_append_once",
    f"SELECT {', '.join(_SENT_SQL)} FROM ({raw_sql('classement_group_stage')}) c",
)
def csv_append_once(spark, sf):
    """Three batches of landing rows, of which one is sent twice; and one that failed before its commit."""
    root = scratch_path(spark, "appended")
    rows = raw_table(spark, sf, "classement_group_stage")
    part = F.pmod(F.xxhash64(*_SENT), F.lit(3))
    for n in (0, 1, 2, 1):
        ledger.append_csv_once(rows.where(part == n), root, _SENT, f"part/{n}")

    def fails(path: str) -> None:
        rows.select(*_SENT).write.csv(path)
        raise OSError("lost before the commit")

    try:
        ledger.append_once(spark, root, "part/3", fails)
    except OSError:
        pass
    return ledger.read_csv(spark, root, _SENT)


@register(
    "layered_resume",
    f"SELECT match_id, is_match_joue, total_buts FROM ({_BOTH}) m",
)
def layered_resume(spark, sf):
    """A run that had published bronze and silver goes on with gold, though the landing files are gone."""
    landed, out, batch = scratch_path(spark, "landing"), scratch_path(spark, "layers"), "run-1"
    land_all(spark, sf, landed)
    layers.ingest_bronze(spark, landed, out, batch)
    store.remove(spark, landed)
    layers.run_silver(spark, out, batch, batch)
    gold = layers.run_layers(spark, landed, out, batch)
    return gold["fact_match"].select("match_id", "is_match_joue", "total_buts")


_CHANGED = "o_orderkey % 10"


@register(
    "change_set",
    "WITH u AS (SELECT DISTINCT o_orderkey FROM orders) SELECT o_orderkey,"
    f" CASE {_CHANGED} WHEN 0 THEN 'inserted' WHEN 1 THEN 'deleted' ELSE 'changed' END AS change,"
    f" CASE {_CHANGED} WHEN 2 THEN 'o_totalprice' WHEN 3 THEN 'o_orderstatus' WHEN 4 THEN 'o_totalprice,o_orderstatus'"
    f" ELSE '' END AS differs FROM u WHERE {_CHANGED} < 5",
)
def change_set(spark, sf):
    """What differs between two published batches: rows added and gone, a number changed, a text become null."""
    out = scratch_path(spark, "layers")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    price = F.when(F.expr(f"{_CHANGED} IN (2, 4)"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    status = F.when(~F.expr(f"{_CHANGED} IN (3, 4)"), F.col("o_orderstatus"))
    batches = {
        "first": orders.where(f"{_CHANGED} <> 0"),
        "second": orders.where(f"{_CHANGED} <> 1").withColumns({"o_totalprice": price, "o_orderstatus": status}),
    }
    for batch, rows in batches.items():
        layers.write_layer(spark, out, "silver", {"orders": rows}, batch)
        snapshot.publish(spark, out, "silver", batch)
    old, new = (snapshot.read_layer(spark, out, "silver", "orders", batch) for batch in batches)
    found = reads.changes(old, new, ["o_orderkey"])
    return found.withColumn("differs", F.array_join("differs", ","))
