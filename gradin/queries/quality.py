"""Queries for constraint checks, repairs and types of the warehouse."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradin.functions import typing
from gradin.operators import quality, repair, rules
from gradin.plans.football import FACT_BUTEUR, STAR
from gradin.plans.layers import write_layer
from gradin.plans.star import build_star, projection_of
from gradin.queries.registry import plain_times, register, table
from gradin.queries.tables import STAR_SQL, silver_of, silver_tables
from gradin.session import scratch_path
from gradin.spec import ForeignKey


def _row_sql(source: str, name: str, key: str, checks: list[tuple[str, str, str]]) -> str:
    """Violations of row rules: (rule, condition that is broken, value shown)."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", '{rule}' AS rule, {key} AS key,"
        f" CAST({shown} AS VARCHAR) AS detail, CAST(1 AS BIGINT) AS rows FROM {source} WHERE {broken}"
        for rule, broken, shown in checks
    )


_LINE_KEY = "l_orderkey || '|' || l_linenumber"

# ---- row rules -----------------------------------------------------------------------

_GAPS = (
    "(SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END AS equipe,"
    " CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE o_orderstatus END AS statut FROM orders)"
)


@register(
    "check_not_null",
    _row_sql(
        f"{_GAPS} g",
        "matchs",
        "CAST(o_orderkey AS VARCHAR)",
        [
            ("not_null(equipe)", "equipe IS NULL", "NULL"),
            ("not_null(statut)", "statut IS NULL", "NULL"),
        ],
    ),
)
def check_not_null(spark, sf):
    df = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END AS equipe",
        "CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE o_orderstatus END AS statut",
    )
    checks = [rules.not_null("equipe"), rules.not_null("statut")]
    return quality.check_rows(df, "matchs", ["o_orderkey"], checks)


@register(
    "check_range",
    _row_sql(
        "lineitem",
        "lineitem",
        _LINE_KEY,
        [
            ("range(l_linenumber,1,5)", "l_linenumber NOT BETWEEN 1 AND 5", "l_linenumber"),
            ("range(jour,1,28)", "day(l_shipdate) NOT BETWEEN 1 AND 28", "day(l_shipdate)"),
        ],
    ),
)
def check_range(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "dayofmonth(l_shipdate) AS jour"
    )
    checks = [rules.in_range("l_linenumber", 1, 5), rules.in_range("jour", 1, 28)]
    return quality.check_rows(df, "lineitem", ["l_orderkey", "l_linenumber"], checks)


_STATUS = "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END"


@register(
    "check_enum",
    _row_sql(
        f"(SELECT o_orderkey, {_STATUS} AS statut FROM orders) o",
        "orders",
        "CAST(o_orderkey AS VARCHAR)",
        [("enum(statut)", "statut NOT IN ('F', 'O')", "statut")],
    ),
)
def check_enum(spark, sf):
    df = table(spark, sf, "orders").selectExpr("o_orderkey", f"{_STATUS} AS statut")
    return quality.check_rows(df, "orders", ["o_orderkey"], [rules.one_of("statut", ("F", "O"))])


_NET = "CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE CAST(l_quantity AS INT) - 25 END"


@register(
    "check_non_negative",
    _row_sql(
        f"(SELECT l_orderkey, l_linenumber, {_NET} AS buts FROM lineitem) l",
        "lineitem",
        _LINE_KEY,
        [("non_negative(buts)", "buts < 0", "buts")],
    ),
)
def check_non_negative(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_NET} AS buts")
    checks = [rules.non_negative("buts")]
    return quality.check_rows(df, "lineitem", ["l_orderkey", "l_linenumber"], checks)


@register(
    "check_length",
    _row_sql(
        "documents",
        "documents",
        "CAST(doc_id AS VARCHAR)",
        [
            ("max_length(text,500)", "length(text) > 500", "length(text)"),
            ("max_length(source,4)", "length(source) > 4", "length(source)"),
        ],
    ),
)
def check_length(spark, sf):
    checks = [rules.max_length("text", 500), rules.max_length("source", 4)]
    return quality.check_rows(table(spark, sf, "documents"), "documents", ["doc_id"], checks)


_RATIO = "CASE WHEN l_orderkey % 12 = 0 THEN NULL ELSE l_extendedprice / 16 END"


# The SQL goes through text: half up is meant of the decimal digits, and DuckDB's own cast
# multiplies the double, which turns 317.465 into 317.46.
@register(
    "to_numeric_5_2",
    "SELECT l_orderkey, l_linenumber,"
    " TRY_CAST(CAST(v AS VARCHAR) AS DECIMAL(5,2)) AS ratio,"
    " coalesce(abs(round(v, 2)) >= 1000, FALSE) AS overflow"
    f" FROM (SELECT l_orderkey, l_linenumber, {_RATIO} AS v FROM lineitem) r",
)
def to_numeric_5_2(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_RATIO} AS v")
    overflow = rules.fits_numeric("v", 5, 2).violated()
    return df.select(
        "l_orderkey",
        "l_linenumber",
        typing.to_numeric(F.col("v")).alias("ratio"),
        F.coalesce(overflow, F.lit(False)).alias("overflow"),
    )


# ---- keys ----------------------------------------------------------------------------


@register(
    "check_primary_key",
    "SELECT 'lineitem' AS \"table\", 'primary_key(l_orderkey,l_linenumber)' AS rule,"
    f" {_LINE_KEY} AS key, CAST(NULL AS VARCHAR) AS detail, count(*) AS rows"
    " FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def check_primary_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    return quality.check_primary_key(lines, "lineitem", ["l_orderkey", "l_linenumber"])


# Two keys to one parent: one is NULL in some rows and has a single lost value in a fifth of
# all rows, the other has many lost values.
_HOME = (
    "CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN -1"
    " ELSE o_custkey END"
)
_CHILD = {"o_orderkey": "o_orderkey", "domicile": _HOME, "exterieur": "o_custkey * 2"}
_CHILD_SQL = f"(SELECT {', '.join(f'{v} AS {c}' for c, v in _CHILD.items())} FROM orders) c"
_KEYS = [
    ForeignKey("domicile", "equipes", "equipe_id", "set null"),
    ForeignKey("exterieur", "equipes", "equipe_id", "set null"),
]


def _child_and_parent(spark, sf):
    child = table(spark, sf, "orders").selectExpr(*[f"{v} AS {c}" for c, v in _CHILD.items()])
    return child, table(spark, sf, "customer").select(F.col("c_custkey").alias("equipe_id"))


def _lost(column: str) -> str:
    return f"{column} IS NOT NULL AND {column} NOT IN (SELECT c_custkey FROM customer)"


@register(
    "check_foreign_key",
    " UNION ALL ".join(
        f"SELECT 'matchs' AS \"table\", 'foreign_key({c})' AS rule, CAST({c} AS VARCHAR) AS key,"
        f" CAST({c} AS VARCHAR) AS detail, count(*) AS rows FROM {_CHILD_SQL} WHERE {_lost(c)}"
        f" GROUP BY {c}"
        for c in ("domicile", "exterieur")
    ),
)
def check_foreign_key(spark, sf):
    child, parent = _child_and_parent(spark, sf)
    return quality.check_foreign_keys(child, "matchs", _KEYS, parent)


@register(
    "orphans_set_null",
    "SELECT o_orderkey, "
    + ", ".join(
        f"CASE WHEN {_lost(c)} THEN NULL ELSE {c} END AS {c}" for c in ("domicile", "exterieur")
    )
    + f" FROM {_CHILD_SQL}",
)
def orphans_set_null(spark, sf):
    child, parent = _child_and_parent(spark, sf)
    return repair.orphans_set_null(child, _KEYS, parent)


@register(
    "orphans_cascade",
    f"SELECT * FROM {_CHILD_SQL} WHERE NOT ({_lost('domicile')}) AND NOT ({_lost('exterieur')})",
)
def orphans_cascade(spark, sf):
    child, parent = _child_and_parent(spark, sf)
    return repair.orphans_cascade(child, _KEYS, parent)


@register(
    "apply_defaults",
    "SELECT l_partkey AS joueur_id, l_suppkey AS equipe_id, 0 AS buts, 0 AS assists,"
    " CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linenumber END AS matchs_joues,"
    " 0 AS penaltys, CAST(0 AS DECIMAL(5,2)) AS buts_par_match FROM lineitem",
)
def apply_defaults(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr(
        "l_partkey AS joueur_id",
        "l_suppkey AS equipe_id",
        "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linenumber END AS matchs_joues",
    )
    return repair.apply_defaults(df, FACT_BUTEUR).drop("derniere_maj")


# ---- the whole report ----------------------------------------------------------------

# Per table: key, text limits, other row rules, foreign keys.
_REPORT = {
    "dim_equipe": (
        ["equipe_id"],
        {
            "nom_equipe": 100, "nom_court": 50, "code_tla": 3, "pays": 100, "code_pays": 10,
            "couleurs_club": 100, "site_web": 200, "selectionneur": 100,
            "nationalite_selectionneur": 100,
        },
        {},
        {},
    ),
    "dim_joueur": (
        ["joueur_id"],
        {
            "nom": 100, "prenom": 100, "nom_complet": 200, "nationalite": 100, "position": 50,
        },
        {},
        {"equipe_id": ("dim_equipe", "equipe_id")},
    ),
    "dim_date": (
        ["date_id"],
        {"nom_mois": 20, "nom_jour_semaine": 20},
        {
            "range(mois,1,12)": "mois NOT BETWEEN 1 AND 12",
            "range(jour,1,31)": "jour NOT BETWEEN 1 AND 31",
            "range(num_jour_semaine,1,7)": "num_jour_semaine NOT BETWEEN 1 AND 7",
        },
        {},
    ),
    "fact_match": (
        ["match_id"],
        {"competition": 100, "statut": 50, "resultat_match": 10, "arbitre": 100},
        {"enum(resultat_match)": "resultat_match NOT IN ('HOME_WIN', 'AWAY_WIN', 'DRAW')"},
        {
            "date_id": ("dim_date", "date_id"),
            "equipe_domicile_id": ("dim_equipe", "equipe_id"),
            "equipe_exterieur_id": ("dim_equipe", "equipe_id"),
            "vainqueur_equipe_id": ("dim_equipe", "equipe_id"),
        },
    ),
    "fact_buteur": (
        ["joueur_id", "equipe_id"],
        {},
        {
            "numeric(buts_par_match,5,2)": "abs(round(buts_par_match, 2)) >= 1000",
            "non_negative(buts)": "buts < 0",
            "non_negative(assists)": "assists < 0",
            "non_negative(penaltys)": "penaltys < 0",
        },
        {"joueur_id": ("dim_joueur", "joueur_id"), "equipe_id": ("dim_equipe", "equipe_id")},
    ),
    "fact_classement": (
        ["equipe_id", "groupe"],
        {"groupe": 50, "forme": 20},
        {"non_negative(points)": "points < 0", "non_negative(matchs_joues)": "matchs_joues < 0"},
        {"equipe_id": ("dim_equipe", "equipe_id")},
    ),
}


def _report_sql() -> str:
    parts = []
    for name, (key, lengths, checks, parents) in _REPORT.items():
        broken = {f"not_null({c})": f"{c} IS NULL" for c in key}
        broken |= {f"max_length({c},{n})": f"length({c}) > {n}" for c, n in lengths.items()}
        broken |= checks
        for column, (parent, parent_key) in parents.items():
            broken[f"foreign_key({column})"] = (
                f"{column} IS NOT NULL AND {column} NOT IN (SELECT {parent_key} FROM {parent})"
            )
        for rule, condition in broken.items():
            parts.append(
                f"SELECT '{name}' AS \"table\", '{rule}' AS rule, count(*) AS violations"
                f" FROM {name} WHERE {condition}"
            )
        known = " AND ".join(f"{c} IS NOT NULL" for c in key)
        parts.append(
            f"SELECT '{name}' AS \"table\", 'primary_key({','.join(key)})' AS rule, count(*)"
            f" AS violations FROM (SELECT 1 FROM {name} WHERE {known}"
            f" GROUP BY {', '.join(key)} HAVING count(*) > 1) d"
        )
    with_tables = ", ".join(f"{n} AS MATERIALIZED ({STAR_SQL[n]})" for n in _REPORT)
    return f"WITH {with_tables} {' UNION ALL '.join(parts)}"


def _written_star(spark, sf):
    """The star over written silver tables, as the layered run checks it."""
    silver = write_layer(spark, scratch_path(spark, "layers"), "silver", silver_tables(spark, sf), "batch-1")
    return build_star(silver)


@register("constraint_report", _report_sql())
def constraint_report(spark, sf):
    """All rules of the star schema but those on the venue id, which is Spark's hash."""
    report = quality.constraint_report(STAR.values(), _written_star(spark, sf))
    return report.where("table <> 'dim_stade' AND rule <> 'foreign_key(stade_id)'")


@register(
    "venue_constraints",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", '{rule}' AS rule, count(*) AS violations"
        f" FROM ({STAR_SQL[source]}) s WHERE {broken}"
        for name, rule, source, broken in (
            ("dim_stade", "not_null(stade_id)", "dim_stade", "nom_stade IS NULL AND ville IS NULL"),
            ("dim_stade", "max_length(nom_stade,200)", "dim_stade", "length(nom_stade) > 200"),
            ("dim_stade", "max_length(ville,100)", "dim_stade", "length(ville) > 100"),
            # Spark's hash is not in SQL; unless two venues share one, both of these hold.
            ("dim_stade", "primary_key(stade_id)", "dim_stade", "FALSE"),
            ("fact_match", "foreign_key(stade_id)", "dim_stade", "FALSE"),
        )
    ),
)
def venue_constraints(spark, sf):
    """The rules on the venue id."""
    tables = [STAR["dim_stade"], STAR["fact_match"]]
    report = quality.constraint_report(tables, _written_star(spark, sf))
    return report.where("table = 'dim_stade' OR rule = 'foreign_key(stade_id)'")


# ---- one fact's violations and its repair --------------------------------------------

_SCORERS = ("dim_equipe", "dim_joueur", "fact_buteur")
_SCORER_TABLES = ", ".join(f"{n} AS MATERIALIZED ({STAR_SQL[n]})" for n in _SCORERS)
_SCORER_KEY = (
    "coalesce(CAST(joueur_id AS VARCHAR), 'NULL') || '|' ||"
    " coalesce(CAST(equipe_id AS VARCHAR), 'NULL')"
)
_SCORER_ORPHANS = {
    "joueur_id": "joueur_id IS NOT NULL AND joueur_id NOT IN (SELECT joueur_id FROM dim_joueur)",
    "equipe_id": "equipe_id IS NOT NULL AND equipe_id NOT IN (SELECT equipe_id FROM dim_equipe)",
}


def _scorer_frames(spark, sf):
    sources = dict(zip(_SCORERS, ("equipes", "joueurs", "buteurs")))
    silver = {source: silver_of(spark, sf, source) for source in sources.values()}
    written = write_layer(spark, scratch_path(spark, "layers"), "silver", silver, "batch-1")
    return {name: projection_of(STAR[name], written[source]) for name, source in sources.items()}


@register(
    "star_violations",
    f"WITH {_SCORER_TABLES} "
    + _row_sql(
        "fact_buteur",
        "fact_buteur",
        _SCORER_KEY,
        [
            ("not_null(joueur_id)", "joueur_id IS NULL", "NULL"),
            ("not_null(equipe_id)", "equipe_id IS NULL", "NULL"),
            ("numeric(buts_par_match,5,2)", "abs(buts_par_match) >= 999.995", "buts_par_match"),
            ("non_negative(buts)", "buts < 0", "buts"),
            ("non_negative(assists)", "assists < 0", "assists"),
            ("non_negative(penaltys)", "penaltys < 0", "penaltys"),
        ],
    )
    + "".join(
        f" UNION ALL SELECT 'fact_buteur', 'foreign_key({c})', CAST({c} AS VARCHAR),"
        f" CAST({c} AS VARCHAR), count(*) FROM fact_buteur WHERE {lost} GROUP BY {c}"
        for c, lost in _SCORER_ORPHANS.items()
    )
    + " UNION ALL SELECT 'fact_buteur', 'primary_key(joueur_id,equipe_id)',"
    f" {_SCORER_KEY}, NULL, count(*) FROM fact_buteur WHERE joueur_id IS NOT NULL"
    " AND equipe_id IS NOT NULL GROUP BY joueur_id, equipe_id HAVING count(*) > 1",
)
def star_violations(spark, sf):
    """Everything in the scorer fact that breaks its declaration."""
    return quality.violations(FACT_BUTEUR, _scorer_frames(spark, sf))


@register(
    "star_repair",
    f"WITH {_SCORER_TABLES} SELECT * FROM fact_buteur"
    f" WHERE NOT ({_SCORER_ORPHANS['joueur_id']}) AND NOT ({_SCORER_ORPHANS['equipe_id']})",
)
def star_repair(spark, sf):
    """The scorer fact after its delete rules."""
    return plain_times(repair.repair(FACT_BUTEUR, _scorer_frames(spark, sf)))
