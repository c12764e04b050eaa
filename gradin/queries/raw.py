"""Landing tables derived from the given tables, and the SQL that reads them back.

Each raw column is one expression that Spark and DuckDB both understand. The expressions
spread the faults of real landing files over all rows: padding, null tokens, malformed
numbers and dates, repeated keys, keys that point nowhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradin.queries.registry import table

RAW: dict[str, tuple[str, dict[str, str]]] = {
    "equipes": (
        "orders",
        {
            "team_id": "CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN 'n/a'"
            " WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey AS STRING) || '.0'"
            " ELSE ' ' || CAST(o_custkey AS STRING) || ' ' END",
            "nom": "CASE WHEN o_orderkey % 7 = 0 THEN ' NaN ' WHEN o_orderkey % 7 = 1 THEN ''"
            " ELSE '  Team ' || CAST(o_custkey % 100 AS STRING) || ' ' END",
            "nom_court": "CASE WHEN o_orderkey % 3 = 0 THEN 'none'"
            " ELSE 'T' || CAST(o_custkey AS STRING) END",
            "code_tla": "CASE WHEN o_orderkey % 11 = 0 THEN ' Null '"
            " ELSE chr(CAST(97 + o_custkey % 26 AS INT)) || chr(CAST(97 + o_custkey % 25 AS INT))"
            " || CASE WHEN o_orderkey % 41 = 0 THEN 'long' ELSE 'x' END END",
            "pays": "' ' || o_orderpriority",
            "code_pays": "lower(o_orderstatus) || 'y'",
            "logo_url": "'https://example.org/' || CAST(o_custkey AS STRING) || '.svg'",
            "couleurs_club": "CASE WHEN o_orderkey % 2 = 0 THEN 'Red / \"Blue\", White' ELSE '' END",
            "site_web": "'http://example.org/' || CAST(o_orderkey AS STRING)",
            "selectionneur": "CASE WHEN o_orderkey % 13 = 0 THEN 'NULL'"
            " ELSE 'Élan ' || CAST(o_orderkey % 17 AS STRING) END",
            "nationalite_selectionneur": "o_orderpriority",
            "derniere_maj": "CASE WHEN o_orderkey % 19 = 0 THEN 'unknown'"
            " ELSE CAST(o_orderdate AS STRING) END",
        },
    ),
    "joueurs": (
        "lineitem",
        {
            "joueur_id": "CASE WHEN l_orderkey % 83 = 0 THEN 'abc' WHEN l_orderkey % 79 = 0 THEN ''"
            " WHEN l_linenumber = 3 THEN CAST(l_partkey AS STRING) || '.0'"
            " ELSE CAST(l_partkey AS STRING) END",
            "team_id": "CASE WHEN l_orderkey % 29 = 0 THEN '' ELSE CAST(l_suppkey AS STRING) END",
            "equipe": "'Team ' || CAST(l_suppkey AS STRING)",
            "nom": "CASE WHEN l_linenumber = 5 THEN 'NONE' ELSE 'Nom ' || l_returnflag END",
            "prenom": "' ' || l_linestatus || ' '",
            "nom_complet": "l_returnflag || ' ' || l_linestatus",
            "date_naissance": "CASE WHEN l_orderkey % 23 = 0 THEN '1987'"
            " ELSE substr(CAST(l_shipdate AS STRING), 1, 10) END",
            "nationalite": "CASE WHEN l_linenumber = 2 THEN 'nan' ELSE 'N' || l_returnflag END",
            "position": "''",
            "numero_maillot": "CASE WHEN l_orderkey % 7 = 0 THEN 'x'"
            " ELSE CAST(CAST(l_quantity AS INT) AS STRING) || '.9' END",
            "derniere_maj": "CAST(l_shipdate AS STRING)",
        },
    ),
    "buteurs": (
        "lineitem",
        {
            "joueur_id": "CASE WHEN l_orderkey % 83 = 0 THEN 'abc'"
            " ELSE CAST(l_partkey AS STRING) END",
            "nom": "'Nom ' || CAST(l_partkey AS STRING)",
            "nationalite": "' N' || l_returnflag",
            "position": "''",
            "date_naissance": "substr(CAST(l_shipdate AS STRING), 1, 10)",
            "equipe_id": "CASE WHEN l_orderkey % 53 = 0 THEN 'null'"
            " ELSE CAST(l_suppkey AS STRING) END",
            "equipe": "'Team ' || CAST(l_suppkey AS STRING)",
            "buts": "CAST(CAST(l_quantity AS INT) - 2 AS STRING)",
            "assists": "CASE WHEN l_linenumber % 2 = 1 THEN '' ELSE '1.0' END",
            "matchs_joues": "CAST(l_linenumber - 1 AS STRING)",
            "penaltys": "CASE WHEN l_orderkey % 9 = 0 THEN '1' ELSE 'NaN' END",
            "derniere_maj": "CAST(l_shipdate AS STRING)",
        },
    ),
    "matchs": (
        "orders",
        {
            "match_id": "CASE WHEN o_orderkey % 101 = 0 THEN '' WHEN o_orderkey % 10 = 1"
            " THEN CAST(o_orderkey - 1 AS STRING) ELSE CAST(o_orderkey AS STRING) END",
            "competition": "' Cup '",
            "journee": "CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE CAST(o_orderkey % 8 AS STRING) END",
            "statut": "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN ' finished'"
            " WHEN o_orderstatus = 'F' THEN 'IN_PLAY' WHEN o_orderstatus = 'P' THEN 'AWARDED'"
            " WHEN o_orderkey % 5 = 0 THEN '' ELSE 'timed' END",
            "date_heure": "CASE WHEN o_orderkey % 17 = 0 THEN CAST(o_orderdate AS STRING)"
            " ELSE substr(CAST(o_orderdate AS STRING), 1, 16) END",
            "equipe_domicile_id": "CASE WHEN o_orderkey % 31 = 0 THEN ''"
            " ELSE CAST(o_custkey AS STRING) END",
            "equipe_domicile": "'Team ' || CAST(o_custkey AS STRING)",
            "equipe_exterieur_id": "CAST(o_custkey * 7 + 1 AS STRING)",
            "equipe_exterieur": "'Team ' || CAST(o_custkey * 7 + 1 AS STRING)",
            "score_domicile_mi_temps": "CAST(o_orderkey % 2 AS STRING)",
            "score_exterieur_mi_temps": "'0'",
            "score_domicile_final": "CASE WHEN o_orderkey % 43 = 0 THEN ''"
            " ELSE CAST(o_orderkey % 5 AS STRING) END",
            "score_exterieur_final": "CAST(o_orderkey % 4 AS STRING) || '.0'",
            "stade": "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END",
            "ville": "CASE WHEN o_orderkey % 6 = 0 THEN 'None' ELSE 'Ville ' || o_orderstatus END",
            "arbitre": "'Ref ' || CAST(o_orderkey % 50 AS STRING)",
            "derniere_maj": "CAST(o_orderdate AS STRING)",
        },
    ),
    "classement_group_stage": (
        "orders",
        {
            "groupe": "CASE WHEN o_orderkey % 37 = 0 THEN ''"
            " ELSE 'Groupe ' || chr(CAST(65 + o_custkey % 14 AS INT)) END",
            "position": "CAST(o_orderkey % 4 + 1 AS STRING)",
            "equipe_id": "CASE WHEN o_orderkey % 61 = 0 THEN 'none'"
            " ELSE CAST(o_custkey AS STRING) END",
            "equipe": "'Team ' || CAST(o_custkey AS STRING)",
            "matchs_joues": "CAST(o_orderkey % 4 AS STRING)",
            "victoires": "CAST(o_orderkey % 3 AS STRING)",
            "nuls": "'0.0'",
            "defaites": "''",
            "buts_pour": "CAST(o_orderkey % 9 AS STRING)",
            "buts_contre": "CAST(o_orderkey % 7 AS STRING)",
            "difference_buts": "CAST(o_orderkey % 9 - o_orderkey % 7 AS STRING)",
            "points": "CAST(o_orderkey % 11 - 1 AS STRING)",
            "forme": "CASE WHEN o_orderkey % 2 = 0 THEN 'W,D,L' ELSE '' END",
            "derniere_maj": "CAST(o_orderdate AS STRING)",
        },
    ),
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = RAW[name]
    return table(spark, sf_dir, source).selectExpr(
        *[f"{value} AS {column}" for column, value in columns.items()]
    )


def raw_sql(name: str) -> str:
    source, columns = RAW[name]
    return f"SELECT {', '.join(f'{v} AS {c}' for c, v in columns.items())} FROM {source}"


# ---- SQL for cleaned values ----------------------------------------------------------


def clean(c: str) -> str:
    return (
        f"CASE WHEN lower(trim({c}, ' ')) NOT IN ('', 'nan', 'none', 'null')"
        f" THEN trim({c}, ' ') END"
    )


def whole(c: str, kind: str = "INTEGER") -> str:
    return f"TRY_CAST(regexp_replace({clean(c)}, '[.][0-9]*$', '') AS {kind})"


def day(c: str) -> str:
    return f"CAST(try_strptime({clean(c)}, '%Y-%m-%d') AS DATE)"


def second(c: str) -> str:
    return f"try_strptime({clean(c)}, '%Y-%m-%d %H:%M:%S')"


def minute(c: str) -> str:
    return f"try_strptime({clean(c)}, '%Y-%m-%d %H:%M')"


def latest(
    typed: str, columns: list[str], key: list[str], newest: str = "derniere_maj"
) -> str:
    """The newest row per key of a typed SELECT, ties broken by the other columns."""
    others = [f"{c} ASC NULLS FIRST" for c in columns if c not in {*key, newest}]
    order = ", ".join([f"{newest} DESC NULLS LAST", *others])
    return (
        f"SELECT * FROM ({typed}) t QUALIFY row_number() OVER"
        f" (PARTITION BY {', '.join(key)} ORDER BY {order}) = 1"
    )
