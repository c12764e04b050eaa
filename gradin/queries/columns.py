"""Queries for column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradin.functions import calendar, keys, scores, text, typing
from gradin.operators import projection
from gradin.operators.rows import drop_blank
from gradin.plans.football import EQUIPES
from gradin.queries.raw import RAW, clean, day, minute, raw_sql, raw_table, second, whole
from gradin.queries.registry import plain_times, register, table
from gradin.sources.lineage import drop_lineage, with_lineage, with_processed_time

# ---- text ----------------------------------------------------------------------------

_PADDED = "CASE WHEN doc_id % 3 = 0 THEN '  ' || text || ' ' ELSE chr(9) || text END"


@register(
    "trim_strings",
    f"SELECT doc_id, trim({_PADDED}, ' ') AS text, trim(' ' || lang || '  ', ' ') AS lang,"
    " n_chars FROM documents",
)
def trim_strings(spark, sf):
    df = table(spark, sf, "documents").selectExpr(
        "doc_id", f"{_PADDED} AS text", "' ' || lang || '  ' AS lang", "n_chars"
    )
    return projection.trim_strings(df)


@register(
    "null_tokens",
    "SELECT "
    + ", ".join(
        f"CASE WHEN lower({c}) NOT IN ('', 'nan', 'none', 'null') THEN {c} END AS {c}"
        for c in RAW["equipes"][1]
    )
    + f" FROM ({raw_sql('equipes')}) r",
)
def null_tokens(spark, sf):
    return projection.null_tokens(raw_table(spark, sf, "equipes"))


_LANGS = "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END"


# Spark writes the capital of ß as SS; DuckDB leaves the letter.
@register(
    "upper_codes",
    f"SELECT doc_id, upper({_LANGS}) AS lang, upper(replace(text, 'ß', 'ss')) AS text"
    " FROM documents",
)
def upper_codes(spark, sf):
    df = table(spark, sf, "documents").selectExpr("doc_id", f"{_LANGS} AS lang", "text")
    return df.select(
        "doc_id",
        text.upper_code(F.col("lang")).alias("lang"),
        text.upper_code(F.col("text")).alias("text"),
    )


_NAMES = {
    "nom": "CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN NULL ELSE c_name END",
    "nom_court": "CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END",
    "team_id": "CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey AS STRING) END",
}
_NAMES_SQL = f"SELECT {', '.join(f'{v} AS {c}' for c, v in _NAMES.items())} FROM customer"


def _names(spark, sf):
    return table(spark, sf, "customer").selectExpr(*[f"{v} AS {c}" for c, v in _NAMES.items()])


@register(
    "team_name_fallback",
    f"SELECT team_id, coalesce(nullif(nom, ''), nullif(nom_court, ''), team_id) AS equipe"
    f" FROM ({_NAMES_SQL}) r",
)
def team_name_fallback(spark, sf):
    name = text.first_filled(F.col("nom"), F.col("nom_court"), F.col("team_id"))
    return _names(spark, sf).select("team_id", name.alias("equipe"))


@register("drop_blank_key", f"SELECT * FROM ({_NAMES_SQL}) r WHERE team_id <> ''")
def drop_blank_key(spark, sf):
    return drop_blank(_names(spark, sf), "team_id")


# ---- groups --------------------------------------------------------------------------

_GROUP = (
    "CASE o_orderkey % 4 WHEN 0 THEN 'GROUP_' || chr(CAST(65 + o_custkey % 14 AS INT))"
    " WHEN 1 THEN 'group ' || chr(CAST(97 + o_custkey % 14 AS INT))"
    " WHEN 2 THEN 'Last 16' ELSE '' END"
)
_STAGE = "CASE WHEN o_orderkey % 8 = 3 THEN NULL ELSE 'GROUP_STAGE' END"
_LETTER = (
    "regexp_extract(replace(upper({g}), ' ', '_'), '^GROUP_([A-L])$', 1)"
)


def _groups(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey", f"{_GROUP} AS groupe", f"{_STAGE} AS etape"
    )


@register(
    "group_fallback",
    f"SELECT o_orderkey, coalesce(nullif({_GROUP}, ''), {_STAGE}, 'INCONNU') AS groupe FROM orders",
)
def group_fallback(spark, sf):
    value = scores.group_or_stage(F.col("groupe"), F.col("etape"))
    return _groups(spark, sf).select("o_orderkey", value.alias("groupe"))


@register(
    "group_label",
    f"SELECT o_orderkey, CASE WHEN {_LETTER.format(g='g')} <> '' THEN 'Groupe ' ||"
    f" {_LETTER.format(g='g')} ELSE g END AS groupe FROM (SELECT o_orderkey, {_GROUP} AS g"
    " FROM orders) r",
)
def group_label(spark, sf):
    return _groups(spark, sf).select(
        "o_orderkey", scores.group_label(F.col("groupe")).alias("groupe")
    )


@register(
    "group_slug",
    f"SELECT o_orderkey, CASE WHEN {_LETTER.format(g='g')} <> '' THEN 'groupe_' ||"
    f" lower({_LETTER.format(g='g')}) ELSE replace(lower(g), ' ', '_') END AS fichier"
    f" FROM (SELECT o_orderkey, {_GROUP} AS g FROM orders) r",
)
def group_slug(spark, sf):
    return _groups(spark, sf).select(
        "o_orderkey", scores.group_slug(F.col("groupe")).alias("fichier")
    )


# ---- typing --------------------------------------------------------------------------

_NUMBER = (
    "CASE l_orderkey % 7 WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN"
    " CAST(l_partkey AS STRING) || '.7' WHEN 3 THEN '99999999999' WHEN 4 THEN"
    " '-' || CAST(l_partkey AS STRING) || '.' ELSE CAST(l_partkey AS STRING) END"
)


def _numbers(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{_NUMBER} AS v"
    )


def _number_sql(expression: str) -> str:
    return (
        f"SELECT l_orderkey, l_linenumber, {expression} AS v"
        f" FROM (SELECT l_orderkey, l_linenumber, {_NUMBER} AS v FROM lineitem) r"
    )


@register("cast_int", _number_sql(whole("v")))
def cast_int(spark, sf):
    return _numbers(spark, sf).select(
        "l_orderkey", "l_linenumber", typing.to_int(F.col("v")).alias("v")
    )


@register("cast_long", _number_sql(whole("v", "BIGINT")))
def cast_long(spark, sf):
    return _numbers(spark, sf).select(
        "l_orderkey", "l_linenumber", typing.to_long(F.col("v")).alias("v")
    )


@register("null_to_zero", _number_sql(f"coalesce({whole('v')}, 0)"))
def null_to_zero(spark, sf):
    return _numbers(spark, sf).select(
        "l_orderkey", "l_linenumber", typing.zero_if_null(typing.to_int(F.col("v"))).alias("v")
    )


_MOMENT = (
    "CASE l_orderkey % 6 WHEN 0 THEN 'TBD' WHEN 1 THEN substr(CAST(l_shipdate AS STRING), 1, 10)"
    " WHEN 2 THEN substr(CAST(l_shipdate AS STRING), 1, 16) WHEN 3 THEN '1987'"
    " ELSE CAST(l_shipdate AS STRING) END"
)


def _moments(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{_MOMENT} AS v"
    )


def _moment_sql(expression: str) -> str:
    return (
        f"SELECT l_orderkey, l_linenumber, {expression} AS v"
        f" FROM (SELECT l_orderkey, l_linenumber, {_MOMENT} AS v FROM lineitem) r"
    )


def _parsed(spark, sf, parse):
    df = _moments(spark, sf).select("l_orderkey", "l_linenumber", parse(F.col("v")).alias("v"))
    return plain_times(df)


@register("parse_date", _moment_sql(day("v")))
def parse_date(spark, sf):
    return _parsed(spark, sf, typing.to_date)


@register("parse_ts_seconds", _moment_sql(second("v")))
def parse_ts_seconds(spark, sf):
    return _parsed(spark, sf, typing.to_timestamp)


@register("parse_ts_minutes", _moment_sql(minute("v")))
def parse_ts_minutes(spark, sf):
    return _parsed(spark, sf, lambda c: typing.to_timestamp(c, typing.MINUTE_FORMAT))


@register("ts_to_date", _moment_sql(f"CAST({minute('v')} AS DATE)"))
def ts_to_date(spark, sf):
    return _parsed(
        spark, sf, lambda c: typing.day_of(typing.to_timestamp(c, typing.MINUTE_FORMAT))
    )


_TEAM_VALUES = {
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
}
_TEAM_SQL = (
    f"SELECT {', '.join(f'{v} AS {c}' for c, v in _TEAM_VALUES.items())}"
    f" FROM ({raw_sql('equipes')}) r"
)


@register("rename_project", _TEAM_SQL)
def rename_project(spark, sf):
    return plain_times(projection.project(raw_table(spark, sf, "equipes"), EQUIPES.fields))


# ---- constants and lineage -----------------------------------------------------------


@register("constant_flag", "SELECT o_orderkey, TRUE AS is_match_joue FROM orders")
def constant_flag(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.lit(True).alias("is_match_joue"))


@register(
    "typed_nulls",
    "SELECT o_orderkey, CAST(NULL AS INTEGER) AS total_buts, CAST(NULL AS VARCHAR) AS"
    " resultat_match, CAST(NULL AS BIGINT) AS vainqueur_equipe_id FROM orders",
)
def typed_nulls(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        typing.typed_null("int").alias("total_buts"),
        typing.typed_null("string").alias("resultat_match"),
        typing.typed_null("bigint").alias("vainqueur_equipe_id"),
    )


@register("processed_timestamp", "SELECT o_orderkey, TRUE AS stamped FROM orders")
def processed_timestamp(spark, sf):
    df = with_processed_time(table(spark, sf, "orders").select("o_orderkey"))
    return df.select("o_orderkey", F.col("_silver_processed_timestamp").isNotNull().alias("stamped"))


@register("batch_id", "SELECT o_orderkey, 'batch-1' AS _batch_id FROM orders")
def batch_id(spark, sf):
    return with_lineage(table(spark, sf, "orders"), "batch-1").select("o_orderkey", "_batch_id")


@register("drop_lineage", "SELECT * FROM orders")
def drop_lineage_columns(spark, sf):
    df = with_processed_time(with_lineage(table(spark, sf, "orders"), "batch-1"))
    return drop_lineage(df)


# ---- scores --------------------------------------------------------------------------

_HOME = "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_linenumber END"
_AWAY = "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(l_quantity AS INT) % 7 END"
_SCORES_SQL = (
    f"(SELECT l_orderkey, l_partkey, l_suppkey, {_HOME} AS a, {_AWAY} AS b FROM lineitem) r"
)


def _scores(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", f"{_HOME} AS a", f"{_AWAY} AS b"
    )


@register("sum_two", f"SELECT l_orderkey, a, b, a + b AS total_buts FROM {_SCORES_SQL}")
def sum_two(spark, sf):
    total = scores.total(F.col("a"), F.col("b")).alias("total_buts")
    return _scores(spark, sf).select("l_orderkey", "a", "b", total)


@register(
    "outcome_label",
    "SELECT l_orderkey, a, b, CASE WHEN a > b THEN 'HOME_WIN' WHEN a < b THEN 'AWAY_WIN'"
    " ELSE 'DRAW' END AS resultat, CASE WHEN a > b THEN 'HOME_WIN' WHEN a < b THEN 'AWAY_WIN'"
    f" WHEN a = b THEN 'DRAW' END AS resultat_connu FROM {_SCORES_SQL}",
)
def outcome_label(spark, sf):
    a, b = F.col("a"), F.col("b")
    return _scores(spark, sf).select(
        "l_orderkey",
        "a",
        "b",
        scores.outcome(a, b).alias("resultat"),
        scores.outcome(a, b, unknown=None).alias("resultat_connu"),
    )


@register(
    "winner_key",
    "SELECT l_orderkey, CASE WHEN a > b THEN l_partkey WHEN a < b THEN l_suppkey END"
    f" AS vainqueur FROM {_SCORES_SQL}",
)
def winner_key(spark, sf):
    key = scores.winner(F.col("a"), F.col("b"), F.col("l_partkey"), F.col("l_suppkey"))
    return _scores(spark, sf).select("l_orderkey", key.alias("vainqueur"))


@register(
    "safe_ratio",
    "SELECT l_orderkey, a, b, CASE WHEN b > 0 THEN round(CAST(a AS DOUBLE) / b, 2) ELSE 0.0 END"
    f" AS ratio FROM {_SCORES_SQL}",
)
def safe_ratio(spark, sf):
    ratio = scores.safe_ratio(F.col("a"), F.col("b")).alias("ratio")
    return _scores(spark, sf).select("l_orderkey", "a", "b", ratio)


# ---- keys and calendar ---------------------------------------------------------------


@register(
    "hash_key",
    "SELECT stade, ville, 1 AS keys_of_32_bits, 1 AS keys_of_64_bits, count(*) AS rows"
    " FROM (SELECT CASE WHEN l_linenumber = 1 THEN '' ELSE l_returnflag END AS stade,"
    " CAST(l_suppkey AS VARCHAR) AS ville FROM lineitem) r GROUP BY stade, ville",
)
def hash_key(spark, sf):
    """Every pair has one key, and NULL counts as ''. Spark's hash is not in SQL."""
    pairs = table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_linenumber = 1 AND l_orderkey % 2 = 0 THEN NULL"
        " WHEN l_linenumber = 1 THEN '' ELSE l_returnflag END AS stade",
        "CAST(l_suppkey AS STRING) AS ville",
    )
    keyed = pairs.select(
        F.coalesce("stade", F.lit("")).alias("stade"),
        "ville",
        keys.hash_key(F.col("stade"), F.col("ville")).alias("k32"),
        keys.hash_key(F.col("stade"), F.col("ville"), bits=64).alias("k64"),
    )
    one_key = [(F.min(k) == F.max(k)) & (F.min(k) >= 0) for k in ("k32", "k64")]
    return keyed.groupBy("stade", "ville").agg(
        one_key[0].cast("int").alias("keys_of_32_bits"),
        one_key[1].cast("int").alias("keys_of_64_bits"),
        F.count(F.lit(1)).alias("rows"),
    )


@register(
    "date_key",
    "SELECT l_orderkey, l_linenumber, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_id"
    " FROM lineitem",
)
def date_key(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", calendar.date_key(F.to_date("l_shipdate")).alias("date_id")
    )


CALENDAR_SQL = (
    "CAST(day({d}) AS INTEGER) AS jour, CAST(month({d}) AS INTEGER) AS mois,"
    " monthname({d}) AS nom_mois, CAST(year({d}) AS INTEGER) AS annee,"
    " CAST(dayofweek({d}) + 1 AS INTEGER) AS num_jour_semaine,"
    " dayname({d}) AS nom_jour_semaine, CAST(weekofyear({d}) AS INTEGER) AS semaine_annee"
)


@register(
    "calendar_parts",
    f"SELECT event_id, {CALENDAR_SQL.format(d='CAST(ts AS DATE)')} FROM events",
)
def calendar_parts(spark, sf):
    parts = calendar.calendar_parts(F.to_date("ts"))
    return table(spark, sf, "events").select(
        "event_id", *[part.alias(name) for name, part in parts.items()]
    )


_ISO = (
    "CASE event_id % 5 WHEN 0 THEN replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T') || 'Z'"
    " WHEN 1 THEN replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T') || '+02:00'"
    " WHEN 2 THEN substr(CAST(ts AS STRING), 1, 10) WHEN 3 THEN 'TBD' ELSE '2024-13-45T10:00:00Z' END"
)


@register(
    "iso_to_minute",
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M')"
    " WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M') WHEN 2 THEN strftime(ts, '%Y-%m-%d 00:00')"
    " WHEN 3 THEN 'TBD' ELSE '2024-13-45T10:00:00Z' END AS date_heure FROM events",
)
def iso_to_minute(spark, sf):
    df = table(spark, sf, "events").selectExpr("event_id", f"{_ISO} AS v")
    return df.select("event_id", calendar.iso_to_minute(F.col("v")).alias("date_heure"))


@register("stamp_updated_at", "SELECT event_id, 19 AS length, TRUE AS reads_back FROM events")
def stamp_updated_at(spark, sf):
    df = table(spark, sf, "events").select("event_id", calendar.updated_at().alias("stamp"))
    return df.select(
        "event_id",
        F.length("stamp").alias("length"),
        typing.to_timestamp(F.col("stamp")).isNotNull().alias("reads_back"),
    )
