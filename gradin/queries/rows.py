"""Queries for filters, deduplication, unions, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradin.functions import calendar, typing
from gradin.operators import rows
from gradin.operators.projection import clean_strings
from gradin.queries.raw import clean, raw_sql, raw_table
from gradin.queries.registry import register, table

# ---- filters -------------------------------------------------------------------------

_KEYS = "CASE WHEN p_partkey % 6 = 0 THEN 'x' || p_name ELSE CAST(p_partkey AS STRING) END"


@register(
    "require_key",
    f"SELECT * FROM (SELECT TRY_CAST({_KEYS} AS BIGINT) AS cle, p_name, p_brand FROM part) r"
    " WHERE cle IS NOT NULL",
)
def require_key(spark, sf):
    df = table(spark, sf, "part").selectExpr(f"{_KEYS} AS v", "p_name", "p_brand")
    keyed = df.select(typing.to_long(F.col("v")).alias("cle"), "p_name", "p_brand")
    return rows.require(keyed, "cle")


_DAY = "CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END"


@register(
    "require_date",
    f"SELECT * FROM (SELECT l_orderkey, l_linenumber, {_DAY} AS jour FROM lineitem) r"
    " WHERE jour IS NOT NULL",
)
def require_date(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_DAY} AS jour")
    return rows.require(df, "jour")


_VENUES = f"SELECT {clean('stade')} AS stade, {clean('ville')} AS ville FROM ({raw_sql('matchs')}) r"


@register(
    "any_part_present",
    f"SELECT * FROM ({_VENUES}) v WHERE stade IS NOT NULL OR ville IS NOT NULL",
)
def any_part_present(spark, sf):
    df = clean_strings(raw_table(spark, sf, "matchs").select("stade", "ville"))
    return rows.require_any(df, "stade", "ville")


# ---- deduplication -------------------------------------------------------------------

_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


def _latest_line_sql(*key: str) -> str:
    others = ", ".join(c for c in _LINE_COLUMNS if c not in key)
    return (
        "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY"
        f" {', '.join(key)} ORDER BY l_shipdate DESC, {others}) = 1"
    )


@register("dedupe_single_key", _latest_line_sql("l_orderkey"))
def dedupe_single_key(spark, sf):
    return rows.latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_shipdate"])


@register("dedupe_composite_key", _latest_line_sql("l_orderkey", "l_linenumber"))
def dedupe_composite_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    return rows.latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def _order_days(spark, sf):
    return table(spark, sf, "orders").selectExpr("CAST(o_orderdate AS DATE) AS jour")


def _ship_days(spark, sf):
    return table(spark, sf, "lineitem").selectExpr("CAST(l_shipdate AS DATE) AS jour")


@register(
    "distinct_after_union",
    "SELECT CAST(o_orderdate AS DATE) AS jour FROM orders"
    " UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem",
)
def distinct_after_union(spark, sf):
    return rows.distinct_union([_order_days(spark, sf), _ship_days(spark, sf)], ["jour"])


# ---- unions --------------------------------------------------------------------------


@register(
    "union_aligned",
    "SELECT o_orderkey AS match_id, o_orderstatus AS statut, o_orderdate AS jour FROM orders"
    " UNION ALL SELECT l_orderkey, l_linestatus, l_shipdate FROM lineitem",
)
def union_aligned(spark, sf):
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderdate AS jour", "o_orderkey AS match_id", "o_orderstatus AS statut"
    )
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS match_id", "l_shipdate AS jour", "l_linestatus AS statut", "l_tax"
    )
    return rows.union_aligned([orders, lines], ["match_id", "statut", "jour"])


@register(
    "union_projected",
    "SELECT CAST(o_orderdate AS DATE) AS jour FROM orders"
    " UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem",
)
def union_projected(spark, sf):
    return rows.union_aligned([_order_days(spark, sf), _ship_days(spark, sf)], ["jour"])


# ---- order, limit, routing -----------------------------------------------------------


@register(
    "order_by_key",
    "SELECT DISTINCT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_id FROM lineitem"
    " ORDER BY date_id",
)
def order_by_key(spark, sf):
    days = rows.distinct_union([_ship_days(spark, sf)], ["jour"])
    return days.select(calendar.date_key(F.col("jour")).alias("date_id")).orderBy("date_id")


@register(
    "top_n_request",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
    " ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def top_n_request(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows.top_n(orders, 100, F.col("o_totalprice").desc(), F.col("o_orderkey"))


@register(
    "status_split",
    f"SELECT match_id, statut, upper(trim(statut, ' ')) IN ('FINISHED', 'IN_PLAY', 'PAUSED',"
    f" 'SUSPENDED', 'AWARDED') AS joue FROM ({raw_sql('matchs')}) r",
)
def status_split(spark, sf):
    played, upcoming = rows.split_by_status(raw_table(spark, sf, "matchs"))
    parts = [
        df.select("match_id", "statut", F.lit(flag).alias("joue"))
        for df, flag in ((played, True), (upcoming, False))
    ]
    return rows.union_aligned(parts, ["match_id", "statut", "joue"])


