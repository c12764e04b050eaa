"""Row operators: deduplication, unions, routing, and the plans they get."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gradin.operators import projection, rows
from gradin.plans.football import BUTEURS, EQUIPES
from gradin.plans.silver import build_silver


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_strings_touches_text_only(spark):
    df = spark.createDataFrame([(" Null ", " null ", 1)], "a string, b string, n int")
    assert values(projection.clean_strings(df, keep=["b"])) == [(None, "null", 1)]
    assert values(projection.null_tokens(projection.trim_strings(df))) == [(None, None, 1)]


def test_latest_row_wins_and_null_keys_are_one_key(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 3), (1, "c", None), (None, "x", 1), (None, "y", 2), (2, "z", None)],
        "k int, v string, at int",
    )
    expected = [(1, "b", 3), (2, "z", None), (None, "y", 2)]
    for parts in (1, 3, 8):
        found = rows.latest_per_key(df.repartition(parts), ["k"], ["at"])
        assert values(found) == expected


def test_ties_do_not_depend_on_how_rows_are_spread(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id % 13 AS a", "id AS b")
    expected = values(rows.latest_per_key(df.coalesce(1), ["k"], ["a"]))
    for seed in (1, 2):
        shuffled = df.orderBy(F.rand(seed)).repartition(5)
        assert values(rows.latest_per_key(shuffled, ["k"], ["a"])) == expected


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(0, 10000, 1, 8).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS at")
    found = rows.latest_per_key(df, ["k"], ["at"])
    plan = plan_of(found)
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:exchange]
    assert "Partial" in plan[exchange:]
    assert found.count() == 1 + 10000 - 3334


def test_only_the_first_key_is_required(spark):
    raw = spark.createDataFrame(
        [("1", None, "2"), ("1", "null", "2"), ("x", "5", "1"), (None, "5", "1")],
        "joueur_id string, equipe_id string, buts string",
    )
    for column in BUTEURS.raw_columns:
        if column not in raw.columns:
            raw = raw.withColumn(column, F.lit(None).cast("string"))
    found = build_silver(BUTEURS, raw).select("joueur_id", "equipe_id", "buts", "buts_par_match")
    assert values(found) == [(1, None, 2, 0.0)]


def test_silver_is_typed_renamed_and_carries_lineage(spark):
    raw = spark.createDataFrame(
        [(" 7.0 ", " Équipe ", "abc", "2026-06-22 20:35:19", "f.csv")],
        "team_id string, nom string, code_tla string, derniere_maj string, _source_file string",
    )
    for column in EQUIPES.raw_columns:
        if column not in raw.columns:
            raw = raw.withColumn(column, F.lit(""))
    row = build_silver(EQUIPES, raw).first()
    assert (row.equipe_id, row.nom_equipe, row.code_tla) == (7, "Équipe", "ABC")
    assert row.derniere_maj == dt.datetime(2026, 6, 22, 20, 35, 19) and row.pays is None
    assert row._source_file == "f.csv" and row._silver_processed_timestamp is not None


def test_union_aligns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2, 9)], "v string, k int, extra int")
    assert values(rows.union_aligned([a, b], ["k", "v"])) == [(1, "x"), (2, "y")]
    assert values(rows.distinct_union([a, a], ["k"])) == [(1,)]


def test_every_row_goes_to_one_side(spark):
    df = spark.createDataFrame([("finished",), ("TIMED",), (None,), ("",)], "statut string")
    played, upcoming = rows.split_by_status(df)
    assert values(played) == [("finished",)]
    assert values(upcoming) == [("",), ("TIMED",), (None,)]


def test_filters_and_top(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (None, None)], "a int, b int")
    assert values(rows.require(df, "a")) == [(1, None)]
    assert rows.require_any(df, "a", "b").count() == 2
    top = rows.top_n(spark.range(50), 3, F.col("id").desc())
    assert [r.id for r in top.collect()] == [49, 48, 47]
    assert "TakeOrderedAndProject" in plan_of(top)
