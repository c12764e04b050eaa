"""Reads of the star: results on small tables, and the plans they are built for."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradin.operators import reads
from gradin.operators.numbering import numbered
from gradin.operators.ranges import in_ranges, range_of
from gradin.operators.ranking import first_rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set settings for one test."""
    before = {}

    def put(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Facts and dimensions as files; some facts point at nothing, or have no key."""
    root = str(tmp_path_factory.mktemp("star"))
    none = F.lit(None).cast("bigint")
    facts = spark.range(4000).select(
        F.col("id").alias("match_id"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 50).otherwise(none).alias("equipe_domicile_id"),
        (F.col("id") % 60).alias("equipe_exterieur_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(none).alias("vainqueur_equipe_id"),
        (F.col("id") % 7).cast("int").alias("stade_id"),
        (F.lit(20240100) + F.col("id") % 28).cast("int").alias("date_id"),
        F.when(F.col("id") % 4 != 0, F.lit("FINISHED")).when(F.col("id") % 8 == 0, F.lit("TIMED")).alias("statut"),
        (F.col("id") % 4 != 0).alias("is_match_joue"),
        (F.col("id") % 5).cast("int").alias("total_buts"),
        F.concat(F.lit("C"), (F.col("id") % 3).cast("string")).alias("competition"),
    )
    tables = {
        "fact": facts,
        "teams": spark.range(50).selectExpr("id AS equipe_id", "'T' || id AS nom_equipe", "'P' || id % 4 AS pays"),
        "venues": spark.range(6).selectExpr("CAST(id AS INT) AS stade_id", "'S' || id AS nom_stade", "'V' AS ville"),
        "days": spark.range(28).selectExpr(
            "CAST(20240100 + id AS INT) AS date_id", "DATE'2024-01-01' AS date_complete", "CAST(id % 12 AS INT) AS mois",
            "CAST(2024 + id % 2 AS INT) AS annee",
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in tables}


@pytest.mark.parametrize("large", [False, True])
def test_facts_meet_their_dimensions(star, large):
    roles = reads.match_roles(star["teams"], star["venues"], star["days"])
    found = reads.star_read(star["fact"], roles, large).collect()
    assert len(found) == 4000
    for r in found:
        home = r.equipe_domicile_id
        assert r.domicile == (None if home is None else f"T{home}")
        assert r.exterieur == (f"T{r.equipe_exterieur_id}" if r.equipe_exterieur_id < 50 else None)
        assert r.vainqueur == (None if r.vainqueur_equipe_id is None else f"T{r.vainqueur_equipe_id}")
        assert r.nom_stade == (f"S{r.stade_id}" if r.stade_id < 6 else None)
        assert r.annee == 2024 + (r.date_id - 20240100) % 2


def test_small_dimensions_do_not_shuffle_the_fact(star):
    roles = reads.match_roles(star["teams"], star["venues"], star["days"])
    read = reads.star_read(star["fact"], roles)
    assert "Exchange hashpartitioning" not in plan(read)


def test_large_dimensions_shuffle_the_fact_once(star, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    roles = reads.match_roles(star["teams"], star["venues"], star["days"])

    def shuffles_of_facts(df) -> int:
        """Exchanges above the scan that has the fact's own columns."""
        lines = plan(df).split("\n")
        return sum(
            "Exchange hashpartitioning" in line and any("competition" in x for x in lines[i + 1 : i + 4])
            for i, line in enumerate(lines)
        )

    assert shuffles_of_facts(reads.star_read(star["fact"], roles, large=True)) == 1
    assert shuffles_of_facts(reads.star_read(star["fact"], roles)) >= 1


def test_a_condition_on_a_dimension_filters_the_fact_before_its_shuffle(star, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
        spark__sql__optimizer__runtime__bloomFilter__enabled="true",
    )
    roles = reads.match_roles(star["teams"], star["venues"], star["days"], {"home": F.col("pays") == "P1"})
    read = reads.star_read(star["fact"], roles)
    assert "might_contain" in plan(read)
    expected = star["fact"].where("equipe_domicile_id % 4 = 1").count()
    assert read.count() == expected
    assert reads.star_read(star["fact"], roles, large=True).count() == expected
    with pytest.raises(ValueError, match="no role"):
        reads.match_roles(star["teams"], star["venues"], star["days"], {"coach": F.lit(True)})


def test_only_the_folders_and_days_of_a_status_are_read(spark, star, settings, tmp_path):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="12")
    path = f"{tmp_path}/by_status"
    reads.write_by_status(star["fact"], path)
    read = reads.matches_by_status(spark, path, "FINISHED", (20240103, 20240104))
    files = spark.read.parquet(path).where("statut = 'FINISHED'").inputFiles()
    opened = read.select("_metadata.file_path").distinct().collect()
    assert "PartitionFilters: [isnotnull(statut" in plan(read) and "PushedFilters" in plan(read)
    assert all("statut=FINISHED" in r.file_path for r in opened)
    # the common status is spread over files, and these hold few days each
    assert len(files) >= 6 and len(opened) <= 3
    expected = star["fact"].where("statut = 'FINISHED' AND date_id BETWEEN 20240103 AND 20240104")
    assert read.count() == expected.count() > 0
    assert spark.read.parquet(path).count() == 4000


def test_bucketed_tables_join_and_count_without_a_shuffle(spark, star, settings, tmp_path):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    players = spark.range(500).selectExpr(
        "id AS joueur_id", "id % 55 AS equipe_id", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'Defence' END AS position",
        "DATE'1990-01-01' AS date_naissance", "CAST(id % 23 AS INT) AS numero_maillot",
    )
    players = reads.write_bucketed(players, "players_test", f"{tmp_path}/players", ["equipe_id"], ["position"], 4)
    teams = reads.write_bucketed(star["teams"], "teams_test", f"{tmp_path}/teams", ["equipe_id"], [], 4)
    found = reads.players_by_team(players, teams)
    assert "Exchange" not in plan(found)
    rows = Counter((i % 55, None if i % 3 == 0 else "Defence") for i in range(500) if i % 55 < 50)
    assert {(r.equipe_id, r.position): r.joueurs for r in found.collect()} == rows
    spark.sql("DROP TABLE players_test")
    spark.sql("DROP TABLE teams_test")


def _ranks(rows, key):
    """SQL's rank() by a key that puts the best first."""
    return {i: 1 + sum(key(o) < key(r) for o in rows) for i, r in enumerate(rows)}


def test_ties_with_the_last_are_all_there(spark):
    draw = random.Random(1)
    rows = [(draw.choice(["a", None, "b"]), draw.choice([None, 1, 2, 3]), i) for i in range(300)]
    rows += [("tied", 7, i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(7)
    found = {(r.id, r.g): r["rank"] for r in reads.first_with_ties(df, ["g"], {"v": False}, 3).collect()}
    expected = {}
    for g in ("a", None, "b", "tied"):
        own = [r for r in rows if r[0] == g]
        for i, rank in _ranks(own, lambda r: (r[1] is None, -(r[1] or 0))).items():
            if rank <= 3:
                expected[own[i][2], g] = rank
    assert found == expected
    assert sum(g == "tied" for _, g in found) == 200


def test_ranks_of_whole_groups(spark):
    draw = random.Random(2)
    rows = [(draw.choice(["a", None]), draw.choice([None, 1, 2, 3]), draw.randrange(4), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v int, w bigint, id int").repartition(5)
    found = {r.id: r["rank"] for r in reads.ranked(df, ["g"], {"v": False, "w": True}).collect()}
    for g in ("a", None):
        own = [r for r in rows if r[0] == g]
        ranks = _ranks(own, lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        assert {own[i][3]: rank for i, rank in ranks.items()} == {r[3]: found[r[3]] for r in own}
    assert reads.ranked(df.limit(0), ["g"], {"v": False}).count() == 0
    with pytest.raises(ValueError, match="no number"):
        reads.ranked(df, [], {"g": False})


def test_a_hot_group_is_numbered_by_many_tasks(spark, tmp_path):
    """Two thirds of the rows are one group: its rows lie in several of the ranges that are numbered."""
    rows = spark.range(30000).selectExpr("CASE WHEN id % 3 < 2 THEN 'hot' ELSE 'g' || id % 100 END AS g", "id % 7 AS v", "id")
    rows.write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    out = numbered(df, ["g"], ["v", "id"], "at", "n")
    tasks = out.where("g = 'hot'").select("_metadata.file_path") if "_metadata" in out.columns else None
    assert tasks is None
    got = out.groupBy("g").agg(F.count_distinct("at").alias("k"), F.max("at").alias("m"), F.max("n").alias("n"), F.count("*").alias("c"))
    assert all(r.k == r.c == r.n == r.m + 1 for r in got.collect())
    order = [(r.v, r.id) for r in out.where("g = 'hot'").orderBy("at").collect()]
    assert order == sorted(order)
    # the only exchanges of rows are by range; the windows see counts alone
    text = plan(out)
    assert not re.search(r"Window .*\[_at", text)
    with pytest.raises(ValueError, match="already there"):
        numbered(df.withColumn("_at", F.lit(1)), [], ["id"])


def test_weights_are_summed_up(spark, tmp_path):
    spark.range(1000).selectExpr("id % 3 AS g", "id", "id % 5 AS w").repartition(6).write.parquet(f"{tmp_path}/w")
    out = numbered(spark.read.parquet(f"{tmp_path}/w"), ["g"], ["id"], "before", weight="w").collect()
    for g in range(3):
        own = sorted((r.id, r.w, r.before) for r in out if r.g == g)
        assert [b for _, _, b in own] == list(np.cumsum([0] + [w for _, w, _ in own])[:-1])


def test_first_rows_beyond_the_planner_s_own_limit(spark):
    df = spark.range(20000).selectExpr("id % 2 AS g", "id * 7919 % 20011 AS v", "id").repartition(9)
    found = first_rows(df, ["g"], [F.col("v").desc(), F.col("id")], 1500)
    for g in (0, 1):
        expected = sorted((-(i * 7919 % 20011), i) for i in range(20000) if i % 2 == g)[:1500]
        got = sorted((r["rank"], -r.v, r.id) for r in found.where(F.col("g") == g).collect())
        assert [(v, i) for _, v, i in got] == expected and [n for n, _, _ in got] == list(range(1, 1501))
    with pytest.raises(ValueError, match="must be free"):
        first_rows(df.withColumn("_part", F.lit(1)), ["g"], ["v"], 3)


def test_ranges_depend_on_the_rows_alone(spark, settings):
    df = spark.range(20000).selectExpr(
        "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 < 3 THEN 7 ELSE id END AS a", "xxhash64(id) AS b", "1 + id % 9 AS n"
    )
    seen = []
    for parts, shuffles, adaptive in ((3, "4", "true"), (8, "13", "false")):
        settings(spark__sql__shuffle__partitions=shuffles, spark__sql__adaptive__enabled=adaptive)
        out = in_ranges(df.repartition(parts), "a", "b", "n", 10000)
        seen.append({(r.a, r.b): r["range"] for r in out.collect()})
    assert seen[0] == seen[1]
    sizes = Counter(seen[0].values())
    assert len(sizes) >= 8 and max(sizes.values()) < 5000  # the one id and the nulls are split as well
    order = sorted(seen[0], key=lambda k: (k[0] is not None, k[0] or 0, k[1]))
    ranges = [seen[0][k] for k in order]
    assert ranges == sorted(ranges)
    assert {r["range"] for r in in_ranges(df.limit(0), "a", "b", "n", 10).collect()} == set()


def test_a_range_is_how_many_bounds_are_reached():
    bounds = (np.array([1, 5, 5, 9]), np.array([0, 3, 7, 2]))
    pairs = [(0, 9), (1, -1), (1, 0), (5, 2), (5, 3), (5, 6), (5, 7), (9, 1), (9, 2), (10, 0)]
    expected = [sum((a, b) >= bound for bound in zip(*bounds)) for a, b in pairs]
    assert range_of(*map(np.array, zip(*pairs)), bounds).tolist() == expected


def test_roll_up_expands_aggregated_rows(star):
    found = reads.calendar_rollup(star["fact"], star["days"])
    rows = {(r.level, r.annee, r.mois): r for r in found.collect()}
    facts = star["fact"].collect()
    top = rows["all", None, None]
    assert (top.matchs, top.joues) == (4000, 3000)
    assert top.equipes == len({f.equipe_domicile_id for f in facts} - {None}) and top.competitions == 3
    text = plan(found)
    expand = text.index("Expand")
    assert "HashAggregate(keys=[date_id" in text[expand:]  # the fact is aggregated below the expansion
    assert "partial_count" in text[expand:]


def test_changes_between_two_tables(spark):
    kind = "k int, a string, b int"
    old = spark.createDataFrame(
        [(1, "x", 1), (2, None, 2), (3, "y", None), (None, "n", 1), (4, "t", 4), (4, "u", 5), (6, "z", 0), (7, "v", 1)], kind
    )
    new = spark.createDataFrame(
        [(1, "x", 1), (2, "", 2), (3, "y", 0), (None, "n", 1), (4, "u", 5), (4, "t", 4), (5, "w", 1), (7, "v", 1), (7, "v", 1)],
        kind,
    )
    found = {r.k: (r.change, r.differs) for r in reads.changes(old, new, ["k"]).collect()}
    assert found == {
        2: ("changed", ["a"]), 3: ("changed", ["b"]), 5: ("inserted", []), 6: ("deleted", []), 7: ("changed", ["a", "b"]),
    }
    assert reads.changes(old, old, ["k"]).count() == 0
    assert reads.changes(old.limit(0), old.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError, match="not on both sides"):
        reads.changes(old, new.withColumn("c", F.lit(1)), ["k"])
