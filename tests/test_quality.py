"""Constraint checks and repairs with seeded faults."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradin.operators import quality, repair, rules
from gradin.plans.football import FACT_BUTEUR, STAR
from gradin.spec import ForeignKey, StarTable

TABLE = StarTable(
    "fact",
    (("k", "bigint"), ("team", "bigint"), ("other", "bigint"), ("code", "varchar(3)"),
     ("ratio", "decimal(5,2)"), ("month", "int"), ("n", "int"), ("label", "string")),
    primary_key=("k",),
    foreign_keys=(
        ForeignKey("team", "dim", "id", "cascade"),
        ForeignKey("other", "dim", "id", "set null"),
    ),
    rules=(rules.in_range("month", 1, 12), rules.non_negative("n"), rules.one_of("label", ("A",))),
)
ROWS = [
    (1, 10, 10, "abc", 1.5, 1, 0, "A"),
    (1, 99, 98, "abcd", 999.99, 13, -1, "B"),
    (2, None, None, None, None, None, None, None),
    (None, 99, 10, "é€😀", 1000.0, 0, 5, "A"),
    (None, 10, 97, "x", 999.996, 12, 5, "A"),
]


@pytest.fixture(scope="module")
def frames(spark):
    kinds = "k long, team long, other long, code string, ratio double, month int, n int, label string"
    return {
        "fact": spark.createDataFrame(ROWS, kinds),
        "dim": spark.createDataFrame([(10,), (11,)], "id long"),
    }


EXPECTED = {
    "not_null(k)": 2,
    "max_length(code,3)": 1,
    "numeric(ratio,5,2)": 2,
    "range(month,1,12)": 2,
    "non_negative(n)": 1,
    "enum(label)": 1,
    "primary_key(k)": 1,
    "foreign_key(team)": 2,
    "foreign_key(other)": 2,
}


def test_report_counts_every_rule(frames):
    report = quality.constraint_report([TABLE], frames)
    assert {r.rule: r.violations for r in report.collect()} == EXPECTED


def test_violations_add_up_to_the_report(frames):
    found = quality.violations(TABLE, frames)
    by_rule = {r.rule: r.n for r in found.groupBy("rule").agg(F.sum("rows").alias("n")).collect()}
    assert by_rule == {**EXPECTED, "primary_key(k)": 2}
    lost = found.where("rule = 'foreign_key(team)'").collect()
    assert [(r.key, r.rows) for r in lost] == [("99", 2)]
    wide = found.where("rule = 'max_length(code,3)'").first()
    assert (wide.key, wide.detail) == ("1", "4")


def test_empty_tables_still_report_every_rule(spark, frames):
    empty = {"fact": frames["fact"].limit(0), "dim": frames["dim"].limit(0)}
    report = quality.constraint_report([TABLE], empty)
    assert {r.rule: r.violations for r in report.collect()} == dict.fromkeys(EXPECTED, 0)


def test_require_clean(frames):
    with pytest.raises(ValueError, match=r"fact: foreign_key\(other\) broken 2 times"):
        quality.require_clean(quality.constraint_report([TABLE], frames))
    fine = {"fact": frames["fact"].where("k = 2"), "dim": frames["dim"]}
    quality.require_clean(quality.constraint_report([TABLE], fine))


def test_keys_are_grouped_before_a_large_anti_join(spark):
    """With a parent too large to broadcast the child's rows are not shuffled one by one."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        child = spark.range(1000).selectExpr("IF(id % 3 = 0, 0, id) AS fk")
        parent = spark.range(1, 990).selectExpr("id AS pk")
        lost = quality.orphan_counts(child, ["fk"], parent, "pk")
        plan = lost._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Join") < plan.index("HashAggregate")
        assert plan.count("Exchange hashpartitioning(key") == 2
        found = {r.key: r.fk for r in lost.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found[0] == 334 and set(found) == {0} | {i for i in range(990, 1000) if i % 3}


def repaired(df):
    return sorted(((r.k, r.team, r.other) for r in df.collect()), key=str)


REPAIRED = [(1, 10, 10), (2, None, None), (None, 10, None)]


def test_repair_cascades_and_sets_null(frames):
    assert repaired(repair.repair(TABLE, frames)) == REPAIRED


def test_a_hot_key_is_split_where_a_broadcast_is_too_large(spark):
    """Without a broadcast, adaptive execution splits the partition of the hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        child = spark.range(0, 300000, 1, 8).selectExpr("id AS k", "IF(id % 3 = 0, 7, id) AS fk")
        parent = spark.range(0, 300000, 2).selectExpr("id AS pk")
        keys = [ForeignKey("fk", "parent", "pk", "set null")]
        found = repair.orphans_set_null(child, keys, parent)
        known = found.where("fk IS NOT NULL")
        assert found.count() == 300000
        rows = known.collect()
        plan = known._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "skew=true" in plan
    assert len(rows) == sum(1 for i in range(300000) if i % 3 and i % 2 == 0)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_beyond_the_parents_type_are_orphans(spark, tmp_path, ansi):
    """4294967297 would be 1 as an INT."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        child = spark.createDataFrame([(1, 1), (2, 4294967297), (3, None)], "k long, fk long")
        parent = spark.createDataFrame([(1,), (2,)], "pk int")
        keys = [ForeignKey("fk", "parent", "pk", "set null")]
        found = quality.check_foreign_keys(child, "child", keys, parent).collect()
        assert [(r.key, r.rows) for r in found] == [("4294967297", 1)]
        scratch = str(tmp_path / "scratch")
        nulled = repair.orphans_set_null(child, keys, parent, scratch).collect()
        assert {(r.k, r.fk) for r in nulled} == {(1, 1), (2, None), (3, None)}
        left = repair.orphans_cascade(child, keys, parent, scratch).collect()
        assert {r.k for r in left} == {1, 3}
        assert len(list((tmp_path / "scratch").iterdir())) == 2
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_defaults_fill_columns_that_are_left_out(spark):
    df = spark.createDataFrame([(1, 2, None)], "joueur_id long, equipe_id long, buts int")
    row = repair.apply_defaults(df, FACT_BUTEUR).first()
    assert (row.buts, row.assists, float(row.buts_par_match), row.derniere_maj) == (None, 0, 0.0, None)


def test_conform_casts_to_declared_types(spark, frames):
    found = repair.conform(frames["fact"], TABLE)
    assert dict(found.dtypes)["ratio"] == "decimal(5,2)"
    values = [r.ratio for r in found.collect()]
    assert [None if v is None else float(v) for v in values] == [1.5, 999.99, None, None, None]


def test_the_star_declares_what_the_warehouse_does():
    assert sum(len(t.foreign_keys) for t in STAR.values()) == 9
    lengths = [k for t in STAR.values() for _, k in t.columns if k.startswith("varchar")]
    assert len(lengths) == 9 + 5 + 2 + 2 + 4 + 0 + 2


def test_row_checks_stay_in_one_stage_and_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id AS k", "id - 2 AS n", "id % 14 AS month").write.parquet(path)
    checks = [rules.non_negative("n"), rules.in_range("month", 1, 12)]
    found = quality.check_rows(spark.read.parquet(path), "t", ["k"], checks)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "LessThan(n,0)" in plan.split("PushedFilters")[1]
    assert found.count() == sum((i < 2) + (i % 14 in (0, 13)) for i in range(100))
