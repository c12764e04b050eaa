"""What a layered run leaves on the disk while it runs."""

from __future__ import annotations

import os
import shutil
import time
from functools import partial

import pytest
from pyspark.sql import functions as F
from test_layers import landed  # noqa: F401

from gradin.plans import layers
from gradin.queries import QUERIES
from gradin.session import RELEASE, shared_root, shuffles_released
from gradin.sources import snapshot, store


def shuffle_files(spark) -> set[str]:
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f for top in folders for _, _, files in os.walk(top) for f in files if f.startswith("shuffle_")}


def test_a_write_removes_its_shuffle_files(spark, tmp_path):
    df = spark.range(10_000, numPartitions=4).groupBy((F.col("id") % 99).alias("k")).count()
    before = shuffle_files(spark)
    layers.together(spark, [partial(snapshot.write_snapshot, df, str(tmp_path / n)) for n in "ab"])
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.read.parquet(str(tmp_path / "b")).count() == 99


def test_the_setting_is_put_back(spark):
    assert spark.conf.get(RELEASE, None) is None
    with pytest.raises(OSError, match="lost"), shuffles_released(spark):
        with shuffles_released(spark):
            assert spark.conf.get(RELEASE) == "true"
        assert spark.conf.get(RELEASE) == "true"
        raise OSError("lost")
    assert spark.conf.get(RELEASE, None) is None


def test_snapshots_are_in_zstd(spark, tmp_path):
    snapshot.write_snapshot(spark.range(5), str(tmp_path / "t"))
    written = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]
    assert written and all(name.endswith(".zstd.parquet") for name in written)


def test_large_tables_take_turns_and_small_ones_share_them(spark):
    tables = {n: spark.range(100, numPartitions=n) for n in (1, 2, 3, 9, 20)}
    assert layers.in_turns(tables, 8) == [[20], [9], [3, 2, 1]]
    assert layers.in_turns(tables, 40) == [[20, 9, 3, 2, 1]]
    assert layers.in_turns({}, 8) == []


def test_landing_files_go_once_bronze_is_published(spark, landed, tmp_path):  # noqa: F811
    def rows(tables):
        return {n: sorted(map(str, df.collect())) for n, df in tables.items()}

    own = shutil.copytree(landed, str(tmp_path / "landed"))
    kept = layers.run_layers(spark, landed, str(tmp_path / "a"), "run-1")
    assert store.exists(spark, landed)
    out = str(tmp_path / "b")
    gone = layers.run_layers(spark, own, out, "run-1", consume=True)
    assert not store.exists(spark, own) and rows(gone) == rows(kept)
    assert rows(layers.run_layers(spark, own, out, "run-1", consume=True)) == rows(kept)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Orders and their lines, with nulls and rows that come twice."""
    root = str(tmp_path_factory.mktemp("tables"))
    day = "CAST(timestamp_seconds(883612800 + id * 86400) AS TIMESTAMP_NTZ)"
    orders = spark.range(60).selectExpr(
        "id AS o_orderkey",
        "id % 7 AS o_custkey",
        "substr('FOP', CAST(id % 3 + 1 AS INT), 1) AS o_orderstatus",
        f"CASE WHEN id % 11 <> 0 THEN {day} END AS o_orderdate",
        "CASE WHEN id % 5 <> 0 THEN '1-URGENT' END AS o_orderpriority",
    )
    lines = spark.range(200).selectExpr(
        "id % 60 AS l_orderkey", "id % 13 AS l_partkey", "id % 4 AS l_suppkey",
        "CAST(id % 5 + 1 AS INT) AS l_linenumber", "CAST(id % 9 + 1 AS DOUBLE) AS l_quantity",
        "'A' AS l_returnflag", "CASE WHEN id % 3 <> 0 THEN 'F' END AS l_linestatus", f"{day} AS l_shipdate",
    )
    orders.unionAll(orders.where("o_orderkey < 9")).write.parquet(f"{root}/orders.parquet")
    lines.unionAll(lines.where("l_orderkey < 9")).write.parquet(f"{root}/lineitem.parquet")
    return root


@pytest.mark.parametrize("name", ["layered_run", "layered_resume", "layered_run_all_played"])
def test_layered_queries_leave_no_landing_files(spark, small, name):
    before = set(store.names(spark, shared_root(spark)))
    assert QUERIES[name](spark, small).count() > 0
    left = set(store.names(spark, shared_root(spark))) - before
    assert any("layers" in n for n in left) and not any("landing" in n for n in left)
