"""Files in and out, and the options of a warehouse load."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gradin.session import scratch_path
from gradin.sources import documents, landing, lineage, snapshot, warehouse


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_landing_files_with_mark_quotes_and_blanks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(
        '﻿id,nom,x\r\n1,"a,""b""",\r\n2, é ,""\r\n'.encode()
    )
    (tmp_path / "b.csv").write_bytes("﻿id,nom,x\n3,c,2.0\n".encode())
    expected = [("1", 'a,"b"', None), ("2", " é ", None), ("3", "c", "2.0")]
    for columns in (["id", "nom", "x"], None):
        df = landing.read_raw_csv(spark, str(tmp_path / "*.csv"), columns)
        assert df.columns == ["id", "nom", "x"]
        assert {kind for _, kind in df.dtypes} == {"string"}
        assert values(df) == expected


def test_a_wrong_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,autre\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.read_raw_csv(spark, str(tmp_path), ["id", "nom"]).collect()


def test_short_and_long_rows_are_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,nom\n1\n2,b,extra\n3,c\n")
    assert values(landing.read_raw_csv(spark, str(tmp_path), ["id", "nom"])) == [("3", "c")]
    bad = landing.rejected_rows(spark, str(tmp_path), ["id", "nom"])
    assert sorted(r.record for r in bad.collect()) == ["1", "2,b,extra"]
    assert bad.first().file.endswith("a.csv")


@pytest.mark.parametrize("text", ["a\nb", "\r\n", "\\n", "\\\\r\n", "x\\", "\\\\", "n\\\nr", "c:\\new"])
def test_line_breaks_survive_a_round_trip(spark, tmp_path, text):
    path = str(tmp_path / "out")
    landing.write_csv(spark.createDataFrame([(text, "z")], "a string, b string"), path, ["a", "b"])
    assert values(landing.read_raw_csv(spark, path, ["a", "b"])) == [(text, "z")]
    assert values(landing.read_raw_csv(spark, path)) == [(text, "z")]


def test_groups_that_look_like_numbers_stay_texts(spark, tmp_path):
    df = spark.createDataFrame([("007", "a"), ("1e2", "b")], "g string, v string")
    landing.write_csv_per_group(df, str(tmp_path / "out"), ["v"], "g")
    back = landing.read_raw_csv(spark, str(tmp_path / "out"), ["v"], folder="g_folder")
    assert values(back) == [("a", "007"), ("b", "1e2")]


def test_damaged_documents_fail_or_are_rejected(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/d.json").write_text('{"teams": [{"id": 1}]}\n{"teams": [{"id"\n{\n"teams": []\n}\n')
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        documents.read_documents(spark, str(tmp_path / "in"), documents.TEAMS).collect()
    rejects = str(tmp_path / "rejects")
    docs = documents.read_documents(spark, str(tmp_path / "in"), documents.TEAMS, rejects)
    assert [d.teams[0].id for d in docs.collect()] == ["1"]
    assert spark.read.parquet(rejects).count() == 4


def test_damage_in_a_later_field_is_rejected(spark, tmp_path):
    """Each line is a document or rejected, whichever fields are asked for."""
    good = '{"id": "1", "name": "a", "squad": [{"id": 5}]}'
    bad = ['{"id":"2","name":"b","squad":"none listed"}', '{"id":"3","name":"c","squad":[{"id":"6"},7]}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in/d.json").write_text("\n".join([good, *bad]) + "\n")
    rejects = str(tmp_path / "rejects")
    docs = documents.read_documents(spark, str(tmp_path / "in"), documents.SQUAD, rejects)
    assert docs.columns == ["id", "name", "squad"]
    assert [(d.id, d.squad[0].id) for d in docs.collect()] == [("1", "5")]
    assert [d.id for d in docs.select("id").collect()] == ["1"] and docs.count() == 1
    found = spark.read.parquet(rejects).collect()
    assert sorted(r.record for r in found) == sorted(bad) and all(r.file.endswith("d.json") for r in found)


def test_texts_survive_a_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    texts = [(" padded ", 'say "x", y'), ("\ttab", "back\\slash"), ("", None)]
    df = spark.createDataFrame(texts, "a string, b string").withColumn("c", F.lit(1))
    landing.write_csv(df, path, ["b", "a"])
    back = landing.read_raw_csv(spark, path, ["b", "a"])
    assert values(back) == sorted([('say "x", y', " padded "), ("back\\slash", "\ttab"), (None, None)], key=str)


def test_header_only_then_appended(spark, tmp_path):
    path = str(tmp_path / "out")
    landing.write_csv(landing.empty_table(spark, ["a", "b"]), path, ["a", "b"])
    assert landing.read_raw_csv(spark, path).columns == ["a", "b"]
    assert landing.read_raw_csv(spark, path, ["a", "b"]).count() == 0
    more = spark.createDataFrame([("1", "2")], "a string, b string")
    landing.append_csv(more, path, ["a", "b"])
    landing.append_csv(more, path, ["a", "b"])
    assert values(landing.read_raw_csv(spark, path, ["a", "b"])) == [("1", "2"), ("1", "2")]


@pytest.mark.parametrize("gather", [True, False])
def test_one_folder_per_group(spark, tmp_path, gather):
    path = str(tmp_path / "out")
    df = spark.range(100).selectExpr(
        "CAST(id AS STRING) AS id", "IF(id % 3 = 0, 'a', 'b c') AS groupe"
    )
    landing.write_csv_per_group(df.repartition(4), path, ["id", "groupe"], "groupe", gather)
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert folders == ["groupe_folder=a", "groupe_folder=b c"]
    one = landing.read_raw_csv(spark, f"{path}/groupe_folder=a", ["id", "groupe"])
    assert one.count() == 34
    assert landing.read_raw_csv(spark, path, ["id", "groupe"]).count() == 100


def test_a_hot_group_is_written_by_several_tasks(spark, tmp_path):
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }
    before = {k: spark.conf.get(k) for k in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(0, 60000, 1, 8).selectExpr(
            "CAST(id AS STRING) AS id", "IF(id % 3 = 0, 'hot', CAST(id % 11 AS STRING)) AS g"
        )
        landing.write_csv_per_group(df, str(tmp_path / "out"), ["id"], "g")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = len(list((tmp_path / "out" / "g_folder=hot").glob("*.csv")))
    assert 1 < files
    assert landing.read_raw_csv(spark, str(tmp_path / "out"), ["id"]).count() == 60000


def test_lineage(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    raw = landing.read_raw_csv(spark, str(tmp_path), ["id"])
    row = lineage.with_lineage(raw.select("id"), "batch", "table.csv").first()
    assert (row._source_file, row._batch_id) == ("table.csv", "batch")
    assert row._source_path.endswith("/a.csv")
    assert abs(row._ingestion_timestamp - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=5)
    assert lineage.with_lineage(raw, "batch").first()._source_file == "a.csv"
    full = lineage.with_processed_time(lineage.with_lineage(raw, "batch"))
    assert lineage.drop_lineage(full).columns == ["id"]
    assert lineage.new_batch_id() != lineage.new_batch_id()


def test_snapshots_replace_and_are_counted(spark, tmp_path):
    root = str(tmp_path)
    for n in (5, 3):
        snapshot.write_snapshot(spark.range(n), snapshot.layer_path(root, "silver", "t"))
    back = snapshot.read_layer(spark, root, "silver", "t")
    report = snapshot.load_report({"t": back, "u": spark.range(0)})
    assert values(report) == [("t", 3), ("u", 0)]


def test_documents_from_files_and_texts(spark, tmp_path):
    text = '{"teams": [{"id": 9007199254740993, "area": null, "unknown": 1}]}'
    (tmp_path / "d.json").write_text(text + '\n{"other": 1}\n')
    for docs in (
        documents.read_documents(spark, str(tmp_path), documents.TEAMS),
        documents.parse_documents(
            spark.createDataFrame([(text,), ('{"other": 1}',)], "t string"), F.col("t"), documents.TEAMS
        ),
    ):
        assert docs.columns == ["teams"]
        found = [r.teams for r in docs.collect() if r.teams]
        assert found[0][0].id == "9007199254740993" and found[0][0].area is None


def test_scratch_paths_lie_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(root.rstrip("/") + "/")


class Recorder:
    """Stands in for a frame: no database is started for a test."""

    def __init__(self):
        self.calls = []

    @property
    def write(self):
        return self

    def options(self, **options):
        self.given = options
        return self

    def jdbc(self, **where):
        self.calls.append((where, self.given))


def test_warehouse_loads_truncate_and_keep_the_order():
    frames = {"dim_equipe": Recorder(), "fact_match": Recorder()}
    properties = {"user": "u", "driver": "org.postgresql.Driver"}
    warehouse.publish_star(frames, "jdbc:postgresql://host/db", properties, partitions=4)
    (where, options), = frames["dim_equipe"].calls
    assert where == {
        "url": "jdbc:postgresql://host/db", "table": "public.dim_equipe", "mode": "overwrite",
    }
    assert options == {
        **properties, "truncate": "true", "cascadeTruncate": "true", "numPartitions": "4",
    }
    assert warehouse.jdbc_options({}, cascade=False) == {
        "truncate": "true", "cascadeTruncate": "false",
    }
