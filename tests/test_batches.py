"""Batches that are there once and whole: ledger, key map, publishing, resumed runs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from test_layers import DOCUMENTS

from gradin.operators.keymap import KeyMap
from gradin.plans import layers
from gradin.sources import landing, ledger, snapshot, store


def test_a_batch_sent_twice_is_read_once(spark, tmp_path):
    root = str(tmp_path / "appended")
    rows = spark.createDataFrame([("1", "a"), ("2", None)], "id string, nom string")
    assert ledger.read_csv(spark, root, ["id", "nom"]).count() == 0
    assert ledger.append_csv_once(rows, root, ["id", "nom"], "b/1 %25")
    assert not ledger.append_csv_once(rows, root, ["id", "nom"], "b/1 %25")
    assert ledger.append_csv_once(rows, root, ["id", "nom"], "b2")
    assert sorted(map(tuple, ledger.read_csv(spark, root, ["id", "nom"]).collect()), key=str) == sorted(
        [("1", "a"), ("2", None)] * 2, key=str
    )
    assert list(ledger.batches(spark, root)) == ["b/1 %25", "b2"]


def test_what_failed_before_its_commit_is_not_read(spark, tmp_path):
    root = str(tmp_path / "appended")
    rows = spark.createDataFrame([("1",)], "id string")

    def fails(path):
        landing.write_csv(rows, path, ["id"])
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        ledger.append_once(spark, root, "b1", fails)
    assert ledger.read_csv(spark, root, ["id"]).count() == 0
    assert ledger.append_csv_once(rows, root, ["id"], "b1")
    assert ledger.read_csv(spark, root, ["id"]).count() == 1


def test_of_two_that_append_one_batch_one_counts(spark, tmp_path):
    root = str(tmp_path / "appended")
    rows = spark.createDataFrame([("1",)], "id string")
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda _: ledger.append_csv_once(rows, root, ["id"], "b"), range(4)))
    assert sum(done) == 1 and ledger.read_csv(spark, root, ["id"]).count() == 1


def test_keys_stay_and_new_values_follow(spark, tmp_path):
    keys = KeyMap(spark, str(tmp_path / "keys"), ["stade", "ville"])
    first = [("s", "a"), ("s", None), (None, "a"), (None, None), ("s", "a"), ("", "a")]
    kind = "stade string, ville string"
    one = {tuple(r)[1:]: r.key for r in keys.assign(spark.createDataFrame(first, kind)).collect()}
    assert sorted(one.values()) == [1, 2, 3, 4] and (None, None) not in one
    second = spark.createDataFrame([(f"s{i % 90}", "b") for i in range(1000)] + [("s", None)], kind)
    two = {tuple(r)[1:]: r.key for r in keys.assign(second.repartition(5)).collect()}
    assert {k: two[k] for k in one} == one
    assert sorted(two.values()) == list(range(1, 95))
    again = {tuple(r)[1:]: r.key for r in keys.assign(second).collect()}
    assert again == two and len(ledger.batches(spark, keys.root)) == 2
    rows = keys.keyed(spark.createDataFrame([("s", None), (None, None), ("x", "y")], kind)).collect()
    assert {(r.stade, r.ville): r.key for r in rows} == {("s", None): one["s", None], (None, None): None, ("x", "y"): None}


def test_keys_of_two_that_assign_at_once(spark, tmp_path):
    keys = KeyMap(spark, str(tmp_path / "keys"), ["v"])
    frames = [spark.createDataFrame([(f"{n}-{i}",) for i in range(50)] + [("both",)], "v string") for n in range(3)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(keys.assign, frames))
    rows = keys.read().collect()
    assert len(rows) == len({r.key for r in rows}) == len({r.v for r in rows}) == 151


def test_publishers_never_share_a_number(spark, tmp_path):
    out = str(tmp_path / "layers")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: snapshot.publish(spark, out, "silver", f"b{n}"), range(4)))
    files = sorted((tmp_path / "layers" / "silver" / "published").glob("0*"))
    assert [int(f.name) for f in files] == [0, 1, 2, 3]
    assert sorted(f.read_text() for f in files) == ["b0", "b1", "b2", "b3"]
    assert snapshot.published(spark, out, "silver") == files[-1].read_text()
    snapshot.publish(spark, out, "silver", "b1")
    assert snapshot.published(spark, out, "silver") == "b1"
    assert snapshot.is_published(spark, out, "silver", "b2") and not snapshot.is_published(spark, out, "gold", "b2")


def test_old_batches_are_removed(spark, tmp_path):
    out = str(tmp_path / "layers")
    for n in range(4):
        layers.write_layer(spark, out, "silver", {"t": spark.range(n + 1)}, f"b{n}")
        if n != 2:
            snapshot.publish(spark, out, "silver", f"b{n}")
    assert snapshot.remove_old(spark, out, "silver", keep=2) == ["b0"]
    assert not store.exists(spark, f"{out}/silver/b0") and store.exists(spark, f"{out}/silver/b2")
    assert snapshot.read_layer(spark, out, "silver", "t").count() == 4
    assert snapshot.read_layer(spark, out, "silver", "t", "b1").count() == 2
    assert snapshot.remove_old(spark, out, "gold") == []


def test_a_run_that_failed_in_gold_goes_on_there(spark, tmp_path, monkeypatch):
    import json

    for kind, docs in DOCUMENTS.items():
        (tmp_path / "json" / kind).mkdir(parents=True)
        (tmp_path / "json" / kind / "d.json").write_text("\n".join(map(json.dumps, docs)))
    landed, out = f"{tmp_path}/DATA", f"{tmp_path}/out"
    layers.extract(layers.read_source_documents(spark, f"{tmp_path}/json"), landed)

    def lost(*given):
        raise OSError("lost in gold")

    with monkeypatch.context() as patch:
        patch.setattr(layers, "key_report", lost)
        with pytest.raises(OSError, match="lost in gold"):
            layers.run_layers(spark, landed, out, "run")
    assert snapshot.published(spark, out, "gold") is None
    ran = []
    for name in ("ingest_bronze", "run_silver", "run_gold"):
        monkeypatch.setattr(layers, name, lambda *given, _n=name, _f=getattr(layers, name): ran.append(_n) or _f(*given))
    # another run publishes meanwhile: the resumed one reads its own tables
    empty = {t: df.limit(0) for t, df in layers.read_tables(spark, out, "silver", layers.SILVER).items()}
    layers.write_layer(spark, out, "silver", empty, "other")
    snapshot.publish(spark, out, "silver", "other")
    gold = layers.run_layers(spark, landed, out, "run")
    assert ran == ["run_gold"] and gold["dim_equipe"].count() == 3
    again = layers.run_layers(spark, landed, out, "run")
    assert ran == ["run_gold"] and again["dim_equipe"].count() == 3


def test_venues_keep_their_keys_from_batch_to_batch(spark, tmp_path):
    import json

    for kind, docs in DOCUMENTS.items():
        (tmp_path / "json" / kind).mkdir(parents=True)
        (tmp_path / "json" / kind / "d.json").write_text("\n".join(map(json.dumps, docs)))
    landed, out = f"{tmp_path}/DATA", f"{tmp_path}/out"
    layers.extract(layers.read_source_documents(spark, f"{tmp_path}/json"), landed)
    one = layers.run_layers(spark, landed, out, "one", key_map=True)
    first = {(r.nom_stade, r.ville): r.stade_id for r in one["dim_stade"].collect()}
    assert sorted(first.values()) == list(range(1, len(first) + 1))
    assert dict(one["fact_match"].dtypes)["stade_id"] == "bigint"
    assert {r.stade_id for r in one["fact_match"].collect()} <= {*first.values(), None}
    matches = layers.read_tables(spark, out, "silver", layers.SILVER, "one")
    more = matches | {"matchs_joues": matches["matchs_joues"].replace(list({k[1] for k in first if k[1]}), "A first city", "ville")}
    layers.write_layer(spark, out, "silver", more, "two")
    snapshot.publish(spark, out, "silver", "two")
    two = layers.run_gold(spark, out, batch_id="two", source="two", key_map=True)
    second = {(r.nom_stade, r.ville): r.stade_id for r in two["dim_stade"].collect()}
    assert all(second[k] == first[k] for k in set(first) & set(second))
    assert min(second[k] for k in set(second) - set(first)) > max(first.values())
