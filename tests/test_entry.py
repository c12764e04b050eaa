"""The command line and the entry points."""

from __future__ import annotations

import json

import pytest
from test_layers import DOCUMENTS

import __spark_entry__
from gradin import __main__ as command
from gradin.plans.football import STAR
from gradin.queries import ORACLES, QUERIES
from gradin.sources import snapshot


def test_steps_run_one_at_a_time(spark, tmp_path):
    for kind, docs in DOCUMENTS.items():
        (tmp_path / "json" / kind).mkdir(parents=True)
        (tmp_path / "json" / kind / "d.json").write_text("\n".join(map(json.dumps, docs)))
    folders = [
        "--documents", f"{tmp_path}/json", "--landing", f"{tmp_path}/DATA", "--out", f"{tmp_path}/out",
    ]
    for step in ("extract", "bronze", "silver", "gold"):
        command.run(spark, command.arguments([*folders, "--strict", step]))
    counts = {t: snapshot.read_layer(spark, f"{tmp_path}/out", "gold", t).count() for t in STAR}
    assert counts == {
        "dim_equipe": 3, "dim_joueur": 3, "dim_stade": 2, "dim_date": 3,
        "fact_match": 5, "fact_buteur": 2, "fact_classement": 3,
    }


def test_publishing_takes_the_password_from_the_environment(spark, tmp_path, monkeypatch):
    calls = []
    monkeypatch.setattr(command, "publish_star", lambda *given: calls.append(given))
    monkeypatch.setattr(command.layers, "read_tables", lambda *given: {"t": None})
    monkeypatch.setenv("DB_SECRET", "s")
    command.run(spark, command.arguments([
        "--out", "o", "--jdbc-url", "jdbc:x", "--jdbc-option", "user=u",
        "--jdbc-password-env", "DB_SECRET", "--jdbc-partitions", "8", "publish",
    ]))
    assert calls == [({"t": None}, "jdbc:x", {"user": "u", "password": "s"}, "public", 8)]


def test_a_step_names_what_it_needs(capsys):
    with pytest.raises(SystemExit):
        command.arguments(["--landing", "x", "bronze"])
    assert "bronze needs --out" in capsys.readouterr().err


def test_entry_points(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns[0] == "match_id" and df.limit(5).count() == 5
    assert set(QUERIES) == set(ORACLES)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
