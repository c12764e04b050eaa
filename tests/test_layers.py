"""From JSON documents to the star schema on a small invented tournament."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from gradin.operators import flatten
from gradin.operators.quality import constraint_report
from gradin.plans import layers, star
from gradin.plans.football import LANDING_COLUMNS, STAR
from gradin.sources import landing, snapshot
from gradin.sources.lineage import LINEAGE


def team(n, **more):
    return {"id": n, "name": f"Team {n}", "shortName": f"T{n}", "tla": f"t{n:02d}", **more}


def match(n, status, home, away, ft=(None, None), **more):
    return {
        "id": n,
        "competition": {"name": "Cup"},
        "matchday": 1,
        "status": status,
        "utcDate": "2026-06-11T19:00:00Z",
        "homeTeam": {"id": home, "name": f"Team {home}"},
        "awayTeam": {"id": away, "name": f"Team {away}"},
        "score": {"halfTime": {"home": 0, "away": None}, "fullTime": {"home": ft[0], "away": ft[1]}},
        "venue": None,
        "area": {"name": "World"},
        "referees": [{"name": "Réf, \"A\""}, {"name": "B"}],
        **more,
    }


def line(n, team_id, points):
    return {
        "position": n, "team": {"id": team_id, "name": f"Team {team_id}"}, "playedGames": 1,
        "won": 0, "draw": 1, "lost": 0, "goalsFor": 2, "goalsAgainst": 2,
        "goalDifference": 0, "points": points, "form": None,
    }


DOCUMENTS = {
    "teams": [
        {"teams": [
            team(1, area={"name": "Pays", "code": "pay"}, coach={"name": "C", "nationality": "N"}),
            team(2, name=""),
        ]},
        {"teams": [team(3, name=None, shortName=None), {"id": None, "name": "Nobody"}]},
        {"count": 0},
    ],
    "squads": [
        {"id": 1, "squad": [
            {"id": 11, "firstName": "Zoé", "lastName": "A", "name": "Zoé A",
             "dateOfBirth": "2000-02-29", "shirtNumber": 9},
            {"id": 12, "name": "None", "dateOfBirth": "1999"},
        ]},
        {"id": 2, "squad": [{"id": 21, "name": "B"}]},
        {"id": 3},
        {"id": 77, "squad": [{"id": 99, "name": "Of no team"}]},
    ],
    "scorers": [
        {"scorers": [
            {"player": {"id": 11, "name": "Zoé A"}, "team": {"id": 1, "name": "Team 1"},
             "goals": 7, "playedMatches": 3, "assists": None, "penalties": 1},
            {"player": {"id": 21, "name": "B"}, "team": {"id": 2}, "goals": 1, "playedMatches": 0},
        ]},
    ],
    "standings": [
        {"standings": [
            {"group": "GROUP_A", "stage": "GROUP_STAGE", "table": [line(1, 1, 1), line(2, 2, 1)]},
            {"group": None, "stage": "GROUP_STAGE", "table": [line(1, 3, 0)]},
            {"group": "GROUP_B", "table": []},
        ]},
    ],
    "matches": [
        {"matches": [
            match(101, "FINISHED", 1, 2, (2, 1)),
            match(102, "IN_PLAY", 2, 1, utcDate="2026-06-12T21:30:00+02:00", venue="Stade"),
            match(103, "FINISHED", 3, 1, (0, 3)),
            match(104, "TIMED", None, None, utcDate="TBD", referees=[], area=None),
            match(105, None, 1, 3, utcDate="2026-06-30T00:00:00Z"),
        ]},
    ],
}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("documents")
    for kind, docs in DOCUMENTS.items():
        (root / kind).mkdir()
        (root / kind / "part.json").write_text("\n".join(json.dumps(d) for d in docs))
    out = str(tmp_path_factory.mktemp("landed"))
    layers.extract(layers.read_source_documents(spark, str(root)), out)
    return out


@pytest.fixture(scope="module")
def run(spark, landed, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("layers"))
    return out, layers.run_layers(spark, landed, out, batch_id="batch-1")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_landing_tables_have_the_declared_columns(spark, landed):
    for name, columns in LANDING_COLUMNS.items():
        df = landing.read_raw_csv(spark, layers.landing_path(landed, name), columns)
        assert tuple(df.columns[: len(columns)]) == columns, name
        assert df.count() == {"equipes": 4, "joueurs": 3, "buteurs": 2, "matchs_joues": 3,
                              "matchs_non_joues": 2, "classement_group_stage": 3}[name]


def test_bronze_has_one_batch_and_declared_files(spark, run):
    out, _ = run
    for name, columns in LANDING_COLUMNS.items():
        df = snapshot.read_layer(spark, out, "bronze", name)
        assert tuple(df.columns) == (*columns, *LINEAGE[:-1])
        assert rows(df.distinct(), "_source_file", "_batch_id")[0] == (f"{name}.csv", "batch-1")


def test_dimensions(run):
    _, gold = run
    assert list(gold) == list(STAR)
    assert rows(gold["dim_equipe"], "equipe_id", "nom_equipe", "code_tla", "code_pays", "selectionneur") == [
        (1, "Team 1", "T01", "PAY", "C"),
        (2, None, "T02", None, None),
        (3, None, "T03", None, None),
    ]
    assert rows(gold["dim_joueur"], "joueur_id", "equipe_id", "nom_complet", "date_naissance", "numero_maillot") == [
        (11, 1, "Zoé A", dt.date(2000, 2, 29), 9),
        (12, 1, None, None, None),
        (21, 2, "B", None, None),
    ]
    assert rows(gold["dim_stade"], "nom_stade", "ville") == [("Stade", "World"), (None, "World")]
    assert (234213619, None, "World") in rows(gold["dim_stade"], "stade_id", "nom_stade", "ville")
    assert rows(gold["dim_date"], "date_id", "nom_jour_semaine", "semaine_annee") == [
        (20260611, "Thursday", 24),
        (20260612, "Friday", 24),
        (20260630, "Tuesday", 27),
    ]


def test_facts(run):
    _, gold = run
    found = rows(
        gold["fact_match"],
        "match_id", "date_id", "is_match_joue", "total_buts", "resultat_match",
        "vainqueur_equipe_id", "statut", "arbitre",
    )
    assert found == [
        (101, 20260611, True, 3, "HOME_WIN", 1, "FINISHED", 'Réf, "A"'),
        (102, 20260612, True, None, "DRAW", None, "IN_PLAY", 'Réf, "A"'),
        (103, 20260611, True, 3, "AWAY_WIN", 1, "FINISHED", 'Réf, "A"'),
        (104, None, False, None, None, None, "TIMED", None),
        (105, 20260630, False, None, None, None, None, 'Réf, "A"'),
    ]
    minutes = rows(gold["fact_match"].where("match_id = 102"), "date_heure")
    assert minutes == [(dt.datetime(2026, 6, 12, 21, 30),)]
    no_venue = rows(gold["fact_match"].where("stade_id IS NULL"), "match_id")
    assert no_venue == [(104,)]
    scorers = rows(gold["fact_buteur"], "joueur_id", "buts", "assists", "penaltys", "buts_par_match")
    assert [(*r[:4], float(r[4])) for r in scorers] == [(11, 7, 0, 1, 2.33), (21, 1, 0, 0, 0.0)]
    assert rows(gold["fact_classement"], "groupe", "equipe_id", "points") == [
        ("GROUP_STAGE", 3, 0),
        ("Groupe A", 1, 1),
        ("Groupe A", 2, 1),
    ]


def test_gold_has_declared_columns_and_holds_its_constraints(run):
    _, gold = run
    for name, df in gold.items():
        assert df.columns == STAR[name].column_names
    assert dict(gold["fact_buteur"].dtypes)["buts_par_match"] == "decimal(5,2)"
    assert constraint_report(STAR.values(), gold).where("violations > 0").count() == 0


def test_a_second_run_gives_the_same_content(spark, landed, run):
    out, gold = run
    before = {name: rows(df, *df.columns) for name, df in gold.items()}
    again = layers.run_layers(spark, landed, out, batch_id="batch-2", strict=True)
    for name, df in again.items():
        assert rows(df, *df.columns) == before[name], name


def test_a_strict_run_stops_before_it_replaces_gold(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    layers.run_layers(spark, landed, out)
    bad = str(tmp_path / "bad")
    for name, columns in LANDING_COLUMNS.items():
        df = landing.read_raw_csv(spark, layers.landing_path(landed, name), columns)
        if name == "equipes":
            df = df.where("team_id <> '3'")
        target = {"matchs_joues": "matchs/matchs_joues.csv", "matchs_non_joues": "matchs/matchs_non_joues.csv"}
        path = f"{bad}/{target[name]}" if name in target else layers.landing_path(bad, name)
        landing.write_csv(df, path, columns)
    with pytest.raises(ValueError, match=r"fact_classement: foreign_key\(equipe_id\) broken 1"):
        layers.run_layers(spark, bad, out, strict=True)
    assert snapshot.read_layer(spark, out, "gold", "dim_equipe").count() == 3
    assert layers.run_layers(spark, bad, out)["dim_equipe"].count() == 2


def test_played_side_wins_where_both_tables_have_a_match(spark, run):
    out, _ = run
    played = snapshot.read_layer(spark, out, "silver", "matchs_joues")
    upcoming = snapshot.read_layer(spark, out, "silver", "matchs_non_joues")
    twice = upcoming.unionByName(played.withColumn("is_match_joue", played.is_match_joue & False))
    assert star.fact_match(played, twice).count() == 8
    single = star.fact_match(played, twice, one_per_match=True)
    assert rows(single.where("is_match_joue"), "match_id") == [(101,), (102,), (103,)]
    assert single.count() == 5


def test_flattening_gives_blanks_for_what_is_missing(spark):
    docs = spark.createDataFrame([([None],)], "teams array<struct<id: string, name: string,"
        " shortName: string, tla: string, area: struct<name: string, code: string>, crest: string,"
        " clubColors: string, website: string, coach: struct<name: string, nationality: string>>>")  # fmt: skip
    row = flatten.flatten_teams(docs).first()
    assert set(row[:-1]) == {""} and len(row.derniere_maj) == 19
