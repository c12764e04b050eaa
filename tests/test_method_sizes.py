"""What keeps large runs of the layers fast: small generated methods, and landing files in gzip."""

from __future__ import annotations

import re

import pytest

from gradin.plans.football import LANDING_COLUMNS, SILVER
from gradin.plans.layers import land_matches, landing_path, raw_with_lineage
from gradin.plans.silver import build_silver
from gradin.sources import landing

#: The JVM does not compile methods of more bytes.
MOST = 8000


def largest_method(df, capsys) -> int:
    capsys.readouterr()
    df.explain("codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)))


@pytest.mark.parametrize("table", SILVER)
def test_generated_methods_are_small_enough_to_be_compiled(spark, tmp_path, capsys, table):
    path = landing_path(str(tmp_path), table).replace("*", "")
    landing.write_csv(landing.empty_table(spark, LANDING_COLUMNS[table]), path, LANDING_COLUMNS[table])
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        raw = raw_with_lineage(spark, str(tmp_path), table, "b")
        assert largest_method(raw, capsys) < MOST
        raw.write.parquet(f"{tmp_path}/bronze")
        silver = build_silver(SILVER[table], spark.read.parquet(f"{tmp_path}/bronze"))
        assert largest_method(silver, capsys) < MOST
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_landed_files_are_packed_and_hold_the_same_rows(spark, tmp_path):
    columns = LANDING_COLUMNS["matchs_joues"]
    rows = [(str(i), "FINISHED" if i % 2 else "TIMED", "a\nb\\n\r\\" if i % 3 else None) for i in range(30)]
    matches = spark.createDataFrame(rows, "match_id string, statut string, stade string")
    matches = matches.selectExpr(*[c if c in matches.columns else f"CAST(NULL AS STRING) AS {c}" for c in columns])
    land_matches(matches, str(tmp_path))
    files = [f for f in (tmp_path / "matchs").rglob("part-*")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    for table, status in (("matchs_joues", "FINISHED"), ("matchs_non_joues", "TIMED")):
        back = landing.read_raw_csv(spark, landing_path(str(tmp_path), table), columns)
        found = back.select("match_id", "statut", "stade").collect()
        assert sorted(map(tuple, found)) == sorted(r for r in rows if r[1] == status)


@pytest.mark.parametrize("text", ["\\", "\\\\", "\\n", "\\\\n", "\\\\\\n\\\\r", "a\nb\rc", "\\\n\\\\\r", "x\\\\\\\\n\\r"])
def test_breaks_and_backslashes_come_back(spark, tmp_path, text):
    df = spark.createDataFrame([(text,)], "t string")
    landing.write_csv(df, f"{tmp_path}/t", ["t"], packed=True)
    assert landing.read_raw_csv(spark, f"{tmp_path}/t", ["t"]).first().t == text
