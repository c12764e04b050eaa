"""Queries that write to the shared folder and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradin.operators.rows import split_by_status
from gradin.plans.football import LANDING_COLUMNS, STAR
from gradin.plans.layers import (
    ingest_bronze,
    land_matches,
    land_standings,
    landing_path,
    run_layers,
    together,
)
from gradin.queries.raw import RAW, raw_sql, raw_table
from gradin.queries.registry import register, table
from gradin.queries.tables import PLAYED_SQL, STAR_SQL
from gradin.session import scratch_path
from gradin.sources import documents, landing, snapshot
from gradin.sources.lineage import with_lineage


def _read_back_sql(name: str, extra: str = "") -> str:
    columns = ", ".join(f"nullif({c}, '') AS {c}" for c in RAW[name][1])
    return f"SELECT {columns}{extra} FROM ({raw_sql(name)}) r"


def _landed(spark, sf, name: str):
    path = scratch_path(spark, name)
    columns = list(RAW[name][1])
    landing.write_csv(raw_table(spark, sf, name), path, columns)
    return path, columns


@register("csv_raw_scan", _read_back_sql("equipes"))
def csv_raw_scan(spark, sf):
    path, columns = _landed(spark, sf, "equipes")
    return landing.read_raw_csv(spark, path, columns)


@register(
    "csv_sink",
    "SELECT * REPLACE (" + "nom || chr(10) || 'x' || chr(13) || chr(92) || 'n' || chr(92) || chr(92) || 'r' || chr(10)"
    f" AS nom) FROM ({_read_back_sql('joueurs')}) t",
)
def csv_sink(spark, sf):
    """Columns come from the header here, and the sink leaves out the extra one."""
    path = scratch_path(spark, "joueurs")
    odd = F.concat(F.nullif("nom", F.lit("")), F.lit("\nx\r\\n\\\\r\n"))
    extra = raw_table(spark, sf, "joueurs").withColumn("ignored", F.lit("x")).withColumn("nom", odd)
    landing.write_csv(extra, path, LANDING_COLUMNS["joueurs"])
    return landing.read_raw_csv(spark, path)


@register("csv_append", _read_back_sql("matchs"))
def csv_append(spark, sf):
    path = scratch_path(spark, "matchs")
    for part in split_by_status(raw_table(spark, sf, "matchs")):
        landing.append_csv(part, path, LANDING_COLUMNS["matchs_joues"])
    return landing.read_raw_csv(spark, path, LANDING_COLUMNS["matchs_joues"])


@register("empty_with_schema", _read_back_sql("buteurs"))
def empty_with_schema(spark, sf):
    """A header without rows, rows added later."""
    path, columns = scratch_path(spark, "buteurs"), LANDING_COLUMNS["buteurs"]
    landing.write_csv(landing.empty_table(spark, columns), path, columns)
    landing.append_csv(raw_table(spark, sf, "buteurs"), path, columns)
    return landing.read_raw_csv(spark, path, columns)


# Names of groups that look like numbers.
_ODD_GROUP = "CASE WHEN position = '1' THEN '007' WHEN position = '2' THEN '1e2' ELSE groupe END"


def _grouped(df):
    return df.withColumn("groupe", F.expr(_ODD_GROUP))


@register(
    "partitioned_write",
    "SELECT *, groupe AS dossier FROM (SELECT * REPLACE (nullif("
    + _ODD_GROUP
    + f", '') AS groupe) FROM ({_read_back_sql('classement_group_stage')}) t) u",
)
def partitioned_write(spark, sf):
    name = "classement_group_stage"
    path, columns = scratch_path(spark, name), LANDING_COLUMNS[name]
    landing.write_csv_per_group(_grouped(raw_table(spark, sf, name)), path, columns, "groupe")
    back = landing.read_raw_csv(spark, path, columns, folder="groupe_folder")
    return back.select(*columns, F.col("groupe_folder").alias("dossier"))


@register(
    "lineage_columns",
    _read_back_sql(
        "equipes",
        ", 'equipes.csv' AS _source_file, TRUE AS has_path, TRUE AS has_time, 'batch-1' AS _batch_id",
    ),
)
def lineage_columns(spark, sf):
    path, columns = _landed(spark, sf, "equipes")
    df = with_lineage(landing.read_raw_csv(spark, path, columns), "batch-1", "equipes.csv")
    return df.select(
        *columns,
        "_source_file",
        F.col("_source_path").contains(path.rsplit("/", 1)[-1]).alias("has_path"),
        F.col("_ingestion_timestamp").isNotNull().alias("has_time"),
        "_batch_id",
    )


@register("parquet_snapshot", "SELECT * FROM lineitem")
def parquet_snapshot(spark, sf):
    """Written twice: the second snapshot replaces the first."""
    path = scratch_path(spark, "lineitem")
    lines = table(spark, sf, "lineitem")
    for _ in range(2):
        snapshot.write_snapshot(lines, path)
    return spark.read.parquet(path)


@register("parquet_scan", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def parquet_scan(spark, sf):
    root = scratch_path(spark, "layers")
    orders = table(spark, sf, "orders")
    snapshot.write_snapshot(orders, snapshot.layer_path(root, "silver", "orders"))
    back = snapshot.read_layer(spark, root, "silver", "orders")
    return back.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")


_COUNTED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@register(
    "load_report",
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in _COUNTED),
)
def load_report(spark, sf):
    return snapshot.load_report({t: table(spark, sf, t) for t in _COUNTED})


def land_all(spark, sf, root: str, status=None) -> None:
    def write(name: str) -> None:
        df = raw_table(spark, sf, name)
        landing.write_csv(df, landing_path(root, name), LANDING_COLUMNS[name], packed=True)

    matches = raw_table(spark, sf, "matchs")
    standings = raw_table(spark, sf, "classement_group_stage")
    steps = (
        lambda: write("equipes"),
        lambda: write("joueurs"),
        lambda: write("buteurs"),
        lambda: land_matches(matches if status is None else matches.withColumn("statut", status), root),
        lambda: land_standings(standings.withColumn("groupe_brut", F.col("groupe")), root),
    )
    together(spark, steps)


def _told(name: str, columns, kinds: dict[str, str]) -> str:
    """A row as one text, in a way that both SQL dialects write alike."""
    typed = [f"CAST({c} AS {kinds[c]})" if kinds.get(c, "").startswith("decimal") else c for c in columns]
    parts = [f"coalesce(CAST({c} AS VARCHAR(1000)), '~')" for c in typed]
    return f"'{name}' AS \"table\", concat_ws('|', {', '.join(parts)}) AS row"


def _told_rows(tables: dict, columns: dict[str, list[str]]):
    texts = [
        df.select(
            F.lit(name).alias("table"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns[name]]).alias("row"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, texts)


_BRONZE_SQL = {
    **{t: _read_back_sql(t) for t in RAW if t != "matchs"},
    "matchs_joues": f"SELECT * FROM ({_read_back_sql('matchs')}) t WHERE {PLAYED_SQL}",
    "matchs_non_joues": f"SELECT * FROM ({_read_back_sql('matchs')}) t WHERE NOT {PLAYED_SQL}",
}


@register(
    "bronze_ingest",
    " UNION ALL ".join(
        f"SELECT {_told(t, [*LANDING_COLUMNS[t], '_source_file', '_batch_id'], {})} FROM"
        f" (SELECT *, '{t}.csv' AS _source_file, 'batch-1' AS _batch_id FROM ({sql}) b) c"
        for t, sql in _BRONZE_SQL.items()
    ),
)
def bronze_ingest(spark, sf):
    """All landing tables, every column and the lineage that does not depend on the run."""
    landed, out = scratch_path(spark, "landing"), scratch_path(spark, "layers")
    land_all(spark, sf, landed)
    bronze = ingest_bronze(spark, landed, out, "batch-1")
    del bronze["rejected"]
    return _told_rows(bronze, {t: [*LANDING_COLUMNS[t], "_source_file", "_batch_id"] for t in bronze})


_STAR_COLUMNS = {name: [c for c in t.column_names if c != "stade_id"] for name, t in STAR.items()}


@register(
    "layered_run",
    " UNION ALL ".join(
        f"SELECT {_told(name, _STAR_COLUMNS[name], dict(STAR[name].columns))} FROM ({STAR_SQL[name]}) t" for name in STAR
    ),
)
def layered_run(spark, sf):
    """Landing files to written star tables, through every layer: all columns but the hash."""
    landed, out = scratch_path(spark, "landing"), scratch_path(spark, "layers")
    land_all(spark, sf, landed)
    return _told_rows(run_layers(spark, landed, out, consume=True), _STAR_COLUMNS)


@register(
    "layered_run_all_played",
    f"SELECT match_id, is_match_joue FROM (SELECT TRY_CAST(match_id AS BIGINT) AS match_id, TRUE AS"
    f" is_match_joue FROM (SELECT trim(match_id, ' ') AS match_id FROM ({raw_sql('matchs')}) r) m)"
    " WHERE match_id IS NOT NULL GROUP BY ALL",
)
def layered_run_all_played(spark, sf):
    """After the last match nothing is left to play: one side of the routing is empty."""
    landed, out = scratch_path(spark, "landing"), scratch_path(spark, "layers")
    land_all(spark, sf, landed, F.lit("FINISHED"))
    return run_layers(spark, landed, out, consume=True)["fact_match"].select("match_id", "is_match_joue")


_CUT_OFF = "o_orderkey % 5 = 0"


@register(
    "rejected_documents",
    f"SELECT '{{\"teams\": [{{\"id\": ' || o_orderkey AS record FROM orders WHERE {_CUT_OFF}",
)
def rejected_documents(spark, sf):
    """Every fifth document is cut off."""
    start = F.concat(F.lit('{"teams": [{"id": '), F.col("o_orderkey").cast("string"))
    text = F.when(F.expr(_CUT_OFF), start).otherwise(F.concat(start, F.lit("}]}")))
    docs = table(spark, sf, "orders").select(text.alias("text"))
    return documents.rejected_documents(docs, F.col("text"), documents.TEAMS)


@register(
    "rejected_rows",
    "SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey || ',a,b' ELSE CAST(o_orderkey AS VARCHAR) END AS record"
    " FROM orders WHERE o_orderkey % 3 = 0",
)
def rejected_rows(spark, sf):
    """Every third line has a field too many or too few."""
    path = scratch_path(spark, "lines")
    key = F.col("o_orderkey").cast("string")
    odd = F.when(F.expr("o_orderkey % 2 = 0"), F.concat(key, F.lit(",a,b"))).otherwise(key)
    line = F.when(F.expr("o_orderkey % 3 = 0"), odd).otherwise(F.concat(key, F.lit(",a")))
    table(spark, sf, "orders").select(line.alias("id,nom")).write.option("header", "true").option(
        "quote", ""
    ).option("sep", "\t").csv(path)
    return landing.rejected_rows(spark, path, ["id", "nom"]).select("record")
