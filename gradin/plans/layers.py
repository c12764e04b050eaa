"""The layered run: documents -> landing -> bronze -> silver -> star.

Each layer is written as a full snapshot and read back by the next, so a lost executor
costs at most the tasks it was running, and a rerun repeats no earlier layer's work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gradin.functions.scores import group_slug, is_played
from gradin.operators import flatten
from gradin.operators.quality import RowRules, key_report, require_clean
from gradin.operators.repair import conform
from gradin.plans.football import LANDING_COLUMNS, LANDING_FILES, SILVER
from gradin.plans.silver import build_all_silver
from gradin.plans.star import build_star, star_tables, venue_keys
from gradin.session import shuffles_released
from gradin.sources import documents, landing, snapshot, store
from gradin.sources.lineage import new_batch_id, with_lineage


def together(spark: SparkSession, steps: Iterable[Callable[[], None]]) -> None:
    """Submit independent writes at once, so a small table does not leave executors idle,
    and wait for all of them. The first failure is raised. Each removes its shuffle files when it ends."""
    steps = list(steps)
    run = inheritable_thread_target(spark)(lambda step: step())
    with shuffles_released(spark), ThreadPoolExecutor(len(steps)) as pool:
        list(pool.map(run, steps))


def in_turns(tables: dict[str, DataFrame], splits: int) -> list[list[str]]:
    """Which tables to read at the same time, the largest first.

    A turn has so many splits at most, unless a single table has more: that one keeps the executors
    busy alone, and its shuffle files need not lie beside those of others.
    """
    of = {name: df.rdd.getNumPartitions() for name, df in tables.items()}
    turns, room = [], 0
    for name in sorted(of, key=of.get, reverse=True):
        if not turns or of[name] > room:
            turns.append([])
            room = splits
        turns[-1].append(name)
        room -= of[name]
    return turns


def landing_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{LANDING_FILES[table]}"


def land_matches(matches: DataFrame, landed: str) -> None:
    """Route matches to the two landing tables by status, reading them once."""
    name = F.when(is_played(F.col("statut")), "matchs_joues").otherwise("matchs_non_joues")
    landing.write_csv_per_group(
        matches.withColumn("table", name),
        f"{landed.rstrip('/')}/matchs",
        LANDING_COLUMNS["matchs_joues"],
        group="table",
        gather=False,
        packed=True,
    )
    # a side without matches has its header all the same, as before the first match or after the last
    for table in ("matchs_joues", "matchs_non_joues"):
        folder = f"{landed.rstrip('/')}/matchs/table_folder={table}"
        columns = LANDING_COLUMNS[table]
        landing.append_csv(landing.empty_table(matches.sparkSession, columns), folder, columns, packed=True)


def land_standings(standings: DataFrame, landed: str) -> None:
    """One folder per group, all of them part of one landing table."""
    table = "classement_group_stage"
    landing.write_csv_per_group(
        standings.withColumn("groupe_slug", group_slug(F.col("groupe_brut"))),
        landing_path(landed, table),
        LANDING_COLUMNS[table],
        group="groupe_slug",
        packed=True,
    )


def extract(docs: dict[str, DataFrame], landed: str) -> None:
    """Flatten documents into landing files.

    `docs` holds frames named teams, squads, scorers, standings and matches. Teams are
    landed first: squads take the names of the landed teams.
    """
    spark = docs["teams"].sparkSession

    def write(df: DataFrame, table: str) -> None:
        landing.write_csv(df, landing_path(landed, table), LANDING_COLUMNS[table], packed=True)

    write(flatten.flatten_teams(docs["teams"]), "equipes")
    teams = landing.read_raw_csv(
        spark, landing_path(landed, "equipes"), LANDING_COLUMNS["equipes"]
    )
    steps = (
        lambda: write(flatten.flatten_squads(docs["squads"], teams), "joueurs"),
        lambda: write(flatten.flatten_scorers(docs["scorers"]), "buteurs"),
        lambda: land_matches(flatten.flatten_matches(docs["matches"]), landed),
        lambda: land_standings(flatten.flatten_standings(docs["standings"]), landed),
    )
    together(spark, steps)


def read_source_documents(
    spark: SparkSession, root: str, rejects: str | None = None
) -> dict[str, DataFrame]:
    """The five kinds of JSON lines documents below a folder.

    A damaged document fails the run; with `rejects` it goes to a table below that folder.
    """
    schemas = {
        "teams": documents.TEAMS,
        "squads": documents.SQUAD,
        "scorers": documents.SCORERS,
        "standings": documents.STANDINGS,
        "matches": documents.MATCHES,
    }
    return {
        kind: documents.read_documents(
            spark, f"{root.rstrip('/')}/{kind}", schema, f"{rejects.rstrip('/')}/{kind}" if rejects else None
        )
        for kind, schema in schemas.items()
    }


def raw_with_lineage(
    spark: SparkSession, landed: str, table: str, batch_id: str, damaged: Observation | None = None
) -> DataFrame:
    """One landing table, all columns text, with lineage.

    `damaged` counts, while the table is written, the lines that do not belong in it.
    """
    columns = LANDING_COLUMNS[table]
    raw = landing.read_lines(spark, landing_path(landed, table), columns)
    if damaged is not None:
        raw = raw.observe(damaged, F.count(landing.CORRUPT).alias("lines"))
    raw = raw.where(F.col(landing.CORRUPT).isNull())
    return with_lineage(raw, batch_id, source_file=f"{table}.csv").drop(landing.CORRUPT, "_metadata")


def write_layer(
    spark: SparkSession,
    out: str,
    layer: str,
    tables: dict[str, DataFrame],
    batch_id: str,
    turns: Iterable[Iterable[str]] | None = None,
) -> dict[str, DataFrame]:
    """Write the tables of a batch below its own folder and give back what was written: all of them
    at the same time, or those of one turn after those of another.

    Nobody reads it before it is published, so a failure halfway leaves what there was.
    """
    paths = {name: snapshot.layer_path(out, layer, f"{batch_id}/{name}") for name in tables}
    for names in [tables] if turns is None else turns:
        together(spark, [partial(snapshot.write_snapshot, tables[n], paths[n]) for n in names])
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def ingest_bronze(
    spark: SparkSession, landed: str, out: str, batch_id: str, tables: Iterable[str] = SILVER
) -> dict[str, DataFrame]:
    """Land files as Parquet. Lines with another number of fields than there are columns go to
    the batch's table `rejected` (table, file, record)."""
    tables = list(tables)
    damaged = {t: Observation(f"damaged_{t}") for t in tables}
    raw = {t: raw_with_lineage(spark, landed, t, batch_id, damaged[t]) for t in tables}
    written = write_layer(spark, out, "bronze", raw, batch_id)
    # only files that have such lines are read again for them
    bad = [
        landing.rejected_rows(spark, landing_path(landed, t), LANDING_COLUMNS[t]).select(
            F.lit(t).alias("table"), "file", "record"
        )
        for t in tables
        if damaged[t].get["lines"]
    ]
    none = spark.createDataFrame([], "table string, file string, record string")
    rejected = {"rejected": reduce(DataFrame.unionByName, bad, none)}
    written |= write_layer(spark, out, "bronze", rejected, batch_id)
    snapshot.publish(spark, out, "bronze", batch_id)
    return written


def read_tables(
    spark: SparkSession, out: str, layer: str, tables: Iterable[str], batch: str | None = None
) -> dict[str, DataFrame]:
    """Tables of one batch, by default of the one published last, which is looked up once."""
    batch = batch or snapshot.published(spark, out, layer)
    return {name: snapshot.read_layer(spark, out, layer, name, batch) for name in tables}


def run_silver(
    spark: SparkSession, out: str, batch_id: str | None = None, source: str | None = None
) -> dict[str, DataFrame]:
    """Silver tables from the bronze tables of batch `source`, by default the one published last."""
    batch_id = batch_id or new_batch_id()
    bronze = read_tables(spark, out, "bronze", SILVER, source)
    turns = in_turns(bronze, 2 * spark.sparkContext.defaultParallelism)
    written = write_layer(spark, out, "silver", build_all_silver(bronze), batch_id, turns)
    snapshot.publish(spark, out, "silver", batch_id)
    return written


def run_gold(
    spark: SparkSession,
    out: str,
    strict: bool = False,
    batch_id: str | None = None,
    bits: int = 32,
    one_per_match: bool = False,
    source: str | None = None,
    key_map: bool = False,
) -> dict[str, DataFrame]:
    """Star tables from the silver tables of batch `source`, by default the one published last.

    Row rules are counted while the tables are written, before values that do not fit their
    declared type become NULL; keys are checked on what was written. The batch's table
    `constraint_report` has the result. With `strict` a broken constraint raises, and the
    batch is not published: what was published before stays. With `key_map` venues have bigint keys
    that are kept below `out` from batch to batch, in place of hashes.
    """
    batch_id = batch_id or new_batch_id()
    declared = star_tables(64 if key_map else bits)
    keys = venue_keys(spark, f"{out.rstrip('/')}/keys/dim_stade") if key_map else None
    star = build_star(read_tables(spark, out, "silver", SILVER, source), bits, one_per_match, keys)
    counted = {name: RowRules(declared[name], df) for name, df in star.items()}
    loaded = {name: conform(counted[name].frame, declared[name]) for name in star}
    written = write_layer(spark, out, "gold", loaded, batch_id)
    rows = [row for rules in counted.values() for row in rules.counts()]
    report = spark.createDataFrame(rows, "table string, rule string, violations bigint")
    report = report.unionByName(key_report(declared.values(), written))
    path = snapshot.layer_path(out, "gold", f"{batch_id}/constraint_report")
    together(spark, [partial(snapshot.write_snapshot, report, path)])
    if strict:
        require_clean(spark.read.parquet(path))
    snapshot.publish(spark, out, "gold", batch_id)
    return written


def run_layers(
    spark: SparkSession,
    landed: str,
    out: str,
    batch_id: str | None = None,
    strict: bool = False,
    bits: int = 32,
    one_per_match: bool = False,
    key_map: bool = False,
    consume: bool = False,
) -> dict[str, DataFrame]:
    """All layers from landing files, each begun when the one before is complete; gives
    back the written star tables.

    A layer that has published the batch is not run again: a run that failed, begun again with the
    same `batch_id`, goes on with the layer that failed. Every layer reads the batch's own tables,
    whatever others publish meanwhile. With `consume` the landing files are removed once bronze is
    published, as no layer reads them after that; bronze has all of their lines, the rejected ones as well.
    """
    batch_id = batch_id or new_batch_id()
    if not snapshot.is_published(spark, out, "bronze", batch_id):
        ingest_bronze(spark, landed, out, batch_id)
    if consume:
        store.remove(spark, landed)
    if not snapshot.is_published(spark, out, "silver", batch_id):
        run_silver(spark, out, batch_id, batch_id)
    if not snapshot.is_published(spark, out, "gold", batch_id):
        return run_gold(spark, out, strict, batch_id, bits, one_per_match, batch_id, key_map)
    return read_tables(spark, out, "gold", star_tables(bits), batch_id)
