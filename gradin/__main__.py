"""Run layers: spark-submit gradin/__main__.py, or python -m gradin.

    python -m gradin --landing DATA --out layers bronze silver gold
    python -m gradin --documents json --landing DATA extract
    python -m gradin --out layers --jdbc-url jdbc:postgresql://host/db \\
        --jdbc-option user=loader --jdbc-password-env PGPASSWORD publish
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from gradin.plans import layers
from gradin.plans.football import STAR
from gradin.sources import snapshot
from gradin.sources.lineage import new_batch_id
from gradin.sources.warehouse import publish_star

STEPS = ("extract", "bronze", "silver", "gold", "publish", "clean")
NEEDS = {
    "extract": ("documents", "landing"),
    "bronze": ("landing", "out"),
    "silver": ("out",),
    "gold": ("out",),
    "publish": ("out", "jdbc_url"),
    "clean": ("out",),
}


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gradin", description="Run layers in order.")
    parser.add_argument("steps", nargs="+", choices=STEPS)
    parser.add_argument("--documents", help="folder of JSON lines documents")
    parser.add_argument("--landing", help="folder of landing files")
    parser.add_argument("--out", help="folder of the bronze, silver and gold tables")
    parser.add_argument("--batch", help="name of the run; layers that have published it are not run again")
    parser.add_argument("--keep", type=int, default=2, help="published batches of a layer that clean leaves")
    parser.add_argument("--strict", action="store_true", help="stop at a broken constraint")
    parser.add_argument("--rejects", help="folder for damaged documents; without it they stop the run")
    parser.add_argument("--key-bits", type=int, choices=(32, 64), default=32, help="of venue keys")
    parser.add_argument("--key-map", action="store_true", help="keep venue keys from batch to batch, without hashes")
    parser.add_argument("--one-per-match", action="store_true", help="keep the played row of a match")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-schema", default="public")
    parser.add_argument("--jdbc-partitions", type=int, help="connections opened at a time")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--jdbc-password-env", help="environment variable of the password")
    given = parser.parse_args(argv)
    for step in given.steps:
        for name in NEEDS[step]:
            if getattr(given, name) is None:
                parser.error(f"{step} needs --{name.replace('_', '-')}")
    return given


def run(spark: SparkSession, given: argparse.Namespace) -> None:
    """The chosen steps, in layer order whatever order they were named in."""
    if "extract" in given.steps:
        docs = layers.read_source_documents(spark, given.documents, given.rejects)
        layers.extract(docs, given.landing)
    batch = given.batch or new_batch_id()

    def due(layer: str) -> bool:
        return layer in given.steps and not snapshot.is_published(spark, given.out, layer, batch)

    def source(layer: str) -> str | None:
        """The run's own batch of a layer, where there is one."""
        return batch if snapshot.is_published(spark, given.out, layer, batch) else None

    if due("bronze"):
        layers.ingest_bronze(spark, given.landing, given.out, batch)
    if due("silver"):
        layers.run_silver(spark, given.out, batch, source("bronze"))
    if due("gold"):
        gold = layers.run_gold(
            spark, given.out, given.strict, batch, given.key_bits, given.one_per_match, source("silver"), given.key_map
        )
        snapshot.load_report(gold).show(truncate=False)
    if "clean" in given.steps:
        for layer in ("bronze", "silver", "gold"):
            snapshot.remove_old(spark, given.out, layer, given.keep)
    if "publish" in given.steps:
        properties = dict(option.split("=", 1) for option in given.jdbc_option)
        if given.jdbc_password_env:
            properties["password"] = os.environ[given.jdbc_password_env]
        tables = layers.read_tables(spark, given.out, "gold", STAR)
        publish_star(tables, given.jdbc_url, properties, given.jdbc_schema, given.jdbc_partitions)


def main() -> None:
    given = arguments()
    spark = (
        SparkSession.builder.appName("gradin")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    run(spark, given)
    spark.stop()


if __name__ == "__main__":
    main()
