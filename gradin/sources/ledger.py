"""Appending batches so that each is there once, whole or not at all, however often it is sent.

Every attempt writes a folder of its own below `batches`. A batch is committed last, by a file in
`ledger` that is named after it, can be made only once, and holds the names of folder and batch. Readers
take the folders that the ledger names: what a failed or repeated attempt has left is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from gradin.sources import landing, store


def _entry(root: str, batch: str) -> str:
    return f"{root.rstrip('/')}/ledger/{quote(batch, safe='')}"


def has_batch(spark: SparkSession, root: str, batch: str) -> bool:
    return store.exists(spark, _entry(root, batch))


def append_once(spark: SparkSession, root: str, batch: str, write: Callable[[str], None]) -> bool:
    """Append a batch that `write` writes to a given path; False if it is there already.

    Of two that append one batch at the same time the first to commit counts.
    """
    if has_batch(spark, root, batch):
        return False
    folder = uuid.uuid4().hex
    write(f"{root.rstrip('/')}/batches/{folder}")
    return store.create_once(spark, _entry(root, batch), f"{folder}\n{batch}")


def batches(spark: SparkSession, root: str) -> dict[str, str]:
    """The committed batches with the paths of their folders, by name."""
    entries = f"{root.rstrip('/')}/ledger"
    if not store.names(spark, entries):
        return {}
    found = {}
    for row in spark.read.text(entries, wholetext=True).collect():
        # a file that is just being made is still empty
        if row["value"]:
            folder, _, batch = row["value"].partition("\n")
            found[batch] = f"{root.rstrip('/')}/batches/{folder}"
    return dict(sorted(found.items()))


def append_csv_once(df: DataFrame, root: str, columns: Sequence[str], batch: str) -> bool:
    """Append landing rows under the name of a batch; a rerun of it adds nothing."""
    return append_once(df.sparkSession, root, batch, lambda path: landing.write_csv(df, path, columns))


def read_csv(spark: SparkSession, root: str, columns: Sequence[str]) -> DataFrame:
    """The rows of all committed batches, every column text; without any, an empty table."""
    paths = list(batches(spark, root).values())
    return landing.read_raw_csv(spark, paths, columns) if paths else landing.empty_table(spark, columns)
