"""Columns that say where and when a row came in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
SOURCE_LINEAGE = ("_source_file", "_source_path", "_ingestion_timestamp", "_batch_id")
PROCESSED_AT = "_silver_processed_timestamp"
LINEAGE = (*SOURCE_LINEAGE, PROCESSED_AT)


def new_batch_id() -> str:
    """One id per run, shared by all of its tables."""
    return str(uuid.uuid4())


def with_lineage(df: DataFrame, batch_id: str, source_file: str | None = None) -> DataFrame:
    """Add the four lineage columns to a frame just read from files.

    `source_file` is the name of the landing table's file; left out, each row
    carries the name of the file it was read from.
    """
    file_name = F.col("_metadata.file_name") if source_file is None else F.lit(source_file)
    values = (file_name, F.col("_metadata.file_path"), F.current_timestamp(), F.lit(batch_id))
    return df.select(
        "*", *[value.alias(name) for name, value in zip(SOURCE_LINEAGE, values)]
    )


def with_processed_time(df: DataFrame) -> DataFrame:
    return df.withColumn(PROCESSED_AT, F.current_timestamp())


def drop_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*LINEAGE)
