"""Building a silver table from its raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gradin.operators.projection import project
from gradin.operators.rows import latest_per_key, require
from gradin.plans.football import SILVER
from gradin.sources.lineage import SOURCE_LINEAGE, with_processed_time
from gradin.spec import SilverTable


def build_silver(table: SilverTable, raw: DataFrame) -> DataFrame:
    """Clean and type, require the key, keep the latest row per key, derive.

    One shuffle, on the key. Lineage columns come along where the raw table has them.
    """
    lineage = [c for c in SOURCE_LINEAGE if c in raw.columns]
    rows = require(project(raw, table.fields, carry=lineage), *table.required)
    rows = latest_per_key(rows, table.unique_on, table.latest_by)
    rows = rows.withColumns({name: column() for name, column in table.derived})
    return with_processed_time(rows)


def build_all_silver(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build_silver(table, raw[name]) for name, table in SILVER.items()}
