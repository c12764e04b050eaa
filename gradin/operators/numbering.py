"""Positions of rows in an order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gradin.session import scratch_path

#: monotonically_increasing_id() holds the task's number above these bits.
_TASK_BITS = 33


def numbered(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    total: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """The rows with their position in their group, from 0, in ascending order (nulls first).

    With `weight` a row counts as often as that column says, and the position is the sum of the
    weights before it.

    Rows are dealt by range of groups and order, so a group that holds most rows is spread over
    many tasks; each task numbers its range and the counts of the ranges before it are added. Only
    these counts, one per range and group, meet in a window. With `total` the group's number of rows
    is added too. Rows that tie in the whole order lie in one range: end the order with a column
    that tells them apart if they may be many. `df` should be a read table, as it is read twice. The
    numbered rows are written to the scratch folder once, so that no retry numbers them anew.
    """
    taken = {"_at", "_task", "_first", "_rows", "_before"} | {name} | ({total} if total else set())
    clash = taken & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are already there")
    keys = [F.col(f"`{c}`") for c in (*groups, *order)]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    path = scratch_path(df.sparkSession, "numbered")
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = df.sparkSession.read.parquet(path).withColumn("_task", F.shiftright("_at", _TASK_BITS))
    if weight:
        # the rows of one range, which a task has written, are summed up by one
        own = Window.partitionBy("_task", *keys[: len(groups)]).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn("_within", F.coalesce(F.sum(weight).over(own), F.lit(0)))
    own = [F.col(f"`{c}`").alias(f"_g{i}") for i, c in enumerate(groups)]
    names = [f"_g{i}" for i in range(len(groups))]
    counts = placed.groupBy(*own, "_task").agg(F.min("_at").alias("_first"), (F.sum(weight) if weight else F.count("*")).alias("_rows"))
    within = Window.partitionBy(*names)
    before = within.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *names,
        F.col("_task").alias("_t"),
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        *([F.sum("_rows").over(within).alias(total)] if total else []),
    )
    same = F.col("_task") == F.col("_t")
    for i, c in enumerate(groups):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_g{i}"))
    position = (F.col("_within") if weight else F.col("_at") - F.col("_first")) + F.col("_before")
    numbers = placed.join(counts, same).withColumn(name, position)
    return numbers.drop("_at", "_task", "_t", "_first", "_before", "_within", *names)
