"""Filters, deduplication, unions, ordering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gradin.functions.keys import any_present
from gradin.functions.scores import is_played


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all columns are known."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def require_any(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where at least one column is known."""
    return df.where(any_present(*[F.col(c) for c in columns]))


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) != "")


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the latest, ties broken by the other columns in order.

    NULL keys count as equal. The survivor does not depend on how rows are spread, and
    Spark keeps only a task's best row per key before the shuffle, so a key that holds
    a third of all rows sends one row per task and not its whole group.
    """
    newest = [F.col(c).desc_nulls_last() for c in latest_by]
    others = [
        F.col(c).asc_nulls_first() for c in df.columns if c not in {*keys, *latest_by}
    ]
    ranked = Window.partitionBy(*keys).orderBy(*(newest + others or [F.lit(0)]))
    rank = "_rank"
    while rank in df.columns:
        rank += "_"
    return df.withColumn(rank, F.row_number().over(ranked)).where(F.col(rank) == 1).drop(rank)


def distinct_union(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Distinct values of the columns over all frames."""
    return union_aligned(frames, columns).distinct()


def union_aligned(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """All rows of all frames, cut down to the same columns in the same order."""
    return reduce(DataFrame.unionByName, [df.select(*columns) for df in frames])


def split_by_status(df: DataFrame, status: str = "statut") -> tuple[DataFrame, DataFrame]:
    """(played, not played); every row is in exactly one of the two."""
    played = is_played(F.col(status))
    return df.where(played), df.where(~played)


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in the given order; every task sends at most n of its rows."""
    return df.orderBy(*order).limit(n)
