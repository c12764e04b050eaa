"""Ranges of an order that depend on the rows alone: not on partitions, settings or the run."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradin.operators.numbering import numbered
from gradin.session import scratch_path

#: Rows that stand for one range when its bounds are chosen.
PER_RANGE = 64
_NULL = np.iinfo(np.int64).min


def range_of(first: np.ndarray, second: np.ndarray, bounds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many bounds each pair reaches; bounds ascend by both columns."""
    low = np.searchsorted(bounds[0], first, "left")
    high = np.searchsorted(bounds[0], first, "right")
    out = high.copy()
    for at in np.unique(low[low < high]):
        own = np.flatnonzero((low == at) & (low < high))
        top = high[own[0]]
        out[own] = at + np.searchsorted(bounds[1][at:top], second[own], "right")
    return out


def in_ranges(
    rows: DataFrame, first: str, second: str, size: str, target: int, name: str = "range", then: Sequence[str] = ()
) -> DataFrame:
    """The rows dealt by ranges of (first, second), whose number is added, and sorted by them within a
    range, then by the columns `then`.

    Both columns are bigints; a null `first` comes before all. A range holds about `target` of `size`. Its
    bounds are keys of rows chosen by a hash of the key, with a chance in proportion to their
    size, so that two runs give the same ranges whatever the partitions and settings. Rows
    of one key lie in one range: let `second` tell rows with one `first` apart, as a hash does. One
    pair of numbers a range reaches the driver. `rows` is read three times before it is dealt.
    """
    if name in rows.columns:
        raise ValueError(f"a column {name} is already there")
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.col(size).cast("bigint"))).first()[0] or 0
    count = max(1, math.ceil(total / target))
    if count == 1:
        numbers = rows.withColumn(name, F.lit(0).cast("bigint"))
        return numbers.repartition(1).sortWithinPartitions(name, first, second, *then)
    expected = F.col(size) * (PER_RANGE * count / total)
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(17), first, second), 11) / float(1 << 53)
    times = F.floor(expected) + (chance < expected - F.floor(expected)).cast("bigint")
    chosen = rows.select(first, second, times.alias("times")).where("times > 0")
    chosen = chosen.groupBy(first, second).agg(F.sum("times").alias("times"))
    chosen = chosen.select(first, second, F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("nth"))
    path = scratch_path(spark, "chosen")
    chosen.write.parquet(path)
    places = numbered(spark.read.parquet(path), [], [first, second, "nth"], "place")
    ends = places.where((F.col("place") > 0) & (F.col("place") % PER_RANGE == 0)).select(first, second).distinct()
    found = sorted((_NULL if a is None else a, b) for a, b in ends.toLocalIterator())
    bounds = tuple(np.array(column, np.int64) for column in zip(*found, strict=True)) or (np.zeros(0, np.int64),) * 2
    held = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("bigint")
    def number(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(range_of(a.to_numpy(), b.to_numpy(), held.value))

    key = F.coalesce(F.col(first), F.lit(int(_NULL)))
    numbers = rows.withColumn(name, number(key, F.col(second)))
    return numbers.repartitionByRange(len(bounds[0]) + 1, name).sortWithinPartitions(name, first, second, *then)
