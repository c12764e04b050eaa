"""Keys without collisions: a map from values to numbers that is kept and grows by batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradin.operators.numbering import numbered
from gradin.session import scratch_path
from gradin.sources import ledger


class KeyMap:
    """A table of (key, columns) below `root`, in batches that a ledger commits.

    A key once given stays; new values get the numbers behind the greatest one, in the order of the
    values, so a batch gives the same keys whatever the partitions. A null is a value; a
    value without any part has no key, as it names nothing.
    """

    def __init__(self, spark: SparkSession, root: str, columns: Sequence[str], key: str = "key"):
        self.spark, self.root, self.columns, self.key = spark, root.rstrip("/"), list(columns), key

    def read(self) -> DataFrame:
        paths = list(ledger.batches(self.spark, self.root).values())
        if paths:
            return self.spark.read.parquet(*paths)
        fields = [T.StructField(self.key, T.LongType()), *[T.StructField(c, T.StringType()) for c in self.columns]]
        return self.spark.createDataFrame([], T.StructType(fields))

    def _same(self, left: DataFrame, right: DataFrame):
        return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in self.columns])

    def assign(self, rows: DataFrame) -> DataFrame:
        """Give keys to the values of `rows` that have none yet, and give back the whole map.

        The values are made distinct per task before they move, and numbered over many tasks.
        Values sent again change nothing. Each batch takes the next place in the ledger; of two
        that want one place at the same time the second begins again with what the first has added.
        """
        any_part = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in self.columns])
        values = rows.select(*self.columns).where(any_part).distinct()
        while True:
            place = len(ledger.batches(self.spark, self.root))
            known = self.read()
            start = (known.agg(F.max(self.key)).first()[0] or 0) + 1
            path = scratch_path(self.spark, "values")
            values.join(known, self._same(values, known), "left_anti").write.parquet(path)
            fresh = self.spark.read.parquet(path)
            if fresh.isEmpty():
                return known
            keyed = numbered(fresh, [], self.columns, "_position")
            keyed = keyed.select((F.col("_position") + start).alias(self.key), *self.columns)
            if ledger.append_once(self.spark, self.root, f"{place:012d}", keyed.write.parquet):
                return self.read()

    def keyed(self, rows: DataFrame) -> DataFrame:
        """The rows with their key; null where the values have none."""
        known = self.read().withColumnsRenamed({c: f"_of_{c}" for c in self.columns})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in self.columns])
        return rows.join(known, same, "left").drop(*[f"_of_{c}" for c in self.columns])
