"""The first rows of each group, also of a group that holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Parts of a group whose first rows meet in one task.
FAN = 64


def first_rows(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first `n` rows of each group in the given order, numbered from 1 in column `rank`.

    A group's rows are split by a hash of the row and of the task they come from (so equal rows are
    split as well); each part keeps its first `n`, then every `FAN` parts meet, until one is left. So no task sees more of a group than a task's share or
    `FAN * n` rows, whatever `n` is: Spark itself keeps a task's first rows before the shuffle only for
    an `n` up to spark.sql.optimizer.windowGroupLimitThreshold. Null is a group. Rows that tie in the
    whole order are taken in any order.
    """
    if {rank, "_part"} & set(df.columns):
        raise ValueError(f"columns {rank} and _part must be free")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{g}`") for g in groups]
    hashed = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    df = df.withColumn("_part", F.pmod(F.xxhash64(F.spark_partition_id(), *hashed), F.lit(parts)).cast("int"))
    while True:
        last = parts == 1
        ranked = Window.partitionBy(*keys, *([] if last else ["_part"])).orderBy(*order)
        df = df.withColumn(rank, F.row_number().over(ranked)).where(F.col(rank) <= n)
        if last:
            return df.drop("_part")
        parts = -(-parts // FAN)
        df = df.drop(rank).withColumn("_part", F.expr(f"CAST(_part DIV {FAN} AS INT)"))
