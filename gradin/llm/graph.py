"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradin.session import scratch_path


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The rows as a table in the shared folder, so that no lost executor repeats their work."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


def _least(near: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and all its v."""
    least = near.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return near.join(least, "u")


def _settled(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u as well: then each v is the least it reaches."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return ends.where("up > 1 OR up > 0 AND least = 0").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b), root being the least node it reaches.

    Alternates two steps until every node is tied to its root alone: every node's larger neighbours, then its
    smaller ones, are tied to the least of its neighbourhood. The number of rounds grows with
    the logarithm of the number of nodes. A hub's rows are aggregated before the shuffle, and
    the join that follows can be split.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _least(large)
        small = small.select("v", "m").union(small.select("u", "m")).toDF("u", "v")
        edges = written(small.where("u <> v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct()
    )
