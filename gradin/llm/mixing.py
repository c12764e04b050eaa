"""Mixing sources to target weights by the cube method.

A source's rate is its target over its size. Every document is taken as often as the rate's
whole part says, and once more with the fractional part as its inclusion probability. The cube
method makes these choices so that a source's number of documents and of words stay what the
probabilities say: three undecided documents at a time move along the null space of the two
constraints until one of them is decided. Blocks of a source fly apart; the two documents that
may stay undecided in each are gathered and fly again, until one block is left, whose last two
are landed on the choice that is nearest in words.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gradin.llm.graph import written
from gradin.operators.numbering import numbered

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
BLOCK = 8192
WORD = r"[^\x20\x09-\x0D]+"
EDGE = 1e-9


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def key_of(source: str) -> Column:
    """A source as a string that is never null; null comes last."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("k"), F.col(source).cast("string")))


def targets(sources: DataFrame, weights: tuple, share: float, cap: float) -> DataFrame:
    """(key, source_size, n) with target and rate.

    Sources are numbered by code point without gathering them: ranges of them are numbered
    apart, and the ranges' sizes, one row per partition, give each its offset. The level that
    weights share in rises, one aggregate at a time, until no target passes its bound.
    """
    ranged = sources.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "sources")
    offsets = ranged.groupBy("part").count()
    offsets = offsets.withColumn(
        "offset", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("count")
    number = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1 + F.col("offset")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    known = written(ranged.join(offsets, "part").select("key", "source_size", "n", weight.alias("weight")), "weights")
    bound = F.col("source_size") * F.lit(cap)
    level, before = 0.0, None
    while True:
        open_ = bound > F.col("weight") * level if before is not None else F.lit(True)
        total, capped, free, still = known.agg(
            F.sum("source_size"), F.sum(F.when(~open_, bound)), F.sum(F.when(open_, F.col("weight"))), F.count(F.when(open_, 1))
        ).first()
        if still == before or not still:
            break
        before = still
        level = ((total or 0) * share - (capped or 0)) / free
    target = F.least(bound, F.col("weight") * level)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return known.select("key", "source_size", target.alias("target"), rate.alias("rate"))


def flight(x: np.ndarray, size: np.ndarray, seed: int) -> None:
    """Decide documents in place, but for two at most, keeping sum(x) and sum(x * size)."""
    draw = iter(np.random.default_rng(seed).random(len(x) + 1).tolist())
    probability, length = x.tolist(), size.tolist()
    waiting = [i for i in range(len(probability)) if EDGE < probability[i] < 1 - EDGE][::-1]
    pool = [waiting.pop() for _ in range(min(3, len(waiting)))]
    while len(pool) == 3:
        i, j, k = pool
        move = (length[k] - length[j], length[i] - length[k], length[j] - length[i])
        if move == (0, 0, 0):
            move = (1, -1, 0)
        ahead = back = np.inf
        for q, u in zip(pool, move, strict=True):
            if u > 0:
                ahead, back = min(ahead, (1 - probability[q]) / u), min(back, probability[q] / u)
            elif u < 0:
                ahead, back = min(ahead, -probability[q] / u), min(back, -(1 - probability[q]) / u)
        step = ahead if next(draw) * (ahead + back) < back else -back
        left = []
        for q, u in zip(pool, move, strict=True):
            probability[q] += step * u
            if EDGE < probability[q] < 1 - EDGE:
                left.append(q)
            else:
                probability[q] = float(round(probability[q]))
        pool = left
        while len(pool) < 3 and waiting:
            pool.append(waiting.pop())
    x[:] = probability


def landing(x: np.ndarray, size: np.ndarray) -> None:
    """Decide the last few documents: of all choices the one nearest in words, then in number."""
    last = np.flatnonzero((x > 0) & (x < 1))
    best = None
    for bits in range(1 << len(last)):
        choice = (bits >> np.arange(len(last))) & 1
        off = abs(((choice - x[last]) * size[last]).sum()), abs((choice - x[last]).sum()), bits
        if best is None or off < best[0]:
            best = off, choice
    x[last] = best[1]


def _flown(last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # long documents are decided first, so that what stays undecided is short
        rows = rows.sort_values(["size", "h", "doc_id", "k"], ascending=False, kind="stable")
        x, size = rows["x"].to_numpy(float).copy(), rows["size"].to_numpy(float)
        flight(x, size, zlib.crc32(f"{rows['key'].iloc[0]}|{rows['block'].iloc[0]}".encode()))
        if last:
            landing(x, size)
        return rows.assign(x=x)[["key", "doc_id", "size", "k", "h", "x"]]

    return run


UNIT = "key string, doc_id bigint, size bigint, k bigint, h bigint, x double"


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """doc_id, key (its source), k, size, source_size, target and copies, one row per input row.

    Size is the number of words, 0 for a null text. Sources by code point, null last, take the
    weights in turn and share `share` of all sizes; a target stops at `cap` times its source's
    size, and the excess is reshared by weight. Rows that agree in id, source and size are
    copies of one another, numbered by k; each is decided by itself. A source without words has
    target 0 and nothing of it is taken. Other columns are not read, and reruns agree.
    """
    sized = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), key_of(source).alias("key"), size_of(text).alias("size"))
    sizes = written(sized.groupBy("doc_id", "key", "size").agg(F.count(F.lit(1)).alias("m")), "sizes")
    sources = sizes.groupBy("key").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum("m").alias("n"))
    known = written(targets(sources, weights, share, cap), "targets")
    units = sizes.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))).alias("k")).join(known, "key")
    units = units.withColumn("whole", F.floor(F.col("rate") + EDGE))
    state = units.select(
        "key", "doc_id", "size", "k", F.xxhash64("doc_id", "k").alias("h"),
        F.greatest(F.lit(0.0), F.col("rate") - F.col("whole")).alias("x"),
    )
    decided = []
    while True:
        counts = written(state.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")), "blocks")
        last = (counts.agg(F.max("blocks")).first()[0] or 0) <= 1
        dealt = state.join(counts, "key").withColumn("block", F.pmod(F.col("h"), F.col("blocks"))).drop("blocks")
        state = written(dealt.groupBy("key", "block").applyInPandas(_flown(last), UNIT), "flown")
        undecided = (F.col("x") > 0) & (F.col("x") < 1)
        decided.append(state.where(~undecided))
        if last:
            break
        state = state.where(undecided)
    chosen = decided[0]
    for more in decided[1:]:
        chosen = chosen.unionByName(more)
    copies = (F.floor(F.col("rate") + EDGE) + F.col("x")).cast("bigint")
    return chosen.join(known, "key").select("doc_id", "key", "k", "size", "source_size", "target", copies.alias("copies"))


def row_hash(docs: DataFrame, text: str = "text"):
    """A hash of the whole row, whatever types it has: the text, and the other columns as JSON."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return F.xxhash64(F.col(text), F.to_json(F.struct(*others))) if others else F.xxhash64(F.col(text))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents, each as often as the mix takes it; the columns stay as they are.

    Rows that agree in id, source and size are numbered by a hash of the row, over many tasks and
    without their texts; so reruns agree. Of rows that are equal throughout, one gives the copies
    of all. Texts move once.
    """
    chosen = mix(docs, **how).where("copies > 0").select("doc_id", "key", "size", "k", "copies")
    rows = docs.select(
        F.col(how.get("doc_id", "doc_id")).cast("bigint").alias("doc_id"),
        key_of(how.get("source", "source")).alias("key"),
        size_of(how.get("text", "text")).alias("size"),
        row_hash(docs, how.get("text", "text")).alias("h"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    unit = ["doc_id", "key", "size"]
    units = written(rows.select(*unit, "h", F.monotonically_increasing_id().alias("r")), "units")
    units = numbered(units, unit, ["h", "r"], "k").withColumn("k", F.col("k") + 1)

    def same(left: DataFrame, right: DataFrame, *columns: str):
        out = left["doc_id"].eqNullSafe(right["doc_id"])
        for c in columns:
            out &= left[c] == right[c]
        return out

    told = units.join(chosen, same(units, chosen, "key", "size", "k"), "left")
    told = told.select(*[units[c] for c in (*unit, "h")], F.coalesce("copies", F.lit(0)).alias("copies"))
    taken = told.groupBy(*unit, "h").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    taken = written(taken.where("copies > 0"), "taken")
    found = rows.join(taken, same(rows, taken, "key", "size", "h"))
    found = found.select(*[rows[c] for c in (*unit, "h")], "row", "copies", "rows")
    repeated = found.where("rows > 1").groupBy(*unit, "h").agg(F.first("row").alias("row"), F.first("copies").alias("copies"))
    found = found.where("rows = 1").select("row", "copies").unionByName(repeated.select("row", "copies"))
    return found.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("row.*")
