"""Nearest neighbours by learned partitions.

A bounded sample of the vectors gets its neighbour graph. The graph is split into parts of equal
size with few edges between them, and a small network learns which parts a vector's neighbours
are in. Every row is indexed in its most probable part. A query goes to its most probable parts,
as many as the sample needed for the wished recall and on until they hold as many rows as are
wanted, and is compared there with every row.

A part with more rows than a bound is split again in the same way, by a router of its own, which is
taught by a sample of the part where that lies. So the rows that a query meets are bounded.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gradin.llm.graph import written
from gradin.operators.ranking import first_rows

SAMPLE = 8192
#: There are sqrt(rows) / PART_SCALE parts: with a fixed number of rows to a part, what queries
#: find in all their parts would grow with the square of the input. A sample teaches MOST_PARTS.
PART_SCALE, MOST_PARTS = 16, 256
#: Rows of a part that is not split again; the parts have some when there are MOST_PARTS of them.
MOST_ROWS = 1 << 16
NEIGHBOURS = 10
#: Recall on the sample that fixes how many parts a query goes to.
WANTED = 0.97
#: Rows of a part that meet in one task; a larger part is split into blocks by a hash.
BLOCK = 8192
QUERY_BLOCK = 2048


@dataclass
class Router:
    first: np.ndarray
    second: np.ndarray
    probes: int
    parts: int

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _forward(x, self.first, self.second)[1]


@dataclass
class Forest:
    """Routers of two levels: to parts, and within those that are split again to leaves.

    A leaf's number is its part's times MOST_PARTS, and its own in it.
    """

    root: Router | None
    inner: dict[int, Router]

    def home(self, x: np.ndarray) -> np.ndarray:
        """The most probable leaf of each row."""
        if self.root is None or not len(x):
            return np.zeros(len(x), np.int64)
        part = self.root.probabilities(x).argmax(axis=1)
        leaf = part * MOST_PARTS
        for p in np.unique(part):
            if p in self.inner:
                own = part == p
                leaf[own] += self.inner[p].probabilities(x[own]).argmax(axis=1)
        return leaf

    def asked(self, x: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        """The leaves that each row goes to: those of its most probable parts, and on until they hold as
        many rows as it wants. `sizes` has the rows of each leaf."""
        out: list[list[np.ndarray]] = [[] for _ in x]
        if self.root is None or not len(x):
            return [np.zeros(1, np.int64) for _ in x]
        order = np.argsort(-self.root.probabilities(x), axis=1, kind="stable")
        have = np.zeros(len(x), np.int64)
        for rank in range(order.shape[1]):
            open_ = np.flatnonzero((rank < self.root.probes) | (have < wanted))
            if not len(open_):
                break
            for p in np.unique(order[open_, rank]):
                rows = open_[order[open_, rank] == p]
                if p not in self.inner:
                    leaves, many = np.full((len(rows), 1), p * MOST_PARTS), np.ones(len(rows), np.int64)
                else:
                    inner = self.inner[p]
                    leaves = p * MOST_PARTS + np.argsort(-inner.probabilities(x[rows]), axis=1, kind="stable")
                    short = (have[rows, None] + np.cumsum(sizes[leaves], axis=1) < wanted[rows, None]).sum(axis=1)
                    many = np.minimum(np.maximum(inner.probes, short + 1), leaves.shape[1])
                for i, own, n in zip(rows, leaves, many, strict=True):
                    out[i].append(own[:n])
                    have[i] += sizes[own[:n]].sum()
        return [np.concatenate(own) for own in out]


def _forward(x: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(0, x @ first[:-1] + first[-1])
    logit = hidden @ second[:-1] + second[-1]
    p = np.exp(logit - logit.max(axis=1, keepdims=True))
    return hidden, p / p.sum(axis=1, keepdims=True)


def neighbours(x: np.ndarray, y: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """For each row of x the k rows of y with the largest inner product, but for its own number."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        near = x[a : a + 1024] @ y.T
        if own is not None:
            near[np.arange(len(near)), own[a : a + 1024]] = -np.inf
        out[a : a + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, seed: int) -> np.ndarray:
    """A part for each vertex of the neighbour graph.

    Starts from halving along the direction of largest spread again and again; then vertices
    move to the part with most of their neighbours, greatest gains first, while no part grows
    beyond 1.05 or falls under 0.95 of an equal share.
    """
    draw = np.random.default_rng(seed)
    part = np.zeros(len(x), np.int64)
    work = [(np.arange(len(x)), 0, parts)]
    while work:
        rows, low, count = work.pop()
        if count == 1:
            part[rows] = low
            continue
        way = draw.normal(size=x.shape[1])
        centred = x[rows] - x[rows].mean(axis=0)
        for _ in range(8):
            way = centred.T @ (centred @ way)
            way /= np.linalg.norm(way) + 1e-12
        order = rows[np.argsort(centred @ way, kind="stable")]
        left = count // 2
        cut = len(rows) * left // count
        work += [(order[:cut], low, left), (order[cut:], low + left, count - left)]
    edges = np.repeat(np.arange(len(x)), near.shape[1]), near.ravel()
    ends = np.concatenate(edges), np.concatenate(edges[::-1])
    share = len(x) / parts
    for _ in range(12):
        votes = np.zeros((len(x), parts), np.int32)
        np.add.at(votes, (ends[0], part[ends[1]]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if sizes[best[v]] < 1.05 * share and sizes[part[v]] > 0.95 * share:
                sizes[part[v]] -= 1
                sizes[best[v]] += 1
                part[v] = best[v]
                moved += 1
        if not moved:
            break
    return part


def fit(sample: np.ndarray, parts: int, k: int, wanted: float = WANTED, seed: int = 5) -> Router:
    """The router of a sample of vectors."""
    near = neighbours(sample, sample, min(NEIGHBOURS, len(sample) - 1), np.arange(len(sample)))
    part = balanced_parts(sample, near, parts, seed)
    target = np.zeros((len(sample), parts))
    np.add.at(target, (np.repeat(np.arange(len(sample)), near.shape[1]), part[near].ravel()), 0.5 / near.shape[1])
    target[np.arange(len(sample)), part] += 0.5
    draw = np.random.default_rng(seed)
    width, scale = max(32, min(128, 2 * parts)), 1 / (np.sqrt((sample**2).sum(axis=1).mean()) + 1e-12)
    weights = [draw.normal(0, 2 * scale, (sample.shape[1] + 1, width)), draw.normal(0, 0.3, (width + 1, parts))]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    t, batch = 0, 256
    every = 15 * -(-len(sample) // batch)
    for _ in range(15):
        order = draw.permutation(len(sample))
        for a in range(0, len(order), batch):
            rows = order[a : a + batch]
            x = sample[rows]
            hidden, p = _forward(x, *weights)
            d = (p - target[rows]) / len(rows)
            back = (d @ weights[1][:-1].T) * (hidden > 0)
            g = [np.concatenate([x.T @ back, back.sum(axis=0)[None]]), np.concatenate([hidden.T @ d, d.sum(axis=0)[None]])]
            t += 1
            for i in range(2):
                first[i] += 0.1 * (g[i] - first[i])
                second[i] += 0.01 * (g[i] ** 2 - second[i])
                step = (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.99**t)) + 1e-9)
                weights[i] -= 0.02 * scale ** (i == 0) * (1 - t / (every + 1)) * step
    router = Router(*weights, parts, parts)
    # every sampled row is in its most probable part, as it will be in the index
    p = router.probabilities(sample)
    home, order = p.argmax(axis=1), np.argsort(-p, axis=1, kind="stable")
    asked = np.arange(0, len(sample), max(1, len(sample) // 1024))
    true = neighbours(sample[asked], sample, min(k, len(sample) - 1), asked)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :].repeat(len(sample), axis=0), axis=1)
    reached = rank[asked][np.arange(len(asked))[:, None], home[true]]
    for probes in range(1, parts + 1):
        if (reached < probes).mean() >= wanted:
            router.probes = probes
            break
    return router


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) without null or zero vectors and those that hold null or non-finite numbers."""
    v = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return rows.where(F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda e: e != 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


#: What a block finds: the query and a hash of its vector, the candidate, a hash of its vector and its
#: number among equal rows, the inner product, and whether the query has several vectors.
FOUND = {
    "query_id": "bigint", "spot": "bigint", "vec_id": "bigint", "to": "bigint", "nth": "bigint", "score": "double",
    "several": "boolean",
}


def _nearest(k: int):
    """The k best candidates of each query among a block's."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[list[np.ndarray]] = [[] for _ in FOUND]
        if len(queries) and len(rows):
            rows = rows.sort_values(["vec_id", "spot"], kind="stable")
            ids, y, to = rows["vec_id"].to_numpy(), _matrix(rows["v"]), rows["spot"].to_numpy()
            first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (to[1:] != to[:-1])]))
            nth = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
            own, name, several = (queries[c].to_numpy() for c in ("vec_id", "spot", "several"))
            for a in range(0, len(queries), 256):
                x = _matrix(queries["v"].iloc[a : a + 256])
                rough = x @ y.T
                rough[own[a : a + 256, None] == ids[None, :]] = -np.inf
                # what may tie with the last of the best is scored again by a fixed order of sums
                floor = np.partition(rough, -min(k, len(ids)), axis=1)[:, -min(k, len(ids))]
                slack = 1e-12 * np.sqrt((x**2).sum(axis=1) * (y**2).sum(axis=1).max())
                for i in range(len(x)):
                    near = np.flatnonzero(rough[i] >= floor[i] - slack[i])
                    near = near[rough[i][near] > -np.inf]
                    score = (y[near] * x[i]).sum(axis=1)
                    best = np.lexsort((ids[near], -score))[:k]
                    near, score = near[best], score[best]
                    same = [np.full(len(near), c[a + i]) for c in (own, name, several)]
                    for column, values in zip(out, (*same[:2], ids[near], to[near], nth[near], score, same[2]), strict=True):
                        column.append(values)
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in zip(FOUND, out, strict=True)})

    return run


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    n = batch.num_rows
    return np.array(batch.column("v").flatten()).reshape(n, -1) if n else np.zeros((0, 0))


def _inner_routers(
    index: DataFrame, large: dict[int, int], k: int, wanted: float, sample: int, most_rows: int
) -> dict[int, Router]:
    """A router for each part with too many rows, taught in the tasks by `sample` rows of the part at
    most: the first by a hash, of those below a hash that leaves some twice as many."""
    table = [(p, float(2 * sample / n), min(MOST_PARTS, -(-n // most_rows))) for p, n in large.items()]
    spark, h = index.sparkSession, F.xxhash64("vec_id", "v")
    table = F.broadcast(spark.createDataFrame(table, "part bigint, share double, inner bigint"))
    rows = index.join(table, "part").withColumn("h", h)
    low = F.shiftrightunsigned("h", 11) / float(1 << 53) < F.col("share")
    rows = rows.where(low).select("part", "inner", F.shiftrightunsigned("h", 11).alias("h"), "vec_id", "v")
    rows = first_rows(rows, ["part"], [F.col("h"), F.col("vec_id")], sample)

    def taught(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("rank")
        x = _matrix(own["v"])
        parts = max(1, min(int(own["inner"].iloc[0]), len(x) // 32))
        router = fit(x, parts, k, wanted) if parts > 1 else None
        return pd.DataFrame({"part": own["part"].iloc[:1], "router": [pickle.dumps(router)]})

    found = rows.groupBy("part").applyInPandas(taught, "part bigint, router binary").collect()  # at most MOST_PARTS
    routers = {r["part"] // MOST_PARTS: pickle.loads(r["router"]) for r in found}
    return {p: router for p, router in routers.items() if router is not None}


def search(
    vectors: DataFrame,
    query,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    sample: int = SAMPLE,
    wanted: float = WANTED,
    most_rows: int = MOST_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score: the nearest rows of each row that fulfils `query`.

    Nearness is the inner product in double precision, ties go to the smaller vec_id, and a
    row is never its own neighbour: candidates with the query's vec_id are left out. Vectors
    that are null, zero, or hold nulls or non-finite numbers take no part, nor do those whose
    length is not the commonest one, nor null ids. With fewer than k candidates all are
    returned; repeated rows are candidates each, and one query. Several vectors under one query id are one
    query: a candidate is as near as to the nearest of them. At most `sample` rows, the first by a hash,
    teach the router; parts of more than `most_rows` rows are split again. Other columns are not read.
    """
    rows = written(usable(vectors, vec_id, embedding).where("vec_id IS NOT NULL"), "vectors")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width, total = (common["n"], common["count"]) if common else (0, 0)
    rows = rows.where(F.size("v") == width)
    taught = rows.orderBy(F.xxhash64("vec_id"), "vec_id", F.xxhash64("v")).limit(sample).toPandas()
    x = _matrix(taught["v"])
    parts = max(1, min(MOST_PARTS, math.ceil(math.sqrt(total) / PART_SCALE), len(x) // 32))
    forest = Forest(fit(x, parts, k, wanted) if parts > 1 else None, {})
    kind = "vec_id bigint, v array<double>"

    def dealt_home(rows: DataFrame, forest: Forest) -> DataFrame:
        held = rows.sparkSession.sparkContext.broadcast(forest)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = held.value.home(_vectors(batch))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(leaf)], ["vec_id", "v", "part"])

        return written(rows.select("vec_id", "v").mapInArrow(run, f"{kind}, part bigint"), "index")

    index = dealt_home(rows, forest)
    counts = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}  # at most MOST_PARTS rows
    if large := {p: n for p, n in counts.items() if n > most_rows}:
        forest.inner = _inner_routers(index, large, k, wanted, sample, most_rows)
        index = dealt_home(index, forest)
        counts = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}  # MOST_PARTS squared
    sizes = np.zeros(max([0, *counts]) // MOST_PARTS * MOST_PARTS + MOST_PARTS * max(1, parts), np.int64)
    sizes[list(counts)] = list(counts.values())
    held = rows.sparkSession.sparkContext.broadcast((forest, sizes))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forest, sizes = held.value
            # rows with the query's id are no candidates
            leaves = forest.asked(_vectors(batch), sizes, k + batch.column("own").to_numpy())
            ends = np.concatenate([[0], np.cumsum([len(own) for own in leaves])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, np.concatenate([*leaves, np.zeros(0, np.int64)]))
            columns = [batch.column("vec_id"), batch.column("v"), lists, batch.column("several")]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "parts", "several"])

    queries = rows.where(query(F.col("vec_id"))).groupBy("vec_id", "v").agg(F.count("*").alias("times"))
    many = queries.groupBy("vec_id").agg(F.sum("times").alias("own"), (F.count("*") > 1).alias("several"))
    queries = queries.join(many, "vec_id").select("vec_id", "v", "own", "several")
    asked = queries.mapInArrow(routed, f"{kind}, parts array<bigint>, several boolean")
    asked = written(asked.select("vec_id", "v", "several", F.explode("parts").alias("part")), "asked")
    # a part meets its queries in a grid of blocks, both of bounded size
    blocks = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).alias("c")).join(
        asked.groupBy("part").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("q")), "part"
    )
    grid = {r["part"]: (r["c"], r["q"]) for r in blocks.collect()}  # a row for each part
    table = rows.sparkSession.createDataFrame([(p, c, q) for p, (c, q) in grid.items()], "part bigint, c bigint, q bigint")
    table = F.broadcast(table)
    spot = F.xxhash64("vec_id", "v")

    def dealt(side: DataFrame, mine: str, other: str) -> DataFrame:
        side = side.join(table, "part").withColumn("spot", spot).withColumn(mine + "_at", F.pmod("spot", F.col(mine)))
        side = side.withColumn(other + "_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)))
        return side.select("part", "c_at", "q_at", "vec_id", "spot", "v", *[c for c in side.columns if c == "several"])

    keys = ["part", "c_at", "q_at"]
    met = dealt(asked, "q", "c").groupBy(*keys).cogroup(dealt(index, "c", "q").groupBy(*keys))
    found = met.applyInPandas(_nearest(k), ", ".join(f"`{c}` {kind}" for c, kind in FOUND.items()))
    nearest = [F.desc("score"), "vec_id", "to", "nth"]
    best = Window.partitionBy("query_id", "spot").orderBy(*nearest)
    found = written(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "found")
    # of several vectors under one query id the nearest of any counts
    joint = found.where("several").groupBy("query_id", "vec_id", "to", "nth").agg(F.max("score").alias("score"))
    joint = joint.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*nearest)))
    columns = ["query_id", "rank", "vec_id", "score"]
    return found.where("NOT several").select(*columns).unionByName(joint.where(F.col("rank") <= k).select(*columns))

