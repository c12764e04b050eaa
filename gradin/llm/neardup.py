"""Near duplicates by b-bit MinHash.

Each text gets the minima of 180 hash functions over its word shingles. Five minima make a
band; texts that agree in one of 36 bands are candidates, so a pair at similarity 0.8 is missed
with a probability of 6.2e-7. The low four bits of every minimum are packed, each bit in a plane
of its own. One in sixteen of the minima that differ agrees in them by chance, so the number of
differing ones is binomial, and pairs are dropped if a pair at the bound has as many with a
probability below 1e-7: both losses together stay below 1e-6. Beside them stand the parities of the shingles' numbers in 1,024 cells. Every cell in
which two texts differ holds a shingle that only one of them has, so the count of such cells is a
lower bound of the sets' difference, and pairs beyond the difference that the similarity allows
are dropped without any loss. What is left is confirmed on the full shingle sets.

Equal shingle sets are one node. In a bucket every node is compared with one of them, the pivot:
the one that shares its buckets with most others, mostly the text that the others are copies of.
Nodes that this leaves in different components are then compared with each other. So a bucket of
thousands of near copies does not become all its pairs, and no link between different components
is left untested.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradin.llm.graph import components, written
from gradin.llm.hashing import LOWER, Texts, mixed, pieces, shingles, span_hashes

BANDS, ROWS, BITS = 36, 5, 4
KEPT = BANDS * ROWS
#: Longs of a plane, of all planes, and of the parities.
PLANE = -(-KEPT // 64)
LOW = BITS * PLANE
PARITY = 16
#: The probability with which the differing minima may drop a pair at the bound.
LOSS = 1e-7
_SHINGLES_AT_ONCE = 1 << 17


def _text_shingles(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    words = texts.words()
    hashes = span_hashes(texts.prefix(LOWER[texts.data]), words.starts, words.ends)
    return shingles(hashes, words, k)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def _multipliers() -> np.ndarray:
    return (mixed(np.arange(1, KEPT + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minima(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The least value of each hash function over each text's shingles; all texts have some."""
    out = np.empty((len(first) - 1, KEPT), np.uint32)
    by, plus = _multipliers(), _multipliers()[::-1]
    begin = 0
    while begin < len(out):
        end = int(np.searchsorted(first, first[begin] + _SHINGLES_AT_ONCE, "right")) - 1
        end = min(max(end, begin + 1), len(out))
        part = (x[first[begin] : first[end]] >> np.uint64(32)).astype(np.uint32)
        cuts = first[begin:end] - first[begin]
        for k in range(KEPT):
            moved = part * by[k]
            moved += plus[k]
            moved ^= moved >> np.uint32(15)
            out[begin:end, k] = np.minimum.reduceat(moved, cuts)
        begin = end
    return out


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima: BITS planes of a bit from each minimum, a plane after the other."""
    bits = np.zeros((len(least), BITS, PLANE * 64), np.uint8)
    for k in range(BITS):
        bits[:, k, :KEPT] = (least >> np.uint32(k)) & np.uint32(1)
    return np.packbits(bits.reshape(len(least), BITS * PLANE * 64), axis=1).view(np.uint64)


def parities(distinct: np.ndarray) -> np.ndarray:
    """Whether each of 64 * PARITY cells holds an odd number of the shingles, a bit to a cell."""
    out = np.zeros(PARITY, np.uint64)
    cell = distinct & np.uint64(64 * PARITY - 1)
    np.bitwise_xor.at(out, (cell >> np.uint64(6)).astype(np.int64), np.uint64(1) << (cell & np.uint64(63)))
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.repeat(mixed(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :], len(least), axis=0)
    by_band = least.reshape(len(least), BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        keys = mixed(keys + by_band[:, :, r])
    return keys


SIGNED = (
    "doc_id bigint, n_shingles bigint, t bigint, node bigint, "
    "bands array<bigint>, low array<bigint>, parity array<bigint>"
)


def _signed(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in pieces(batch.column("text")):
                x, first = _text_shingles(texts, shingle_words)
                n = np.zeros(len(texts), np.int64)
                node = np.zeros(len(texts), np.uint64)
                parity = np.zeros((len(texts), PARITY), np.uint64)
                for i in range(len(texts)):
                    own = _distinct(x[first[i] : first[i + 1]])
                    n[i] = len(own)
                    node[i] = mixed(own + np.uint64(len(own))).sum(dtype=np.uint64)
                    parity[i] = parities(own)
                has = n > 0
                ends = np.concatenate([[0], np.cumsum(np.diff(first)[has])])
                least = minima(x, ends) if has.any() else np.empty((0, KEPT), np.uint32)
                bands = np.zeros((len(texts), BANDS), np.uint64)
                low = np.zeros((len(texts), LOW), np.uint64)
                bands[has], low[has] = band_keys(least), packed(least)
                rows = batch.slice(begin, len(texts))

                def lists(a: np.ndarray) -> pa.Array:
                    at = np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]
                    return pa.ListArray.from_arrays(at, a.view(np.int64).ravel())

                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(n),
                        rows.column("t"),
                        pa.array(node.view(np.int64), mask=~has),
                        lists(bands),
                        lists(low),
                        lists(parity),
                    ],
                    ["doc_id", "n_shingles", "t", "node", "bands", "low", "parity"],
                )

    return run


def _sketch(side: str = "") -> list[Column]:
    """The node's size, low bits and parities as plain columns, named for one side of a pair."""
    return [
        F.col("n").alias(f"n{side}"),
        *[F.col("low")[k].alias(f"low{k}{side}") for k in range(LOW)],
        *[F.col("parity")[k].alias(f"parity{k}{side}") for k in range(PARITY)],
    ]


def _xor(column: str) -> Column:
    return F.col(f"{column}_a").bitwiseXOR(F.col(f"{column}_b"))


def _differing_minima() -> Column:
    differ = F.lit(0)
    for k in range(PLANE):
        x = _xor(f"low{k}")
        for plane in range(1, BITS):
            x = x.bitwiseOR(_xor(f"low{k + plane * PLANE}"))
        differ = differ + F.bit_count(x)
    return differ


def _differing_cells() -> Column:
    return sum((F.bit_count(_xor(f"parity{k}")) for k in range(PARITY)), F.lit(0))


def most_differing(percent: int) -> int:
    """The least number of differing minima that a pair of that similarity exceeds with a
    probability below LOSS."""
    p = (1 - percent / 100) * (1 - 0.5**BITS)
    beyond, most = 0.0, KEPT
    while most and (beyond := beyond + math.comb(KEPT, most) * p**most * (1 - p) ** (KEPT - most)) < LOSS:
        most -= 1
    return most


def _likely(percent: int) -> Column:
    """Whether the sketches of a and b allow for that similarity."""
    return (
        (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
        & (_differing_cells() * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))
        & (_differing_minima() <= most_differing(percent))
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets are similar enough."""

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            column = pa.array([x for pair in zip(rows["text_a"], rows["text_b"], strict=True) for x in pair])
            sets: list[np.ndarray] = []
            for _, part in pieces(column):
                x, first = _text_shingles(part, k)
                sets += [_distinct(x[first[i] : first[i + 1]]) for i in range(len(part))]
            keep = []
            for one, other in zip(sets[::2], sets[1::2], strict=True):
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(other) - both))
            yield rows.loc[np.array(keep, bool), ["a", "b"]]

    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    sides = sides.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return sides.select("a", "b", "text_a", "text_b").mapInPandas(similar, "a bigint, b bigint")


def _grouped(docs: DataFrame, doc_id: str, text: str, shingle_words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, t, node, ...) of every row, t being the text's hash, and (node, root, least)
    of every node: its component's name and its least row (no_id, doc_id, t), null ids last."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    keyed = docs.withColumn("t", F.xxhash64("text"))
    signed = written(keyed.select("doc_id", "t", "text").mapInArrow(_signed(shingle_words), SIGNED), "signed")
    nodes = written(
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")).alias("least"),
            F.min("t").alias("t"),
            F.min("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("low").alias("low"),
            F.first("parity").alias("parity"),
        ),
        "nodes",
    )
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(banded.join(sizes, "bucket"), "shared")
    weights = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    pivots = (
        shared.join(weights, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("weight", F.xxhash64("node").alias("h"), "node")).alias("p"))
        .select("bucket", F.col("p.node").alias("pivot"))
    )
    members = written(shared.select("bucket", "node").join(pivots, "bucket"), "members")
    likely = _likely(percent)
    wanted = members.select("node").distinct()
    texts = written(
        keyed.select("t", "text")
        .dropDuplicates(["t"])
        .join(nodes.join(wanted, "node", "left_semi").select("t", "node"), "t")
        .select("node", "text"),
        "texts",
    )
    stars = members.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    for x in "ab":
        stars = stars.join(nodes.select(F.col("node").alias(x), *_sketch(f"_{x}")), x)
    links = _confirmed(stars.where(likely).select("a", "b"), texts, shingle_words, percent)
    roots = components(links)
    # then what is still apart within a bucket
    labelled = members.join(roots, "node", "left").select("bucket", "pivot", "node", F.coalesce("root", "node").alias("root"))
    apart = labelled.groupBy("bucket").agg(
        F.min("root").alias("r"),
        F.max("root").alias("s"),
        # most of a bucket is in its pivot's component: only the others are compared with all
        F.max(F.when(F.col("node") == F.col("pivot"), F.col("root"))).alias("main"),
    )
    apart = apart.where("r <> s").select("bucket", "main")
    labelled = labelled.join(apart, "bucket").select("bucket", "main", "node", "root")
    labelled = written(labelled.join(nodes.select("node", *_sketch()), "node"), "labelled")

    def side(rows: DataFrame, x: str) -> DataFrame:
        return rows.select(*[F.col(c).alias(f"{c}_{x}") for c in rows.columns])

    # two minor nodes meet once
    pairs = side(labelled.where("root <> main"), "a").join(
        side(labelled, "b"),
        (F.col("bucket_a") == F.col("bucket_b"))
        & (F.col("root_a") != F.col("root_b"))
        & ((F.col("root_b") == F.col("main_b")) | (F.col("node_a") < F.col("node_b")))
        & likely,
    )
    pairs = pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    later = _confirmed(pairs, texts, shingle_words, percent)
    roots = components(roots.toDF("a", "b").unionByName(later))
    found = nodes.select("node", "least").join(roots, "node", "left")
    return signed, found.withColumn("root", F.coalesce("root", "node"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per input row.

    Words are runs of non-blank characters with A-Z lower-cased. Two documents are linked if
    the shared part of their shingle sets is at least `percent` of the union; a component's id
    is its smallest doc_id. Fewer words than a shingle count as one shingle; documents without
    words, empty ones and nulls have no shingle and are linked with nothing: their component is
    their own doc_id. Repeated rows are copies of each other. A null doc_id never names a
    component that has other ids; it is kept only where its component has none. Other columns
    are not read.
    """
    signed, found = _grouped(docs, doc_id, text, shingle_words, percent)
    named = found.groupBy("root").agg(F.min("least").getField("doc_id").alias("component_id"))
    named = found.join(named, "root").select("node", "component_id")
    rows = signed.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def representatives(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """doc_id and t, the text's xxhash64: the least row of each component of near_duplicates.

    Null ids come last. Documents without a shingle are linked with nothing: each is there.
    """
    signed, found = _grouped(docs, doc_id, text, shingle_words, percent)
    least = found.groupBy("root").agg(F.min("least").alias("least")).select("least.doc_id", "least.t")
    return least.unionByName(signed.where("node IS NULL").select("doc_id", "t").distinct())
