"""Hashed n-gram features, bounded labelled samples, and small linear models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradin.llm.graph import written
from gradin.llm.hashing import Texts, Words, mixed
from gradin.operators.ranking import first_rows

_TURNS = np.uint32([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F])


def code_points(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts as numbers, and the place of each text's first one."""
    points = np.frombuffer(texts.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    leads = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    return points, leads[texts.offsets]


def char_grams(points: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """The bucket of the n characters from each place on; the last n - 1 places have none."""
    size = max(0, len(points) - n + 1)
    h = np.zeros(size, np.uint32)
    for j in range(n):
        h += points[j : j + size] * _TURNS[j]
        h ^= h >> np.uint32(15)
        h *= _TURNS[(j + 1) % 4]
    return (h >> np.uint32(8)) & np.uint32(buckets - 1)


def word_grams(hashes: np.ndarray, n: int, buckets: int) -> np.ndarray:
    size = max(0, len(hashes) - n + 1)
    h = np.zeros(size, np.uint64)
    for j in range(n):
        h = mixed(h + hashes[j : j + size])
    return (h >> np.uint64(20)).astype(np.uint32) & np.uint32(buckets - 1)


def runs(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's n-grams begin and end, given where its units begin."""
    return first[:-1], np.maximum(first[1:] - (n - 1), first[:-1])


def summed(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[begins[i]:ends[i]], by row; zero for empty spans."""
    out = np.zeros((len(begins), *values.shape[1:]), np.float64)
    full = ends > begins
    if full.any():
        cuts = np.stack([begins[full], ends[full]], axis=1).ravel()
        padded = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
        out[full] = np.add.reduceat(padded, cuts, axis=0)[::2]
    return out


#: Texts of all labels together that a sample may have.
MOST_TEXTS = 4000


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int, most: int = MOST_TEXTS) -> DataFrame:
    """(doc_id, label, text) of at most `per_label` documents of each label, and fewer where there are so
    many labels that `most` would be passed; one of each label is always taken.

    `labels` has doc_id and label; of several labels of one id the largest counts. The first ids
    by a hash are taken: the first of each task, then the first of these, so no task sees all ids of
    a label. The ids are written, so Spark knows how few they are when their texts are joined.
    Repeated rows of one id give one text.
    """
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = written(known, "labels")
    number = known.agg(F.count_distinct("label")).first()[0]
    per_label = max(1, min(per_label, most // max(1, number)))
    ids = first_rows(known, ["label"], [F.xxhash64("doc_id"), F.col("doc_id")], per_label, "_n").drop("_n")
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(written(ids, "taught"), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


Features = Callable[[pa.Array], Iterator[np.ndarray]]


def collected_features(
    sample: DataFrame, features: Features, label_type: str, width: int, forms: int = 1
) -> tuple[np.ndarray, np.ndarray]:
    """(labels, x) of a bounded sample, in the order of a hash of the ids.

    A text's features are `forms` vectors of `width`, made where the rows are; what is not zero comes
    back and is laid into one array of single precision. It has all first forms, then all second
    ones, and as many labels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = [], []
            for part in features(batch.column("text")):
                for row in part:
                    held = np.flatnonzero(row)
                    at.append(held.astype("<u4").tobytes())
                    values.append(row[held].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("h"), pa.array(at, pa.binary()), pa.array(values, pa.binary())],
                ["label", "h", "at", "x"],
            )

    sample = sample.select("label", F.xxhash64("doc_id").alias("h"), "text")
    got = sample.mapInArrow(run, f"label {label_type}, h bigint, at binary, x binary").toArrow()
    labels = np.array(got.column("label").to_pylist())
    order = np.lexsort((labels, got.column("h").to_numpy())) if len(labels) else []
    x = np.zeros((forms, len(order), width), np.float32)
    places, values = got.column("at"), got.column("x")
    for to, i in enumerate(order):
        i = int(i)
        at = np.frombuffer(places[i].as_py(), "<u4")
        x[at // width, to, at % width] = np.frombuffer(values[i].as_py(), "<f4")
    return np.tile(labels[order], forms) if len(order) else labels, x.reshape(forms * len(order), width)


def scales(x: np.ndarray) -> np.ndarray:
    """Factors that give rare features a say; they are folded into the weights."""
    mean, square = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for begin in range(0, len(x), 256):  # without a copy of all inputs
        part = x[begin : begin + 256].astype(np.float64)
        mean += part.sum(axis=0) / len(x)
        square += (part**2).sum(axis=0) / len(x)
    deviation = np.sqrt(np.maximum(0, square - mean**2))
    return 1 / (deviation + 0.02 * deviation.max() + 1e-9)


def length(x: np.ndarray) -> np.float32:
    """The root of the mean square length of the rows."""
    return np.float32(np.sqrt(np.einsum("ij,ij->i", x, x).mean(dtype=np.float64)))


def fitted(
    gradient: Callable[[np.ndarray, np.ndarray], np.ndarray], shape: tuple[int, ...], steps: int, rate: float
) -> np.ndarray:
    """Full-batch Adam from zero; gradient(weights, bias) gives d/d(weights and bias row).

    Products with the inputs are in single precision, so that the inputs are not copied."""
    w = np.zeros(shape)
    m, v = np.zeros(shape), np.zeros(shape)
    for t in range(1, steps + 1):
        g = gradient(w[:-1].astype(np.float32), w[-1])
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * np.asarray(x, np.float64))


def platt(margins: np.ndarray, labels: np.ndarray, prior: float | None = None) -> tuple[float, float]:
    """a, b so that sigmoid(a * margin + b) is a probability, fitted by Newton's method on
    softened targets; with `prior`, b is moved from the sample's share of ones to it."""
    ones = labels.sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * w)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
    if prior is not None:
        share = (ones + 1) / (len(labels) + 2)
        w[1] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return float(w[0]), float(w[1])


def trimmed(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word spans without ASCII punctuation around them; a word of nothing else stays."""
    alnum = np.zeros(256, bool)
    alnum[128:] = True
    for a, b in ((48, 58), (65, 91), (97, 123)):
        alnum[a:b] = True
    held = alnum[texts.data]
    good = np.flatnonzero(held)
    before = np.zeros(len(held) + 1, np.int64)
    np.cumsum(held, out=before[1:])
    low, high = before[words.starts], before[words.ends] - 1
    has = high >= low
    starts, ends = words.starts.copy(), words.ends.copy()
    starts[has] = good[low[has]]
    ends[has] = good[high[has]] + 1
    return starts, ends
