"""Quality rules with a learned verdict.

Base counts come from whole texts: words, characters in words, symbols, repeated lines and
words in repeated runs of three. Beside them a logistic regression over hashed word and
character n-grams is trained on labelled rows, its output turned into probabilities on rows
that it was not fitted on, and texts are scored in Arrow batches against fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradin.llm import features as X
from gradin.llm.hashing import Texts, Words, mixed, pieces, span_hashes

BUCKETS = 2048
CHARS = (1, 3)
WORDS = (1, 2)
PER_LABEL = 800
#: A text is kept if its probability of good quality is at least this.
KEEP_AT = 0.5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[back] > 1


def base_counts(texts: Texts, words: Words, hashes: np.ndarray, prefix: np.ndarray) -> dict[str, np.ndarray]:
    n = words.counts
    leads = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[texts.data])])
    of_word = leads[words.ends] - leads[words.starts]
    chars = np.concatenate([[0], np.cumsum(of_word)])
    doc = np.repeat(np.arange(len(texts)), n)
    salt = mixed(np.arange(1, len(texts) + 1, dtype=np.uint64))
    # windows of three words within a text
    whole = np.flatnonzero(doc[:-2] == doc[2:]) if len(doc) > 2 else np.zeros(0, int)
    keys = salt[doc[whole]]
    for j in range(3):
        keys = mixed(keys + hashes[whole + j])
    again = whole[_repeated(keys)]
    covered = np.zeros(len(doc) + 1, bool)
    for j in range(3):
        covered[again + j] = True
    repeat = np.concatenate([[0], np.cumsum(covered[:-1])])
    # lines: spans between line feeds, those of them with a word
    breaks = np.flatnonzero(texts.data == 10)
    begins = np.unique(np.concatenate([texts.offsets[:-1], breaks + 1]))
    begins = begins[begins < len(texts.data)]
    line_doc = np.searchsorted(texts.offsets, begins, "right") - 1
    stop = np.append(breaks, len(texts.data))[np.searchsorted(breaks, begins)]
    ends = np.minimum(stop, texts.offsets[line_doc + 1])
    has = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, begins)
    begins, ends, line_doc = begins[has], ends[has], line_doc[has]
    lines = mixed(salt[line_doc] + span_hashes(prefix, begins, ends))
    _, firsts = np.unique(lines, return_index=True)
    dup = np.ones(len(lines), bool)
    dup[firsts] = False
    return {
        "n_words": n,
        "word_chars": np.diff(chars[words.first]),
        "n_symbols": symbols[texts.offsets[1:]] - symbols[texts.offsets[:-1]],
        "n_dup_lines": np.bincount(line_doc[dup], minlength=len(texts)),
        "n_repeat_words": np.diff(repeat[words.first]),
    }


def _grams(texts: Texts, words: Words, hashes: np.ndarray):
    """The buckets of each kind of n-gram, and where each text's begin and end."""
    points, first = X.code_points(texts)
    for n in CHARS:
        yield X.char_grams(points, n, BUCKETS), *X.runs(first, n)
    for n in WORDS:
        yield X.word_grams(hashes, n, BUCKETS), *X.runs(words.first, n)


def _units(texts: Texts) -> tuple[Words, np.ndarray, np.ndarray]:
    words = texts.words()
    prefix = texts.prefix()
    return words, span_hashes(prefix, words.starts, words.ends), prefix


def _vectors(column: pa.Array) -> Iterator[np.ndarray]:
    for _, texts in pieces(column):
        words, hashes, _ = _units(texts)
        out = []
        for grams, begins, ends in _grams(texts, words, hashes):
            own = [np.bincount(grams[a:b], minlength=BUCKETS) / max(1, b - a) for a, b in zip(begins, ends, strict=True)]
            out.append(np.array(own).reshape(len(texts), BUCKETS))
        yield np.concatenate(out, axis=1)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model | None:
    """Fit on the texts of `docs` that `labels` (doc_id, quality 0/1) covers: at most
    `per_label` of each label, the first by a hash. Every fifth of them is left for the
    probabilities, which follow the labels' shares. None unless both labels occur."""
    labels = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("label"))
    shares = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    named, x = X.collected_features(X.labelled_sample(docs, labels, per_label), _vectors, "int", (len(CHARS) + len(WORDS)) * BUCKETS)
    if len(set(named.tolist())) < 2:
        return None
    y = named.astype(float)
    factor = X.scales(x).astype(np.float32)
    x *= factor
    size = X.length(x)
    x /= size
    factor /= size
    apart = np.arange(len(y)) % 5 == 0
    if len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        apart[:] = True
    own = ~apart if not apart.all() else apart
    taught = x[own]
    n = np.where(y[own] > 0, max(1, y[own].sum()), max(1, (1 - y[own]).sum())) * 2

    def gradient(w, b):
        g = (X.sigmoid(taught @ w + b) - y[own]) / n
        return np.concatenate([taught.T @ g.astype(np.float32) + 1e-4 * w, [g.sum()]])

    w = X.fitted(gradient, (x.shape[1] + 1,), 150, 0.05)
    margins = x[apart] @ w[:-1] + w[-1]
    slope, shift = X.platt(margins, y[apart], shares[1] / (shares[0] + shares[1]))
    return Model((w[:-1] * factor).astype(np.float32), float(w[-1]), slope, shift)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Model | None, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, the base counts, base_failed, score (the probability of good quality) and kept,
    one row per input row.

    A null or empty text has no words, so it fails the base. Without a model the score is null
    and the base alone decides. Repeated rows get equal results; no other column is read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COLUMNS) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            for begin, texts in pieces(batch.column("text")):
                words, hashes, prefix = _units(texts)
                counts = base_counts(texts, words, hashes, prefix)
                score = pa.nulls(len(texts), pa.float64())
                if known is not None:
                    margin = np.full(len(texts), known.bias)
                    for k, (grams, begins, ends) in enumerate(_grams(texts, words, hashes)):
                        part = known.weights[k * BUCKETS : (k + 1) * BUCKETS][grams]
                        margin += X.summed(part, begins, ends) / np.maximum(1, ends - begins)
                    score = pa.array(X.sigmoid(known.slope * margin + known.shift))
                ids = batch.column("doc_id").slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(counts[c].astype(np.int64)) for c in COLUMNS], score], ["doc_id", *COLUMNS, "score"]
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= keep_at, F.lit(True)))
