"""Language of a text in two steps: its family, then the language within the family.

A softmax over families comes first. Within a family every two languages have a linear support
vector machine; a language's share of the family is the mean of its pairwise probabilities.
Inputs are hashed character pairs and triples of the lower-cased text, averaged over the whole
text. Weights are fitted in numpy on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradin.llm import features as X
from gradin.llm.hashing import Texts, pieces

#: Families of common languages. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk",
    "indic": "hi ur bn pa mr gu ne",
    "semitic": "ar he mt am",
    "turkic": "tr az kk uz tk ky",
    "uralic": "fi et hu",
}
UNKNOWN = "und"
BUCKETS = 2048
ORDERS = (2, 3)
PER_LANGUAGE = 500
_LETTERS = np.zeros(128, bool)
_LETTERS[97:123] = True


def _points(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    points, first = X.code_points(texts)
    return np.where((points < 128) & ~_LETTERS[np.minimum(points, 127)], np.uint32(32), points), first


def _vectors(column: pa.Array) -> Iterator[np.ndarray]:
    """Mean counts of each text's n-grams, and the same for its first characters alone: the
    short form teaches the model short texts."""
    for _, texts in pieces(pc.utf8_lower(column)):
        points, first = _points(texts)
        grams = [X.char_grams(points, n, BUCKETS) for n in ORDERS]
        out = np.zeros((len(texts), 2, len(ORDERS) * BUCKETS))
        for i in range(len(texts)):
            for form, end in enumerate((first[i + 1], min(first[i + 1], first[i] + 80))):
                for k, n in enumerate(ORDERS):
                    own = grams[k][first[i] : max(first[i], end - n + 1)]
                    out[i, form, k * BUCKETS : (k + 1) * BUCKETS] = np.bincount(own, minlength=BUCKETS) / max(1, len(own))
        yield out.reshape(len(texts), -1)


@dataclass
class Model:
    languages: list[str]
    families: list[list[int]]  #: the languages of each family, by number
    pairs: list[tuple[int, int]]  #: languages of one family
    weights: np.ndarray  #: a row per bucket; columns: families, then pairs
    bias: np.ndarray
    scale: np.ndarray  #: of each pair's margin as a probability


def _pair_fit(x: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """A linear support vector machine: squared hinge loss, a small squared penalty."""
    n = np.where(sign > 0, (sign > 0).mean(), (sign < 0).mean()) * 2 * len(sign)

    def gradient(w, b):
        short = np.maximum(0, 1 - sign * (x @ w + b))
        g = -2 * sign * short / n
        return np.concatenate([x.T @ g.astype(np.float32) + 2e-4 * w, [g.sum()]])

    return X.fitted(gradient, (x.shape[1] + 1,), 120, 0.03)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on (doc_id, text, lang): at most `per_language` texts of each language, the first
    by a hash, and 4,000 of all languages together. None if there is no labelled text."""
    labels = docs.select("doc_id", F.col("lang").alias("label"))
    sample = X.labelled_sample(docs, labels, per_language)
    named, x = X.collected_features(sample, _vectors, "string", len(ORDERS) * BUCKETS, 2)
    if not len(named):
        return None
    languages = sorted(set(named.tolist()))
    y = np.searchsorted(languages, named)
    name = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
    groups: dict[str, list[int]] = {}
    for i, code in enumerate(languages):
        groups.setdefault(name.get(code.lower().split("-")[0], f"={code}"), []).append(i)
    families = list(groups.values())
    factor = X.scales(x).astype(np.float32)
    x *= factor
    length = X.length(x)
    x /= length
    norm = factor / length
    family_of = np.empty(len(languages), int)
    for f, members in enumerate(families):
        family_of[members] = f
    columns = []
    target = np.eye(len(families))[family_of[y]]
    weight = (1 / np.bincount(family_of[y]))[family_of[y]][:, None] / len(families)

    def softmax_gradient(w, b):
        logit = x @ w + b
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        g = (p / p.sum(axis=1, keepdims=True) - target) * weight
        return np.concatenate([x.T @ g.astype(np.float32) + 2e-5 * w, g.sum(axis=0)[None]])

    both_w = X.fitted(softmax_gradient, (x.shape[1] + 1, len(families)), 150, 0.05)
    columns += list(both_w.T)
    pairs, scale = [], []
    for members in families:
        for i, j in combinations(members, 2):
            own = (y == i) | (y == j)
            sign = np.where(y[own] == i, 1.0, -1.0)
            taught = x[own]
            w = _pair_fit(taught, sign)
            pairs.append((i, j))
            columns.append(w)
            a, _ = X.platt(taught @ w[:-1] + w[-1], (sign > 0).astype(float))
            del taught
            scale.append(max(a, 1e-3))
    stacked = np.array(columns).T
    weights = (stacked[:-1] * norm[:, None]).astype(np.float32)
    return Model(languages, families, pairs, weights, stacked[-1], np.array(scale))


def _scored(model: Model, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The most probable language of each text, by number, and its probability."""
    points, first = _points(texts)
    margins = np.repeat(model.bias[None], len(texts), axis=0)
    for k, n in enumerate(ORDERS):
        grams = X.char_grams(points, n, BUCKETS)
        begins, ends = X.runs(first, n)
        sums = X.summed(model.weights[k * BUCKETS : (k + 1) * BUCKETS][grams], begins, ends)
        margins += sums / np.maximum(1, ends - begins)[:, None]
    count = len(model.families)
    logit = margins[:, :count]
    family = np.exp(logit - logit.max(axis=1, keepdims=True))
    family /= family.sum(axis=1, keepdims=True)
    votes = np.zeros((len(texts), len(model.languages)))
    for k, (i, j) in enumerate(model.pairs):
        p = X.sigmoid(model.scale[k] * margins[:, count + k])
        votes[:, i] += p
        votes[:, j] += 1 - p
    probability = np.zeros_like(votes)
    for f, members in enumerate(model.families):
        own = votes[:, members] + (len(members) == 1)
        probability[:, members] = family[:, [f]] * own / own.sum(axis=1, keepdims=True)
    # the family is decided first, the language within it
    chosen = family.argmax(axis=1)
    within = np.zeros_like(probability, bool)
    for f, members in enumerate(model.families):
        within[np.ix_(chosen == f, members)] = True
    best = np.where(within, probability, -1).argmax(axis=1)
    return best, probability[np.arange(len(texts)), best]


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows with `lang_pred` and `score` appended, over the whole text of each.

    A text without a letter, an empty one and a null are `und` with score 0. When there was
    nothing to learn from, a text with a letter is `und` without a score: no language was looked
    for. Equal texts get equal results, and no other column is read. Columns already called `lang_pred` or `score` are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    at = kept.index(text)
    names = [*kept, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            column = batch.column(at)
            letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            codes = np.full(len(column), UNKNOWN, object)
            scores = np.zeros(len(column))
            unjudged = letters if known is None else np.zeros(len(column), bool)
            if known is not None:
                for begin, texts in pieces(pc.utf8_lower(column)):
                    best, p = _scored(known, texts)
                    own = slice(begin, begin + len(texts))
                    codes[own] = np.where(letters[own], np.array(known.languages, object)[best], UNKNOWN)
                    scores[own] = np.where(letters[own], p, 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.string()), pa.array(scores, mask=unjudged)], names)

    fields = T.StructType(list(schema.fields)).add("lang_pred", "string").add("score", "double")
    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, fields)


def settled(model: Model | None):
    """Whether a text that `identify` judged is in one language: its score is half or more of the greatest
    that its language can get, which is 1 for a language alone in its family and 2/m for one of m.

    Texts without a letter are not; without a model all others are, as no language was looked for.
    """
    found = F.col("score").isNull() | (F.col("score") > 0)
    if model is None:
        return found
    for members in model.families:
        codes = [model.languages[i] for i in members]
        found &= ~F.col("lang_pred").isin(codes) | (F.col("score") >= min(0.5, 1 / len(members)))
    return found


def learnable(docs: DataFrame) -> DataFrame:
    """The rows that labels may be learned from: crc32 of the doc_id's text mod 4 is not 2."""
    return docs.where(~held_out(4, 2))


def held_out(mod: int, remainder: int):
    """Whether crc32 of the doc_id's text leaves that remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == remainder, F.lit(False))


