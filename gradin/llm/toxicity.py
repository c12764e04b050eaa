"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word goes in as the embedding of its hash beside the mean embedding of its character triples.
Two gated recurrent units read a window of words in both directions, attention pools their
states, and the pooled state gives the window's logit. Windows of 32 words begin every 8 words,
so any 25 words stand whole in one, and the last one reaches the end, and a text's score is that
of its worst window, turned into a probability on rows the network was not fitted on. All of it is
numpy: training on a bounded sample of labelled rows on the driver, scoring in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradin.llm import features as X
from gradin.llm.graph import written
from gradin.llm.hashing import LOWER, Texts, pieces, span_hashes

LENGTH, STRIDE = 32, 8
WORD_BUCKETS, CHAR_BUCKETS = 1 << 13, 1 << 12
WIDTH, HIDDEN = 6, 8
PER_LABEL = 1500
EPOCHS, LEAST_STEPS = 6, 200
#: Windows that are scored at a time.
_AT_ONCE = 2048


@dataclass
class Units:
    """Distinct words of some texts: word buckets, character triples, and which word each is."""

    ids: np.ndarray  #: for each word of the texts its distinct word, from 1 on
    first: np.ndarray
    word: np.ndarray  #: the bucket of each distinct word
    grams: np.ndarray  #: the buckets of all triples of all distinct words, one word after another
    gram_first: np.ndarray


def units(texts: Texts) -> Units:
    words = texts.words()
    lower = LOWER[texts.data]
    starts, ends = X.trimmed(texts, words)
    hashes = span_hashes(texts.prefix(lower), starts, ends)
    distinct, at, ids = np.unique(hashes, return_index=True, return_inverse=True)
    a, b = starts[at], ends[at]
    # each distinct word between two marks, triples of bytes
    size = b - a + 2
    first = np.concatenate([[0], np.cumsum(size)])
    spread = np.repeat(a - 1 - first[:-1], size) + np.arange(first[-1])
    held = lower[np.clip(spread, 0, max(0, len(lower) - 1))] if len(lower) else np.zeros(0, np.uint8)
    held = held.astype(np.uint32)
    held[first[:-1]] = 1
    held[first[1:] - 1] = 2
    grams = X.char_grams(held, 3, CHAR_BUCKETS)
    whole = np.ones(len(held), bool)
    whole[np.concatenate([first[1:] - 1, first[1:] - 2])] = False
    grams = grams[whole[: len(grams)]]
    bucket = (distinct >> np.uint64(30)).astype(np.int64) & (WORD_BUCKETS - 1)
    return Units(ids + 1, words.first, bucket, grams, np.concatenate([[0], np.cumsum(size - 2)]))


def window_starts(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window its text and its first word; the last window of a text ends with it.

    A text without words has one window, of nothing.
    """
    n = np.diff(first)
    number = np.where(n <= LENGTH, 1, 1 + -(-(n - LENGTH) // STRIDE))
    text = np.repeat(np.arange(len(n)), number)
    rank = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    start = np.minimum(rank * STRIDE, np.maximum(0, n - LENGTH)[text])
    return text, first[:-1][text] + start


def window_words(u: Units, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(LENGTH, windows) numbers of distinct words; 0 where the text has ended."""
    at = start[None, :] + np.arange(LENGTH)[:, None]
    inside = at < u.first[1:][text][None, :]
    return np.where(inside, np.concatenate([u.ids, [0]])[np.minimum(at, len(u.ids))], 0)


class Network:
    """Parameters by name; the gates are update, reset and candidate, forward then backward."""

    def __init__(self, seed: int, word_prior: np.ndarray, char_prior: np.ndarray):
        draw = np.random.default_rng(seed)
        part = lambda *shape: draw.normal(0, 0.15, shape)
        self.p = {"word": part(WORD_BUCKETS, WIDTH), "char": part(CHAR_BUCKETS, WIDTH)}
        # the first component begins as the log odds of the training labels
        self.p["word"][:, 0] = word_prior
        self.p["char"][:, 0] = char_prior
        for d in "fb":
            self.p["x" + d] = part(2 * WIDTH, 3 * HIDDEN) * 2
            self.p["h" + d] = part(HIDDEN, 3 * HIDDEN) * 2
            self.p["b" + d] = np.zeros(3 * HIDDEN)
        self.p["attend"], self.p["out"], self.p["bias"] = part(2 * HIDDEN), part(2 * HIDDEN) * 3, np.zeros(1)

    def embedded(self, word: np.ndarray, grams: np.ndarray, gram_first: np.ndarray) -> np.ndarray:
        """The input of each distinct word."""
        chars = X.summed(self.p["char"][grams], gram_first[:-1], gram_first[1:])
        chars /= np.maximum(1, np.diff(gram_first))[:, None]
        return np.concatenate([self.p["word"][word], chars], axis=1)

    def step(self, d: str, xw: np.ndarray, h: np.ndarray):
        """One step of a recurrent unit: the new state and what its gradient needs."""
        hw = h @ self.p["h" + d]
        gates = X.sigmoid(xw[:, : 2 * HIDDEN] + hw[:, : 2 * HIDDEN])
        update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(xw[:, 2 * HIDDEN :] + reset * hw[:, 2 * HIDDEN :])
        return update * h + (1 - update) * new, (h, update, reset, new, hw[:, 2 * HIDDEN :])

    def loss_gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """Logits of windows, the gradient of their weighted log loss by parameter, and by input.

        x: (LENGTH, n, 2 * WIDTH); mask: (LENGTH, n), 1 where there is a word.
        """
        steps, n, _ = x.shape
        states, kept = np.zeros((steps, n, 2 * HIDDEN)), {}
        for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            xw = x @ self.p["x" + d] + self.p["b" + d]
            h, own = np.zeros((n, HIDDEN)), slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            for t in order:
                new, kept[d, t] = self.step(d, xw[t], h)
                m = mask[t][:, None]
                h = m * new + (1 - m) * h
                states[t, :, own] = h
        attend = np.exp(states @ self.p["attend"]) * mask
        total = attend.sum(axis=0) + 1e-9
        a = attend / total
        pooled = (a[:, :, None] * states).sum(axis=0)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        g: dict[str, np.ndarray] = {}
        d_logit = (X.sigmoid(logit) - y) * weight
        g["bias"], g["out"] = np.array([d_logit.sum()]), pooled.T @ d_logit
        d_pooled = d_logit[:, None] * self.p["out"]
        d_a = (states * d_pooled).sum(axis=2)
        d_s = a * (d_a - (a * d_a).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", d_s, states)
        d_states = a[:, :, None] * d_pooled + d_s[:, :, None] * self.p["attend"]
        d_x = np.zeros_like(x)
        for d, order in (("f", range(steps - 1, -1, -1)), ("b", range(steps))):
            own = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            d_xw = np.zeros((steps, n, 3 * HIDDEN))
            g["h" + d] = np.zeros((HIDDEN, 3 * HIDDEN))
            d_h = np.zeros((n, HIDDEN))
            for t in order:
                h, update, reset, new, hn = kept[d, t]
                d_h = d_h + d_states[t, :, own]
                m = mask[t][:, None]
                d_new = m * d_h
                d_candidate = d_new * (1 - update) * (1 - new**2)
                d_update = d_new * (h - new) * update * (1 - update)
                d_reset = d_candidate * hn * reset * (1 - reset)
                d_xw[t] = np.concatenate([d_update, d_reset, d_candidate], axis=1)
                d_hw = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
                g["h" + d] += h.T @ d_hw
                d_h = (1 - m) * d_h + d_new * update + d_hw @ self.p["h" + d].T
            g["b" + d] = d_xw.sum(axis=(0, 1))
            g["x" + d] = np.einsum("tni,tnj->ij", x, d_xw)
            d_x += d_xw @ self.p["x" + d].T
        return logit, g, d_x

    def frozen(self) -> Frozen:
        return Frozen({k: v.astype(np.float32) for k, v in self.p.items()})


class Frozen:
    """The network for scoring, in single precision: gates by tanh alone, and attention summed
    up on the way back instead of keeping all states."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    def logits(self, u: Units, ids: np.ndarray) -> np.ndarray:
        """Of windows, given as columns of distinct words' numbers."""
        p = self.p
        chars = X.summed(p["char"][u.grams], u.gram_first[:-1], u.gram_first[1:]).astype(np.float32)
        chars /= np.maximum(1, np.diff(u.gram_first)).astype(np.float32)[:, None]
        x = np.concatenate([p["word"][u.word], chars], axis=1)
        halves = np.ones(3 * HIDDEN, np.float32)
        halves[: 2 * HIDDEN] = 0.5
        table, inner = {}, {}
        for d in "fb":
            xw = np.concatenate([np.zeros((1, 3 * HIDDEN), np.float32), x @ p["x" + d]]) + p["b" + d]
            table[d] = xw * halves
            inner[d] = np.ascontiguousarray((p["h" + d] * halves).T)
        out = np.empty(ids.shape[1], np.float32)
        for begin in range(0, ids.shape[1], _AT_ONCE):
            some = np.ascontiguousarray(ids[:, begin : begin + _AT_ONCE])
            out[begin : begin + _AT_ONCE] = self._some(some, table, inner)
        return out

    def _some(self, ids: np.ndarray, table: dict, inner: dict) -> np.ndarray:
        p, n = self.p, ids.shape[1]
        mask = (ids > 0).astype(np.float32)
        full = bool(mask.all())
        heads = np.stack([p["attend"], p["out"]])
        ahead = np.empty((LENGTH, 2, n), np.float32)
        top = np.zeros(n, np.float32)
        total = np.full(n, 1e-9, np.float32)
        half = np.float32(0.5)
        for d, order in (("f", range(LENGTH)), ("b", range(LENGTH - 1, -1, -1))):
            h = np.zeros((HIDDEN, n), np.float32)
            for t in order:
                # a row for each gate, so that all steps run along windows
                xw = np.ascontiguousarray(np.take(table[d], ids[t], axis=0, mode="clip").T)
                hw = inner[d] @ h
                gates = xw[: 2 * HIDDEN]
                gates += hw[: 2 * HIDDEN]
                np.tanh(gates, out=gates)
                gates *= half
                gates += half
                new = hw[2 * HIDDEN :]
                new *= gates[HIDDEN:]
                new += xw[2 * HIDDEN :]
                np.tanh(new, out=new)
                moved = h - new
                moved *= gates[:HIDDEN]
                moved += new
                h = moved if full else h + mask[t] * (moved - h)
                if d == "f":
                    ahead[t] = heads[:, :HIDDEN] @ h
                else:
                    both = ahead[t] + heads[:, HIDDEN:] @ h
                    weight = np.exp(both[0]) * mask[t]
                    total += weight
                    top += weight * both[1]
        return top / total + p["bias"][0]


@dataclass
class Model:
    network: Frozen
    slope: float
    shift: float


def text_logits(network: Frozen, texts: Texts) -> np.ndarray:
    """Of each text the highest of its windows."""
    u = units(texts)
    text, start = window_starts(u.first)
    out = np.full(len(texts), -np.inf, np.float32)
    # windows with a word missing are handled apart, so that the others need no mask
    short = (np.diff(u.first) < LENGTH)[text]
    for own in (np.flatnonzero(~short), np.flatnonzero(short)):
        for begin in range(0, len(own), 16 * _AT_ONCE):
            some = own[begin : begin + 16 * _AT_ONCE]
            np.maximum.at(out, text[some], network.logits(u, window_words(u, text[some], start[some])))
    return out


def _log_odds(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of each word bucket and character bucket: log odds of toxic against other rows, by the
    number of sampled texts that have it. Counted where the rows are; two bounded vectors per
    task come back."""
    size = WORD_BUCKETS + CHAR_BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size + 1), np.int64)
        for batch in batches:
            label = batch.column("label").to_numpy()
            for begin, texts in pieces(batch.column("text")):
                u = units(texts)
                of_gram = np.repeat(np.arange(len(u.word)), np.diff(u.gram_first))
                for i in range(len(texts)):
                    own = np.unique(u.ids[u.first[i] : u.first[i + 1]]) - 1
                    mine = counts[label[begin + i]]
                    mine[np.unique(u.word[own])] += 1
                    has = np.zeros(len(u.word), bool)
                    has[own] = True
                    mine[WORD_BUCKETS + np.unique(u.grams[has[of_gram]])] += 1
                    mine[size] += 1
        at, = np.nonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(counts[0][at]), pa.array(counts[1][at])], ["bucket", "zeros", "ones"]
        )

    rows = sample.mapInArrow(run, "bucket bigint, zeros bigint, ones bigint")
    got = rows.groupBy("bucket").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toPandas()
    counts = np.zeros((2, size + 1))
    counts[:, got["bucket"]] = got[["zeros", "ones"]].to_numpy().T
    share = (counts[:, :size] + 0.5) / (counts[:, size:] + 1)
    odds = np.clip(np.log(share[1] / share[0]), -3, 3)
    odds[counts[:, :size].sum(axis=0) < 3] = 0
    return odds[:WORD_BUCKETS], odds[WORD_BUCKETS:]


@dataclass
class OddsStrength:
    """Of each window the sum of its words' squared log odds, where these speak for toxic."""

    word: np.ndarray
    char: np.ndarray

    def __call__(self, u: Units, text: np.ndarray, start: np.ndarray) -> np.ndarray:
        chars = X.summed(self.char[u.grams], u.gram_first[:-1], u.gram_first[1:])
        value = self.word[u.word] + chars / np.maximum(1, np.diff(u.gram_first))
        sums = np.concatenate([[0], np.cumsum(np.maximum(0, value)[u.ids - 1] ** 2)])
        return sums[np.minimum(start + LENGTH, u.first[1:][text])] - sums[start]


@dataclass
class NetworkStrength:
    network: Frozen

    def __call__(self, u: Units, text: np.ndarray, start: np.ndarray) -> np.ndarray:
        return self.network.logits(u, window_words(u, text, start))


def _training_windows(sample: DataFrame, strength) -> list:
    """(label, words, triples, lengths): of each sampled text the strongest window, and of one
    that is not toxic another by a hash. Windows have whole words; texts are not bounded."""
    held = sample.sparkSession.sparkContext.broadcast(strength)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            label, h = batch.column("label").to_numpy(), batch.column("h").to_numpy()
            for begin, texts in pieces(batch.column("text")):
                u = units(texts)
                text, start = window_starts(u.first)
                stop = np.minimum(start + LENGTH, u.first[1:][text])
                value = held.value(u, text, start)
                cuts = np.searchsorted(text, np.arange(len(texts) + 1))
                for i in range(len(texts)):
                    a, b = cuts[i], cuts[i + 1]
                    picks = {int(a + value[a:b].argmax())}
                    if not label[begin + i]:
                        picks.add(int(a + int(h[begin + i]) % (b - a)))
                    for w in sorted(picks):
                        own = u.ids[start[w] : stop[w]] - 1
                        grams = [u.grams[u.gram_first[k] : u.gram_first[k + 1]] for k in own]
                        rows.append(
                            (
                                int(label[begin + i]), int(h[begin + i]), u.word[own].astype(np.int16).tobytes(),
                                np.concatenate([*grams, np.zeros(0, np.uint32)]).astype(np.int16).tobytes(),
                                np.array([len(x) for x in grams], np.int32).tobytes(),
                            )
                        )
        names = ["label", "h", "word", "grams", "lengths"]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    got = sample.mapInArrow(run, "label int, h bigint, word binary, grams binary, lengths binary").toPandas()
    got = got.sort_values(["h", "word", "label"], kind="stable")
    read = lambda x, kind=np.int16: np.frombuffer(x, kind).astype(np.int64)
    return [(r.label, read(r.word), read(r.grams), read(r.lengths, np.int32)) for r in got.itertuples()]


def _train(net: Network, windows: list, epochs: int, seed: int) -> None:
    y_all = np.array([w[0] for w in windows], float)
    balance = np.where(y_all > 0, 0.5 / max(1, y_all.sum()), 0.5 / max(1, (1 - y_all).sum())) * len(y_all)
    draw = np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    batch, t = 128, 0
    epochs = max(epochs, -(-LEAST_STEPS // -(-len(windows) // batch)))
    every = epochs * -(-len(windows) // batch)
    for _ in range(epochs):
        order = draw.permutation(len(windows))
        for begin in range(0, len(order), batch):
            some = order[begin : begin + batch]
            word = np.concatenate([windows[i][1] for i in some])
            grams = np.concatenate([windows[i][2] for i in some])
            lengths = np.concatenate([windows[i][3] for i in some])
            sizes = np.array([len(windows[i][1]) for i in some])
            gram_first = np.concatenate([[0], np.cumsum(lengths)])
            e = net.embedded(word, grams, gram_first)
            place = np.arange(LENGTH)[:, None] < sizes[None, :]
            at = np.where(place, np.concatenate([[0], np.cumsum(sizes)[:-1]])[None, :] + np.arange(LENGTH)[:, None], 0)
            x = np.concatenate([e, np.zeros((1, 2 * WIDTH))])[np.where(place, at, len(e))]
            _, g, d_x = net.loss_gradient(x, place.astype(float), y_all[some], balance[some] / len(some))
            d_e = np.zeros((len(e) + 1, 2 * WIDTH))
            d_e[at[place]] = d_x[place]
            d_e = d_e[:-1]
            for name, rows, d in (
                ("word", word, d_e[:, :WIDTH]),
                ("char", grams, np.repeat(d_e[:, WIDTH:] / np.maximum(1, lengths)[:, None], lengths, axis=0)),
            ):
                g[name] = np.stack(
                    [np.bincount(rows, d[:, k], len(net.p[name])) for k in range(WIDTH)], axis=1
                )
            t += 1
            rate = 0.01 * (1 - 0.9 * t / every)
            for k, v in net.p.items():
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.01 * (g[k] ** 2 - second[k])
                v -= rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)


def fit(
    docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, epochs: int = EPOCHS, seed: int = 7
) -> Model | None:
    """Fit on the texts of `docs` that `labels` (doc_id, toxic 0/1) covers: at most `per_label`
    of each label, the first by a hash. Every fifth of them is left for the probabilities,
    which follow the labels' shares. None unless both labels occur."""
    labels = labels.where("toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("label"))
    shares = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    sample = X.labelled_sample(docs, labels, per_label).select("label", F.xxhash64("doc_id").alias("h"), "text")
    sample = written(sample, "labelled")
    own, apart = sample.where("pmod(h, 5) <> 0"), sample.where("pmod(h, 5) = 0")
    odds = _log_odds(own)
    windows = _training_windows(own, OddsStrength(*odds))
    if len({w[0] for w in windows}) < 2:
        return None
    learner = Network(seed, *odds)
    _train(learner, windows, epochs, seed)
    # the windows that this network finds worst teach it what it still takes for toxic
    _train(learner, windows + _training_windows(own, NetworkStrength(learner.frozen())), epochs // 2, seed + 1)
    network = learner.frozen()
    margins = _margins(apart, network)
    if margins["label"].nunique() < 2:
        margins = _margins(sample, network)
    prior = shares[1] / (shares[0] + shares[1])
    return Model(network, *X.platt(margins["m"].to_numpy(), margins["label"].to_numpy().astype(float), prior))


def _margins(sample: DataFrame, network: Frozen):
    held = sample.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in pieces(batch.column("text")):
                m = text_logits(held.value, texts).astype(np.float64)
                own = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([own.column("label"), own.column("h"), pa.array(m)], ["label", "h", "m"])

    got = sample.mapInArrow(run, "label int, h bigint, m double").toPandas()
    return got.sort_values(["h", "m"], kind="stable")


def scored(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows with `score` (the probability of label 1) and `predicted` (1 from 0.5 on).

    Every window of the whole text is scored; one begins every STRIDE words. A null or empty text has one window
    of no words. Without a model the score is 0. Equal texts get equal results; no other column
    is read. Columns already called `score` or `predicted` are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(text)
    names = [*kept, "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if known is not None:
                for begin, texts in pieces(batch.column(at)):
                    m = text_logits(known.network, texts).astype(np.float64)
                    score[begin : begin + len(texts)] = X.sigmoid(known.slope * m + known.shift)
            hit = pa.array((score >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), hit], names)

    schema = T.StructType(list(docs.schema.fields)).add("score", "double").add("predicted", "integer")
    return docs.mapInArrow(run, schema)
