"""Packing documents into sequences, in order, by dynamic programming.

The documents of a range of ids form one stream of tokens, which is cut into windows. A cut costs
nothing where a document ends, a little where a sentence ends, and more elsewhere; a window costs
what it leaves empty. As the empty part is linear in both ends of a window, the best previous
cut is the least of (cost + place) over a sliding range of places, which a monotone queue gives
in constant time.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradin.llm.hashing import LOWER, Texts, pieces, span_hashes
from gradin.operators.ranges import in_ranges

CAPACITY = 4096
#: Costs of a cut, in empty places.
SENTENCE, ANYWHERE = 24, 96
#: Where no sentence ends for long, places so far apart can be cut.
FREE_STEP = 256
#: Cuts are chosen for about so many tokens at a time; the last window is chosen again with the
#: tokens that follow.
AT_ONCE = 1 << 19
END_ID = 2
#: Distinct words whose ids a worker remembers, some 15 MB, and how many are encoded at a time.
REMEMBERED = 400_000
ENCODED_AT_ONCE = 4096
#: Bytes of text in a range.
RANGE_BYTES = 32 << 20

_ALNUM, _MARK = np.zeros(256, bool), np.zeros(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _ALNUM[_a:_b] = True
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _MARK[_a:_b] = True


class Remembered:
    """Ids of words by the words' hashes, in flat arrays of some 30 bytes a word.

    New words wait in a short index of their own, so that the long one is rarely merged. Beyond
    `most` words the half that was used longest ago is forgotten.
    """

    KINDS = (np.uint64, np.uint32, np.uint32, np.uint32)  # hash (ascending), begin, size, last use

    def __init__(self, most: int = REMEMBERED):
        self.most, self.now = most, 0
        self.ids = np.zeros(0, np.uint32)
        self.long, self.short = ([np.zeros(0, kind) for kind in self.KINDS] for _ in range(2))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's ids begin and how many there are; -1 where it is not known."""
        if len(self.long[0]) > self.most:
            self._forget()
        begin, size = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        self.now += 1
        for tier in (self.long, self.short):
            if len(tier[0]):
                at = np.minimum(np.searchsorted(tier[0], hashes), len(tier[0]) - 1)
                hit = tier[0][at] == hashes
                begin[hit], size[hit] = tier[1][at[hit]], tier[2][at[hit]]
                tier[3][at[hit]] = self.now
        return begin, size

    def learn(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Hashes ascend and are not known yet; gives where their ids begin."""
        begins = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids])
        new = hashes, begins, sizes, np.full(len(hashes), self.now)
        self.short = self._merged(self.short, [c.astype(kind) for c, kind in zip(new, self.KINDS, strict=True)])
        if len(self.short[0]) > self.most // 16:
            self.long = self._merged(self.long, self.short)
            self.short = [column[:0].copy() for column in self.short]
        return begins

    @staticmethod
    def _merged(one: list[np.ndarray], two: list[np.ndarray]) -> list[np.ndarray]:
        order = np.argsort(np.concatenate([one[0], two[0]]), kind="stable")
        return [np.concatenate([a, b])[order] for a, b in zip(one, two, strict=True)]

    def _forget(self) -> None:
        """Words of the short index stay."""
        kept = np.sort(np.argsort(self.long[3], kind="stable")[-(self.most // 2) :])
        self.long = [column[kept] for column in self.long]
        ids = []
        for tier in (self.long, self.short):
            begins, sizes = tier[1].astype(np.int64), tier[2].astype(np.int64)
            ends = np.cumsum(sizes)
            ids.append(self.ids[np.repeat(begins - (ends - sizes), sizes) + np.arange(sizes.sum())])
            tier[1] = (ends - sizes + (len(ids[0]) if len(ids) > 1 else 0)).astype(np.uint32)
        self.ids = np.concatenate(ids)


class Tokens:
    """Token ids of texts, word by word: words repeat, so each is encoded once and remembered.

    This is the tokenizer's own result, because its splitting never joins what white space
    separates, nor marks that end a word to the ASCII letters or digits before them. Texts with
    a control string are given to it whole. Words are told apart by 64-bit hashes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Remembered()
        ends = re.compile(r"[.!?][\"')\]]*</w>")
        vocabulary = self.tokenizer.get_vocab()
        self.sentence_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.sentence_end[[i for token, i in vocabulary.items() if ends.fullmatch(token)]] = True

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids: many words make one text, a blank between them."""
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for begin in range(0, len(words), ENCODED_AT_ONCE):
            part = words[begin : begin + ENCODED_AT_ONCE]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
            sizes.append(np.bincount(np.searchsorted(ends, starts, "right"), minlength=len(part)))
            ids.append(np.array(found.ids, np.uint32))
        return np.concatenate(sizes), np.concatenate(ids)

    def of(self, texts: Texts) -> list[np.ndarray]:
        words = texts.words()
        lower = LOWER[texts.data]
        # the end of a word without the marks behind it
        cut = words.ends.copy()
        marked = np.flatnonzero(_MARK[texts.data[cut - 1]])
        while len(marked):
            cut[marked] -= 1
            marked = marked[cut[marked] > words.starts[marked]]
            marked = marked[_MARK[texts.data[cut[marked] - 1]]]
        split = (cut > words.starts) & (cut < words.ends)
        split[split] = _ALNUM[texts.data[cut[split] - 1]]
        cut = np.where(split, cut, words.ends)
        number = 1 + split
        first_unit = np.concatenate([[0], np.cumsum(number)])
        starts, ends = np.empty(first_unit[-1], np.int64), np.empty(first_unit[-1], np.int64)
        starts[first_unit[:-1]], ends[first_unit[:-1]] = words.starts, cut
        starts[first_unit[1:][split] - 1], ends[first_unit[1:][split] - 1] = cut[split], words.ends[split]
        hashes, at, which = np.unique(
            span_hashes(texts.prefix(lower), starts, ends), return_index=True, return_inverse=True
        )
        begins, sizes = self.known.find(hashes)
        new = np.flatnonzero(begins < 0)
        if len(new):
            held = lower.tobytes()
            spans = zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)
            new_sizes, new_ids = self._encoded([held[a:b].decode() for a, b in spans])
            begins[new], sizes[new] = self.known.learn(hashes[new], new_sizes, new_ids), new_sizes
        flat = self.known.ids
        of_unit = sizes[which]
        unit_first = np.concatenate([[0], np.cumsum(of_unit)])
        ids = flat[np.repeat(begins[which] - unit_first[:-1], of_unit) + np.arange(unit_first[-1])]
        bounds = unit_first[first_unit[words.first]]
        out = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        marks = np.flatnonzero((texts.data[:-1] == 60) & (texts.data[1:] == 124))
        for i in np.unique(np.searchsorted(texts.offsets, marks, "right") - 1):
            whole = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode()
            out[i] = np.array(self.tokenizer.encode(whole, add_special_tokens=False).ids, np.uint32)
        return out


@cache
def tokens(path: str) -> Tokens:
    return Tokens(path)


def cuts(sizes: list[int], sentence_ends: np.ndarray, capacity: int, sentence: int, anywhere: int) -> list[int]:
    """The ends of the windows of a stream of documents of these sizes, at the least cost.

    `sentence_ends`: places in the stream after which a sentence ends.
    """
    doc_ends = np.cumsum(sizes)
    places = np.union1d(doc_ends, sentence_ends)
    gaps = np.diff(np.concatenate([[0], places]))
    step = min(FREE_STEP, capacity)
    wide = np.flatnonzero(gaps > step)
    free = [np.arange(places[i] - gaps[i] + step, places[i], step) for i in wide]
    places = np.union1d(places, np.concatenate(free)) if free else places
    price = np.full(len(places), anywhere)
    price[np.isin(places, sentence_ends)] = sentence
    price[np.isin(places, doc_ends)] = 0
    at, price = [0, *places.tolist()], [0, *price.tolist()]
    cost, back = [0], [0]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + place, number), values rising
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0][1]] < here - capacity:
            queue.popleft()
        value, i = queue[0]
        own = value + capacity - here + price[j]
        cost.append(own)
        back.append(i)
        own += here
        while queue and queue[-1][0] >= own:
            queue.pop()
        queue.append((own, j))
    out = []
    j = len(at) - 1
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


PIECE = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, `offset` bigint"
)


class _Packer:
    """One range's stream: takes documents, gives rows of PIECE."""

    def __init__(self, shard: int, sentence_end: np.ndarray, capacity: int, sentence: int, anywhere: int):
        self.shard, self.number = shard, shard << 32
        self.sentence_end, self.capacity, self.prices = sentence_end, capacity, (sentence, anywhere)
        self.docs: list[tuple[int | None, int, np.ndarray, int]] = []  # id, start of the rest, rest, all tokens
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((doc_id, 0, ids, len(ids)))
        self.waiting += len(ids)
        if self.waiting >= AT_ONCE:
            yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        sizes = [len(d[2]) for d in self.docs]
        stream = np.concatenate([d[2] for d in self.docs])
        ends = cuts(sizes, np.flatnonzero(self.sentence_end[stream]) + 1, self.capacity, *self.prices)
        # the last window is decided again with what follows
        ends = ends if last else ends[:-1]
        i, at, place = 0, 0, 0  # document, its taken part, place in the stream
        for end in ends:
            begin = place
            while place < end:
                doc_id, start, ids, total = self.docs[i]
                n = min(end - place, len(ids) - at)
                piece = ids[at : at + n].astype("<u4").tobytes()
                yield doc_id, start + at, n, piece, total, self.number, place - begin
                place, at = place + n, at + n
                if at == len(ids):
                    i, at = i + 1, 0
            self.number += 1
        rest = self.docs[i:]
        if rest and at:
            doc_id, start, ids, total = rest[0]
            rest[0] = doc_id, start + at, ids[at:], total
        self.docs = rest
        self.waiting = sum(len(d[2]) for d in rest)


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    sentence: int = SENTENCE,
    anywhere: int = ANYWHERE,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Rows of PIECE: parts of documents with their token ids (little-endian unsigned 32-bit), the sequence
    and the place in it.

    `tokenizer` is the path of a vocabulary file. A document's ids are followed by `end_id`, so
    an empty or null text has that one id. Documents are ordered by id, then by a hash of the
    text, nulls first; each range of the order is a stream of its own, whose last sequence may
    be short. Ranges depend on the rows alone, so reruns agree, whatever the partitions. Every row is
    packed, repeated ones as often as they occur. Texts are moved to their range before they
    are split into tokens, and a task holds some hundred thousand tokens and the longest text in
    memory. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("n", F.coalesce(F.octet_length("text"), F.lit(0)) + 16)
    rows = in_ranges(rows, "doc_id", "h", "n", range_bytes, "shard").select("shard", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(tokenizer)
        packer = None
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names
            )

        for batch in batches:
            shards, doc_ids = batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist()
            for begin, texts in pieces(batch.column("text")):
                for i, ids in enumerate(own.of(texts), begin):
                    out = []
                    if packer is None or packer.shard != shards[i]:
                        out += packer.flush(True) if packer else []
                        packer = _Packer(shards[i], own.sentence_end, capacity, sentence, anywhere)
                    out += packer.add(doc_ids[i], np.append(ids, np.uint32(end_id)))
                    if out:
                        yield batch_of(out)
        if packer and (out := list(packer.flush(True))):
            yield batch_of(out)

    return rows.mapInArrow(run, PIECE)
