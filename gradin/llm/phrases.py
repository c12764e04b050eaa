"""Phrases whose words stand together more often than their parts alone would.

Words get numbers by falling frequency, and texts become sequences of these numbers. Two
neighbours address a cell of a square that is cut into tiles: the tiles of frequent words are counted
densely (`numpy.bincount` on the address within the tile), all others as sorted coordinates with
counts. Longer runs of numbers are counted as sorted coordinates, and only those of which a bitmap of
fixed size allows both parts that are shorter by one. The bitmap holds a hash of each frequent phrase
of that length, so it misses none; what it lets through by chance is too rare in the end. Frequent
phrases find their parts by the numbers of their words, one row each; no row of a text is joined with them.

Texts are read once, into blocks: a dictionary of the block's words and the sequence of their places in
it. Dictionaries are joined with the numbered words, not broadcast, as a vocabulary grows with the
corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradin.llm.graph import written
from gradin.llm.hashing import BASE, LOWER, Texts, Words, mixed, pieces
from gradin.operators.numbering import numbered
from gradin.operators.ranking import first_rows

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Words of a side of a tile, and sides of the square of tiles that are counted densely.
TILE = 1024
DENSE = 3
#: Occurrences outside the dense tiles that a task sorts at a time.
SORTED = 1_000_000
#: Occurrences that a task's dense tiles hold in 32 bits before they are given out.
MOST_SEEN = 1 << 30
#: Bits of the bitmap of frequent phrases, 8 MB whatever the corpus, in pieces of 32,768.
FILTER_BITS = 26
PIECE_BITS = 15
ROWS = 1 << 18

_SEPARATES = np.zeros(256, bool)
_SEPARATES[[46, 44, 59, 58, 33, 63, 10, 11, 12, 13]] = True
_OUTSIDE = _SEPARATES.copy()
_OUTSIDE[[32, 9]] = True


def packed(numbers: np.ndarray) -> bytes:
    kind = np.int32 if not len(numbers) or numbers.max() < 2**31 else np.int64
    data = numbers.astype(kind).tobytes()
    return (b"4" if kind is np.int32 else b"8") + zstandard.ZstdCompressor(level=1).compress(data)


def unpacked(data: bytes) -> np.ndarray:
    kind = np.int32 if data[:1] == b"4" else np.int64
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), kind).astype(np.int64)


def encoded(texts: Texts) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words by falling count, their counts, and the texts as places in that list.

    Places count from 1; a 0 stands between two pieces.
    """
    words = Words.of(texts, _OUTSIDE)
    inside = texts.data[~_OUTSIDE[texts.data]]
    inside = LOWER[inside]
    ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    column = pa.Array.from_buffers(
        pa.large_string(), len(words.starts), [None, pa.py_buffer(ends), pa.py_buffer(inside)]
    ).dictionary_encode()
    at = column.indices.to_numpy(zero_copy_only=False)
    counts = np.bincount(at, minlength=len(column.dictionary))
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(1, len(order) + 1)
    # how many separators stand before each word
    before = np.searchsorted(np.flatnonzero(_SEPARATES[texts.data]), words.starts)
    breaks = np.zeros(len(at), bool)
    breaks[1:] = before[1:] != before[:-1]
    begins = words.first[:-1]
    breaks[begins[begins < len(at)]] = True
    sequence = np.zeros(len(at) + int(breaks.sum()), np.int64)
    sequence[np.arange(len(at)) + np.cumsum(breaks)] = place[at]
    return column.dictionary.take(pa.array(order)), counts[order], sequence


def _blocks(docs: DataFrame, group: str, text: str) -> DataFrame:
    """(block, lang, words, counts, sequence): texts of one language, read and split once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                own = batch.column("text").filter(pc.equal(langs.indices, i))
                for _, texts in pieces(own, BLOCK_BYTES):
                    words, counts, sequence = encoded(texts)
                    if not len(words):
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang]),
                            pa.ListArray.from_arrays([0, len(words)], words.cast(pa.string())),
                            pa.ListArray.from_arrays([0, len(words)], pa.array(counts, pa.int64())),
                            pa.array([packed(sequence)], pa.binary()),
                        ],
                        ["lang", "words", "counts", "sequence"],
                    )

    texts = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    schema = "lang string, words array<string>, counts array<bigint>, sequence binary"
    out = texts.where("text IS NOT NULL").mapInArrow(run, schema)
    return written(out.withColumn("block", F.monotonically_increasing_id()), "blocks", compression="zstd")


def runs(sequence: np.ndarray, length: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """At which places of the sequence that many numbers stand together, and a column for each of them."""
    n = max(0, len(sequence) - length + 1)
    columns = [sequence[k : k + n] for k in range(length)]
    whole = np.ones(n, bool)
    for column in columns:
        whole &= column >= 0
    return whole, [column[whole] for column in columns]


def counted_runs(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The distinct runs as sorted coordinates, and their counts; sorted in place where a run fits one number."""
    bits = [int(column.max(initial=0)).bit_length() for column in columns]
    if sum(bits) <= 63:
        keys = np.zeros(len(columns[0]), np.int64)
        for column, width in zip(columns, bits, strict=True):
            keys <<= width
            keys |= column
        keys.sort()
        new = keys[1:] != keys[:-1]
    else:
        order = np.lexsort(columns[::-1])
        columns = [column[order] for column in columns]
        new = np.logical_or.reduce([column[1:] != column[:-1] for column in columns])
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(columns[0])), bool), new]))
    counts = np.diff(np.append(first, len(columns[0])))
    if sum(bits) > 63:
        return [*(column[first] for column in columns), counts]
    keys, out = keys[first], []
    for width in reversed(bits):
        out.append(keys & ((1 << width) - 1))
        keys = keys >> width
    return [*reversed(out), counts]


class Tiles:
    """Counts of runs: dense tiles for pairs of the most frequent numbers, sorted coordinates for all others."""

    def __init__(self) -> None:
        self.dense: dict[tuple[int, int], np.ndarray] = {}
        self.rest: list[list[np.ndarray]] = []
        self.waiting = self.seen = 0

    def add(self, *columns: np.ndarray) -> Iterator[list[np.ndarray]]:
        rest = self._beside_dense(*columns) if len(columns) == 2 else list(columns)
        self.rest.append(rest)
        self.waiting += len(rest[0])
        if self.waiting >= SORTED:
            yield self.sparse()
        if self.seen >= MOST_SEEN:
            yield from self.left()

    def _beside_dense(self, p: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
        """Counts the pairs of the dense tiles and gives the others."""
        head = (p < DENSE * TILE) & (q < DENSE * TILE)
        a, b = p[head], q[head]
        tile = a // TILE * DENSE + b // TILE
        address = a % TILE * TILE + b % TILE
        for t in np.unique(tile):
            counts = np.bincount(address[tile == t], minlength=TILE * TILE)
            place = (t // DENSE, t % DENSE)
            if place not in self.dense:
                self.dense[place] = np.zeros(TILE * TILE, np.uint32)
            self.dense[place] += counts.astype(np.uint32)
        self.seen += len(a)
        return [p[~head], q[~head]]

    def sparse(self) -> list[np.ndarray]:
        columns = [np.concatenate(column) for column in zip(*self.rest, strict=True)]
        self.rest, self.waiting = [], 0
        return counted_runs(columns)

    def left(self) -> Iterator[list[np.ndarray]]:
        if self.rest:
            yield self.sparse()
        for (row, column), counts in self.dense.items():
            at = np.flatnonzero(counts)
            yield [row * TILE + at // TILE, column * TILE + at % TILE, counts[at]]
        self.dense, self.seen = {}, 0


def _keys(length: int) -> list[str]:
    """The columns with the numbers of a phrase's words."""
    return [f"w{k}" for k in range(length)]


def _counted(sequences: DataFrame, length: int, least: int, bitmap: np.ndarray | None = None) -> DataFrame:
    """(w0, w1, ..., f): the runs of that many numbers that occur `least` times or more.

    `bitmap` holds all frequent runs shorter by one.
    """
    held = None if bitmap is None else sequences.sparkSession.sparkContext.broadcast(bitmap)
    names = [*_keys(length), "f"]

    def allowed(sequence: np.ndarray) -> list[np.ndarray]:
        if held is None:
            return runs(sequence, length)[1]
        whole, parts = runs(sequence, length - 1)
        frequent = np.zeros(len(whole), bool)
        bit = _bit(*parts)
        frequent[whole] = held.value[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1
        at = np.flatnonzero(frequent[:-1] & frequent[1:])
        return [sequence[at + k] for k in range(length)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles()

        def found() -> Iterator[list[np.ndarray]]:
            for batch in batches:
                for data in batch.column("sequence"):
                    yield from tiles.add(*allowed(unpacked(data.as_py())))
            yield from tiles.left()

        for columns in found():
            for begin in range(0, len(columns[0]), ROWS):
                part = [pa.array(c[begin : begin + ROWS], pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(part, names)

    rows = sequences.select("sequence").mapInArrow(run, ", ".join(f"{c} bigint" for c in names))
    return rows.groupBy(*_keys(length)).agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _bit(first: np.ndarray, *rest: np.ndarray) -> np.ndarray:
    h = first.astype(np.uint64)
    with np.errstate(over="ignore"):
        for column in rest:
            h = mixed(h * BASE + column.astype(np.uint64))
    return h >> np.uint64(64 - FILTER_BITS)


def _bitmap(phrases: DataFrame) -> np.ndarray:
    """The bitmap of the hashes of phrases, given as a column for each number: 2,048 pieces of 4 KB at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = _bit(*(column.to_numpy() for column in batch.columns)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bits)], ["bit"])

    bits = phrases.mapInArrow(run, "bit bigint")
    piece = F.shiftright("bit", PIECE_BITS)
    out = np.zeros(1 << FILTER_BITS >> 3, np.uint8).reshape(-1, 1 << PIECE_BITS >> 3)
    held = bits.groupBy(piece.alias("piece")).agg(
        F.bitmap_construct_agg(F.pmod("bit", F.lit(1 << PIECE_BITS))).alias("bits")
    )
    for row in held.toLocalIterator():
        out[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _places(found: DataFrame) -> DataFrame:
    """(block, known): the places of a block's symbols and their numbers; a block bounds the list."""
    return found.groupBy("block").agg(F.collect_list(F.struct("i", "id")).alias("known"))


def _known(column: pa.Array, row: int) -> tuple[np.ndarray, np.ndarray]:
    value = column[row].values
    if value is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return value.field("i").to_numpy(), value.field("id").to_numpy()


def _rewritten(blocks: DataFrame, places: DataFrame) -> DataFrame:
    """(sequence): the blocks in the numbers of the words; -1 where there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                old = unpacked(batch.column("sequence")[row].as_py())
                i, number = _known(batch.column("known"), row)
                numbers = np.full(int(old.max(initial=0)) + 1, -1, np.int64)
                numbers[i + 1] = number
                new = numbers[old]
                held = new >= 0
                held[1:] |= new[:-1] >= 0  # of several gaps in a row one is enough
                yield pa.RecordBatch.from_arrays([pa.array([packed(new[held])], pa.binary())], ["sequence"])

    rows = blocks.select("block", "sequence").join(places, "block")
    return written(rows.mapInArrow(run, "sequence binary"), "sequences")


def _ranked(words: DataFrame) -> DataFrame:
    """The words with their number: rank by falling frequency."""
    words = written(words.withColumn("less", -F.col("f")), "symbols", compression="zstd")
    return written(numbered(words, [], ["less", "lang", "word"], "id").drop("less"), "ranked", compression="zstd")


def _phrases(found: DataFrame, parts: DataFrame, length: int) -> DataFrame:
    """The phrases of a length with lang, words, and the frequencies of all first and all last parts.

    `parts` are those shorter by one.
    """
    keys = _keys(length)
    left = parts.select(*keys[:-1], "lang", "words", F.concat("firsts", F.array("f")).alias("firsts"))
    right = parts.select(
        *[F.col(part).alias(key) for part, key in zip(keys, keys[1:], strict=False)],
        F.array(F.element_at("words", -1)).alias("word"),
        F.concat("lasts", F.array("f")).alias("lasts"),
    )
    words = F.concat("words", "word").alias("words")
    rows = found.join(left, keys[:-1]).join(right, keys[1:])
    return rows.select(*keys, "f", "lang", words, "firsts", "lasts")


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    most: int = 2000,
    share: int = 50,
    group: str = "lang",
    text: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `most` phrases.

    Texts are lower-cased (A-Z), cut at `.,;:!?` and line ends and then at blanks. A phrase is 2 to
    `longest` words that stand together `least` times or more (a). Cut in two parts that occur l and r times it
    scores a million times a*a / (l*r), rounded down; the lowest cut counts, and of equals the first.
    Phrases within a longer one that occurs in `share` percent or more of their places go. A null
    language is `und`; null and empty texts have no words; repeated rows count as often as they
    are there. Equal scores are ranked by a, then by the phrase's bytes. No words, no rows.
    """
    blocks = _blocks(docs, group, text)
    symbols = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    words = symbols.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    totals = blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda x, y: x + y)).alias("n"))
    words = _ranked(words.where(F.col("f") >= least))
    dictionary = blocks.select("block", "lang", F.posexplode("words").alias("i", "word"))
    dictionary = dictionary.select("block", "lang", F.col("i").cast("bigint").alias("i"), "word")
    places = _places(dictionary.join(words, ["lang", "word"]).select("block", "i", "id"))
    sequences = _rewritten(blocks, places)

    none = F.array().cast("array<bigint>")
    level = words.select(
        F.col("id").alias("w0"), "f", "lang", F.array("word").alias("words"), none.alias("firsts"), none.alias("lasts")
    )
    levels, bitmap = [], None
    for length in range(2, longest + 1):
        found = _counted(sequences, length, least, bitmap)
        level = written(_phrases(found, level, length), "phrases", compression="zstd")
        levels.append(level)
        if length < longest:
            bitmap = _bitmap(level.select(*_keys(length)))
    return _best(levels, totals, most, share)


def _scored(level: DataFrame, length: int) -> DataFrame:
    keys = [c for c in _keys(length) if c in level.columns]
    cuts = []
    for k in range(1, length):
        first, last = f"firsts[{k - 1}]", f"lasts[{length - k - 1}]"
        # whole numbers of up to 38 digits, so counts may have 16
        top, bottom = "1000000BD * f_ * f_", f"CAST({first} AS DECIMAL(18, 0)) * CAST({last} AS DECIMAL(18, 0))"
        cuts.append(f"struct(({top}) DIV ({bottom}) AS score, {k} AS k, {first} AS l, {last} AS r)")
    cut = F.expr(f"array_min(array({', '.join(cuts)}))")
    level = level.withColumn("f_", F.col("f").cast("decimal(16,0)")).withColumn("cut", cut)
    return level.select(*keys, "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")


def _best(levels: list[DataFrame], totals: DataFrame, most: int, share: int) -> DataFrame:
    kept = None
    for at, level in enumerate(levels):
        rows = _scored(level, at + 2)
        keys = _keys(at + 2)
        if at + 1 < len(levels):
            longer, more = levels[at + 1], _keys(at + 3)
            over = longer.select(*keys, F.col("f").alias("most"))
            over = over.union(longer.select(*more[1:], "f"))
            rows = rows.join(over.groupBy(*keys).agg(F.max("most").alias("most")), keys, "left")
            rows = rows.where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("a"))).drop("most")
        rows = rows.drop(*keys)
        kept = rows if kept is None else kept.unionByName(rows)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    best = first_rows(written(kept, "kept"), ["lang"], order, most)
    columns = ["lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"]
    return best.join(totals, "lang").select(*columns)
