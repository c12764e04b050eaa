"""Phrases, license notices and the Merkle manifest against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradin.llm import licenses, merkle, phrases
from gradin.llm.hashing import LOWER

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, p int, `rank` int, g string, node string"


def frame(spark, rows):
    """Rows of (doc_id, text, lang) beside columns whose names clash with those that operators make."""
    return spark.createDataFrame(
        [(i, t, lang, None if i == 3 else "s", None if t is None else len(t), 1, 2, "g", "n") for i, t, lang in rows], KIND
    )


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- phrases ---------------------------------------------------------------------------


def mined(rows, longest, least, most, share):
    """The contract in plain Python."""
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * a >= share * f[p[i : i + size]]:
                        inside.add(p[i : i + size])
        scored = []
        for p, a in found.items():
            if p not in inside:
                cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for n, (score, a, phrase, l, r) in enumerate(sorted(scored)[:most], 1):
            out.add((lang, n, phrase.decode(), -a, l, r, total[lang], -score))
    return out


@pytest.fixture(scope="module")
def prose():
    draw = random.Random(5)
    words = ["the", "of", "New", "york", "city", "hall", "é", "ß", "a", "zu", "x-y", "naïve"] + [f"w{i}" for i in range(25)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(draw.randrange(60)):
            text.append(draw.choice(words) if draw.random() < 0.7 else draw.choice(["New York City Hall", "the of", "a zu a zu"]))
            text.append(draw.choice([" ", "  ", "\t", " ", ", ", ".", "\n", "   "]))
        rows.append((i, "".join(text), [None, "de", "en", "und"][i % 4]))
    rows += [(200, None, "de"), (201, "", "de"), (202, " ,.; \n", "fr"), (203, "one", "fr"), (204, "a zu " * 20000, "en")]
    return rows + rows[:30]


@pytest.mark.parametrize(("longest", "most"), [(3, 2000), (3, 7), (2, 2000), (4, 2000)])
def test_phrases_match_brute_force(spark, prose, longest, most, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 4000)
    docs = frame(spark, prose).repartition(5)
    found = phrases.collocations(docs, longest=longest, least=10, most=most).collect()
    assert {tuple(r) for r in found} == mined(prose, longest, 10, most, 50)
    assert len(found) > 20


def test_phrases_of_nothing(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, None), (2, " ", "de"), (3, "a b c", "de")])).count() == 0


def test_scores_beyond_64_bits(spark):
    """a * a * 1,000,000 passes 64 bits from some four million on; the decimals hold it."""
    rows = [(1, "de", ["a", "b"], 9_000_000_000, [9_000_000_001], [9_000_000_007])]
    kind = "id bigint, lang string, words array<string>, f bigint, firsts array<bigint>, lasts array<bigint>"
    row = phrases._scored(spark.createDataFrame(rows, kind), 2).first()
    assert row.score == 10**6 * 9_000_000_000**2 // (9_000_000_001 * 9_000_000_007)


@pytest.mark.parametrize("shift", [0, 2**33])
def test_tiles_count_all_pairs(shift, monkeypatch):
    monkeypatch.setattr(phrases, "SORTED", 500)
    monkeypatch.setattr(phrases, "MOST_SEEN", 900)
    draw = np.random.default_rng(3)
    p, q = (np.where(draw.random(4000) < 0.5, draw.integers(0, 30, 4000), draw.integers(0, 9000, 4000) + shift) for _ in "pq")
    tiles, found = phrases.Tiles(), Counter()
    parts = [t for i in range(0, 4000, 250) for t in tiles.add(p[i : i + 250], q[i : i + 250])] + list(tiles.left())
    for a, b, n in parts:
        for x, y, k in zip(a.tolist(), b.tolist(), n.tolist()):
            found[x, y] += k
    assert found == Counter(zip(p.tolist(), q.tolist()))


@pytest.mark.parametrize(("length", "shift"), [(3, 0), (3, 2**33), (4, 0), (5, 2**20)])
def test_longer_runs_are_counted_where_both_parts_are_frequent(spark, length, shift, monkeypatch):
    monkeypatch.setattr(phrases, "SORTED", 300)
    draw = np.random.default_rng(4)
    texts = [np.where(draw.random(400) < 0.1, -1, draw.integers(0, 5, 400) + shift) for _ in range(6)]
    counts = {
        n: Counter(r for t in texts for r in zip(*(t[k:].tolist() for k in range(n)), strict=False) if min(r) >= 0)
        for n in (length - 1, length)
    }
    parts = [r for r, n in counts[length - 1].items() if n >= 4]
    columns = ", ".join(f"w{k} bigint" for k in range(length - 1))
    bitmap = phrases._bitmap(spark.createDataFrame(parts, columns))
    rows = spark.createDataFrame([(bytearray(phrases.packed(t)),) for t in texts], "sequence binary")
    found = {tuple(r)[:-1]: r.f for r in phrases._counted(rows, length, 4, bitmap).collect()}
    assert found == {r: n for r, n in counts[length].items() if n >= 4}
    assert len(found) > 3


def test_phrases_are_joined_by_a_row_each_and_not_by_their_places(spark, monkeypatch):
    """Before, each pair of each block was joined with the numbered pairs."""
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 200)
    rows = [(i, " ".join(f"w{j % 7}" for j in range(i, i + 60)), "de") for i in range(80)]
    docs = frame(spark, rows)
    made, kind = [], type(docs)

    def join(self, other, on=None, how=None, f=kind.join):
        out = f(self, other, on, how)
        if "lang" not in str(on) and "block" not in str(on):
            made.append(out.count())
        return out

    monkeypatch.setattr(kind, "join", join)
    assert phrases.collocations(docs).count() > 0
    assert made and max(made) <= 14, made  # 7 pairs and 7 triples, in 80 blocks


def test_the_bitmap_misses_no_pair(spark):
    pairs = spark.range(5000).selectExpr("id * 3 AS p", "id * id AS q")
    bitmap = phrases._bitmap(pairs)
    i = np.arange(5000, dtype=np.int64)
    bit = phrases._bit(i * 3, i * i)
    assert ((bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).all()
    other = phrases._bit(i * 3 + 1, i * i)
    assert ((bitmap[other >> np.uint64(3)] >> (other & np.uint64(7)).astype(np.uint8)) & 1).mean() < 0.01


# ---- license notices -------------------------------------------------------------------


def scanned(text, templates):
    """Each template against each place of the text, by whole diagonals of words."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
    out = []
    for number, t in enumerate(templates):
        wanted = [w.decode() for w in t.words]
        hits = defaultdict(set)
        for d in range(-len(wanted), len(words)):
            for at in range(len(wanted) - t.k + 1):
                if 0 <= d + at and words[d + at : d + at + t.k] == wanted[at : at + t.k]:
                    hits[d].add(at)
        spans = []
        for d in sorted(hits):
            if spans and d - spans[-1][-1] <= t.gap:
                spans[-1].append(d)
            else:
                spans.append([d])
        for span in spans:
            covered = {at + j for d in span for at in hits[d] for j in range(t.k)}
            if len(covered) / len(wanted) >= t.share:
                places = [d + at + j for d in span for at in hits[d] for j in range(t.k)]
                out.append((t.label, number, t.base, min(places), max(places), len(covered) / len(wanted)))
    return len(words), sorted(out, key=lambda s: (s[3], s[4], s[1]))


def test_licenses_match_brute_force(spark):
    draw = random.Random(2)
    full = [t.text for t in licenses.TEMPLATES if t.share < 1]
    texts = [
        None, "", " .;", "mit", "MIT License", "the mit-license; MIT\nLICENSE! mit license mit license", "Général Public License",
        "general public license general public licenses", "GNU General Public License v3", "CC BY-NC 4.0, cc by sa",
        "é mit license ü", "mit licenseé", "permission is hereby granted " * 30, "word " * 20000 + "Apache License",
    ]
    for text in full:
        words = text.split()
        texts.append("intro " + text + " outro " + text)
        for drop, put in ((3, 0), (0, 4), (6, 6)):
            own = list(words)
            for _ in range(drop):
                own.pop(draw.randrange(len(own)))
            for _ in range(put):
                own.insert(draw.randrange(len(own)), draw.choice(["new", "words", "here"]))
            texts.append(" ".join(own))
        texts += [" ".join(words[: int(len(words) * part)]) for part in (0.3, 0.49, 0.6)]
    rows = [(i if i % 9 else None, t, "en") for i, t in enumerate(texts)] + [(5, texts[5], "en"), (4, "MIT License", "en")]
    docs = frame(spark, [(i if i is not None else -1, t, lang) for i, t, lang in rows])
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") >= 0, F.col("doc_id"))).repartition(4)
    found = Counter(
        (r.doc_id, r.n_words, tuple((s.label, s.template, s.base, s.first_word, s.last_word, s.share) for s in r.spans))
        for r in licenses.scan(docs).collect()
    )
    expected = Counter()
    for i, text, _ in rows:
        n, spans = scanned(text, licenses.TEMPLATES)
        expected[i, n, tuple(spans)] += 1
    assert found == expected
    labels = {s.label for r in licenses.scan(docs).collect() for s in r.spans}
    assert labels >= {"mit", "apache", "gpl", "bsd", "cc-by-nc", "cc-by-sa"}


def test_spans_have_their_text(spark):
    text = "See: Licensed under The MIT\n  License, é."
    row = licenses.scan(frame(spark, [(1, text, "en")])).first()
    assert [s.text for s in row.spans] == ["MIT\n  License"]


def test_licenses_of_nothing(spark):
    assert licenses.scan(frame(spark, [])).count() == 0
    with pytest.raises(ValueError, match="fewer than 2 words"):
        licenses.scan(frame(spark, []), [licenses.Template("x", "one")])


def test_long_texts_are_looked_up_in_rows_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(licenses, "CHUNK", 7)
    text = "a b c d e f mit license " * 40
    row = licenses.scan(frame(spark, [(1, text, "en")])).first()
    assert [s.first_word for s in row.spans] == list(range(6, 320, 8))


# ---- the manifest ----------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    """The root, and of each leaf the siblings on its way up as (left, right)."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
            ways[leaf].append(("".join(run[: i % 8]), "".join(run[i % 8 + 1 :])))
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        at = [i // 8 for i in at]
    return nodes[0], ways


def leaf_of(row, text):
    fields = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


@pytest.mark.parametrize("sizes", [{"a": 700, "é": 65, None: 9, "b": 1, "c": 8}, {"a": 1}, {"a": 73}, {None: 8, "z": 1}])
def test_manifest_matches_brute_force(spark, sizes, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 64)
    rows, n = [], 0
    for lang, count in sizes.items():
        for _ in range(count):
            rows.append((n * 37 % 10007, [None, "", "Text É of Row", "lower"][n % 4] if n % 5 else f"T{n}", lang))
            n += 1
    rows += [(None, "no id", r[2]) for r in rows[:1] if n > 10] * 3 + rows[5:8]
    docs = frame(spark, [(-1 if i is None else i, t, lang) for i, t, lang in rows])
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") >= 0, F.col("doc_id"))).repartition(6)
    copy = F.when(F.col("doc_id") % 3 == 0, F.unhex(merkle.digest(merkle.record(
        [F.lower(F.col(f)) if f == "text" else F.col(f) for f in merkle.FIELDS]))))
    found = merkle.manifest(docs, carry={"copy": copy})
    found = found.withColumn("folded", merkle.folded(F.coalesce(F.lower(F.hex("copy")), "leaf"), F.col("path")))
    got = Counter(
        (r.doc_id, r.lang, r.leaf, r.subroot, r.root, r.proof, r.folded)
        for r in found.withColumn("proof", merkle.proof(F.col("path"))).collect()
    )
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r.lang].append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, expected = {}, Counter()
    for lang in langs:
        own = groups[lang] = sorted(groups[lang], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[lang] = tree([leaf_of(r, r.text) for r in own])
    root, tops = tree([trees[g][0] for g in langs])
    for g, top in zip(langs, tops):
        for r, way in zip(groups[g], trees[g][1]):
            leaf = leaf_of(r, r.text)
            acc = leaf_of(r, r.text and r.text.lower()) if r.doc_id is not None and r.doc_id % 3 == 0 else leaf
            for left, right in way + top:
                acc = sha(left + acc + right)
            proof = sha("".join(a + b for a, b in way + top))
            expected[r.doc_id, g, leaf, trees[g][0], root, proof, acc] += 1
    assert got == expected


def test_manifest_of_nothing(spark):
    assert merkle.manifest(frame(spark, [])).count() == 0


def test_only_levels_are_windowed_and_only_in_blocks(spark):
    """The hot language's nodes are spread over windows of a bounded number of nodes."""
    nodes = spark.range(3000).selectExpr("'hot' AS g", "id AS at", "3000L AS n", "unhex(sha2(string(id), 256)) AS node")
    level = merkle._level(nodes)
    text = level._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\((g#\d+, )?_w\d+#\d+L", text)
    assert level.where("above IS NOT NULL").count() == 375


def test_lower_casing_is_of_ascii_alone():
    assert bytes(LOWER[np.frombuffer("ÀZ".encode(), np.uint8)]).decode() == "Àz"
    assert zlib.crc32(b"12") % 3 in (0, 1, 2)
