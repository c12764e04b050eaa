"""The operators against brute force on small fixtures, and their defined cases."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gradin.llm import ann, chat, langid, mixing, neardup, packing, quality, toxicity, urls, warc
from gradin.llm.graph import components
from gradin.llm.hashing import pieces
from gradin.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Nulls, empty and blank texts, ties and repeated rows, one long text, no letters.
TEXTS = [None, "", " \n\t", "one", "one", "a b c", "A b\nC d e f", "a b c d e f g", "42 !!", "é ü. ñ", "w " * 30000]
DOCS = "doc_id bigint, text string, lang string, source string, score string, `offset` int"


def docs_of(spark, texts, **columns):
    """Documents beside columns whose names clash with those that operators make."""
    rows = [(i, t, "en", f"s{i % 2}", "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).withColumns({k: F.lit(v) for k, v in columns.items()})


def near_texts():
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(draw.choice(words, 60)) for _ in range(12)]
    out = list(TEXTS)
    for text in base:
        parts = text.split()
        for changes in (0, 1, 2, 3, 4, 6, 9):
            own = list(parts)
            for at in draw.choice(len(own), changes, replace=False):
                own[at] = f"x{draw.integers(1000)}"
            out.append(" ".join(own))
    return out


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_match_brute_force(spark, k):
    texts = near_texts()
    sets = []
    for t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    found = neardup.near_duplicates(docs_of(spark, texts), shingle_words=k).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found} == {
        (i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)
    }


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(docs_of(spark, [])).count() == 0


def test_sketches_tell_the_difference(spark):
    """Differing minima estimate the similarity; differing cells never exceed the difference."""
    x = np.arange(1000, dtype=np.uint64)
    from gradin.llm.hashing import mixed

    sets = [mixed(x[:800]), mixed(x[80:880])]
    least = neardup.minima(np.concatenate(sets), np.array([0, 800, 1600]))
    schema = "n bigint, low array<bigint>, parity array<bigint>"
    sides = []
    for own, bits, side in zip(sets, neardup.packed(least), ("_a", "_b"), strict=True):
        lists = [[int(v) for v in row.view(np.int64)] for row in (bits, neardup.parities(own))]
        sides.append(spark.createDataFrame([(len(own), *lists)], schema).select(*neardup._sketch(side)))
    differ = [neardup._differing_minima().alias("minima"), neardup._differing_cells().alias("cells")]
    row = sides[0].join(sides[1], F.lit(True)).select(*differ, neardup._likely(80).alias("likely")).first()
    agreed = 1 - row.minima / (neardup.KEPT * (1 - 0.5**neardup.BITS))
    assert abs(agreed - 720 / 880) < 0.12
    assert row.minima == sum((least[0] & 15) != (least[1] & 15))
    assert 100 < row.cells <= 160
    assert row.likely


@pytest.mark.parametrize("percent", [50, 80, 95, 100])
def test_sketches_drop_few_pairs_at_the_bound(spark, percent):
    """Of the pairs whose similarity is the bound, by the binomial tail."""
    p = (1 - percent / 100) * (1 - 0.5**neardup.BITS)
    tail = lambda m: sum(math.comb(180, k) * p**k * (1 - p) ** (180 - k) for k in range(m + 1, 181))
    most = max(m for m in range(181) if m == 0 or tail(m - 1) >= 1e-7)
    planes = np.zeros((181, neardup.KEPT), np.uint32)
    for m in range(181):
        planes[m, :m] = 1
    low = [[int(v) for v in row] for row in neardup.packed(planes).view(np.int64)]
    schema = "m int, n bigint, low array<bigint>, parity array<bigint>"
    rows = spark.createDataFrame([(m, 100, low[m], [0] * 16) for m in range(181)], schema)
    one = rows.where("m = 0").select(*neardup._sketch("_a"))
    found = one.join(rows.select("m", *neardup._sketch("_b")), F.lit(True)).where(neardup._likely(percent))
    assert {r.m for r in found.select("m").collect()} == set(range(most + 1))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, j) for j in range(101, 130)] + [(7, 7), (200, 199)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert {got[i] for i in range(31)} == {0} and {got[i] for i in range(100, 130)} == {100} and got[200] == 199


def test_packing_is_an_exact_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = [*TEXTS, "it's Don't, 'S rock' (x)", "<|endoftext|> a <|STARTOFTEXT|>", "É e\u0301 \u00a0x\u2003y ﬀ", "a.b.c 3.14, x…!"]
    found = defaultdict(list)
    rows = packing.pack(docs_of(spark, texts), tokenizer_path()).collect()
    for r in rows:
        found[r.doc_id].append(r)
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted(found[i], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == np.array(ids, "<u4").tobytes()
        assert all(r.doc_tokens == len(ids) for r in own)
        assert [r.start for r in own] == [sum(p.length for p in own[:j]) for j in range(len(own))]
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096


def test_cuts_cost_the_least():
    """The monotone queue against all ways to cut."""
    draw = np.random.default_rng(1)
    for _ in range(60):
        sizes = draw.integers(1, 9, 6).tolist()
        sentences = np.unique(draw.integers(1, sum(sizes), 5))
        ends = set(np.cumsum(sizes).tolist())
        places = sorted(ends | set(sentences.tolist()))
        price = {p: 0 if p in ends else 3 for p in places}

        def cost(chosen, price=price):
            gaps = np.diff([0, *chosen])
            return sum(10 - g for g in gaps) + sum(price[p] for p in chosen) if max(gaps) <= 10 else None

        ways = [
            cost((*some, places[-1])) for n in range(len(places)) for some in itertools.combinations(places[:-1], n)
        ]
        got = packing.cuts(sizes, sentences, 10, 3, 50)
        assert cost(got) == min(w for w in ways if w is not None)


def test_languages(spark):
    samples = {
        "en": "the cat and the dog went with this house that thing",
        "de": "der hund und die katze gingen nicht mit ihrem haus",
        "fr": "le chien et les chats sont dans une maison avec nous",
        "es": "el perro y los gatos que con una casa para nosotros",
    }
    draw = np.random.default_rng(0)
    rows = [
        (i, " ".join(draw.choice(samples[lang].split(), 12)), lang)
        for i, lang in enumerate(draw.choice(list(samples), 200))
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(langid.learnable(docs))
    assert model.languages == ["de", "en", "es", "fr"] and len(model.families) == 2 and len(model.pairs) == 2
    found = langid.identify(docs.withColumn("score", F.lit("mine")), model).collect()
    assert np.mean([r.lang_pred == r.lang for r in found]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)
    odd = {r.doc_id: r for r in langid.identify(docs_of(spark, TEXTS), model).collect()}
    assert [odd[i].lang_pred == "und" for i in range(len(TEXTS))] == [
        not re.search(r"[^\W\d_]", t or "") for t in TEXTS
    ]
    assert {r.lang_pred for r in langid.identify(docs, langid.fit(docs.limit(0))).collect()} == {"und"}


def test_quality_counts_and_verdict(spark):
    texts = [*TEXTS, "a b c\na b c\nx\n\n \nx", "a b c a b c a", "l # * $\nl # * $", "é é é é <x>\n"]
    found = {r.doc_id: r for r in quality.judge(docs_of(spark, texts), None).collect()}
    for i, t in enumerate(texts):
        words = WORD.findall(t or "")
        runs = Counter(tuple(words[j : j + 3]) for j in range(len(words) - 2))
        again = {j + d for j in range(len(words) - 2) if runs[tuple(words[j : j + 3])] > 1 for d in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        expected = (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""),
            len(lines) - len(set(lines)), len(again),
        )
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(words) < 50 or 100 * len(again) > 50 * len(words))
    good, bad = "plain words of a text that runs on " * 3, "###*** $$$ %%% BUY!! " * 4
    docs = docs_of(spark, [f"{good if i % 2 else bad} {i}" for i in range(120)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    scores = {r.doc_id: r.score for r in quality.judge(docs, quality.fit(docs, labels)).collect()}
    assert all((scores[i] > 0.5) == bool(i % 2) for i in scores)
    assert quality.fit(docs, labels.where("quality = 1")) is None


def test_nearest_neighbours_match_brute_force(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(600, 8)).astype(np.float32)
    x[50:60] = x[40]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [None] * 8), (1080, [1.0]), (None, [1.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(1))
    found = defaultdict(list)
    for r in ann.search(table, lambda i: F.pmod(i, F.lit(20)) == 0, k=20).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == set(range(0, 600, 20))
    hits, v = 0, x.astype(np.float64)
    for q, got in found.items():
        score = (v * v[q]).sum(axis=1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(600), -score))[:20]
        hits += len(set(best.tolist()) & {i for i, _ in got})
        assert [s for _, s in got] == pytest.approx([float((v[i] * v[q]).sum()) for i, _ in got], abs=1e-12)
        assert got == sorted(got, key=lambda p: (-p[1], p[0]))
    assert hits / (20 * len(found)) >= 0.9
    assert ann.search(table.limit(0), lambda i: i > 0).count() == 0


def test_queries_get_k_neighbours_beside_many_equal_vectors(spark, monkeypatch):
    """A third of the vectors are equal: they teach many parts and fill one."""
    monkeypatch.setattr(ann, "PART_SCALE", 1)
    draw = np.random.default_rng(6)
    x = draw.normal(size=(1500, 8))
    x[::3] = x[0]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(20, [float(v) for v in x[1]])] * 30
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    router = ann.fit
    def few(*given):
        out = router(*given)
        out.probes = 1
        return out
    monkeypatch.setattr(ann, "fit", few)
    found = ann.search(table, lambda i: F.pmod(i, F.lit(5)) == 0, k=60).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in found} == {i: 60 for i in range(0, 1500, 5)}


def test_mix_meets_its_targets(spark):
    draw = np.random.default_rng(4)
    rows = [
        (i, " ".join("w" * n for n in range(1, 2 + int(draw.integers(40)))), None if i % 7 == 0 else f"s{i % 5}")
        for i in range(900)
    ] + [(5000, None, "s1"), (5001, "", "zero"), (5002, "a b", "s2"), (5002, "a b", "s2")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit(0))
    first = mixing.mix(docs).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, mixing.mix(docs).collect())) and len(first) == len(rows)
    keys = sorted({r.key for r in first}, key=lambda k: (k == "n", k))
    size = {k: sum(r.size for r in first if r.key == k) for k in keys}
    weight = {k: (3, 1, 2)[i % 3] for i, k in enumerate(keys)}
    total, capped = 1.5 * sum(size.values()), set()
    while True:  # reshare what stands above twice a source's size
        left = total - sum(2 * size[k] for k in capped)
        level = left / sum(weight[k] for k in keys if k not in capped)
        over = {k for k in keys if k not in capped and level * weight[k] >= 2 * size[k]}
        if not over:
            break
        capped |= over
    for k in keys:
        own = [r for r in first if r.key == k]
        target = 2 * size[k] if k in capped else level * weight[k]
        assert own[0].target == pytest.approx(target)
        assert abs(sum(r.copies * r.size for r in own) - target) <= 40
        assert all(r.copies <= 2 for r in own)
    again = mixing.mixed_documents(docs)
    assert again.columns == docs.columns and again.count() == sum(r.copies for r in first)


def test_gradients_of_the_network():
    draw = np.random.default_rng(0)
    net = toxicity.Network(1, np.zeros(toxicity.WORD_BUCKETS), np.zeros(toxicity.CHAR_BUCKETS))
    x = draw.normal(size=(toxicity.LENGTH, 3, 2 * toxicity.WIDTH))
    mask = np.ones((toxicity.LENGTH, 3))
    mask[5:, 0] = 0
    y, weight = np.array([1.0, 0, 1]), np.array([1.0, 2, 1])

    def loss():
        p = toxicity.X.sigmoid(net.loss_gradient(x, mask, y, weight)[0])
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    _, g, d_x = net.loss_gradient(x, mask, y, weight)
    for name in ("xf", "hf", "bf", "xb", "hb", "bb", "attend", "out", "bias"):
        at = tuple(draw.integers(0, n) for n in net.p[name].shape)
        net.p[name][at] += 1e-5
        up = loss()
        net.p[name][at] -= 2e-5
        down = loss()
        net.p[name][at] += 1e-5
        assert g[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6), name
    x[2, 1, 3] += 1e-5
    up = loss()
    x[2, 1, 3] -= 2e-5
    assert d_x[2, 1, 3] == pytest.approx((up - loss()) / 2e-5, rel=1e-3, abs=1e-6)


def test_toxic_words_are_found_anywhere(spark):
    draw = np.random.default_rng(5)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("lo", "mi", "ran", "set")]
    texts = []
    for i in range(300):
        own = draw.choice(words, int(draw.integers(5, 150))).tolist()
        if i % 3 == 0:
            own[int(draw.integers(len(own)))] = str(draw.choice(["grumpus", "Blarg!", "snarkle"]))
        texts.append(" ".join(own))
    docs = docs_of(spark, texts)
    labels = docs.select("doc_id", F.expr("IF(doc_id % 3 = 0, 1, 0)").alias("toxic"))
    model = toxicity.fit(docs, labels.where("doc_id % 5 <> 0"))
    found = toxicity.scored(docs, model).orderBy("doc_id").collect()
    held = [r for r in found if r.doc_id % 5 == 0]
    assert np.mean([r.predicted == (r.doc_id % 3 == 0) for r in held]) >= 0.95
    odd = toxicity.scored(docs_of(spark, TEXTS), model).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None


def test_every_word_is_in_a_window():
    texts = next(pieces(pa.array([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 31, 32, 33, 56, 57, 200)])))[1]
    u = toxicity.units(texts)
    text, start = toxicity.window_starts(u.first)
    ids = toxicity.window_words(u, text, start)
    for i, n in enumerate(u.first[1:] - u.first[:-1]):
        seen = ids[:, text == i]
        assert set(seen[seen > 0].tolist()) == set(u.ids[u.first[i] : u.first[i + 1]].tolist()) or n == 0


def test_every_span_of_half_a_window_is_whole_in_one():
    assert toxicity.STRIDE <= toxicity.LENGTH // 2
    span = toxicity.LENGTH // 2 + 1
    texts = next(pieces(pa.array([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 32, 33, 56, 57, 200)])))[1]
    u = toxicity.units(texts)
    text, start = toxicity.window_starts(u.first)
    for i, n in enumerate(np.diff(u.first)):
        own = start[text == i] - u.first[i]
        for a in range(n - span + 1):
            assert ((own <= a) & (a + span <= own + toxicity.LENGTH)).any()


CONTROLS = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\|end|>", "<|turn|>user<|text|>", "[\\INST]<<SYS>>", "\\", "<<s>", "é\n"]


def test_chats_are_read_back(spark):
    rows = [(c, t, r, x) for c in (1, 2) for t, (r, x) in enumerate(itertools.product(["user", "assistant", None, "<|end|>"], CONTROLS))]
    rows += [(3, 0, "user", None), (3, 0, "user", None), (None, None, None, "x")]
    chats = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(0))
    out = chat.format_chats(chat.canonical_turns(chats, "conv_id"))
    back = {r.chat_id: r for r in chat.read_chats(out).collect()}
    for c in (1, 2, 3, None):
        own = sorted([r for r in rows if r[0] == c], key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in back[c].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert back[c].loss_text == "".join(r[3] or "" for r in own if r[2] == "assistant")


def test_layouts_by_fingerprint(spark):
    lines = [
        ('{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}', "messages"),
        ('{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}', "conversations"),
        ('{"prompt": "a", "response": "b"}', "prompt response"),
        ('{"instruction": "a", "input": "", "output": "b"}', "instruction input"),
        ('{"question": "a", "answer": "b"}', "question"),
        ('{"other": 1}', None), ("{", None), (None, None),
    ]
    df = spark.createDataFrame([(x,) for x, _ in lines], "value string")
    found = {r.value: r for r in chat.canonical_json(df).collect()}
    for value, layout in lines:
        assert found[value].layout == layout
        turns = [(t.role, t.text) for t in found[value].turns]
        assert turns == ([("user", "a"), ("assistant", "b")] if layout else [])
    table = spark.createDataFrame([(1, "a", "b")], "id int, prompt string, completion string")
    assert [tuple(t) for t in chat.canonical_turns(table, "id").first().turns] == [("user", "a"), ("assistant", "b")]
    with pytest.raises(ValueError, match="no layout"):
        chat.canonical_turns(spark.createDataFrame([(1, "a")], "id int, zzz string"), "id")


def test_url_membership_is_exact(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS_PER_KEY", 5)  # many keys pass wrongly, so that levels follow
    monkeypatch.setattr(urls, "CHUNK", 4)
    pages = [(i, f"http://Host{i % 97}.example.net/p/{i}?q#f") for i in range(900)]
    pages += [(1000, None), (1001, "no scheme"), (1002, "x://"), (1003, "http://A.org"), (1004, "http://a.org/x")]
    table = spark.createDataFrame(pages, "page_id bigint, url string").withColumn("verdict", F.lit("mine"))
    blocked = spark.createDataFrame([(f"host{i % 97}.example.net/p/{i}",) for i in range(0, 900, 3)] + [("absent",)], "key string")
    rules = (urls.Rule("block", "org", "/"),)
    found = {r.page_id: r for r in urls.judge(table, rules, blocked).collect()}
    assert all(found[i].verdict == ("allow" if i % 3 else "block") for i in range(900))
    assert [(found[i].host, found[i].path, found[i].rule) for i in range(1000, 1005)] == [
        ("", "", None), ("", "", None), ("", "", None), ("a.org", "", None), ("a.org", "/x", "org/"),
    ]
    monkeypatch.setattr(urls, "SHARD_KEYS", 100)
    again = {r.page_id: r.verdict for r in urls.judge(table, rules, blocked).collect()}
    assert again == {i: r.verdict for i, r in found.items()}


def test_archives(spark, tmp_path):
    same = "<p>x</p>" * 200
    pages = [(1, "http://a", same), (9, "http://b", same), (5, None, same), (2, "u\r\nv", "short"), (3, "http://c", "short")]
    pages += [(4, "http://d", None), (None, "http://e", same), (6, "http://f", "é" * 600), (9, "http://b", same)]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("n", F.lit(1))
    folders = [str(tmp_path / name) for name in "ab"]
    sums = []
    for folder in folders:
        listed = warc.write_archive(table, folder, roll_at=500).collect()
        sums.append(sorted((r.file, r.records, r.bytes, r.sha256) for r in listed))
        assert sum(r.records for r in listed) == len(pages) and len(listed) > 1
    assert sums[0] == sums[1]
    found = warc.read_archive(spark, folders[0]).collect()
    kinds = sorted((r.page_id or -1, r.record_type, r.refers_to, r.payload_bytes) for r in found)
    assert kinds == sorted([
        (1, "revisit", 9, 1600), (9, "response", None, 1600), (9, "response", None, 1600), (5, "revisit", 9, 1600),
        (2, "response", None, 5), (3, "response", None, 5), (4, "response", None, 0), (-1, "revisit", 9, 1600),
        (6, "response", None, 1200),
    ], key=lambda k: (k[0], k[1], k[2] or 0, k[3]))
    assert {bytes(r.payload).decode() for r in found if r.page_id == 6} == {"é" * 600}


def test_stages_take_odd_documents(spark, tmp_path):
    """Every stage but the last gives the columns of documents, whatever the rows are."""
    sf = "/root/testdata/sf0.001"
    odd = docs_of(spark, TEXTS).unionByName(docs_of(spark, TEXTS[:6]))
    odd = odd.unionByName(odd.limit(2).withColumn("doc_id", F.lit(None).cast("bigint")))
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != "packing":
                assert out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{name}-{docs.count()}")
    language = spark.read.parquet(f"{tmp_path}/language-{odd.count()}")
    assert {r.text for r in language.collect()} == {t for t in TEXTS if re.search(r"[^\W\d_]", t or "")}
    kept = spark.read.parquet(f"{tmp_path}/near_duplicates-{odd.count()}")
    assert kept.where("text = 'one'").count() == 1


@pytest.mark.parametrize("labelled", [[], [None]])
def test_the_language_stage_without_a_model_rejects_only_texts_without_a_letter(spark, labelled):
    """Labels are null throughout, or stand on a null text alone."""
    docs = docs_of(spark, TEXTS).withColumn("lang", F.lit(None).cast("string"))
    docs = docs.unionByName(docs_of(spark, labelled).withColumn("doc_id", F.lit(99).cast("bigint")))
    assert langid.fit(langid.learnable(docs)) is None
    found = langid.identify(docs, None).collect()
    letters = {t for t in TEXTS if re.search(r"[^\W\d_]", t or "")}
    assert all(r.lang_pred == "und" and r.score == (None if r.text in letters else 0) for r in found)
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == sorted(t for t in TEXTS if t in letters)


def test_the_near_duplicate_stage_decides_by_row(spark):
    """Ids that stand for two texts, and near copies without an id."""
    words = [f"w{i}" for i in range(60)]
    copy = lambda name, n: " ".join([f"{name}{w}" for w in words[: 60 - n]] + [f"x{i}" for i in range(n)])
    rows = [
        (1, copy("a", 0)), (2, copy("a", 1)), (2, copy("b", 0)),  # 2 is a near copy of 1, and unique
        (3, copy("c", 0)), (3, copy("d", 0)), (4, copy("d", 1)),
        (None, copy("e", 0)), (None, copy("e", 1)), (None, copy("e", 1)), (None, copy("a", 2)), (5, ""), (5, ""), (6, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    lone = min((copy("e", 0), copy("e", 1)), key=hashes.get)
    expected = [
        (1, copy("a", 0)), (2, copy("b", 0)), (3, copy("c", 0)), (3, copy("d", 0)), (None, lone), (5, ""), (6, None),
    ]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(expected)
