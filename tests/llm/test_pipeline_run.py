"""A whole run of the pipeline: what each stage writes, against brute force on its own input."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gradin.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    draw = random.Random(8)
    plain = [f"w{i}" for i in range(300)] + ["maison", "house", "casa"]
    bad = [f"vile{i}" for i in range(6)]
    rows, labels = [], []
    for i in range(160):
        words = [draw.choice(plain) for _ in range(draw.randrange(40, 90))]
        toxic = i % 4 == 0
        if toxic:
            at = draw.randrange(len(words))
            words[at:at] = draw.sample(bad, 5)
        rows.append([i, " ".join(words), draw.choice(["en", "fr", None]), f"s{i % 3}" if i % 11 else None])
        if i % 5:
            labels.append((i, 1, int(toxic)))
    for i in range(0, 60, 3):  # near copies of some, exact ones of others
        words = rows[i][1].split()
        if i % 2:
            words[draw.randrange(len(words))] = "other"
        rows.append([200 + i, " ".join(words), rows[i][2], "s1"])
    rows += [[300, None, "en", "s1"], [301, "", "en", "s1"], [302, "123 !!", None, "s2"], [303, "brief", "en", "zero"]]
    rows += [[304, "b " * 6000, "en", "s0"], list(rows[1]), [7, "same id with another text of a few words", "en", "s1"]]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each, as tuples."""
    folder = str(tmp_path_factory.mktemp("sf"))
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    seen, write = {"documents": docs}, corpus_pipeline.written

    def recorded(df, name):
        seen[name] = write(df, name)
        return seen[name]

    corpus_pipeline.written = recorded
    try:
        corpus_pipeline.run(spark, folder)
    finally:
        corpus_pipeline.written = write
    assert list(seen) == ["documents", *[name for name, _ in corpus_pipeline.STAGES]]
    return {name: ([tuple(r) for r in df.collect()], df.columns) for name, df in seen.items()}


def test_all_stages_but_the_last_give_documents(stages):
    for name in list(stages)[:-1]:
        assert stages[name][1] == COLUMNS


def test_language_rejects_what_has_no_letter(stages):
    kept = [r for r in stages["documents"][0] if re.search("[a-zA-Z]", r[1] or "")]
    assert Counter(stages["language"][0]) == Counter(kept) and len(kept) < len(stages["documents"][0])


def test_toxicity_rejects_the_planted_documents(stages):
    kept = [r for r in stages["language"][0] if "vile" not in r[1]]
    assert Counter(stages["toxicity"][0]) == Counter(kept)


def test_one_of_each_group_of_near_duplicates_stays(stages):
    rows = sorted(set(stages["toxicity"][0]), key=lambda r: (r[0], r[1]))
    sets = []
    for r in rows:
        w = WORD.findall(r[1].lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r)
    found = stages["near_duplicates"][0]
    assert len(found) == len(groups) < len(rows)
    for r in found:
        group = next(g for g in groups.values() if r in g)
        assert r[0] == min(g[0] for g in group)
    assert len({find(rows.index(r)) for r in found}) == len(found)


def test_sources_meet_their_targets(stages):
    before, after = stages["near_duplicates"][0], stages["mixing"][0]
    size = lambda r: len(WORD.findall(r[1] or ""))
    total = Counter()
    for r in before:
        total[r[3]] += size(r)
    keys = sorted((s for s in total if total[s] >= 0), key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(keys)}
    target, open_ = {}, set(keys)
    left = 1.5 * sum(total.values())
    while True:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * total[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
            open_.remove(s)
    times = Counter(after)
    assert set(times) <= set(before) and max(times.values()) <= 2
    taken = Counter()
    for r, n in times.items():
        taken[r[3]] += n * size(r)
    largest = max(size(r) for r in before)
    assert all(abs(taken[s] - target[s]) <= largest for s in keys)
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] for s in keys if s != "s0" and total[s] > 1000)


def test_all_tokens_are_packed_once(stages):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows, columns = stages["packing"]
    pieces = [dict(zip(columns, r)) for r in rows]
    expected, found = Counter(), Counter()
    for r in stages["mixing"][0]:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]
        expected.update((r[0], at, t) for at, t in enumerate(ids))
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"]
        found.update((p["doc_id"], p["start"] + at, t) for at, t in enumerate(ids))
    assert found == expected
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096


def test_maps_and_variants_pass_through(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (None, "x y", "en", "s")], "doc_id bigint, text string, lang string, source string")
    docs = docs.withColumns({"m": F.create_map(F.lit("k"), F.col("text")), "v": F.parse_json(F.lit('{"a": 1}'))})
    for name, stage in corpus_pipeline.STAGES[2:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 2
