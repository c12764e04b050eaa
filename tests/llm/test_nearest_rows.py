"""Nearest neighbours where query rows repeat, and where parts are split again."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradin.llm import ann

KIND = "vec_id bigint, embedding array<double>"


def brute(rows, asked, k):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    out = {}
    for q in asked:
        score = np.max([(x * v).sum(axis=1) for v in x[ids == q]], axis=0)
        score[ids == q] = -np.inf
        best = np.lexsort((ids, -score))[: min(k, int((ids != q).sum()))]
        out[q] = [(int(ids[i]), float(score[i])) for i in best]
    return out


def found(spark, rows, **how):
    table = spark.createDataFrame([(int(i), [float(e) for e in v]) for i, v in rows], KIND).repartition(4)
    out = defaultdict(list)
    for r in ann.search(table, lambda i: F.pmod(i, F.lit(20)) == 0, **how).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_repeated_ids_and_vectors_match_brute_force(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 8))
    x[50:60] = x[40]
    rows = list(enumerate(x)) + [(20, x[20])] * 3 + [(40, x[3]), (40, x[4]), (7, x[7]), (7, x[7]), (20, x[9])]
    asked = range(0, 400, 20)
    got, expected = found(spark, rows, k=20), brute(rows, asked, 20)
    assert set(got) == set(asked)
    for q in asked:
        assert [i for i, _ in got[q]] == [i for i, _ in expected[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in expected[q]], abs=1e-12)
    # of rows that do not repeat each neighbour is there once
    assert len({i for i, _ in got[20]} - {7}) >= 18


def test_parts_are_split_again_until_they_are_small(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_SCALE", 10)
    seen, home = [], ann.Forest.home

    def recorded(index, large, *given):
        out = routers(index, large, *given)
        seen.append((large, out))
        return out

    routers = ann._inner_routers
    monkeypatch.setattr(ann, "_inner_routers", recorded)
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(40, 8)) * 2
    x = centres[draw.integers(0, 40, 4000)] + draw.normal(size=(4000, 8)) * 0.3
    rows = list(enumerate(x))
    got, expected = found(spark, rows, k=20, most_rows=300, sample=2000), brute(rows, range(0, 4000, 20), 20)
    large, inner = seen[0]
    assert large and len(inner) == len(large) and all(r.parts >= 2 for r in inner.values())
    assert home is ann.Forest.home
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 20 for q in expected])
    assert recall >= 0.9 and all(len(got[q]) == 20 for q in expected)
