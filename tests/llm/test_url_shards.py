"""Lists longer than a shard, and tables without rows."""

from __future__ import annotations

import pytest

from gradin.llm import urls

KIND = "page_id bigint, url string"


@pytest.mark.parametrize("shard_keys", [None, 9])
def test_shards_decide_as_one(spark, monkeypatch, shard_keys):
    monkeypatch.setattr(urls, "BITS_PER_KEY", 4)
    monkeypatch.setattr(urls, "CHUNK", 2)
    pages = [(i, f"http://h/{i % 60}") for i in range(200)] + [(None, "http://h/3"), (500, None), (501, "h/3")]
    table = spark.createDataFrame(pages, KIND).repartition(4)
    listed = spark.createDataFrame([(f"h/{i}",) for i in range(0, 90, 3)] * 2 + [(None,)], "key string")
    found = sorted((str(r.page_id), r.verdict) for r in urls.judge(table, (), listed, shard_keys=shard_keys).collect())
    blocked = {f"http://h/{i}" for i in range(0, 90, 3)}
    assert found == sorted((str(i), "block" if u in blocked else "allow") for i, u in pages)


@pytest.mark.parametrize("shard_keys", [None, 1])
def test_nothing_listed_or_no_pages(spark, shard_keys):
    none = spark.createDataFrame([], "key string")
    pages = spark.createDataFrame([(1, "http://a/b"), (1, "http://a/b")], KIND)
    assert [r.verdict for r in urls.judge(pages, (), none, shard_keys=shard_keys).collect()] == ["allow"] * 2
    listed = spark.createDataFrame([("a/b",), ("c",)], "key string")
    assert urls.judge(pages.limit(0), (), listed, shard_keys=shard_keys).count() == 0
    assert [r.verdict for r in urls.judge(pages, (), listed, shard_keys=shard_keys).collect()] == ["block"] * 2
    empty = spark.createDataFrame([(7, None)], KIND)
    assert [tuple(r) for r in urls.judge(empty, (), listed, shard_keys=shard_keys).collect()] == [(7, "", "", None, "allow")]
