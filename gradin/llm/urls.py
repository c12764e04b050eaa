"""URL rules and block lists by a cascade of Bloom filters, in DataFrame operations only.

Level 1 holds the listed keys. Level 2 holds those other keys of the corpus that level 1 lets
through, level 3 the listed keys that level 2 lets through, and so on until nothing passes
wrongly. For any key of the corpus the first level that does not hold it decides, so membership
is exact, and the corpus is tested without a join: a level is one value, an array of bits.

Keys are dealt by a hash into shards of bounded size, each with its own cascade, so no value
that is sent to all tasks exceeds SHARD_KEYS keys' bits, whatever the length of the list. With
several shards the corpus is read once and laid out by shard; one shard after the other is built
over its own keys and tested on its own rows, so work and plans do not grow with their number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradin.llm.graph import written
from gradin.session import scratch_path

#: Listed keys of a shard; with BITS_PER_KEY that is 8 MB to a level.
SHARD_KEYS = 4_000_000
BITS_PER_KEY, HASHES = 16, 4
CHUNK = 1024


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, by its name; of equally long ones the least name."""
    order = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in order]
    return F.coalesce(*[F.when(f, F.lit(r.name)) for f, r in zip(fits, order, strict=True)], F.lit(None).cast("string"))


def _places(key: Column, level: int, bits: int) -> list[Column]:
    """The bits of a key in a level: multiples of one hash added to another, as is usual."""
    one, two = F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1))
    return [
        F.pmod(F.shiftright(one, 1) + F.lit(i) * F.shiftright(two, 8), F.lit(bits).cast("bigint")) for i in range(HASHES)
    ]


def _level(keys: DataFrame, level: int, bits: int) -> Column:
    """The bits of all keys as one value: an array of arrays of CHUNK longs."""
    place = keys.select(F.explode(F.array(*_places(F.col("key"), level, bits))).alias("at"))
    word = place.select(F.shiftright("at", 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int")).alias("b"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("bigint").alias("b"))
    words = word.unionByName(every).groupBy("w").agg(F.bit_or("b").alias("b"))

    def in_order(number: Column, value: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(number.alias("n"), F.col(value).alias("x")))), lambda e: e["x"])

    chunks = words.groupBy(F.floor(F.col("w") / CHUNK).alias("c")).agg(in_order(F.col("w"), "b").alias("x"))
    return chunks.agg(in_order(F.col("c"), "x").alias("bits")).scalar()


def _holds(value: Column, key: Column, level: int, bits: int) -> Column:
    found = F.lit(True)
    for at in _places(key, level, bits):
        word = F.shiftright(at, 6)
        long = F.get(F.get(value, F.floor(word / CHUNK).cast("int")), (word % CHUNK).cast("int"))
        found &= F.getbit(long, (at % 64).cast("int")) == 1
    return found


def _bits(count: int) -> int:
    chunk = 64 * CHUNK
    return max(1, -(-count * BITS_PER_KEY // chunk)) * chunk


@dataclass
class Cascade:
    """The levels of one shard: of each the keys that it holds, and its bits."""

    levels: list[tuple[DataFrame, int]]

    def holds(self, key: Column) -> Column:
        """Whether the list has the key; for keys that the cascade was built over."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels), 0, -1):
            keys, bits = self.levels[i - 1]
            inside = _holds(_level(keys, i, bits), key, i, bits)
            verdict = F.when(inside, verdict).otherwise(F.lit(i % 2 == 0))
        return verdict


def cascade(listed: DataFrame, others: DataFrame) -> Cascade:
    """Build over listed keys and the corpus's other keys; both have one column `key`, distinct."""
    out = Cascade([])
    # what the next level has to hold, and what it must not
    inner, outer, size = listed, others, listed.count()
    while size:
        level, bits = len(out.levels) + 1, _bits(size)
        out.levels.append((inner, bits))
        wrong = written(outer.where(_holds(_level(inner, level, bits), F.col("key"), level, bits)), "wrong")
        inner, outer, size = wrong, inner, wrong.count()
    return out


def _dealt(rows: DataFrame, shards: int, label: str) -> Callable[[int], DataFrame]:
    """The rows of a shard by its number, from a table that is laid out by it."""
    if shards == 1:
        kept = written(rows, label)
        return lambda _: kept
    path, spark = scratch_path(rows.sparkSession, label), rows.sparkSession
    shard = F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(shards)).alias("shard")
    # ranges of shard and key: few files to a shard, and a shard of any size in many tasks
    ranged = rows.select("*", shard).repartitionByRange("shard", F.xxhash64("key"))
    ranged.write.partitionBy("shard").parquet(path)
    kept = spark.read.schema(ranged.schema).parquet(path)
    return lambda s: kept.where(F.col("shard") == s).drop("shard")


def with_listed(rows: DataFrame, listed: DataFrame, shard_keys: int | None = None) -> DataFrame:
    """The rows, which have a column `key`, with `listed`: whether `listed` (column `key`) has it.

    Null keys of the list are left out, and a row without a key is not listed. Listed keys that the
    rows lack are kept. Equal keys are one key, however many rows have it.
    """
    listed = written(listed.where("key IS NOT NULL").select("key").distinct(), "listed")
    shards = max(1, -(-listed.count() // (shard_keys or SHARD_KEYS)))
    others = rows.where("key IS NOT NULL").select("key").distinct().join(listed, "key", "left_anti")
    listed_of, others_of = _dealt(listed, shards, "listed"), _dealt(others, shards, "others")

    def tested(part: DataFrame, s: int) -> DataFrame:
        holds = cascade(listed_of(s), others_of(s)).holds(F.col("key"))
        return part.withColumn("listed", F.coalesce(holds, F.lit(False)))

    if shards == 1:
        return tested(rows, 0)
    rows_of, path = _dealt(rows.where("key IS NOT NULL"), shards, "rows"), scratch_path(rows.sparkSession, "tested")
    for s in range(shards):
        tested(rows_of(s), s).write.parquet(f"{path}/shard={s}")
    found = rows.sparkSession.read.parquet(path).drop("shard")
    return found.unionByName(rows.where("key IS NULL").withColumn("listed", F.lit(False)))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    blocked: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    shard_keys: int | None = None,
) -> DataFrame:
    """page_id, host, path, rule and verdict, one row per input row.

    The longest fitting rule decides; a url that none fits is blocked if its host and path are
    among the `blocked` keys (column `key`), else allowed. A null url and one without `://`
    have an empty host and path and fit no rule. Repeated rows get equal results; other columns
    are not read.
    """
    u = F.col(url)
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(u).alias("host"), path_of(u).alias("path"))
    rows = rows.withColumn("key", F.concat("host", "path"))
    out = with_listed(rows, blocked, shard_keys)
    out = out.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    for r in rules:
        verdict = F.when(F.col("rule") == r.name, F.lit(r.verdict)).otherwise(verdict)
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
