"""A Merkle manifest of a table: a tree of digests per group, one more over the groups' roots.

Rows are leaves in a defined order. Of each level's nodes every `FAN` consecutive ones become one
node above. Levels are tables of their own: columns at fixed offsets before and behind a node
(`lag`, `lead`), masked by its slot in its run and by the run's length, are its siblings, and the
first node of a run hashes itself and them into its parent. A window holds `FAN ** 4` nodes, so no
group is seen by one task, however many of the rows it holds. Digests move as 32 bytes and are
hashed as hexadecimal text. Texts are read once, for the leaves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gradin.llm.graph import written
from gradin.operators.numbering import numbered

FAN = 8
#: Runs of nodes that one window holds.
BLOCK = FAN**4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:binary,right:binary>>"


def record(fields: Sequence[Column]) -> Column:
    """The fields one behind the other: `-` for null, else the number of bytes, `:`, the value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.concat(*parts)


def digest(text: Column) -> Column:
    """SHA-256 of the text as lowercase hexadecimal."""
    return F.sha2(text.cast("binary"), 256)


def _hex(data: Column) -> Column:
    return F.lower(F.hex(data))


def proof(path: Column) -> Column:
    """The digest of all siblings, level by level up to the root, left to right."""
    texts = F.transform(path, lambda s: F.concat(_hex(s["left"]), _hex(s["right"])))
    return digest(F.array_join(texts, ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf (hexadecimal) and its siblings on the way up."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(_hex(s["left"]), node, _hex(s["right"]))))


def _level(nodes: DataFrame) -> DataFrame:
    """The nodes with their siblings to the left and right; the first of each run with the digest above."""
    slot = F.pmod("at", F.lit(FAN))
    run = F.least(F.lit(FAN), F.col("n") - F.col("at") + slot)
    ordered = Window.partitionBy("g", F.expr(f"at DIV {BLOCK}")).orderBy("at")
    none = F.lit(bytearray(b""))
    left = [F.when(slot >= k, F.lag("node", k).over(ordered)).otherwise(none) for k in range(FAN - 1, 0, -1)]
    right = [F.when(slot + k < run, F.lead("node", k).over(ordered)).otherwise(none) for k in range(1, FAN)]
    rows = nodes.withColumn("left", F.concat(*left)).withColumn("right", F.concat(*right))
    above = F.unhex(digest(F.concat(_hex(F.col("node")), _hex(F.col("right")))))
    return rows.withColumn("above", F.when(slot == 0, above))


def _climbed(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels of every group with more than one node left, and (g, level, node): their roots.

    The loop goes on as often as the largest group has levels, 14 times for a million million rows.
    """
    levels, roots = [], []
    n = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(nodes.where("n = 1").select("g", F.lit(len(levels)).alias("level"), "node"))
        if n <= 1:
            break
        levels.append(written(_level(nodes.where("n > 1")), "merkle"))
        nodes = levels[-1].where("above IS NOT NULL").select(
            "g",
            F.expr(f"at DIV {FAN}").alias("at"),
            F.expr(f"(n + {FAN - 1}) DIV {FAN}").alias("n"),
            F.col("above").alias("node"),
        )
        n = -(-n // FAN)
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return levels, written(out, "merkle")


def _descended(levels: list[DataFrame], ends: DataFrame) -> DataFrame:
    """Every node of the lowest level with the way up (`path`) and the columns of its group's end.

    `ends` has g, level and path; a level takes the path of the level above, which is an eighth
    of its rows, so siblings are joined once a level and move with few rows.
    """
    carried = [c for c in ends.columns if c not in ("g", "level")]
    above = ends.where(F.col("level") == len(levels)).select("g", F.lit(0).cast("bigint").alias("at"), *carried)
    for k in reversed(range(len(levels))):
        own = levels[k].drop("above")
        parents = above.withColumnsRenamed({"g": "_g", "at": "_at", "path": "_path"})
        same = F.col("g").eqNullSafe(F.col("_g")) & (F.expr(f"at DIV {FAN}") == F.col("_at"))
        step = F.array(F.struct("left", "right")).cast(PATH)
        joined = own.join(parents, same).withColumn("path", F.concat(step, "_path"))
        if k:
            joined = joined.select("g", "at", *carried)
            over = ends.where(F.col("level") == k).select("g", F.lit(0).cast("bigint").alias("at"), *carried)
            joined = written(joined.unionByName(over), "paths")
        above = joined.drop("_g", "_at", "_path", "left", "right")
    return above


def manifest(
    docs: DataFrame,
    group: str = "lang",
    order: str = "doc_id",
    fields: Sequence[str] = FIELDS,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(group, order, position, leaf, subroot, root, path, and the columns to carry) for each row.

    Leaves are the digests of the rows' `fields`; a group's leaves ascend by `order` (nulls first)
    and among equals by digest, so that repeated rows, which then are equal leaves, and null ids have
    a defined place. Null is a group like any other. Groups ascend bytewise, null first. An
    empty table has no rows and no root; of one row, or one group, that node itself is the root,
    without siblings. Digests are lowercase hexadecimal. `path` has, from the leaf up, the
    digests (32 bytes each) of the siblings to the left and to the right of each node.
    """
    carry = dict(carry or {})
    columns = [F.col(f"`{f}`") for f in fields]
    leaves = docs.select(
        F.col(f"`{group}`").alias("g"),
        F.col(f"`{order}`").alias("o"),
        F.unhex(digest(record(columns))).alias("node"),
        F.struct(*[c.alias(name) for name, c in carry.items()], F.lit(True).alias("_")).alias("carry"),
        F.monotonically_increasing_id().alias("r"),
    )
    nodes = numbered(written(leaves, "leaves"), ["g"], ["o", "node", "r"], "at", "n").drop("r")
    nodes = written(nodes, "leaves")
    levels, roots = _climbed(nodes)

    tops = roots.select(F.lit(0).alias("g"), F.col("g").alias("o"), "level", "node")
    tops = written(numbered(tops, ["g"], ["o"], "at", "n"), "tops")
    upper, root = _climbed(tops)
    ends = root.select("g", "level", F.array().cast(PATH).alias("path"), F.col("node").alias("root"))
    ended = _rows(tops, upper, ends).select(
        F.col("o").alias("g"), "level", "path", F.col("node").alias("subroot"), "root"
    )
    found = _rows(nodes, levels, written(ended, "tops"))
    return found.select(
        F.col("g").alias(group),
        F.col("o").alias(order),
        F.col("at").alias("position"),
        _hex(F.col("node")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"),
        "path",
        *[F.col(f"carry.{name}").alias(name) for name in carry],
    )


def _rows(nodes: DataFrame, levels: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The nodes with path and ends: those of groups of several by the levels, the others at once."""
    single = nodes.where("n = 1")
    ended = ends.where("level = 0").drop("level").withColumnRenamed("g", "_g")
    clash = [c for c in nodes.columns if c in ended.columns]
    assert not clash, clash
    alone = single.join(ended, F.col("g").eqNullSafe(F.col("_g"))).drop("_g")
    if not levels:
        return alone
    return _descended(levels, ends).unionByName(alone)
