"""Constraint checks. Each returns its violations as (table, rule, key, detail, rows).

Row checks read a table once for all of its rules and do not shuffle. Key checks
aggregate before they shuffle, so a value that holds a third of all rows counts as one
row per task; nothing is broadcast unless Spark's own size estimate allows it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradin.operators.rules import rules_of
from gradin.spec import ForeignKey, Rule, StarTable


def key_text(columns: Sequence[str]) -> Column:
    """The key of a row as one text, its parts separated by '|'."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


def check_rows(df: DataFrame, table: str, key: Sequence[str], rules: Iterable[Rule]) -> DataFrame:
    """Every broken rule of every row; a rule that evaluates to NULL is kept.

    Rows that break nothing are filtered out before rules multiply the rest; where all
    rules are plain comparisons the scan skips whole row groups by their statistics.
    """
    rules = list(rules)
    offending = reduce(lambda a, b: a | b, [rule.violated() for rule in rules])
    per_rule = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                rule.shown().cast("string").alias("detail"),
                rule.violated().alias("broken"),
            )
            for rule in rules
        ]
    )
    found = df.where(offending).select(key_text(key).alias("key"), F.inline(per_rule))
    return found.where("broken").select(
        F.lit(table).alias("table"),
        "rule",
        "key",
        "detail",
        F.lit(1).cast("bigint").alias("rows"),
    )


def _repeated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return df.where(known).groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def check_primary_key(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row. NULL keys are the business of not_null."""
    return _repeated(df, key).select(
        F.lit(table).alias("table"),
        F.lit(f"primary_key({','.join(key)})").alias("rule"),
        key_text(key).alias("key"),
        F.lit(None).cast("string").alias("detail"),
        "rows",
    )


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def compared_as(child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_key: str) -> str:
    """A type that holds the values of the foreign keys and of the parent's key alike.

    Nothing is narrowed: a value that the parent's type cannot hold is one the parent lacks.
    """
    kinds = [parent.schema[parent_key].dataType, *[child.schema[c].dataType for c in columns]]
    if all(kind == kinds[0] for kind in kinds):
        return kinds[0].simpleString()
    if all(isinstance(kind, _WHOLE) for kind in kinds):
        return "bigint"
    if all(isinstance(kind, (*_WHOLE, T.DecimalType)) for kind in kinds):
        return "decimal(38,10)"
    if all(isinstance(kind, T.NumericType) for kind in kinds):
        return "double"
    return "string"


def orphan_counts(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_key: str
) -> DataFrame:
    """(key, <column>...): values the parent lacks, with the rows holding them per column.

    All columns that refer to the same parent are read in one pass. Both the grouping
    and the anti-join are on the value, so the grouped values are not shuffled again.
    """
    kind = compared_as(child, columns, parent, parent_key)
    if len(columns) == 1:
        values = child.select(F.lit(columns[0]).alias("of"), F.col(columns[0]).cast(kind).alias("key"))
    else:
        pairs = [
            F.struct(F.lit(c).alias("of"), F.col(c).cast(kind).alias("key")) for c in columns
        ]
        values = child.select(F.inline(F.array(*pairs)))
    counts = (
        values.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(*[F.count_if(F.col("of") == c).alias(c) for c in columns])
    )
    keys = parent.select(F.col(parent_key).cast(kind).alias("key"))
    return counts.join(keys, "key", "left_anti")


def check_foreign_keys(
    child: DataFrame, table: str, keys: Sequence[ForeignKey], parent: DataFrame
) -> DataFrame:
    """Values of foreign keys to one parent that the parent lacks; NULL is allowed."""
    columns = [k.column for k in keys]
    per_rule = F.array(
        *[
            F.struct(F.lit(k.rule).alias("rule"), F.col(k.column).alias("rows"))
            for k in keys
        ]
    )
    found = orphan_counts(child, columns, parent, keys[0].parent_key)
    found = found.select(F.col("key").cast("string").alias("key"), F.inline(per_rule))
    return found.where("rows > 0").select(
        F.lit(table).alias("table"), "rule", "key", F.col("key").alias("detail"), "rows"
    )


def keys_by_parent(table: StarTable) -> dict[tuple[str, str], list[ForeignKey]]:
    grouped: dict[tuple[str, str], list[ForeignKey]] = {}
    for key in table.foreign_keys:
        grouped.setdefault((key.parent, key.parent_key), []).append(key)
    return grouped


def violations(
    table: StarTable, frames: dict[str, DataFrame], rules: Iterable[Rule] | None = None
) -> DataFrame:
    """Everything in a table that breaks its declaration."""
    df = frames[table.name]
    rules = rules_of(table) if rules is None else rules
    found = [
        check_rows(df, table.name, table.primary_key, rules),
        check_primary_key(df, table.name, table.primary_key),
    ]
    for (parent, _), keys in keys_by_parent(table).items():
        found.append(check_foreign_keys(df, table.name, keys, frames[parent]))
    return reduce(DataFrame.unionByName, found)


def _counted(counts: dict[str, Column]) -> Column:
    pairs = [F.struct(F.lit(rule).alias("rule"), n.alias("violations")) for rule, n in counts.items()]
    return F.inline(F.array(*pairs))


class RowRules:
    """Counts what breaks a table's row rules while the frame is written for another reason."""

    def __init__(self, table: StarTable, df: DataFrame):
        self.table, self.seen = table, Observation()
        self.rules = {f"r{i}": rule for i, rule in enumerate(rules_of(table))}
        # one more count, so that a table without rules can be observed as well
        counts = [F.count_if(rule.violated()).alias(c) for c, rule in self.rules.items()]
        self.frame = df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *counts)

    def counts(self) -> list[tuple[str, str, int]]:
        """(table, rule, violations), once the frame was written."""
        found = self.seen.get
        return [(self.table.name, rule.name, found[c]) for c, rule in self.rules.items()]


def _row_counts(table: StarTable, df: DataFrame) -> DataFrame:
    rules = {f"r{i}": rule for i, rule in enumerate(rules_of(table))}
    per_row = df.agg(*[F.count_if(rule.violated()).alias(c) for c, rule in rules.items()])
    return _named(table, per_row.select(_counted({r.name: F.col(c) for c, r in rules.items()})))


def _named(table: StarTable, counts: DataFrame) -> DataFrame:
    return counts.select(F.lit(table.name).alias("table"), "rule", "violations")


def _key_counts(table: StarTable, frames: dict[str, DataFrame]) -> list[DataFrame]:
    df = frames[table.name]
    repeated = _repeated(df, table.primary_key).agg(F.count(F.lit(1)).alias("n"))
    parts = [repeated.select(_counted({table.primary_key_rule: F.col("n")}))]
    for (parent, parent_key), keys in keys_by_parent(table).items():
        columns = [k.column for k in keys]
        lost = orphan_counts(df, columns, frames[parent], parent_key)
        sums = lost.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
        parts.append(sums.select(_counted({k.rule: F.col(k.column) for k in keys})))
    return [_named(table, p) for p in parts]


def key_report(tables: Iterable[StarTable], frames: dict[str, DataFrame]) -> DataFrame:
    """One row per primary and foreign key: repeated or lost values."""
    parts = [part for table in tables for part in _key_counts(table, frames)]
    return reduce(DataFrame.unionByName, parts)


def constraint_report(tables: Iterable[StarTable], frames: dict[str, DataFrame]) -> DataFrame:
    """One row per declared rule: offending rows, or repeated values for a primary key."""
    tables = list(tables)
    rows = [_row_counts(t, frames[t.name]) for t in tables]
    return reduce(DataFrame.unionByName, [*rows, key_report(tables, frames)])


def require_clean(report: DataFrame) -> None:
    """Raise if any rule is broken. The report has one row per rule, not per violation."""
    broken = report.where("violations > 0").orderBy("table", "rule").collect()
    if broken:
        lines = [f"{r['table']}: {r['rule']} broken {r['violations']} times" for r in broken]
        raise ValueError("; ".join(lines))
