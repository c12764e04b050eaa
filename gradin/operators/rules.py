"""Row rules: the CHECK, NOT NULL and length conditions of a table declaration."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import functions as F

from gradin.spec import Rule, StarTable


def _rule(kind: str, column: str, limits: Sequence[object], violated) -> Rule:
    name = f"{kind}({','.join([column, *map(str, limits)])})"
    return Rule(name, lambda: violated(F.col(column)), lambda: F.col(column))


def not_null(column: str) -> Rule:
    return _rule("not_null", column, (), lambda c: c.isNull())


def in_range(column: str, low: int, high: int) -> Rule:
    return _rule("range", column, (low, high), lambda c: ~c.between(low, high))


def one_of(column: str, values: Sequence[str]) -> Rule:
    return _rule("enum", column, (), lambda c: ~c.isin(*values))


def non_negative(column: str) -> Rule:
    return _rule("non_negative", column, (), lambda c: c < 0)


def max_length(column: str, limit: int) -> Rule:
    """Shows the length, not the text."""
    length = lambda: F.char_length(F.col(column))
    return Rule(f"max_length({column},{limit})", lambda: length() > limit, length)


def fits_numeric(column: str, precision: int, scale: int) -> Rule:
    bound = 10 ** (precision - scale)
    return _rule(
        "numeric",
        column,
        (precision, scale),
        lambda c: F.abs(F.round(c.cast("double"), scale)) >= bound,
    )


_VARCHAR = re.compile(r"varchar\((\d+)\)")
_NUMERIC = re.compile(r"decimal\((\d+),(\d+)\)")


def rules_of(table: StarTable) -> tuple[Rule, ...]:
    """Key columns are not null, texts and numbers fit their types, and the declared rules."""
    rules = [not_null(c) for c in table.primary_key]
    for column, kind in table.columns:
        if match := _VARCHAR.fullmatch(kind):
            rules.append(max_length(column, int(match[1])))
        elif match := _NUMERIC.fullmatch(kind):
            rules.append(fits_numeric(column, int(match[1]), int(match[2])))
    return (*rules, *table.rules)
