"""Declarations of tables: what a column is, what makes a row unique, what must hold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column


@dataclass(frozen=True)
class Field:
    """One cleaned column: its name, how it is typed, and the raw column it comes from."""

    name: str
    kind: str
    source: str | None = None

    @property
    def raw(self) -> str:
        return self.source or self.name


@dataclass(frozen=True)
class SilverTable:
    """A cleaned table. `derived` columns are computed after deduplication."""

    name: str
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    unique_on: tuple[str, ...]
    latest_by: tuple[str, ...] = ()
    derived: tuple[tuple[str, Callable[[], Column]], ...] = ()

    @property
    def raw_columns(self) -> list[str]:
        return list(dict.fromkeys(f.raw for f in self.fields))


@dataclass(frozen=True)
class Rule:
    """A condition on one row; `violated` is true for an offending row, NULL passes.

    `shown` is what a violation shows of the row.
    """

    name: str
    violated: Callable[[], Column]
    shown: Callable[[], Column]


@dataclass(frozen=True)
class ForeignKey:
    """`column` must be NULL or a value of `parent.parent_key`."""

    column: str
    parent: str
    parent_key: str
    on_delete: str  # "set null" or "cascade"

    @property
    def rule(self) -> str:
        return f"foreign_key({self.column})"


@dataclass(frozen=True)
class StarTable:
    """A dimension or fact as the warehouse declares it."""

    name: str
    columns: tuple[tuple[str, str], ...]
    primary_key: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    rules: tuple[Rule, ...] = ()
    defaults: tuple[tuple[str, object], ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def primary_key_rule(self) -> str:
        return f"primary_key({','.join(self.primary_key)})"
