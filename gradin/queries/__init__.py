"""Every operator as a query over the given tables, each with its SQL where SQL can say it."""

from gradin.queries import columns, documents, files, quality, reads, rows, tables  # noqa: F401
from gradin.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
