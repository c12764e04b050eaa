"""Operators of a training-data pipeline, each with one query over the given tables."""

from gradin.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
