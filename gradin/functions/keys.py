"""Surrogate keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts: Column, bits: int = 32) -> Column:
    """Hash of text parts, NULL and '' alike, without its sign but for the smallest integer.

    32 bits gives the key of the warehouse schema, an INTEGER; near 55,000 distinct
    values two of them are as likely as not to share a key, which the primary key
    check reports. 64 bits is for larger dimensions.
    """
    filled = [F.coalesce(p, F.lit("")) for p in parts]
    hashed = F.hash(*filled) if bits == 32 else F.xxhash64(*filled)
    smallest = F.lit(-(2 ** (bits - 1))).cast(("int" if bits == 32 else "bigint"))
    # The smallest integer has no positive counterpart; it stays as it is.
    return F.when(hashed == smallest, hashed).otherwise(F.abs(hashed))


def any_present(*parts: Column) -> Column:
    """True where at least one part is not NULL."""
    return reduce(lambda a, b: a | b, [p.isNotNull() for p in parts])


def venue_key(stadium: Column, city: Column, bits: int = 32) -> Column:
    """Key of a stadium and city; NULL where neither is known, so no fact points at nothing."""
    return F.when(any_present(stadium, city), hash_key(stadium, city, bits=bits))
