"""Cleaning, typing and projecting raw tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradin.functions import text, typing
from gradin.spec import Field

KINDS = {
    "text": lambda c: c,
    "upper": text.upper_code,
    "int": typing.to_int,
    "long": typing.to_long,
    "measure": lambda c: typing.zero_if_null(typing.to_int(c)),
    "date": typing.to_date,
    "second": typing.to_timestamp,
    "minute": lambda c: typing.to_timestamp(c, typing.MINUTE_FORMAT),
    "minute_day": lambda c: typing.day_of(typing.to_timestamp(c, typing.MINUTE_FORMAT)),
}


def _strings(df: DataFrame) -> set[str]:
    return {name for name, kind in df.dtypes if kind == "string"}


def trim_strings(df: DataFrame, chars: str | None = None) -> DataFrame:
    """Trim every text column in one projection, however many there are."""
    texts = _strings(df)
    return df.select(
        *[text.trimmed(F.col(c), chars).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def null_tokens(
    df: DataFrame, tokens: tuple[str, ...] = text.NULL_TOKENS, keep: Iterable[str] = ()
) -> DataFrame:
    """NULL for null tokens in every text column but those in `keep`."""
    texts = _strings(df) - set(keep)
    return df.select(
        *[
            text.null_if_token(F.col(c), tokens).alias(c) if c in texts else F.col(c)
            for c in df.columns
        ]
    )


def clean_strings(
    df: DataFrame,
    tokens: tuple[str, ...] = text.NULL_TOKENS,
    chars: str | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """trim_strings and null_tokens in a single projection."""
    texts, kept = _strings(df), set(keep)
    out = []
    for name in df.columns:
        if name not in texts:
            out.append(F.col(name))
        elif name in kept:
            out.append(text.trimmed(F.col(name), chars).alias(name))
        else:
            out.append(text.clean_text(F.col(name), tokens, chars).alias(name))
    return df.select(*out)


def project(df: DataFrame, fields: Iterable[Field], carry: Iterable[str] = ()) -> DataFrame:
    """Clean, type, rename and order the fields; `carry` passes as it is.

    Texts are cleaned in a projection of their own, as typing reads each of them several times.
    """
    fields, carry = list(fields), list(carry)
    cleaned = df.select(
        *[text.clean_text(F.col(f.raw)).alias(f"_{i}") for i, f in enumerate(fields)],
        *[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)],
    )
    return cleaned.select(
        *[KINDS[f.kind](F.col(f"_{i}")).alias(f.name) for i, f in enumerate(fields)],
        *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)],
    )
