"""Loading star tables into a relational warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_options(
    properties: dict[str, str], cascade: bool = True, partitions: int | None = None
) -> dict[str, str]:
    """Options of a reload that keeps the table's declaration and empties it first.

    `partitions` bounds the number of connections opened at a time.
    """
    options = {**properties, "truncate": "true", "cascadeTruncate": str(cascade).lower()}
    if partitions is not None:
        options["numPartitions"] = str(partitions)
    return options


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    cascade: bool = True,
    partitions: int | None = None,
) -> None:
    """Truncate and reload `table`; with cascade also the tables that refer to it are
    emptied, where the database can do that. Credentials come from the caller."""
    options = jdbc_options(properties, cascade, partitions)
    df.write.options(**options).jdbc(url=url, table=table, mode="overwrite")


def publish_star(
    tables: dict[str, DataFrame],
    url: str,
    properties: dict[str, str],
    schema: str = "public",
    partitions: int | None = None,
) -> None:
    """Load tables in the order given: dimensions others refer to come first, since
    truncating one with cascade empties the tables that refer to it."""
    for name, df in tables.items():
        publish_jdbc(df, url, f"{schema}.{name}", properties, partitions=partitions)
