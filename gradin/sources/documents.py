"""Nested JSON documents as the source delivers them, one document per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradin.session import scratch_path

# Leaves are read as text: ids keep every digit and the landing tables are text anyway.
TEAMS = (
    "teams array<struct<id string, name string, shortName string, tla string,"
    " area struct<name string, code string>, crest string, clubColors string,"
    " website string, coach struct<name string, nationality string>>>"
)
SQUAD = (
    "id string, name string, squad array<struct<id string, firstName string,"
    " lastName string, name string, dateOfBirth string, nationality string,"
    " position string, shirtNumber string>>"
)
SCORERS = (
    "scorers array<struct<player struct<id string, name string, nationality string,"
    " position string, dateOfBirth string>, team struct<id string, name string>,"
    " goals string, assists string, playedMatches string, penalties string>>"
)
STANDINGS = (
    "standings array<struct<`group` string, stage string, `table` array<struct<"
    "position string, team struct<id string, name string>, playedGames string,"
    " won string, draw string, lost string, goalsFor string, goalsAgainst string,"
    " goalDifference string, points string, form string>>>>"
)
MATCHES = (
    "matches array<struct<id string, competition struct<name string>, matchday string,"
    " status string, utcDate string, homeTeam struct<id string, name string>,"
    " awayTeam struct<id string, name string>, score struct<"
    "halfTime struct<home string, away string>, fullTime struct<home string, away string>>,"
    " venue string, area struct<name string>, referees array<struct<name string>>>>"
)


CORRUPT = "_corrupt_record"


def read_documents(
    spark: SparkSession, paths: str | list[str], schema: str, rejects: str | None = None
) -> DataFrame:
    """Documents from JSON lines files; no pass over the data to infer a schema.

    A line that is no whole document, cut off or one of several of an indented one, fails the
    read; with `rejects` such lines are written there (file, record) and left out. These lines
    are parsed once, with all fields, into a scratch table that is then split: a read that needs
    fewer fields does not see damage in the others.
    """
    reader = spark.read.option("columnNameOfCorruptRecord", CORRUPT)
    if rejects is None:
        return reader.schema(schema).option("mode", "FAILFAST").json(paths)
    lines = reader.schema(f"{schema}, {CORRUPT} string").json(paths)
    path = scratch_path(spark, "documents")
    lines.withColumn("_file", F.col("_metadata.file_path")).write.parquet(path)
    parsed = spark.read.parquet(path)
    bad = parsed.where(F.col(CORRUPT).isNotNull())
    bad.select(F.col("_file").alias("file"), F.col(CORRUPT).alias("record")).write.mode("append").parquet(rejects)
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file")


def rejected_documents(df: DataFrame, text: Column, schema: str) -> DataFrame:
    """(record): the texts that are no whole document. NULL is none."""
    parsed = F.from_json(text, f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    return df.select(text.alias("record"), parsed[CORRUPT].alias("bad")).where("bad IS NOT NULL").select("record")


def parse_documents(df: DataFrame, text: Column, schema: str) -> DataFrame:
    """Documents from a text column, each parsed once.

    inline over a one-element array keeps later filters above the parse. Below a plain
    projection they would be pushed beneath it and parse every text again.
    """
    return df.select(F.inline(F.array(F.from_json(text, schema))))
