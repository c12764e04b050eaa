"""Reads of the star: matches with their dimensions, rankings, roll-ups, and tables laid out for them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradin.operators.numbering import numbered
from gradin.operators.ranking import first_rows
from gradin.session import scratch_path


@dataclass(frozen=True)
class Role:
    """One way in which a fact refers to a dimension: which column leads to which key, and what is
    taken along under which name. `where` keeps the facts whose dimension row fulfils it."""

    column: str
    dimension: DataFrame
    key: str
    taken: Mapping[str, str]
    where: Column | None = None


def _joined(rows: DataFrame, role: Role, number: int) -> DataFrame:
    side = role.dimension if role.where is None else role.dimension.where(role.where)
    key = f"_key{number}"
    side = side.select(F.col(role.key).alias(key), *[F.col(c).alias(name) for c, name in role.taken.items()])
    how = "left" if role.where is None else "inner"
    return rows.join(side, F.col(role.column) == F.col(key), how).drop(key)


def star_read(fact: DataFrame, roles: Sequence[Role], large: bool = False) -> DataFrame:
    """The facts with what they refer to; one that refers to nothing known keeps its row, with nulls.

    The joins are plain, so Spark broadcasts a dimension by its size, and filters the fact by what
    is left of a dimension with a condition. Where the dimensions are too large for that, every role
    would shuffle the fact. With `large` the distinct combinations of keys are looked up instead,
    which are a few narrow columns, and the facts are joined with these: one shuffle of the fact
    whatever the number of roles, and a hot combination can be split by adaptive execution.
    Dimension keys are unique; conditions are applied first.
    """
    roles = sorted(roles, key=lambda role: role.where is None)
    if not large:
        return reduce(lambda rows, n: _joined(rows, roles[n], n), range(len(roles)), fact)
    columns = list(dict.fromkeys(role.column for role in roles))
    keys = fact.select(*columns).distinct()
    looked = reduce(lambda rows, n: _joined(rows, roles[n], n), range(len(roles)), keys)
    looked = looked.withColumnsRenamed({c: f"_of_{c}" for c in columns})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])
    return fact.join(looked, same).drop(*[f"_of_{c}" for c in columns])


def match_roles(
    teams: DataFrame, venues: DataFrame, calendar: DataFrame, where: Mapping[str, Column] | None = None
) -> list[Role]:
    """The roles of a match: both teams and the winner, the venue, the day. `where` has conditions by role."""
    where = dict(where or {})
    roles = {
        "home": ("equipe_domicile_id", teams, "equipe_id", {"nom_equipe": "domicile", "pays": "pays_domicile"}),
        "away": ("equipe_exterieur_id", teams, "equipe_id", {"nom_equipe": "exterieur", "pays": "pays_exterieur"}),
        "winner": ("vainqueur_equipe_id", teams, "equipe_id", {"nom_equipe": "vainqueur"}),
        "venue": ("stade_id", venues, "stade_id", {"nom_stade": "nom_stade", "ville": "ville"}),
        "day": ("date_id", calendar, "date_id", {"date_complete": "jour_match", "mois": "mois", "annee": "annee"}),
    }
    unknown = set(where) - set(roles)
    if unknown:
        raise ValueError(f"no role {sorted(unknown)}")
    return [Role(*spec, where=where.get(name)) for name, spec in roles.items()]


def write_by_status(matches: DataFrame, path: str, status: Sequence[str] = ("is_match_joue", "statut"), day: str = "date_id") -> None:
    """Lay matches out by status, in folders, and by day within: a read of one status opens its folders
    alone, and of one span of days the files and row groups whose range meets it.

    Rows are dealt by range of status, day and match, so the status that nearly all have is spread
    over many files, each with its own days, and a rare one has one file.
    """
    order = [*status, day, *[c for c in matches.columns if c == "match_id"]]
    rows = matches.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.partitionBy(*status).parquet(path)


def matches_by_status(spark: SparkSession, path: str, statut: str, days: tuple[int, int] | None = None) -> DataFrame:
    """The matches of a status, and of the days from the first to the last, both included."""
    rows = spark.read.parquet(path).where(F.col("statut") == statut)
    return rows.where(F.col("date_id").between(*days)) if days else rows


def _ascending(order: Mapping[str, bool]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in order.items()]


def _same(columns: Mapping[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`")) for a, b in columns.items()], F.lit(True))


def _with_rank(df: DataFrame, ranks: DataFrame, columns: Sequence[str], rank: str) -> DataFrame:
    """The rows whose columns are among those of `ranks`, with the rank that stands there."""
    named = ranks.select(*[F.col(f"`{c}`").alias(f"_of_{c}") for c in columns], rank)
    return df.join(named, _same({c: f"_of_{c}" for c in columns})).drop(*[f"_of_{c}" for c in columns])


def first_with_ties(df: DataFrame, groups: Sequence[str], order: Mapping[str, bool], n: int, rank: str = "rank") -> DataFrame:
    """The rows of each group that rank `n` or better, all that tie with the last included.

    `order` maps columns to whether they ascend; nulls are last. Equal rows share a rank, as SQL's
    rank() gives it. The `n` first rows are found without the ties, which tells the last value
    that counts and the ranks of all before; then the rows with these values are taken from the
    input. So ties are never gathered, however many: they meet a small table.
    """
    columns = [*groups, *order]
    first = first_rows(df.select(*columns), groups, _ascending(order), n, rank)
    return _with_rank(df, first.groupBy(*columns).agg(F.min(rank).alias(rank)), columns, rank)


def ranked(df: DataFrame, groups: Sequence[str], order: Mapping[str, bool], rank: str = "rank") -> DataFrame:
    """All rows with their rank in their group, as SQL's rank() gives it, nulls last.

    Distinct values are numbered over many tasks and carry how many rows are before them, so a
    group that holds most rows is split, and equal rows are counted before they move.
    """
    columns = [*groups, *order]
    values = df.groupBy(*columns).agg(F.count("*").alias("_times"))
    spark = df.sparkSession
    sorts = []
    for i, (c, up) in enumerate(order.items()):
        if not up and dict(df.dtypes)[c] not in ("tinyint", "smallint", "int", "bigint", "float", "double") and not dict(df.dtypes)[c].startswith("decimal"):
            raise ValueError(f"{c} descends and is no number")
        values = values.withColumn(f"_null{i}", F.col(c).isNull()).withColumn(f"_sort{i}", F.col(c) if up else -F.col(c))
        sorts += [f"_null{i}", f"_sort{i}"]
    path = scratch_path(spark, "values")
    values.write.parquet(path)
    placed = numbered(spark.read.parquet(path), groups, sorts, "_place", weight="_times")
    placed = placed.withColumn(rank, F.col("_place") + 1)
    return _with_rank(df, placed, columns, rank)


def calendar_rollup(matches: DataFrame, calendar: DataFrame) -> DataFrame:
    """Matches, played ones, goals, and distinct home teams and competitions per month, year and in all.

    `level` is month, year or all; matches without a day are in a month and year of null. The fact is
    aggregated once, to what distinct counts need, before it meets the calendar; the grouping sets
    are expanded from that and not from the facts.
    """
    fine = matches.groupBy("date_id", "equipe_domicile_id", "competition").agg(
        F.count("*").alias("matchs"),
        F.count_if("is_match_joue").alias("joues"),
        F.sum(F.col("total_buts").cast("bigint")).alias("buts"),
    )
    days = calendar.select(F.col("date_id").alias("_day"), "annee", "mois")
    fine = fine.join(days, F.col("date_id") == F.col("_day"), "left")
    out = fine.rollup("annee", "mois").agg(
        F.grouping_id().alias("_sets"),
        F.sum("matchs").alias("matchs"),
        F.sum("joues").alias("joues"),
        F.sum("buts").alias("buts"),
        F.count_distinct("equipe_domicile_id").alias("equipes"),
        F.count_distinct("competition").alias("competitions"),
    )
    level = F.when(F.col("_sets") == 0, "month").when(F.col("_sets") == 1, "year").otherwise("all")
    return out.select(level.alias("level"), "annee", "mois", "matchs", "joues", "buts", "equipes", "competitions")


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], then: Sequence[str], buckets: int) -> DataFrame:
    """Write the table at `path` in buckets of the keys, sorted by them and by `then`, and give it back under
    a name of the session's catalog, which knows the buckets.

    A bucket has one file: rows are dealt to the buckets before they are written.
    """
    rows = df.repartition(buckets, *keys)
    rows.write.bucketBy(buckets, *keys).sortBy(*keys, *then).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def players_by_team(players: DataFrame, teams: DataFrame) -> DataFrame:
    """Per team and position the players and their mean shirt number; teams without players are left out.

    On tables in buckets of the team nothing is shuffled: neither for the counts nor for the join.
    """
    counted = players.groupBy("equipe_id", "position").agg(
        F.count("*").alias("joueurs"),
        F.min("date_naissance").alias("aine"),
        F.sum("numero_maillot").alias("somme_maillots"),
    )
    return counted.join(teams.select("equipe_id", "nom_equipe", "pays"), "equipe_id")


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(keys, change, differs): the keys whose rows are not the same on both sides.

    `change` is inserted, deleted or changed; `differs` names the changed columns. Both sides
    move as hashes of their columns, once, and are combined per task; a null is a value, null keys are
    keys, and of a key that repeats all rows are compared, whatever their order. Columns default to
    all of `new` beside the keys.
    """
    columns = [c for c in (columns or new.columns) if c not in keys]
    missing = [c for c in (*keys, *columns) if c not in old.columns or c not in new.columns]
    if missing:
        raise ValueError(f"columns {missing} are not on both sides")

    def hashed(df: DataFrame, side: int) -> DataFrame:
        # whether a value is null is part of the hash, which a null alone would leave as it was
        values = [F.xxhash64(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")).cast("decimal(38,0)") for c in columns]
        whole = F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))] or [F.lit(0)])
        return df.select(
            *[F.col(f"`{k}`") for k in keys],
            F.lit(side).alias("_side"),
            whole.cast("decimal(38,0)").alias("_row"),
            *[v.alias(f"_v{i}") for i, v in enumerate(values)],
        )

    both = hashed(old, -1).unionByName(hashed(new, 1))
    side = F.col("_side")
    sums = both.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.count_if(side < 0).alias("_before"),
        F.count_if(side > 0).alias("_after"),
        F.sum(F.col("_row") * side).alias("_row"),
        *[F.sum(F.col(f"_v{i}") * side).alias(f"_v{i}") for i in range(len(columns))],
    )
    kind = F.when(F.col("_before") == 0, "inserted").when(F.col("_after") == 0, "deleted").when(
        (F.col("_before") != F.col("_after")) | (F.col("_row") != 0), "changed"
    )
    names = F.array_compact(F.array(*[F.when(F.col(f"_v{i}") != 0, F.lit(c)) for i, c in enumerate(columns)]))
    told = sums.withColumn("change", kind).where("change IS NOT NULL")
    differs = F.when(F.col("change") == "changed", names).otherwise(F.array().cast("array<string>"))
    return told.select(*[F.col(f"`{k}`") for k in keys], "change", differs.alias("differs"))
