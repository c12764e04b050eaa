"""From documents to packed training sequences, in five stages.

Language ID, toxicity, near duplicates, mixing to target weights, packing. Each stage reads all
that its predecessor kept, and its result is written and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradin.llm import langid, mixing, neardup, packing, toxicity
from gradin.llm.graph import written
from gradin.llm.queries import table, tokenizer_path

#: Documents that an executor sends to a Python worker at a time.
BATCH_ROWS = 1000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, empty ones and nulls, which have no language, and those of which
    no language is found with half of the score it can get: mixed and garbled ones.

    Where no language can be learned, only the first are rejected.
    """
    _small_batches(spark)
    model = langid.fit(langid.learnable(docs))
    return _whole(langid.identify(_text_beside(docs), model).where(langid.settled(model)), docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score is 0.5 or more."""
    _small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _whole(toxicity.scored(_text_beside(docs), model).where("predicted = 0"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: that with the smallest id, null ids last,
    and of equal ids that with the smallest hash of its text.

    Repeated rows of it leave one, that with the smallest hash of the row. Documents without words are in no group: they stay, once for
    each id.
    """
    _small_batches(spark)
    kept = neardup.representatives(docs).select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"))
    rows = _texts(docs, F.xxhash64("text").alias("t"), mixing.row_hash(docs).alias("h"))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")), "left_semi")
    return rows.groupBy("doc_id", "t").agg(F.min_by("row", "h").alias("row")).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's documents as often as its target says."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]
#: No stage's decisions can be told in SQL. The tests hold the rows of language (without a model) and
#: near duplicates against expected ones; mixing and packing are compared as operators, toxicity by
#: planted words. No test compares what a whole run() writes.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches, which the JVM and the Python worker each hold more than once for
    every running task; by default they have 10,000 documents."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def _text_beside(docs: DataFrame) -> DataFrame:
    """text, and all other columns in one that no operator's own can replace: each value goes to Python once."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))


def _whole(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of `_text_beside` with their columns in order."""
    return rows.select(*[F.col("text" if c == "text" else f"row.`{c}`") for c in columns])


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id and text beside the whole row, whose other columns may have any name."""
    return docs.select("doc_id", "text", *more, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
