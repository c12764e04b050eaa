"""What the language stage decides by the language it finds."""

from __future__ import annotations

import corpus_pipeline
from gradin.llm import langid, toxicity
from pyspark.sql import functions as F

MODEL = langid.Model(["da", "de", "en", "fr", "nl", "sv"], [[0, 1, 2, 4, 5], [3]], [], None, None, None)
JUDGED = {
    "settled": ("fr", 0.5), "mixed": ("fr", 0.49), "one of five": ("de", 0.2), "garbled": ("en", 0.19), "12": ("und", 0.0),
}


def test_texts_that_no_language_settles_are_rejected(spark, monkeypatch):
    """Of five languages of a family each gets two fifths of the votes at most."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(JUDGED)], "doc_id bigint, text string")
    docs = docs.withColumn("lang", F.lit("fr"))

    def identify(rows, model):
        assert model is MODEL
        found = F.create_map(*[F.lit(x) for t, (code, _) in JUDGED.items() for x in (t, code)])
        scores = F.create_map(*[F.lit(x) for t, (_, score) in JUDGED.items() for x in (t, score)])
        return rows.withColumns({"lang_pred": found[F.col("text")], "score": scores[F.col("text")]})

    monkeypatch.setattr(langid, "fit", lambda docs: MODEL)
    monkeypatch.setattr(langid, "identify", identify)
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.text for r in kept.collect()} == {"settled", "one of five"}


def test_each_value_goes_to_python_once_in_bounded_batches(spark, monkeypatch):
    """Before, the text went beside a row that held it again, 10,000 rows at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(3000).selectExpr("id AS doc_id", "'a' AS score", "concat('text ', id) AS text", "1 AS predicted", "'fr' AS lang")
    sizes = spark.sparkContext.accumulator(0)

    def judged(rows, model):
        assert str(rows.schema).count("'text'") == 1

        def run(batches):
            for batch in batches:
                sizes.add(batch.num_rows > corpus_pipeline.BATCH_ROWS)
                yield batch

        added = {"lang_pred": F.lit("fr"), "score": F.lit(1.0), "predicted": F.lit(0)}
        return rows.mapInArrow(run, rows.schema).withColumns(added)

    monkeypatch.setattr(langid, "fit", lambda docs: MODEL)
    monkeypatch.setattr(langid, "identify", judged)
    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: None)
    monkeypatch.setattr(toxicity, "scored", judged)
    monkeypatch.setattr(corpus_pipeline, "table", lambda spark, folder, name: None)
    try:
        for stage in (corpus_pipeline.language, corpus_pipeline.toxic):
            spark.conf.set(key, "10000")
            kept = stage(spark, docs.coalesce(1), "")
            assert kept.schema.simpleString() == docs.schema.simpleString()
            assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))
            assert sizes.value == 0
    finally:
        spark.conf.set(key, before)
