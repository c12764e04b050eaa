"""License notices in texts, found by diagonal voting.

Every run of k words of every text is hashed and joined with the runs of the templates (in Spark; the
templates are broadcast, they are a declared constant). A hit at word `pos` of a text and word `tpos` of a
template votes for the diagonal `pos - tpos`: a copy of the template puts all its hits on one, and
words put in or left out move the rest to a neighbouring one. Neighbouring diagonals are
merged to spans, and a span is verified word by word on the text. Texts move only where a span is
to be verified.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gradin.llm.graph import written
from gradin.llm.hashing import BASE, LOWER, Texts, Words, mixed, pieces, span_hashes

OUTSIDE = np.zeros(256, bool)
OUTSIDE[:48] = OUTSIDE[58:97] = OUTSIDE[123:128] = True
#: Runs of a text that stand in one row of the join's input; longer texts have several rows.
CHUNK = 1 << 16
#: Words that may be put in or left out between two parts of one span.
GAP = 8
#: Grams that all templates may have together: they are broadcast.
MOST_GRAMS = 100_000


@dataclass(frozen=True)
class Template:
    """A text to look for. A phrase (`share` 1) has to stand there word by word; of a longer text the
    share of its words that are covered by runs of `k` words in place has to be reached."""

    label: str
    text: str
    k: int = 2
    share: float = 1.0
    base: bool = False

    @property
    def words(self) -> list[bytes]:
        data = LOWER[np.frombuffer(self.text.encode(), np.uint8)]
        words = Words.of(Texts(data, np.array([0, len(data)])), OUTSIDE)
        return [data[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]

    @property
    def gap(self) -> int:
        return 0 if self.share == 1 else GAP


#: The phrases looked for, and the notices as their licenses give them.
TEMPLATES = (
    Template("mit", "MIT License", base=True),
    Template("apache", "Apache License", base=True),
    Template("gpl", "General Public License", base=True),
    Template("bsd", "BSD 2 Clause"),
    Template("bsd", "BSD 3 Clause"),
    Template("cc-by-nc", "CC BY NC"),
    Template("cc-by-sa", "CC BY SA"),
    Template("creative-commons", "Creative Commons Attribution"),
    Template("mpl", "Mozilla Public License"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the Software), to deal in the Software without restriction, including"
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the"
        " following conditions: The above copyright notice and this permission notice shall be included in all"
        " copies or substantial portions of the Software.",
        6,
        0.5,
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS"
        " OF ANY KIND, either express or implied. See the License for the specific language governing permissions"
        " and limitations under the License.",
        6,
        0.5,
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
        " GNU General Public License for more details.",
        6,
        0.5,
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce"
        " the above copyright notice, this list of conditions and the following disclaimer in the documentation"
        " and/or other materials provided with the distribution.",
        6,
        0.5,
    ),
)

SPANS = "array<struct<label:string,template:int,base:boolean,first_word:bigint,last_word:bigint,share:double,text:string>>"


def grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a text, and the place of each text's first one."""
    number = np.maximum(np.diff(first) - k + 1, 0)
    places = np.concatenate([[0], np.cumsum(number)])
    at = np.repeat(first[:-1] - places[:-1], number) + np.arange(places[-1])
    out = np.full(len(at), np.uint64(k), np.uint64)
    for j in range(k):
        out = out * BASE + hashes[at + j]
    return mixed(out), places


def _word_hashes(texts: Texts) -> tuple[Words, np.ndarray]:
    low = Texts(LOWER[texts.data], texts.offsets)
    words = Words.of(low, OUTSIDE)
    return words, span_hashes(low.prefix(), words.starts, words.ends)


def _template_grams(templates: Sequence[Template]) -> list[tuple[int, int, int]]:
    """(hash, template, tpos) of every run of every template."""
    rows = []
    for i, template in enumerate(templates):
        data = np.frombuffer(template.text.encode(), np.uint8)
        words, hashes = _word_hashes(Texts(data, np.array([0, len(data)])))
        if len(hashes) < template.k:
            raise ValueError(f"{template.text!r} has fewer than {template.k} words")
        found, _ = grams(hashes, words.first, template.k)
        rows += [(int(h), i, at) for at, h in enumerate(found.astype(np.int64))]
    if len(rows) > MOST_GRAMS:
        raise ValueError(f"templates have {len(rows)} runs of words; {MOST_GRAMS} can be broadcast")
    return rows


def _hits(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """(doc_id, t, n_words, template, tpos, pos): a row for each document, which has n_words, and one for
    each hit."""
    lengths = sorted({template.k for template in templates})
    columns = ["doc_id", "t", "n_words", "start", "hashes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in pieces(batch.column("text")):
                words, hashes = _word_hashes(texts)
                own = {c: batch.column(c).slice(begin, len(texts)) for c in ("doc_id", "t")}
                empty = pa.ListArray.from_arrays(np.zeros(len(texts) + 1, np.int32), pa.array([], pa.int64()))
                zeros = pa.array(np.zeros(len(texts), np.int64))
                counts = pa.array(words.counts.astype(np.int64))
                yield pa.RecordBatch.from_arrays([own["doc_id"], own["t"], counts, zeros, empty], columns)
                for k in lengths:
                    found, first = grams(hashes, words.first, k)
                    rows = -(-np.diff(first) // CHUNK)
                    text = np.repeat(np.arange(len(texts)), rows)
                    chunk = np.arange(len(text)) - np.repeat(np.cumsum(rows) - rows, rows)
                    starts = chunk * CHUNK
                    ends = np.concatenate([first[text] + starts, first[-1:]]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            own["doc_id"].take(pa.array(text)),
                            own["t"].take(pa.array(text)),
                            pa.nulls(len(text), pa.int64()),
                            pa.array(starts.astype(np.int64)),
                            pa.ListArray.from_arrays(ends, pa.array(found.astype(np.int64))),
                        ],
                        columns,
                    )

    schema = T.StructType([
        docs.schema["doc_id"],
        T.StructField("t", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("hashes", T.ArrayType(T.LongType())),
    ])
    known = docs.sparkSession.createDataFrame(
        _template_grams(templates), "hash bigint, template int, tpos int"
    )
    rows = docs.mapInArrow(run, schema).select("doc_id", "t", "n_words", "start", F.posexplode_outer("hashes").alias("at", "hash"))
    hits = rows.join(F.broadcast(known), "hash", "left").where("n_words IS NOT NULL OR template IS NOT NULL")
    return written(
        hits.select("doc_id", "t", "n_words", "template", "tpos", (F.col("start") + F.col("at")).alias("pos")), "hits"
    )


def _spans(hits: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """(doc_id, t, spans): per document the templates and runs of neighbouring diagonals to verify."""

    def per_template(values: Sequence[int]):
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("template") + 1)

    key = ["doc_id", "t", "template"]
    votes = hits.where("template IS NOT NULL").select(*key, (F.col("pos") - F.col("tpos")).alias("diagonal"), "tpos")
    votes = votes.distinct().groupBy(*key, "diagonal").agg(F.count("*").alias("votes"))
    along = Window.partitionBy(*key).orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(along)
    new = F.when(step <= per_template([t.gap for t in templates]), 0).otherwise(1)
    spans = votes.withColumn("new", new).withColumn("span", F.sum("new").over(along))
    spans = spans.groupBy(*key, "span").agg(
        F.sum("votes").alias("votes"), F.array_sort(F.collect_list("diagonal")).alias("diagonals")
    )
    # a vote covers k words at most; a phrase needs every vote
    least = [
        len(t.words) - t.k + 1 if t.share == 1 else int(np.ceil(t.share * len(t.words) / t.k)) for t in templates
    ]
    spans = spans.where(F.col("votes") >= per_template(least))
    return spans.groupBy("doc_id", "t").agg(F.collect_list(F.struct("template", "diagonals")).alias("spans"))


def verified(text: str, spans: list[dict], templates: Sequence[Template]) -> list[dict]:
    """The spans that reach their template's share, compared word by word, in order of the text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    data = LOWER[raw]
    words = Words.of(Texts(data, np.array([0, len(data)])), OUTSIDE)
    low, out = data.tobytes(), []
    for span in spans:
        template = templates[span["template"]]
        wanted = template.words
        covered, places = set(), set()
        for diagonal in span["diagonals"]:
            run = 0
            for at, word in enumerate(wanted):
                i = diagonal + at
                same = 0 <= i < len(words.starts) and low[words.starts[i] : words.ends[i]] == word
                run = run + 1 if same else 0
                if run >= template.k:
                    covered.update(range(at - template.k + 1, at + 1))
                    places.update((i - template.k + 1, i))
        share = len(covered) / len(wanted)
        if covered and share >= template.share:
            first, last = min(places), max(places)
            held = raw[words.starts[first] : words.ends[last]].tobytes().decode()
            out.append({
                "label": template.label, "template": span["template"], "base": template.base,
                "first_word": first, "last_word": last, "share": share, "text": held,
            })
    return sorted(out, key=lambda s: (s["first_word"], s["last_word"], s["template"]))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, spans) for each row of `docs`, which has doc_id and text.

    Words are runs of ASCII letters, digits and characters beyond ASCII, lower-cased (A-Z). A span has the
    label, the template's number, the words it stands on (from 0), the share of the template found,
    and its text. A null text is an empty one; texts without words or spans have an empty list;
    repeated rows, and rows with a null or repeated id, each have their own result, as
    documents are told apart by id and text. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text, F.octet_length(text)).alias("t"), text.alias("text"))
    hits = _hits(rows, templates)
    spans = written(_spans(hits, templates), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([
            ("label", pa.string()), ("template", pa.int32()), ("base", pa.bool_()), ("first_word", pa.int64()),
            ("last_word", pa.int64()), ("share", pa.float64()), ("text", pa.string()),
        ]))
        for batch in batches:
            for i in range(batch.num_rows):
                found = verified(batch.column("text")[i].as_py(), batch.column("spans")[i].as_py(), templates)
                one = {c: batch.column(c).slice(i, 1) for c in ("id", "t")}
                yield pa.RecordBatch.from_arrays([one["id"], one["t"], pa.array([found], kind)], ["id", "t", "spans"])

    named = spans.withColumnsRenamed({"doc_id": "id", "t": "span_t"})
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("t") == F.col("span_t"))
    schema = T.StructType([
        T.StructField("id", docs.schema["doc_id"].dataType), T.StructField("t", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType.fromDDL(SPANS[len("array<struct<") : -2].replace(":", " ")))),
    ])
    found = rows.join(named, same).select("id", "t", "text", "spans").mapInArrow(run, schema)
    found = written(found.dropDuplicates(["id", "t"]), "verified").withColumnRenamed("t", "found_t")
    every = hits.where("n_words IS NOT NULL").select("doc_id", "t", "n_words")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("t") == F.col("found_t"))
    none = F.array().cast(SPANS)
    return every.join(found, same, "left").select("doc_id", "n_words", F.coalesce("spans", none).alias("spans"))
