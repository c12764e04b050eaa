"""Chats turn by turn: the same as whole chats, whatever the batches."""

from __future__ import annotations

import hashlib
import json
from collections import Counter

from pyspark.sql import functions as F

from gradin.llm import chat

ROWS = [
    (1, 0, "system", "be <|turn|> kind"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "fine <\\|end|>"),
    (1, 2, "assistant", None), (1, None, "user", "no number"), (None, 0, "user", "no id"), (None, 1, "assistant", "é\nü"),
    (2, 0, None, None), (2, 0, "", ""), (3, 5, "human", "x"), (3, 4, "gpt", "y"), (4, 0, "user", ""), (4, 0, "user", ""),
    *[(5, i % 700, "assistant" if i % 2 else "user", f"t{i % 900} <s>") for i in range(3000)],
]


def test_turns_one_by_one_are_the_chats(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        df = spark.createDataFrame(ROWS, "conv_id bigint, turn int, role string, text string").withColumn("n", F.lit(1))
        df = df.repartition(5)
        whole = {r.chat_id: r for r in chat.format_chats(chat.canonical_turns(df, "conv_id")).collect()}
        turns = chat.format_turns(chat.turn_rows(df, "conv_id"))
        rows = sorted(turns.collect(), key=lambda r: (str(r.chat_id), r.n))
        for i, w in whole.items():
            own = [r for r in rows if r.chat_id == i]
            assert "".join(r.formatted for r in own) == w.formatted
            assert [r.n for r in own] == list(range(len(own)))
            assert [(r.loss_begin, r.loss_end) for r in own if r.loss_begin is not None] == [(s.begin, s.end) for s in w.loss]
        back = {r.chat_id: r for r in chat.read_chats(chat.format_chats(chat.canonical_turns(df, "conv_id"))).collect()}
        found = chat.digest_turns(turns).collect()
        assert Counter(r.chat_id for r in found) == Counter(list(whole))
        for r in found:
            texts = "".join(f"{t.role}\n{t.text}\n" for t in back[r.chat_id].turns)
            assert r.turns_sha256 == hashlib.sha256(texts.encode()).hexdigest() and r.n_turns == len(back[r.chat_id].turns)
            loss = back[r.chat_id].loss_text
            assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
            assert r.formatted_chars == len(whole[r.chat_id].formatted)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_layouts_of_lines_become_turns(spark):
    lines = [
        (1, json.dumps({"prompt": "p", "response": "r"})), (2, json.dumps({"messages": [{"role": "user", "content": "m"}]})),
        (3, json.dumps({"instruction": "i", "input": "n", "output": "o"})), (4, "{broken"), (5, None),
        (6, json.dumps({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": None}]})),
        (1, json.dumps({"prompt": "p", "response": "r"})),
    ]
    df = spark.createDataFrame(lines, "id int, line string")
    rows = Counter((r.chat_id, r.role, r.text) for r in chat.json_turn_rows(df, "id", "line").collect())
    assert rows == Counter({
        (1, "user", "p"): 2, (1, "assistant", "r"): 2, (2, "user", "m"): 1, (3, "user", "i\n\nn"): 1,
        (3, "assistant", "o"): 1, (4, None, None): 1, (5, None, None): 1, (6, "user", "h"): 1, (6, "assistant", ""): 1,
    })
    found = {r.chat_id: r.n_turns for r in chat.digest_turns(chat.format_turns(chat.json_turn_rows(df, "id", "line"))).collect()}
    assert found == {1: 4, 2: 1, 3: 2, 4: 0, 5: 0, 6: 2}


def test_no_turns(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert chat.digest_turns(chat.format_turns(chat.turn_rows(none, "conv_id"))).count() == 0
