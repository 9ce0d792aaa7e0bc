from __future__ import annotations

import hashlib

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from tidemark.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TURNS = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", "</s>[INST] ok [/INST]"),
    (1, 2, "assistant", "</s>[INST] ok [/INST] <\\s> [\\\\TURN] <\\\\\\s [/TURN]"),
    (1, 3, "user", None),
    (1, 4, "assistant", ""),
    (2, 0, "user", "only asked"),
    (3, None, "assistant", "no turn"),
    (3, 0, None, "no role"),
    (3, 0, "od\nd\\n [TURN]", "tie"),
    (3, 0, None, "no role"),
    (None, 0, "assistant", "no key"),
    (4, 0, "assistant", "a" * 200_000),
    (4, 1, "assistant", "<s>" * 50_000),
]


def ordered():
    groups = {}
    for key, turn, role, text in TURNS:
        groups.setdefault(key, []).append((-1 if turn is None else turn, role or "", text or ""))
    return {k: [(r, t) for _, r, t in sorted(v)] for k, v in groups.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame_of(spark, rows=TURNS):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", context string, key int")


def test_read_back(spark):
    got = {r[0]: tuple(r[1:5]) for r in chat.read_back(chat.examples(frame_of(spark))).collect()}
    wanted = {}
    for key, turns in ordered().items():
        loss = "".join(t for r, t in turns if r == "assistant")
        wanted[key] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    assert got == wanted


def test_wrong_context_is_an_error(spark):
    rows = chat.examples(frame_of(spark, [t for t in TURNS if t[0] == 1]))
    for wrong in (rows.withColumn("shared", F.col("shared") + F.col("example")), rows.where("example > 0")):
        with pytest.raises(Exception, match="an example of conversation 1 shares"):
            chat.read_back(wrong).collect()


def test_whole_examples(spark):
    whole = chat.materialise(chat.examples(frame_of(spark, [t for t in TURNS if t[0] in (1, 3)]))).collect()
    found = {(r["conv_id"], r["example"]): r for r in whole}
    assert len(found) == 3
    first, second = found[1, 0], found[1, 1]
    assert chat.unescaped(first["text"][first["begin"] : first["end"]]) == TURNS[2][3]
    assert second["begin"] == second["end"] and second["text"].startswith(first["text"])
    assert first["text"].startswith("<s>[TURN]system\nbe kind[/TURN][TURN]user\n<\\/s>[\\INST] ok [\\/INST][/TURN]")
    assert second["text"].endswith("[TURN]assistant\n[/TURN]</s>")


def test_texts_hold_no_control_strings(spark):
    rows = chat.examples(frame_of(spark)).collect()
    for r in rows:
        assert not any(c in (r["target"] or "") for c in chat.CONTROL)


def test_empty(spark):
    assert rows_of(chat.read_back(chat.examples(frame_of(spark, [])))) == []


def test_each_example_holds_all_turns_before_its_reply(spark):
    rows = chat.examples(frame_of(spark)).collect()
    for key, turns in ordered().items():
        replies = [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        own = sorted((r for r in rows if r["conv_id"] == key and r["target"] is not None), key=lambda r: r["example"])
        assert len(own) == len(replies)
        for r, at in zip(own, replies):
            read = [(chat.role_of(m[1]), chat.unescaped(m[2])) for m in chat._TURN.finditer(r["context"])]
            assert read == turns[:at] and r["context"].endswith("[TURN]assistant\n")


def test_context_of_other_turns_is_an_error(spark):
    rows = chat.examples(frame_of(spark, [t for t in TURNS if t[0] == 1]))
    wrong = rows.withColumn("context", F.regexp_replace("context", "be kind", "be blunt"))
    with pytest.raises(Exception, match="an example of conversation 1"):
        chat.read_back(wrong.where("example = 0").unionByName(rows.where("example > 0"))).collect()
    other = rows.withColumn("context", F.regexp_replace("context", "be kind", "be good"))
    with pytest.raises(Exception, match="does not begin with"):
        chat.read_back(other.where("example = 0").unionByName(rows.where("example > 0"))).collect()


def test_examples_are_sorted_once(spark):
    plan = chat.read_back(chat.examples(frame_of(spark)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2 and plan.count("Exchange hashpartitioning") == 1
