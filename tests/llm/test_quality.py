from __future__ import annotations

import math
import random

import pytest
from cases import ODD
from helpers import SMALL

from tidemark.llm import quality


def plain(text):
    text = text or ""
    spaces = " \t\n\x0b\x0c\r"

    def split(t):
        for space in spaces:
            t = t.replace(space, " ")
        return [w for w in t.split(" ") if w]

    w = split(text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    hit = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [line for line in text.split("\n") if split(line)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "base_failed": len(w) < 20 or 100 * len(hit) > 30 * len(w),
    }


def made():
    rng = random.Random(8)
    lines = [" ".join(rng.choice(["the", "of", "a", "b#", "c"]) for _ in range(rng.randint(0, 12))) for _ in range(12)]
    return [(1000 + k, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for k in range(60)]


def test_counts(frame):
    rows = [r for r in ODD if r[0] not in (5, None)] + made()
    docs = frame(rows).withColumnRenamed("lang", "t").withColumnRenamed("source", "posterior")
    got = {r["doc_id"]: r.asDict() for r in quality.quality(docs).collect()}
    assert len(got) == len(rows)
    for key, text in rows:
        assert {k: got[key][k] for k in plain(None)} == plain(text), key
        assert not (got[key]["kept"] and got[key]["base_failed"])


def test_smallest_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for r in quality.quality(docs).collect():
        assert {k: r[k] for k in plain(None)} == plain(texts[r["doc_id"]])


def test_odd_rows_are_all_there(frame):
    got = quality.quality(frame(ODD)).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted((k for k, _ in ODD), key=repr)
    assert quality.quality(frame([])).collect() == []


def test_steps_equal_plain_expectation_maximisation(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(400):
        good = rng.random() < 0.7
        rows.append([(1 if good else -1) * (1 if rng.random() < 0.8 else -1) * (rng.random() < 0.9) for _ in quality.RULES])
    votes = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in quality.RULES))
    model = quality.fit(votes, steps=4)
    chances, prior = [dict(quality.LabelModel.start().chances[n]) for n in quality.RULES], 0.8
    start = quality.LabelModel.start().chances["size"]
    for _ in range(4):
        before, q = prior, []
        for row in rows:
            g, b = prior, 1 - prior
            for vote, chance in zip(row, chances):
                g, b = g * chance[vote][0], b * chance[vote][1]
            q.append(g / (g + b))
        good = sum(q)
        bad = len(rows) - good
        for k, chance in enumerate(chances):
            for v in (1, 0, -1):
                chance[v] = (
                    (sum(x for x, row in zip(q, rows) if row[k] == v) + 20 * start[v][0]) / (good + 20),
                    (sum(1 - x for x, row in zip(q, rows) if row[k] == v) + 20 * start[v][1]) / (bad + 20),
                )
        prior = (good + 16) / (len(rows) + 20)
        if abs(before - prior) < 1e-4:
            break
    assert math.isclose(model.prior, prior, rel_tol=1e-9)
    for name, chance in zip(quality.RULES, chances):
        for v in (1, 0, -1):
            assert model.chances[name][v] == pytest.approx(chance[v], rel=1e-9)


def test_plan_has_no_python(frame):
    plan = quality.quality(frame(made()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
