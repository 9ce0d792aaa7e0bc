from __future__ import annotations

import pytest
from cases import ODD
from helpers import rows_of

from tidemark.llm.decontamination import contamination, decontaminate

LONG = "one two three four five six seven eight nine ten eleven twelve"
ITEMS = [(1, LONG), (2, LONG), (2, LONG), (3, "Short item"), (4, ""), (5, None), (None, "nameless pair"), (6, "漢字 é")]


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def plain(rows, items, size=10):
    def words(text):
        out = "".join(
            c.lower() if "A" <= c <= "Z" else c if c > "\x7f" or c.isdigit() or "a" <= c <= "z" else " " for c in text or ""
        )
        return [w for w in out.split(" ") if w]

    windows = []
    for name, text in items:
        w = words(text)
        n = min(size, len(w))
        windows += [(name, w[i : i + n]) for i in range(len(w) - n + 1 if n else 0)]
    result = []
    for key, text in rows:
        w, hit, found = words(text), set(), set()
        for name, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found |= {str(name)} - {"None"}
        result.append((key, len(w), len(hit), sorted(found)))
    return sorted(result, key=repr)


DOCS = [
    (10, "x " + LONG.upper().replace(" ", ", ") + " y short ITEM"),
    (11, "one two three four five six seven eight nine"),
    (12, "two three four five six seven eight nine ten eleven"),
    (13, "nameless pair and short itemised"),
    (14, "漢字 É 漢字 é"),
]


@pytest.mark.parametrize("bound", [2_000_000, 1])
def test_both_ways(frame, items, bound):
    rows = ODD + DOCS + [(10, "clean"), (None, DOCS[0][1]), (11, DOCS[0][1]), (10, DOCS[0][1])]
    docs = frame(rows).withColumnRenamed("lang", "items").withColumnRenamed("source", "found")
    got = contamination(docs, items, max_words=bound).select("doc_id", "n_words", "n_hit", "items")
    assert rows_of(got) == plain(rows, ITEMS)


def test_both_ways_give_the_same_columns(frame, items):
    """Two texts under one id are judged each by itself, spans included, on both sides of the bound."""
    rows = DOCS + [(10, "one clean text of five words"), (10, DOCS[1][1])]
    scanned, joined = (contamination(frame(rows), items, max_words=m) for m in (2_000_000, -1))
    assert scanned.dtypes == joined.dtypes
    assert rows_of(scanned) == rows_of(joined)
    assert all(r["n_hit"] <= r["n_words"] for r in joined.collect())


def test_removal(frame, items):
    kept = decontaminate(frame(DOCS + ODD), items)
    assert {r["doc_id"] for r in kept.collect()} == {11} | {k for k, _ in ODD}
    cut = {r["doc_id"]: r["text"] for r in decontaminate(frame(DOCS), items, remove="spans").collect()}
    assert cut == {10: "x  y ", 11: DOCS[1][1], 12: "", 13: " and short itemised", 14: "漢字 É "}
    assert kept.columns == frame([]).columns


@pytest.mark.parametrize("remove", ["documents", "spans"])
def test_removal_from_many_items(frame, items, remove):
    """Above the bound, with NULL keys, repeated keys of unlike texts and repeated texts."""
    rows = DOCS + ODD + [(10, "clean"), (None, DOCS[0][1]), (11, DOCS[0][1]), (10, DOCS[0][1])]
    given = frame(rows)
    small = rows_of(decontaminate(given, items, remove))
    large = decontaminate(given, items, remove, max_words=1)
    assert rows_of(large) == small and large.columns == given.columns and large.schema["text"] == given.schema["text"]
    assert len(small) == (len(ODD) + 2 if remove == "documents" else len(rows))
    assert rows_of(decontaminate(given, items.limit(0), remove, max_words=-1)) == rows_of(given)


@pytest.mark.parametrize("bound", [2_000_000, -1])
def test_empty(frame, items, bound):
    assert contamination(frame([]), items, max_words=bound).collect() == []
    none = contamination(frame(DOCS), items.limit(0), max_words=bound)
    assert [r["n_hit"] for r in none.collect()] == [0] * len(DOCS)
