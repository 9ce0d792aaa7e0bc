from __future__ import annotations

import random

import numpy as np
import pytest
from cases import ODD
from helpers import SMALL, rows_of

from tidemark.llm import substrings


def plain(rows):
    def words(text):
        for space in "\t\n\x0b\x0c\r":
            text = (text or "").replace(space, " ")
        return [w for w in (text or "").split(" ") if w]

    least = {}
    for key, text in rows:
        w = words(text)
        for i in range(len(w) - 12 if key is not None else 0):
            window = tuple(w[i : i + 13])
            least[window] = min(key, least.get(window, key))
    out = []
    for key, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - 12 if key is not None else 0):
            if least[tuple(w[i : i + 13])] < key:
                gone.update(range(i, i + 13))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def made(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(11, 30))] for _ in range(6)]
    rows = []
    for key in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.5 else rng.choices(vocabulary, k=rng.randint(1, 30))
        rows.append((key, " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [5_000, 3])
@pytest.mark.parametrize("bound", [1_000, 2, -1])
def test_made_documents(frame, hot, bound):
    rows = made(1) + [(None, "w1 " * 40), (200, "w1 " * 40), (201, "w1 " * 50), (201, "w1 " * 20), (202, "w1 " * 40)]
    got = substrings.remove_repeats(frame(rows), hot=hot, hot_anchors=max(bound, 0) * 1000, hot_windows=bound)
    assert rows_of(got) == plain(rows)


@pytest.mark.parametrize("hot", [5_000, 0])
@pytest.mark.parametrize("bound", [1_000, -1])
def test_unlike_texts_under_one_key(frame, hot, bound):
    """A copied text under a key says nothing about another text of that key, which loses its own repeats and is a source."""
    rng = random.Random(9)
    one, two, three = (" ".join(f"{p}{rng.randrange(999)}" for _ in range(20)) for p in "abc")
    rows = [(1, one), (5, one), (5, f"own {two}"), (7, f"{two} end"), (3, f"{three} x"), (5, f"y {three}"), (5, one), (9, None)]
    got = rows_of(substrings.remove_repeats(frame(rows), hot=hot, hot_anchors=max(bound, 0) * 1000, hot_windows=bound))
    assert got == plain(rows)
    assert (7, 21, 20, "end") in got and (5, 21, 20, "y") in got and (5, 21, 0, f"own {two}") in got


def test_many_shards(frame, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_WORDS", 30)
    rows = [(k, "shard bigint " + t.replace(" ", "  ")) for k, t in made(2, 30)]
    batches = list(_sorted_segments(rows))
    split = [f for _, found in substrings._indexed(iter(batches), 5) for f in found]
    monkeypatch.setattr(substrings, "SHARD_WORDS", 10**9)
    whole = [f for _, found in substrings._indexed(iter(batches), 5) for f in found]
    assert all((a == b).all() for a, b in zip(split, whole, strict=True))


def _sorted_segments(rows):
    import pyarrow as pa

    out = []
    for key, text in rows:
        runs = substrings.Runs([text])
        for anchor, first, end in zip(runs.anchor.tolist(), runs.first.tolist(), runs.end.tolist()):
            run = runs.split[0][first : end - 1 + 13]
            out.append((anchor, b" ".join(run).decode(), key, 0, first))
    out.sort()
    for at in range(0, len(out), 7):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out[at : at + 7])], names=list("abcde"))


def test_index_counts():
    rng = np.random.default_rng(4)
    symbols = rng.integers(0, 5, 300)
    index = substrings.FMIndex(symbols, 6)
    circle = np.concatenate([symbols, symbols])
    for _ in range(100):
        pattern = rng.integers(0, 5, rng.integers(1, 7))
        low, high = np.array([0]), np.array([300])
        for symbol in pattern[::-1]:
            low, high = index.step(np.array([symbol]), low, high)
        wanted = sum((circle[i : i + len(pattern)] == pattern).all() for i in range(300))
        assert int(high[0] - low[0]) == wanted


def test_odd_texts(frame):
    docs = frame(ODD).withColumnRenamed("lang", "kept").withColumnRenamed("source", "id")
    assert rows_of(substrings.remove_repeats(docs)) == plain(ODD)
    assert substrings.remove_repeats(frame([])).collect() == []


def test_smallest_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = rows_of(substrings.remove_repeats(spark.read.parquet(f"{SMALL}/documents.parquet")))
    assert got == plain(rows)
    assert sum(r[2] for r in got) > 0
