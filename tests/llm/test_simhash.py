from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from cases import ODD
from helpers import SMALL, rows_of

from tidemark.llm import simhash
from tidemark.llm.components import connected_components
from tidemark.llm.queries import op1_simhash


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(fps):
    parent = list(range(len(fps)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_classes(fps)
    least = {}
    for (key, _), root in zip(rows, roots):
        if key is not None:
            least[root] = min(key, least.get(root, key))
    return sorted(
        [(key, f"{fp:016x}", least.get(root)) for (key, _), fp, root in zip(rows, fps, roots)], key=repr
    )


def test_odd_texts(spark, frame):
    docs = frame(ODD).withColumnRenamed("source", "fingerprint").withColumnRenamed("lang", "component_id")
    assert rows_of(simhash.near_duplicates(docs)) == expected(ODD)


def test_empty(frame):
    assert simhash.near_duplicates(frame([])).collect() == []


def test_smallest_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(op1_simhash(spark, SMALL)) == expected(rows)


@pytest.mark.parametrize("limit", [400, 4])
def test_links_connect_as_all_pairs_do(spark, limit):
    rng = random.Random(5)
    fps = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        bits = rng.sample(range(64), 12)
        for _ in range(60):
            fps.add(center ^ sum(1 << b for b in rng.sample(bits, rng.randint(0, 5))))
    chain = rng.getrandbits(64)
    for b in range(64):
        fps.add(chain)
        chain ^= 1 << b
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(200)} | {0, 7, (1 << 64) - 1})
    roots = plain_classes(fps)
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint")
    links = simhash.fingerprint_links(frame, limit=limit)
    at = {int(np.uint64(f).view(np.int64)): k for k, f in enumerate(fps)}
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in links.collect())
    found = {}
    for node, root in connected_components(links).collect():
        found.setdefault(root, set()).add(at[node])
    wanted = {}
    for k, root in enumerate(roots):
        wanted.setdefault(root, set()).add(k)
    assert sorted(map(sorted, found.values())) == sorted(sorted(c) for c in wanted.values() if len(c) > 1)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(1000, 1100)] + [(7, 7), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {k: 100 for k in range(100, 161)} | {k: 5 for k in [5, *range(1000, 1100)]}
