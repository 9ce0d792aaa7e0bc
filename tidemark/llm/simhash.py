"""Near-duplicate documents by SimHash fingerprints and tables of pivot distances.

Reference fingerprints (pivots) turn a fingerprint into a row of Hamming
distances. By the triangle inequality two fingerprints within ``DISTANCE``
bits have rows that differ by at most as much in every coordinate, so a pair
with a larger difference is discarded and only the survivors are compared.

Two kinds of pivots are used. *Group pivots* differ from the zero fingerprint
in one bit each and are dealt to six groups. Group by group, such coordinates
differ only if the fingerprints do inside the group, and the differences of
the groups add up, so pairs within three bits have no coordinate difference in
at least three of six groups. That makes candidates an equality join on the
coordinates of three groups: 20 tables. *Spread pivots* are far from each
other; their coordinates discard pairs inside such a candidate set.

Exact copies are one fingerprint from the start. A candidate set that is
larger than ``SET_LIMIT`` is dealt again by the coordinates that its members
still have free, as often as needed: each level fixes about half of the free
bits, so the third level ends at sets of at most 256 members by arithmetic.
Sets give a spanning forest of their links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.text import splitmix, staged

DISTANCE = 3
SHINGLE = 3
SEED = 42
SET_LIMIT = 400
GROUPS = 6
SPREAD = 12


# fingerprints


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of a text's shingles, unsigned; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = [digest(join(words[i : i + size]), SEED) for i in range(len(words) - size + 1)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def simhash(text: Column, size: int = SHINGLE) -> Column:
    """Fingerprint of a text column as a signed 64-bit integer; NULL counts as a text without words."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.fromiter((fingerprint(t.as_py(), size) for t in texts), np.uint64, len(texts))
            yield pa.array(found.view(np.int64))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "bigint")(text.cast("string"))


# pivots


def group_masks(free: list[int], groups: int = GROUPS) -> list[int]:
    """Bits of each group of pivots: the free bits, dealt in runs as even as they go."""
    cuts = [round(k * len(free) / groups) for k in range(groups + 1)]
    return [sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:])]


def _bits(mask: int) -> list[int]:
    return [b for b in range(64) if mask >> b & 1]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def relative_distances(fp: Column, mask: int) -> Column:
    """Distances to the single-bit pivots of a group, each less the distance to the zero fingerprint, as one number.

    Such a difference is -1 if the fingerprint has the pivot's bit and 1 if
    not, so the row of a group is told by the bits themselves.
    """
    return fp.bitwiseAND(F.lit(_signed(mask)))


def tables(fixed: int = 0) -> list[int]:
    """For each candidate table the bits whose coordinates must agree, besides ``fixed``."""
    groups = group_masks(_bits(~fixed & (1 << 64) - 1))
    return [fixed | sum(chosen) for chosen in combinations(groups, GROUPS - DISTANCE)]


def spread_pivots(count: int = SPREAD) -> np.ndarray:
    return splitmix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def pivot_rows(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The table of Hamming distances, one row per fingerprint."""
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


# links inside candidate sets


def forest(fps: np.ndarray, pivots: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect the members of one set as its pairs within ``DISTANCE`` do.

    Members are swept in order of the first coordinate, so that only those
    within ``DISTANCE`` of it are looked at; the other coordinates discard
    most of these before the fingerprints are compared.
    """
    rows = pivot_rows(fps, pivots)
    order = np.argsort(rows[:, 0], kind="stable")
    fps, rows = fps[order], rows[order]
    parent = list(range(len(fps)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ends = np.searchsorted(rows[:, 0], rows[:, 0] + DISTANCE, side="right")
    for at in range(len(fps)):
        near = slice(at + 1, ends[at])
        close = np.abs(rows[near] - rows[at]).max(axis=1, initial=0) <= DISTANCE
        where = np.flatnonzero(close)
        if len(where):
            where = where[np.bitwise_count(fps[near][where] ^ fps[at]) <= DISTANCE]
            for other in where + at + 1:
                a, b = top(at), top(int(other))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    yield int(fps[at]), int(fps[other])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of candidate sets that arrive as runs of equal (level, part, key)."""
    pivots = spread_pivots()
    held: list[np.ndarray] = []

    def close(block: np.ndarray) -> Iterator[tuple[int, int]]:
        cuts = np.flatnonzero((block[1:, :2] != block[:-1, :2]).any(axis=1)) + 1
        for run in np.split(block[:, 2], cuts):
            if len(run) > 1:
                yield from forest(np.unique(run.view(np.uint64)), pivots)

    def packed(links: Iterator[tuple[int, int]]) -> pa.RecordBatch:
        found = np.array(list(links), np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        block = np.column_stack([batch.column(k).to_numpy() for k in range(3)])
        if held:
            block = np.concatenate([*held, block])
        begin = np.flatnonzero((block[:, :2] != block[-1, :2]).any(axis=1))
        at = begin[-1] + 1 if len(begin) else 0
        held = [block[at:]]  # the last set may go on; it has SET_LIMIT members at most
        if at:
            yield packed(close(block[:at]))
    if held:
        yield packed(close(np.concatenate(held)))


def fingerprint_links(fps: DataFrame, column: str = "fp", limit: int = SET_LIMIT) -> DataFrame:
    """Links ``a``, ``b`` that connect distinct fingerprints as all pairs within ``DISTANCE`` bits do."""
    level = 0
    #: part tells the tables taken so far, so that sets of different tables never meet.
    fixed = dict(enumerate(tables()))
    rows = _dealt(fps.select(F.col(column).alias("fp")), fixed)
    small = []
    while True:
        sizes = rows.groupBy("part", "key").agg(F.count("*").alias("n")).where("n > 1")
        counted = staged(rows.join(sizes, ["part", "key"]), f"sets-{level}")
        last = level == 2
        small.append(counted.where(F.lit(last) | (F.col("n") <= limit)).select("part", "key", "fp"))
        large = counted.where(F.lit(not last) & (F.col("n") > limit)).select("part", "key", "fp")
        parts = [r[0] for r in large.select("part").distinct().collect()]  # at most 20 ** (level + 1)
        if not parts:
            break
        level += 1
        deeper = {p: tables(fixed[p]) for p in parts}
        rows = _refined(large, deeper)
        fixed = {(p + 1) * 20 + k: mask for p, masks in deeper.items() for k, mask in enumerate(masks)}
    sets = small[0]
    for more in small[1:]:
        sets = sets.unionByName(more)
    sets = sets.repartition("part", "key").sortWithinPartitions("part", "key")
    return sets.mapInArrow(_links, "a bigint, b bigint")


def _dealt(fps: DataFrame, masks: dict[int, int]) -> DataFrame:
    keys = [
        F.struct(F.lit(k).cast("long").alias("part"), relative_distances(F.col("fp"), mask).alias("key"))
        for k, mask in masks.items()
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("x")).select("x.part", "x.key", "fp")


def _refined(large: DataFrame, deeper: dict[int, list[int]]) -> DataFrame:
    """Members of large sets, dealt by the coordinates that are still free in each."""
    masks = F.create_map(
        *[x for p, m in deeper.items() for x in (F.lit(p).cast("long"), F.array(*[F.lit(_signed(v)) for v in m]))]
    )
    dealt = large.select("part", "fp", F.posexplode(masks[F.col("part")]).alias("k", "mask"))
    return dealt.select(
        ((F.col("part") + 1) * 20 + F.col("k")).alias("part"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Per row: key, ``fingerprint`` (16 hex digits) and ``component_id``, the least key of its class.

    Texts are linked if their fingerprints differ in at most ``DISTANCE`` bits;
    classes are what links reach. NULL and empty texts have fingerprint zero
    and are linked like others. NULL keys are never the least one; a class of
    such rows only has a NULL ``component_id``. Repeated rows are repeated in
    the result. Other columns are not read.
    """
    rows = staged(docs.select(F.col(key).alias("id"), simhash(F.col(text), size).alias("fp")), "fingerprints")
    each = rows.groupBy("fp").agg(F.min("id").alias("first"))
    each = staged(each, "distinct")
    roots = staged(connected_components(fingerprint_links(each)), "classes")
    least = (
        each.join(roots.withColumnRenamed("node", "fp"), "fp").groupBy("root").agg(F.min("first").alias("least"))
    )
    linked = roots.join(least, "root").select(F.col("node").alias("fp"), "least")
    class_of = each.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("least"))
    return rows.join(class_of, "fp").select(
        F.col("id").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"),
    )
