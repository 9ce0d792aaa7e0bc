"""Removes passages that an earlier document already has.

A *window* is ``WINDOW`` consecutive words of a document. A word goes if it
lies in a window whose word sequence also starts in a document with a smaller
key.

0. Of documents with the same text only the one with the least key goes on;
   the others lose all their windows to it.
1. *Anchors.* Of the hashes of all ``GRAM``-word sequences in a window the
   least one is its anchor (winnowing), so equal windows have equal anchors,
   and neighbours mostly share one. Anchors found in a single document end
   here; they are counted with partial sums, so a passage that every document
   holds costs one row per task.
2. *Segments.* What is left of a document, the windows with a shared anchor,
   goes to the shard of its anchor as one run of words. Anchors in more than
   ``HOT`` documents are taken by single windows instead, keyed by the window
   itself and summed to one row with the least key before and after the
   shuffle, so that no shard depends on how often a phrase occurs. While hot
   anchors and windows are few enough to be broadcast, by a count, they are
   found by a scan of the texts; else they take the way of the segments.
3. *Index.* A shard's segments make one compressed FM-index: a suffix array
   of its words, and the Burrows-Wheeler transform in a wavelet matrix of
   packed bits. Backward search streams all segments through it at once and
   follows their matching statistics up to the window length; an interval that
   holds one suffix only is given up. Intervals that reach the window length
   are reported with the least key among their suffixes.
4. The reported windows return to their documents.

Words are compared as words in the index; hashes only decide where they meet.
Copies, and windows in the broadcast table, are told by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import pieces, splitmix, staged

WINDOW = 13
GRAM = 4
HOT = 5_000
SHARD_WORDS = 500_000
HOT_ANCHORS = 200_000
HOT_WINDOWS = 1_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


# anchors


def word_hashes(split: list[list[bytes]]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for words in split for w in words], np.uint64)


def window_anchors(hashes: np.ndarray) -> np.ndarray:
    """The anchor of every window of one row of words."""
    grams = len(hashes) - GRAM + 1
    total = np.zeros(grams, np.uint64)
    for k in range(GRAM):
        total = total * _STEP + hashes[k : k + grams]
    total = splitmix(total)
    span, width = WINDOW - GRAM + 1, 1
    while width < span:  # least of each run of ``span`` grams, by doubling
        step = min(width, span - width)
        total = np.minimum(total[: len(total) - step], total[step:])
        width += step
    return total


class Runs:
    """Runs of windows with the same anchor in a list of texts.

    ``owner``: the text of a run; ``anchor``; ``first`` and ``end``: its first
    window, and one after its last, counted in words from the text's start.
    """

    def __init__(self, texts: list[str | None]):
        self.split = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, self.split), np.int64, len(texts))
        if sizes.sum() < WINDOW:
            self.owner = self.first = self.end = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.int64)
            return
        anchors = window_anchors(word_hashes(self.split)).view(np.int64)
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchors)]
        place = np.arange(len(anchors)) - starts[owner]
        inside = np.flatnonzero(place + WINDOW <= sizes[owner])
        owner, place, anchors = owner[inside], place[inside], anchors[inside]
        begins = np.ones(len(inside), bool)
        begins[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(begins)
        self.owner, self.anchor, self.first = owner[at], anchors[at], place[at]
        last = np.append(at[1:], len(inside)) - 1
        self.end = place[last] + 1 if len(at) else place[:0]


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, row, anchor: the distinct anchors of each (id, row, text)."""
    for batch in batches:
        ids, rows, done = batch.column(0).to_numpy(), batch.column(1).to_numpy(), 0
        for piece in pieces(batch.column(2)):
            runs = Runs(piece)
            order = np.lexsort((runs.anchor, runs.owner))
            owner, anchor = runs.owner[order], runs.anchor[order]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1])
            own = done + owner[fresh]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[own]), pa.array(rows[own]), pa.array(anchor[fresh])], names=["id", "row", "anchor"]
            )
            done += len(piece)


# segments

SEGMENT = "id bigint, row bigint, start int, shard bigint, hot boolean, words string"
_SEGMENT = pa.schema(
    [("id", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("shard", pa.int64()), ("hot", pa.bool_()), ("words", pa.string())]
)


def window_shard(text: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text, 1)).view(np.int64))


def window_name(text: bytes) -> bytes:
    """128 bits that stand for a window in a broadcast table."""
    return xxhash.xxh3_128_digest(text)


def _segment_batches(with_hot: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The runs of windows with shared anchors of each (id, row, text, shared, hot)."""
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            shared, hot = batch.column(3), batch.column(4)
            done = 0
            for piece in pieces(batch.column(2)):
                runs = Runs(piece)
                cuts = np.searchsorted(runs.owner, np.arange(len(piece) + 1))
                out: tuple[list, ...] = ([], [], [], [], [], [])
                for k, words in enumerate(runs.split):
                    own = slice(cuts[k], cuts[k + 1])
                    if shared[done + k].as_py() is None or own.start == own.stop:
                        continue
                    at = cuts[k] + np.flatnonzero(np.isin(runs.anchor[own], shared[done + k].values.to_numpy()))
                    busy = np.isin(runs.anchor[at], hot[done + k].values.to_numpy())
                    _plain(out, ids[done + k], rows[done + k], words, runs, at[~busy])
                    if with_hot:
                        _single(out, ids[done + k], rows[done + k], words, runs, at[busy])
                done += len(piece)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _SEGMENT)], schema=_SEGMENT)

    return run


def _plain(out: tuple[list, ...], id_: int, row: int, words: list[bytes], runs: Runs, at: np.ndarray) -> None:
    first, end = runs.first[at].tolist(), runs.end[at].tolist()
    out[0].extend([id_] * len(first))
    out[1].extend([row] * len(first))
    out[2].extend(first)
    out[3].extend(runs.anchor[at].tolist())
    out[4].extend([False] * len(first))
    out[5].extend([b" ".join(words[a : z - 1 + WINDOW]) for a, z in zip(first, end)])


def _single(out: tuple[list, ...], id_: int, row: int, words: list[bytes], runs: Runs, at: np.ndarray) -> None:
    for first, end in zip(runs.first[at].tolist(), runs.end[at].tolist()):
        for start in range(first, end):
            text = b" ".join(words[start : start + WINDOW])
            for column, value in zip(out, (id_, row, start, window_shard(text), True, text)):
                column.append(value)


def _hot_batches(anchors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """id, shard, words: single windows with one of the broadcast anchors."""
        for batch in batches:
            ids, done = batch.column(0).to_pylist(), 0
            for piece in pieces(batch.column(1)):
                runs = Runs(piece)
                out: tuple[list, ...] = ([], [], [], [], [], [])
                for at in np.flatnonzero(np.isin(runs.anchor, anchors.value)):
                    k = int(runs.owner[at])
                    _single(out, ids[done + k], 0, runs.split[k], runs, np.array([at]))
                done += len(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[5], pa.string())],
                    names=["id", "shard", "words"],
                )

    return run


# the index of one shard


class BitRank:
    """Packed bits with a count before every 64 of them."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.packed = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.packed).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones lie before each place."""
        block, rest = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.packed[block] & mask)


class WaveletMatrix:
    """A sequence of numbers below ``2 ** levels`` as one packed bit row per binary digit."""

    def __init__(self, values: np.ndarray, levels: int):
        self.levels, self.rows, self.zeros = levels, [], []
        for level in reversed(range(levels)):
            bits = (values >> level & 1).astype(np.uint8)
            self.rows.append(BitRank(bits))
            self.zeros.append(int(len(bits) - bits.sum(dtype=np.int64)))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        begin = np.zeros_like(at)
        for k, (row, zeros) in enumerate(zip(self.rows, self.zeros)):
            one = (symbol >> (self.levels - 1 - k) & 1).astype(bool)
            low, high = row.ones(begin), row.ones(at)
            begin = np.where(one, zeros + low, begin - low)
            at = np.where(one, zeros + high, at - high)
        return at - begin


class FMIndex:
    """FM-index of a sequence of words, sorted as deep as a window is long.

    Backward search of at most ``depth`` words needs no deeper order.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        self.order = suffix_order(symbols, depth + 1)
        self.levels = max(1, int(symbols.max()).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols))])
        self.matrix = WaveletMatrix(np.roll(symbols, 1)[self.order], self.levels)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = self.first[symbol]
        return base + self.matrix.rank(symbol, low), base + self.matrix.rank(symbol, high)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places of the sequence, taken as a circle, sorted by their next ``depth`` symbols or more."""
    rank, width = symbols.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -width)
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        fresh = np.cumsum(np.append(0, sorted_[1:] != sorted_[:-1]))
        rank = np.empty_like(rank)
        rank[order] = fresh
        width *= 2
        if fresh[-1] == len(rank) - 1:
            break
    return order


def earliest(segments: list[list[bytes]], keys: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For every window of every segment the least key of the segments that hold it."""
    names: dict[bytes, int] = {}
    flat: list[int] = []
    sizes = []
    for words in segments:
        flat.extend([names.setdefault(w, len(names) + 1) for w in words])
        flat.append(0)  # parts segments, and is in no window
        sizes.append(len(words) + 1)
    symbols = np.array(flat, np.int64)
    index = FMIndex(symbols, window)
    ends = np.cumsum(sizes)
    owner = np.repeat(keys, sizes)
    starts = np.concatenate([np.arange(e - s, e - window) for e, s in zip(ends, sizes)])
    least = np.repeat(keys, [s - window for s in sizes])
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(symbols))
    alive = np.arange(len(starts))
    for back in reversed(range(window)):
        a, b = index.step(symbols[starts[alive] + back], low[alive], high[alive])
        low[alive], high[alive] = a, b
        alive = alive[b - a > 1]  # a window that only its own segment holds is done
    if len(alive):
        ranges, which = np.unique(np.column_stack([low[alive], high[alive]]), axis=0, return_inverse=True)
        held = np.append(owner[index.order], np.iinfo(np.int64).max)
        # intervals of equal length patterns do not overlap, so their least keys come from one pass
        found = np.minimum.reduceat(held, ranges.ravel())[::2]
        least[alive] = found[which.ravel()]
    return np.split(least, np.cumsum([s - window for s in sizes])[:-1])


def _indexed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list[tuple], list[np.ndarray]]]:
    """Rows of whole shards and, for each, the least keys of its windows.

    Batches hold shard, words, key and ``width - 3`` more columns, sorted by
    shard, words and key. Whole shards are joined to one index until their
    segments have ``SHARD_WORDS`` words.
    """
    rows: list[tuple] = []
    size, shard = 0, None

    def flush() -> tuple[list[tuple], list[np.ndarray]]:
        distinct, keys, of = [], [], []
        last = None
        for row in rows:
            if row[:2] != last:
                last = row[:2]
                distinct.append(row[1].encode("utf-8", "surrogatepass").split())
                keys.append(row[2])
            of.append(len(distinct) - 1)
        found = earliest(distinct, np.array(keys, np.int64))
        return rows, [found[k] for k in of]

    for batch in batches:
        for row in zip(*[batch.column(k).to_pylist() for k in range(width)]):
            if row[0] != shard and size >= SHARD_WORDS:
                yield flush()
                rows, size = [], 0
            shard = row[0]
            rows.append(row)
            size += row[1].count(" ") + 2
    if rows:
        yield flush()


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, row, begin, end: runs of window starts that a smaller key has, from (shard, words, id, row, start)."""
    for rows, least in _indexed(batches, 5):
        out, last, low, high = [], None, 0, 0
        for (_, _, key, row, start), found in zip(rows, least):
            if found is not last:
                last, low, high = found, int(found.min()), int(found.max())
            if high < key:
                out.append((key, row, start, start + len(found)))
            elif low < key:
                held = np.flatnonzero(np.diff(np.concatenate([[0], found < key, [0]])))
                out.extend((key, row, start + a, start + z) for a, z in held.reshape(-1, 2).tolist())
        yield _ranges(out)


def _ranges(out: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * 4
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["id", "row", "begin", "end"]
    )


def _window_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shard, words, name and least key of single windows, from (shard, words, id)."""
    for rows, least in _indexed(batches, 3):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.string()),
                pa.array([window_name(r[1].encode("utf-8", "surrogatepass")) for r in rows], pa.binary()),
                pa.array([int(f[0]) for f in least], pa.int64()),
            ],
            names=["shard", "words", "name", "least"],
        )


# documents


KEPT = "struct<n_words:bigint,n_removed:bigint,kept:string>"


def keep_words(id_: Column, text: Column, runs: Column, copy: Column, hot: Column, least) -> Column:
    """``n_words``, ``n_removed`` and ``kept`` (words joined by one space) of a text.

    ``runs`` are runs of window starts that go, ``copy`` tells that all of them
    do, and ``hot`` are the anchors whose windows are looked up in ``least``, a
    broadcast table of window names and keys.
    """

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            total, gone, kept = [], [], []
            for one in zip(*batch):
                key, text_, lists, copied, busy = (x.as_py() for x in one)
                words = words_of(text_)
                spans = [(r["begin"], r["end"]) for r in lists or ()]
                if copied and len(words) >= WINDOW:
                    spans = [(0, len(words) - WINDOW + 1)]
                elif busy and least is not None:
                    spans += _held(text_, busy, key, least.value)
                total.append(len(words))
                if not spans:
                    gone.append(0)
                    kept.append(b" ".join(words).decode())
                    continue
                hit = np.zeros(len(words) + 1, np.int64)
                for begin, end in spans:
                    hit[begin] += 1
                    hit[end - 1 + WINDOW] -= 1
                stay = (np.cumsum(hit)[:-1] == 0).tolist()
                left = [w for w, s in zip(words, stay) if s]
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.StructArray.from_arrays(
                [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                names=["n_words", "n_removed", "kept"],
            )

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, KEPT)(id_, text, runs, copy, hot)


def _held(text: str, busy: list[int], key: int, least: dict[bytes, int]) -> list[tuple[int, int]]:
    """Single windows with a hot anchor that a smaller key has."""
    runs = Runs([text])
    spans = []
    for at in np.flatnonzero(np.isin(runs.anchor, np.array(busy, np.int64))):
        for start in range(int(runs.first[at]), int(runs.end[at])):
            if least.get(window_name(b" ".join(runs.split[0][start : start + WINDOW])), key) < key:
                spans.append((start, start + 1))
    return spans


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    hot: int = HOT,
    hot_anchors: int = HOT_ANCHORS,
    hot_windows: int = HOT_WINDOWS,
) -> DataFrame:
    """Per row: key, ``n_words``, ``n_removed`` and ``kept``, the words that stay, joined by one space.

    Windows are judged on the given texts, not on what is left of them. NULL
    texts have no words. Rows with a NULL key lose nothing and take nothing
    from others. Rows that share a key do not take from each other. Other
    columns are not read.
    """
    body = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    # tells texts under the same id apart
    body = body.select("id", F.xxhash64("t").alias("row"), "t")
    row = ["id", "row"]
    known = body.where(F.col("id").isNotNull())
    copies = staged(_copies(known), "copies")
    anchors = staged(known.mapInArrow(_anchor_batches, "id bigint, row bigint, anchor bigint"), "found")
    seen = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    shared = staged(seen.select("anchor", (F.col("n") > hot).alias("hot")), "anchors")
    of_doc = (
        anchors.join(shared, "anchor")
        .groupBy(*row)
        .agg(F.collect_set("anchor").alias("shared"), F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("busy"))
    )
    of_doc = staged(of_doc.join(copies, row, "left_anti"), "shared")
    least = _broadcast_least(known, shared, hot_anchors, hot_windows)
    # Both joins with the texts are by id and row and from the left, with nothing
    # asked of the texts before, so the texts are shuffled once for the two.
    given = F.when(F.col("shared").isNotNull(), F.col("t"))
    segments = (
        body.join(of_doc, row, "left")
        .select(*row, given.alias("t"), "shared", "busy")
        .mapInArrow(_segment_batches(with_hot=least is None), SEGMENT)
    )
    order = ["shard", "words", "id", "row", "start"]
    plain = segments.where(~F.col("hot")).select(*order).repartition("shard").sortWithinPartitions(*order)
    ranges = plain.mapInArrow(_repeats, "id bigint, row bigint, begin int, end int")
    if least is None:
        ranges = ranges.unionByName(_hot_ranges(segments.where("hot")))
    runs = ranges.groupBy(*row).agg(F.collect_list(F.struct("begin", "end")).alias("runs"))
    told = runs.join(copies.withColumn("copy", F.lit(True)), row, "full_outer").join(
        of_doc.where(F.size("busy") > 0).select(*row, "busy"), row, "full_outer"
    )
    copied = F.coalesce("copy", F.lit(False))
    kept = keep_words(F.col("id"), F.col("t"), F.col("runs"), copied, F.col("busy"), least)
    return body.join(told, row, "left").select(F.col("id").alias(key), kept.alias("x")).select(key, "x.*")


def _copies(known: DataFrame) -> DataFrame:
    """id, row: documents whose text a smaller id has too, by 128 bits of hash."""
    named = known.where(F.col("t").isNotNull()).select("id", "row", F.xxhash64(F.lit(7), "t").alias("b"))
    first = named.groupBy("row", "b").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    return named.join(first, ["row", "b"]).where("first < id").select("id", "row").distinct()


def _broadcast_least(known: DataFrame, shared: DataFrame, hot_anchors: int, hot_windows: int):
    """Least key by name of every window with a hot anchor, broadcast; None if there are too many."""
    hot = shared.where("hot").select("anchor")
    spark = known.sparkSession
    if hot.count() > hot_anchors:
        return None
    listed = np.array(sorted(r[0] for r in hot.collect()), np.int64)
    if not len(listed):
        return spark.sparkContext.broadcast({})
    texts = known.select("id", "t")
    windows = texts.mapInArrow(_hot_batches(spark.sparkContext.broadcast(listed)), "id bigint, shard bigint, words string")
    found = staged(_least(windows), "windows")
    if found.count() > hot_windows:
        return None
    return spark.sparkContext.broadcast({bytes(name): least for name, least in found.select("name", "least").collect()})


def _least(windows: DataFrame) -> DataFrame:
    """Least key of each single window, through the index of its shard."""
    order = ["shard", "words", "id"]
    each = windows.groupBy("shard", "words").agg(F.min("id").alias("id")).select(*order)
    return each.repartition("shard").sortWithinPartitions(*order).mapInArrow(
        _window_least, "shard bigint, words string, name binary, least bigint"
    )


def _hot_ranges(windows: DataFrame) -> DataFrame:
    """Runs from single windows, summed to one row each before they meet an index."""
    found = staged(_least(windows.select("shard", "words", "id")), "windows").select("shard", "words", "least")
    met = windows.select("id", "row", "start", "shard", "words").join(found, ["shard", "words"]).where("least < id")
    return met.select("id", "row", F.col("start").alias("begin"), (F.col("start") + 1).alias("end"))
