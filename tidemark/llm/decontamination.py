"""Removes passages of test items from training documents.

Words are runs of digits, letters and non-ASCII characters after lower-casing
A-Z. An item gives its windows of ``size`` consecutive words; a shorter item
is one window. Documents are scanned against a broadcast set of window hashes,
and every hit is verified word by word.

The broadcast is used while the items hold at most ``max_words`` words, which
a count over the items decides before anything is collected. Larger sets of
items are joined with the documents' windows instead, with the same result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import ascii_lower, pieces

SIZE = 10
MAX_WORDS = 2_000_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_SPANS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)

SCAN = "struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<start:int,end:int>>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class WindowSet:
    """Windows of the items: their words, rolling hashes by length, and the items of each."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int):
        self.words: dict[bytes, int] = {}
        windows: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        for name, text in items:
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)], np.int64)
            length = min(size, len(ids))
            for at in range(len(ids) - length + 1 if length else 0):
                held = windows[length][ids[at : at + length].tobytes()]
                if name is not None:
                    held.add(name)
        self.windows = {n: {k: sorted(v) for k, v in found.items()} for n, found in sorted(windows.items())}
        self.hashes = {
            n: np.sort(rolling(np.frombuffer(b"".join(found), np.int64).reshape(-1, n)))
            for n, found in self.windows.items()
        }

    def scan(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, list[str]]]:
        """Per text: its word count, which words are hit, and the items found."""
        get, flat, counts = self.words.get, [], []
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            flat.extend([get(w, 0) for w in words])
            flat.append(0)
        ids = np.array(flat, np.int64)
        ends = np.cumsum(np.array(counts, np.int64) + 1)
        hit = np.zeros(len(ids), bool)
        found: dict[int, set[str]] = defaultdict(set)
        gaps = np.concatenate([[0], np.cumsum(ids == 0)])
        for length, windows in self.windows.items():
            if len(ids) < length:
                continue
            starts = np.flatnonzero(gaps[length:] == gaps[:-length])
            if not len(starts):
                continue
            rows = ids[starts[:, None] + np.arange(length)]
            known, sums = self.hashes[length], rolling(rows)
            likely = known[np.minimum(np.searchsorted(known, sums), len(known) - 1)] == sums
            for start, row in zip(starts[likely], rows[likely]):
                names = windows.get(row.tobytes())
                if names is not None:
                    hit[start : start + length] = True
                    found[int(np.searchsorted(ends, start, side="right"))].update(names)
        for at, (count, end) in enumerate(zip(counts, ends)):
            yield count, hit[end - 1 - count : end - 1], sorted(found.get(at, ()))


def rolling(rows: np.ndarray) -> np.ndarray:
    total = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        total = total * _STEP + column.astype(np.uint64)
    return total


def spans_of(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Character ranges of runs of hit words."""
    out: list[list[int]] = []
    last = -2
    for at, match in enumerate(_SPANS.finditer(text)):
        if hit[at]:
            if last == at - 1:
                out[-1][1] = match.end()
            else:
                out.append([match.start(), match.end()])
            last = at
    return [tuple(x) for x in out]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return "".join([*kept, text[at:]])


class Decontaminator:
    """The hash set of one benchmark, broadcast; ``scan`` and ``clean`` are columns.

    ``scan(text)`` holds the words, hit words, items and character spans of a
    text; a NULL text has no words. ``clean(text)`` is the text without its
    hit spans; NULL stays NULL.
    """

    def __init__(self, benchmark: DataFrame, key: str = "item_id", text: str = "text", size: int = SIZE):
        rows = benchmark.select(F.col(key).cast("string"), F.col(text)).collect()
        self._shared = benchmark.sparkSession.sparkContext.broadcast(
            WindowSet([tuple(r) for r in rows], size)
        )

    def scan(self, text: Column) -> Column:
        shared = self._shared

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            windows = shared.value
            for texts in batches:
                rows = []
                for piece in pieces(texts):
                    for value, (count, hit, items) in zip(piece, windows.scan(piece)):
                        hits = int(hit.sum())
                        spans = [{"start": a, "end": b} for a, b in spans_of(value, hit)] if hits else []
                        rows.append({"n_words": count, "n_hit": hits, "items": items, "spans": spans})
                yield pa.array(rows, _SCAN_TYPE)

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, SCAN)(text.cast("string"))

    def clean(self, text: Column) -> Column:
        shared = self._shared

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            windows = shared.value
            for texts in batches:
                out = []
                for piece in pieces(texts):
                    for value, (_, hit, _) in zip(piece, windows.scan(piece)):
                        out.append(without(value, spans_of(value, hit)) if hit.any() else value)
                yield pa.array(out, pa.string())

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, "string")(text.cast("string"))


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_SCAN_TYPE = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))]
)


def _words(text: Column) -> Column:
    parts = F.split(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, " "), " ")
    return F.filter(parts, lambda w: w != "")


def fits_broadcast(benchmark: DataFrame, text: str = "text", max_words: int = MAX_WORDS) -> bool:
    total = benchmark.agg(F.sum(F.length(text))).first()[0] or 0
    if total <= 2 * max_words:  # a word and what parts it from the next are two characters at least
        return True
    return (benchmark.agg(F.sum(F.size(_words(F.col(text))).cast("long"))).first()[0] or 0) <= max_words


def _text_key(body: Column) -> Column:
    """Tells texts apart by 128 bits of hash."""
    return F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit(7), body).alias("b"))


def joined_hits(docs: DataFrame, benchmark: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """Hits by a join on window texts, for items of any number: text key ``a``, ``b``, hit word positions, items.

    Hits belong to a text and not to a row key, so keys may be NULL or repeated.
    Only windows of documents that meet a window of an item leave the join.
    A hot window costs rows in proportion to the documents that hold it.
    """
    named = benchmark.select(F.col(item).cast("string").alias("item"), _words(F.col(text)).alias("w"))
    named = named.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(size)))
    wanted = (
        named.select("item", "n", F.explode(_windows("w", "n")).alias("x"))
        .select("item", "n", F.col("x.window").alias("window"))
        .groupBy("n", "window")
        .agg(F.collect_set("item").alias("names"))
    )
    lengths = [r[0] for r in wanted.select("n").distinct().collect()]  # at most ``size`` values
    body = docs.select(F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    met = _met(body.select(_text_key(F.col("text")).alias("key"), "text"), wanted, lengths, size)
    found = met.groupBy("key").agg(
        _positions().alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("items"),
    )
    return found.select("key.a", "key.b", "hit", "items")


def _positions() -> Column:
    return F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1))))


def _met(docs: DataFrame, wanted: DataFrame, lengths: list[int], size: int) -> DataFrame:
    """Windows of ``docs`` (key, text) that are wanted: key, ``n``, ``at`` and the columns of ``wanted``."""
    have = docs.select("key", _words(F.col("text")).alias("w")).withColumn(
        "n", F.explode(F.array(*[F.lit(n) for n in lengths] or [F.lit(size)]))
    )
    have = have.where(F.size("w") >= F.col("n")).select("key", "n", F.explode(_windows("w", "n")).alias("x"))
    return have.select("key", "n", "x.at", "x.window").join(wanted, ["n", "window"])


def _joined_removal(docs: DataFrame, benchmark: DataFrame, remove: str, text: str, size: int) -> DataFrame:
    """``decontaminate`` by a join. Hits belong to a text, told by 128 bits of hash, so keys are not asked for."""
    words = benchmark.select(_words(F.col(text)).alias("w")).where(F.size("w") > 0)
    words = words.withColumn("n", F.least(F.size("w"), F.lit(size)))
    wanted = words.select("n", F.explode(_windows("w", "n")).alias("x")).select("n", "x.window").distinct()
    lengths = [r[0] for r in wanted.select("n").distinct().collect()]  # at most ``size`` values
    body = F.col(text).cast("string")
    met = _met(docs.where(F.col(text).isNotNull()).select(_text_key(body).alias("key"), body.alias("text")), wanted, lengths, size)
    if remove == "documents":
        found = met.select("key.a", "key.b").distinct()
    else:
        found = met.select("key", "n", "at").distinct().groupBy("key").agg(_positions().alias("hit"))
        found = found.select("key.a", "key.b", "hit")
    own = docs[text].cast("string")
    same = (F.xxhash64(own) == found["a"]) & (F.xxhash64(F.lit(7), own) == found["b"])
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    new = F.when(found["hit"].isNull(), docs[text]).otherwise(_cut(own, found["hit"]))
    return docs.join(found, same, "left").select(*[(new if c == text else docs[c]).alias(c) for c in docs.columns])


def _cut(text: Column, hit: Column) -> Column:
    """The text without its words at the positions ``hit``, counted from one; NULL without positions."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, hits in batches:
            out = []
            for value, at in zip(texts, hits):
                value, at = value.as_py(), at.as_py()
                if value is not None and at:
                    where = np.zeros(len(words_of(value)), bool)
                    where[np.array(at) - 1] = True
                    value = without(value, spans_of(value, where))
                out.append(value if at else None)
            yield pa.array(out, pa.string())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(text, hit)


def _hit_spans(text: Column, hit: Column) -> Column:
    """Character spans of the words at the positions ``hit``, counted from one."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, hits in batches:
            out = []
            for value, at in zip(texts, hits):
                value, at = value.as_py(), at.as_py()
                spans = []
                if value is not None and at:
                    where = np.zeros(len(words_of(value)), bool)
                    where[np.array(at) - 1] = True
                    spans = [{"start": a, "end": b} for a, b in spans_of(value, where)]
                out.append(spans)
            yield pa.array(out, pa.list_(_SPAN))

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<struct<start: int, end: int>>")(text, hit)


def _windows(words: str, length: str) -> Column:
    """Structs of start and space-joined words of every window of ``length`` words."""
    starts = F.sequence(F.lit(1), F.size(words) - F.col(length) + 1)
    return F.transform(
        starts,
        lambda at: F.struct(
            at.alias("at"), F.array_join(F.slice(F.col(words), at, F.col(length)), " ").alias("window")
        ),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    size: int = SIZE,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """Per document: key, ``n_words``, ``n_hit``, sorted ``items`` and ``spans`` of characters.

    NULL and empty texts have no words. Items without words, or an empty set
    of items, hit nothing. Items with a NULL id hit words but are not listed.
    Repeated items count once; every row of ``docs`` comes out, each judged by
    its own text, whatever its key. Above ``max_words`` the windows are joined,
    with the same result.
    """
    if fits_broadcast(benchmark, text, max_words):
        found = Decontaminator(benchmark, item, text, size).scan(F.col(text))
        return docs.select(F.col(key), found.alias("found")).select(key, "found.*")
    hits = joined_hits(docs, benchmark, item, text, size)
    body = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    own = _text_key(F.col("__text"))
    same = (own["a"] == hits["a"]) & (own["b"] == hits["b"])
    met = body.join(hits, same & F.col("__text").isNotNull(), "left")
    return met.select(
        F.col("__key").alias(key),
        F.size(_words(F.col("__text"))).cast("long").alias("n_words"),
        F.coalesce(F.size("hit"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        _hit_spans(F.col("__text"), F.col("hit")).alias("spans"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    remove: str = "documents",
    text: str = "text",
    item: str = "item_id",
    size: int = SIZE,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """Documents without contaminated ones, or with the hit spans cut out of their texts.

    Returns the columns of ``docs``. Clean documents are unchanged. Keys are
    not read, so they may be NULL or repeated. Above ``max_words`` the windows
    are joined, with the same result.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove!r}")
    if not fits_broadcast(benchmark, text, max_words):
        return _joined_removal(docs, benchmark, remove, text, size)
    held = Decontaminator(benchmark, item, text, size)
    if remove == "documents":
        return docs.where(held.scan(F.col(text))["n_hit"] == 0)
    return docs.withColumn(text, held.clean(F.col(text)))
