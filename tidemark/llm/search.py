"""Ranked lexical search by no-random-access reads of impact-sorted lists.

Documents are read once for their terms; of each one only the terms that some
query asks for are kept, so the postings grow with the input and the counts
(documents, terms, document frequencies) cover all of it. The scoring task
reads postings shard by shard. In a shard every term has one list of (document,
impact), highest impact first. A query reads its lists from the top, all to the
same depth, and keeps an interval for each document met: the lower end sums
the impacts read, the upper end adds, for every list in which the document has
not been met, the impact at which reading stands. Documents whose upper end is below the
k-th best lower end are out. Reading goes on until no unmet document can come
in and every one left has an interval of one point, so that members, equal scores
and final scores are all certain. The best of earlier shards of the task bound
the next ones; best lists of tasks are merged by two windows, the first one salted.

Queries are taken in blocks of at most ``BLOCK_BYTES`` of text, one broadcast
dictionary of terms for each; a block reads the documents once.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import UPPER, ascii_lower, staged

#: What a term is, and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, UNIT, LENGTH_SHARE, LENGTH_WEIGHT = 1_000_000_000, 1000, 75, 8

BEST = 10
BLOCK_BYTES = 16 << 20
SHARD_POSTINGS = 2_000_000
FIRST_READ, READ_GROWTH = 64, 4
_SALTS = 64
_LOWER = str.maketrans(UPPER, UPPER.lower())
_LONG_TEXT = 1 << 20


def _postings(docs: DataFrame, key: str, text: str, terms: dict[str, int]) -> DataFrame:
    """``doc``, ``n`` (terms with repeats), and ``terms`` and ``tfs`` of the terms asked for, for every row."""
    asked = docs.sparkSession.sparkContext.broadcast(terms)
    schema = T.StructType([T.StructField("doc", docs.schema[key].dataType)])
    schema = schema.add("n", "long").add("terms", T.ArrayType(T.IntegerType())).add("tfs", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        number, found, out = asked.value, re.compile(TERM), to_arrow_schema(schema)
        for batch in batches:
            sizes, terms_of, tfs_of = [], [], []
            for value in batch.column(1):
                value = value.as_py() or ""
                if len(value) < _LONG_TEXT:
                    counts = Counter(found.findall(value))
                else:  # words of a very long text are not held, only their counts
                    counts = Counter(m.group() for m in found.finditer(value))
                kept: dict[int, int] = {}
                for word, count in counts.items():
                    at = number.get(word.lower() if word.isascii() else word.translate(_LOWER))
                    if at is not None:
                        kept[at] = kept.get(at, 0) + count
                sizes.append(counts.total())
                terms_of.append(list(kept))
                tfs_of.append(list(kept.values()))
            columns = [batch.column(0), *(pa.array(c, f.type) for c, f in zip((sizes, terms_of, tfs_of), list(out)[1:]))]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


class Shard:
    """Impact-sorted lists of the documents of one batch."""

    def __init__(self, size: int, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray):
        self.size = size
        order = np.lexsort((-impacts, terms))
        self.docs, self.impacts, terms = docs[order], impacts[order], terms[order]
        names, starts = np.unique(terms, return_index=True)
        self.bounds = dict(zip(names.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(terms)])))

    def best(self, query: list[tuple[int, int]], k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of all that reach both the k-th place here and ``bar``, all above 0."""
        lists = [(*self.bounds[t], times) for t, times in query if t in self.bounds]
        lower = np.zeros(self.size, dtype=np.int64)
        met = np.zeros((self.size, len(lists)), dtype=bool)
        alive = np.ones(self.size, dtype=bool)
        depth, step = 0, FIRST_READ
        while True:
            stands = np.zeros(len(lists), dtype=np.int64)  # no unread impact of a list is higher
            for at, (start, end, times) in enumerate(lists):
                part = slice(min(start + depth, end), min(start + depth + step, end))
                docs = self.docs[part]
                lower[docs] += self.impacts[part] * times
                met[docs, at] = True
                if part.stop < end:
                    stands[at] = self.impacts[part.stop] * times
            depth, step = depth + step, step * READ_GROWTH
            unmet = int(stands.sum())
            least = max(bar, int(np.partition(lower, -k)[-k]) if self.size >= k else 0)
            at = np.flatnonzero(alive)
            open_ = unmet - met[at] @ stands  # width of each interval
            out = lower[at] + open_ < least
            alive[at[out]] = False
            if not unmet or (unmet < least and not open_[~out].any()):
                at = at[~out]
                at = at[(lower[at] >= max(least, 1))]
                return at, lower[at]


def _shards(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``SHARD_POSTINGS``, one row at least."""
    bounds = np.asarray(batch.column(2).offsets, dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(bounds, bounds[first] + SHARD_POSTINGS, side="right")) - 1
        last = max(first + 1, last)
        yield batch.slice(first, last - first)
        first = last


def _order(score: int, doc) -> tuple:
    """Ascending in rank from the worst: lower scores, later ids, NULL last of all."""
    return (score, doc is not None, -doc if doc is not None else 0)


def _task_bests(postings: DataFrame, weights: np.ndarray, queries: list[tuple[int, list]], documents: int, total: int, k: int) -> DataFrame:
    """``query``, ``doc``, ``score``, ``part``: the k best of every task for every query of the block."""
    shared = postings.sparkSession.sparkContext.broadcast((weights, queries))
    schema = T.StructType([T.StructField("query", T.LongType()), postings.schema["doc"]]).add("score", "long").add("part", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        weight, asked = shared.value
        out, part = to_arrow_schema(schema), TaskContext.get().partitionId()
        bests: list[list[tuple]] = [[] for _ in asked]
        for whole in batches:
            for batch in _shards(whole):
                keys = batch.column(0).to_pylist()
                lists = batch.column(2)
                sizes = np.diff(np.asarray(lists.offsets, dtype=np.int64))
                terms = np.asarray(lists.flatten(), dtype=np.int64)
                tfs = np.asarray(batch.column(3).flatten(), dtype=np.int64)
                length = np.asarray(batch.column(1), dtype=np.int64)
                share = 100 - LENGTH_SHARE + (LENGTH_SHARE * length * documents) // max(total, 1)
                docs = np.repeat(np.arange(len(keys)), sizes)
                impacts = weight[terms] * ((SCALE * tfs) // (UNIT * tfs + LENGTH_WEIGHT * share[docs]))
                shard = Shard(len(keys), terms, docs, impacts)
                for best, (_, query) in zip(bests, asked):
                    bar = best[0][0] if len(best) == k else 0
                    for at, score in zip(*(a.tolist() for a in shard.best(query, k, bar))):
                        entry = (*_order(score, keys[at]), keys[at])
                        if len(best) < k:
                            heapq.heappush(best, entry)
                        elif entry > best[0]:
                            heapq.heapreplace(best, entry)
        rows = [(q, e[-1], e[0], part) for best, (q, _) in zip(bests, asked) for e in best]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    return postings.mapInArrow(run, schema)


def _block(docs: DataFrame, asked: DataFrame, key: str, text: str, k: int) -> DataFrame | None:
    """The best documents for the queries of one block (``query``, ``term``, ``times``)."""
    rows = asked.collect()  # at most BLOCK_BYTES of terms
    number = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
    queries: dict[int, list] = {}
    for r in rows:
        queries.setdefault(r["query"], []).append((number[r["term"]], r["times"]))
    if not number:
        return None
    postings = staged(_postings(docs, key, text, number), "postings")
    documents, total = postings.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    documents, total = documents or 0, total or 0
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    share = (F.lit(2 * documents + 2).cast("double")) / (2 * F.col("df") + 1).cast("double")
    found = held.select("term", F.floor(F.lit(1000.0) * F.log(share)).alias("w")).collect()  # a row per term asked for
    weights = np.zeros(len(number), dtype=np.int64)
    for r in found:
        weights[r["term"]] = r["w"]
    return _task_bests(postings, weights, sorted(queries.items()), documents, total, k)


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = BEST,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` best rows of ``docs`` for each row of ``items``: ``item``, ``rank`` from 1, ``key``, ``score``.

    Only scores above 0 count; equal scores go by ascending ``key``, NULL last.
    NULL and empty texts have no terms and give or get no rows. Rows that repeat
    a key are documents, or queries, of their own. Empty tables give no rows.
    Other columns are not read. ``key`` is an integer.
    """
    spark = docs.sparkSession
    named = items.select(F.monotonically_increasing_id().alias("query"), F.col(item).alias("item"), F.col(item_text).cast("string").alias("text"))
    named = staged(named, "search-items")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    terms = named.select("query", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(f"({TERM})"), 1)).alias("term"))
    terms = terms.groupBy("query", "term").agg(F.count(F.lit(1)).alias("times"))
    found = []
    for number in range(blocks):
        mine = terms if blocks == 1 else terms.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == number)
        found.append(_block(docs, mine, key, text, k))
    found = [f for f in found if f is not None]
    if not found:
        empty = T.StructType([items.schema[item], T.StructField("rank", T.IntegerType()), docs.schema[key]]).add("score", "long")
        return spark.createDataFrame([], empty)
    best = reduce(DataFrame.unionByName, found)
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    salted = Window.partitionBy("query", F.col("part") % _SALTS).orderBy(*order)
    best = best.withColumn("place", F.row_number().over(salted)).where(F.col("place") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    return best.join(named.select("query", "item"), "query").select(
        F.col("item").alias(item), "rank", F.col("doc").alias(key), "score"
    )
