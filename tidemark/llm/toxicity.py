"""Toxicity of texts from two class-conditional Kneser-Ney models.

A text is its words, lower-cased and joined by one ``EDGE``, and each letter
and edge is told by the ``ORDER - 1`` letters before it, across words; so
every letter of every text is read, with spaces or without. The counts of
these longest contexts belong to a class, toxic or ordinary; all shorter
contexts have continuation counts of both classes together, so rare
expressions are smoothed through what they share. A letter that no class has
counted after its context is neutral: both models back off to the same shared
probability, and the ratio of their backoff weights tells little more than
how much text each was trained on. A letter that one class has counted is
backed off in the other, with its weight.

The difference of the two log-likelihoods is summed over stretches, a word
with its edge, or each ``LETTERS`` letters of a longer run. Its average by
letter, some of the highest stretches and the logarithm of their number are
properties of the text, and a logistic calibration on rows kept out of the
counts turns them into a probability.

Counts cover every labelled training text, and are summed and fitted in
Spark. A table of up to ``max_grams`` ratios is broadcast to the texts; a
larger one meets the distinct stretches of the texts in joins, with the same
result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.language import DRAWS, drawn_below
from tidemark.llm.text import id_crc, pieces, splitmix, staged

ORDER = 4
MAX_GRAMS = 4_000_000
BROADCAST_LABELS = 2_000_000
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.3
EDGE = " "
LETTERS = 24
_PAD = EDGE * (ORDER - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _joined(texts: list[str | None]) -> list[str]:
    """Every text as it is told: pad, words joined by edges, edge; nothing for a text without words."""
    split = ((t or "").lower().split() for t in texts)
    return [_PAD + EDGE.join(words) + EDGE if words else "" for words in split]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _told(sizes: np.ndarray) -> np.ndarray:
    """Places of all letters that are told, in texts of these sizes one after the other."""
    told = np.ones(int(sizes.sum()), bool)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    for k in range(ORDER - 1):
        told[starts + k] = False
    return np.flatnonzero(told)


def _hashes(points: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the ``ORDER`` letters that end at each place of ``last``."""
    total = np.full(len(last), ORDER, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ORDER - 1, -1, -1):
            total = total * _BASE + points[last - k]
        return splitmix(total)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for label in (0, 1):
            for piece in pieces(batch.column(0).filter(pa.array(toxic == label))):
                joined = _joined(piece)
                text = "".join(joined)
                last = _told(np.fromiter(map(len, joined), np.int64, len(joined)))
                if not len(last):
                    continue
                _, one, counts = np.unique(_hashes(_points(text), last), return_index=True, return_counts=True)
                grams = [text[b - ORDER + 1 : b + 1] for b in last[one].tolist()]
                zero = np.zeros(len(counts), np.int64)
                pair = (counts, zero) if label else (zero, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams, pa.string()), pa.array(pair[0]), pa.array(pair[1])],
                    names=["gram", "toxic", "ordinary"],
                )


def gram_counts(rows: DataFrame) -> DataFrame:
    """``gram`` (``ORDER`` letters), ``toxic``, ``ordinary``: counts over all letters of all texts of ``rows``."""
    found = rows.select("text", F.col("toxic").cast("int")).mapInArrow(
        _count_batches, "gram string, toxic bigint, ordinary bigint"
    )
    return found.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def cuts(numbers: list[int]) -> list[float]:
    """Discounts of counts 1, 2 and above, from how many counts are 1, 2, 3 and 4."""
    n = [max(1, x) for x in numbers]
    share = n[0] / (n[0] + 2 * n[1])
    each = [k - (k + 1) * share * n[k] / n[k - 1] for k in (1, 2, 3)]
    return [min(max(0.1, d), k - 0.05) for k, d in enumerate(each, 1)]


def _numbers(rows: DataFrame, column: str) -> list[int]:
    return list(rows.agg(*[F.count_if(F.col(column) == k) for k in (1, 2, 3, 4)]).first())


def _discount(count: Column, cut: list[float]) -> Column:
    return F.when(count == 0, 0.0).when(count == 1, cut[0]).when(count == 2, cut[1]).otherwise(cut[2])


def _shared_table(grams: DataFrame) -> DataFrame:
    """Kneser-Ney probability of a letter after shorter contexts, of both classes: ``suffix`` of ``ORDER - 1`` letters, ``shared``."""
    below = None
    alphabet = grams.select(F.right("gram", F.lit(1))).distinct().count() + 1
    for size in range(1, ORDER):
        longer = grams.select(F.right("gram", F.lit(size + 1)).alias("longer")).distinct()
        rows = staged(
            longer.groupBy(F.right("longer", F.lit(size)).alias("suffix")).agg(F.count("*").alias("continued")),
            "suffixes",
        )
        cut = _discount(F.col("continued"), cuts(_numbers(rows, "continued")))
        rows = rows.withColumns({"context": F.left("suffix", F.lit(size - 1)), "cut": cut})
        totals = rows.groupBy("context").agg(F.sum("continued").alias("total"), F.sum("cut").alias("kept"))
        rows = rows.join(totals, "context")
        if below is None:
            rows = rows.withColumn("below", F.lit(1 / alphabet))
        else:
            lower = below.select(F.col("suffix").alias("lower"), F.col("shared").alias("below"))
            rows = rows.join(lower, F.right("suffix", F.lit(size - 1)) == F.col("lower"))
        shared = (F.col("continued") - F.col("cut") + F.col("kept") * F.col("below")) / F.col("total")
        below = staged(rows.select("suffix", shared.alias("shared")), "shared")
    return below


def ratios(counts: DataFrame) -> DataFrame:
    """``gram``, ``ratio``: log ratio of the two models for the last letter of every counted gram."""
    rows = counts.withColumns({"suffix": F.right("gram", F.lit(ORDER - 1)), "context": F.left("gram", F.lit(ORDER - 1))})
    names = ("toxic", "ordinary")
    rows = rows.withColumns({f"{c}_cut": _discount(F.col(c), cuts(_numbers(counts, c))) for c in names})
    totals = rows.groupBy("context").agg(
        *[F.sum(c).alias(f"{c}_total") for c in names], *[F.sum(f"{c}_cut").alias(f"{c}_kept") for c in names]
    )
    rows, ratio = rows.join(_shared_table(counts), "suffix").join(totals, "context"), F.lit(0.0)
    for name, sign in zip(names, (1.0, -1.0)):
        total, own = F.col(f"{name}_total"), F.col(name) - F.col(f"{name}_cut")
        told = F.when(total > 0, (own + F.col(f"{name}_kept") * F.col("shared")) / total).otherwise(F.col("shared"))
        ratio = ratio + F.lit(sign) * F.log(told)
    return staged(rows.select("gram", ratio.alias("ratio")), "ratios")


FEATURES = ["average", "most", "second", "third", "fifth", "size"]
_BEST = {"most": 1, "second": 2, "third": 3, "fifth": 5}


@dataclass
class ToxicModel:
    """Log ratios of counted grams by sorted hash."""

    hashes: np.ndarray
    ratios: np.ndarray

    @classmethod
    def of(cls, found: DataFrame) -> ToxicModel:
        """From the hashes of ``ratios``, which are all collected."""
        table = found.mapInArrow(_hashed, "hash bigint, ratio double").toArrow()
        hashes = table["hash"].to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        return cls(hashes[order], table["ratio"].to_numpy()[order])

    def letters(self, points: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The log ratio of each letter at ``last``."""
        if not len(self.hashes):
            return np.zeros(len(last))
        hashes, back = np.unique(_hashes(points, last), return_inverse=True)
        where = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[where] == hashes, self.ratios[where], 0.0)[back]

    def measures(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text the ``FEATURES``: average by letter, highest stretches, not below 0, and log of their number."""
        joined = _joined(texts)
        sizes = np.fromiter(map(len, joined), np.int64, len(joined))
        average, size = np.zeros(len(texts)), np.zeros(len(texts))
        best = {rank: np.zeros(len(texts)) for rank in _BEST.values()}
        last = _told(sizes)
        if len(last):
            points = _points("".join(joined))
            ratio = self.letters(points, last)
            owner = np.repeat(np.arange(len(texts)), np.maximum(sizes - ORDER + 1, 0))
            begin = _stretches(points, last)
            average += np.bincount(owner, ratio, len(texts)) / np.maximum(np.bincount(owner, minlength=len(texts)), 1)
            total, of = np.add.reduceat(ratio, begin), owner[begin]
            size += np.log1p(np.bincount(of, minlength=len(texts)))
            order = np.lexsort((total, of))
            total, of = np.maximum(total[order], 0.0), of[order]
            ends = np.flatnonzero(np.append(of[1:] != of[:-1], True))
            for rank, held in best.items():
                at = ends - rank + 1
                more = (at >= 0) & (of[at] == of[ends])
                held[of[ends[more]]] = total[at[more]]
        return [average, *best.values(), size]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = _points("".join(batch.column(0).to_pylist()))
        hashes = _hashes(points, np.arange(ORDER - 1, len(points), ORDER))
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column(1)], names=["hash", "ratio"])


def _stretches(points: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where stretches begin among the letters at ``last``."""
    edge = points[last] == ord(EDGE)
    at = np.arange(len(last))
    word = np.maximum.accumulate(np.where(np.append(True, edge[:-1]), at, 0))
    return np.flatnonzero((at - word) % LETTERS == 0)


def _stretch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row its stretches, each with the letters before it, and their numbers."""
    for batch in batches:
        done = 0
        for piece in pieces(batch.column(1)):
            rows = []
            for text in _joined(piece):
                last = _told(np.array([len(text)]))
                if not len(last):
                    rows.append((0, []))
                    continue
                begin = (_stretches(_points(text), last) + ORDER - 1).tolist()
                found = Counter(text[a - ORDER + 1 : z] for a, z in zip(begin, [*begin[1:], len(text)]))
                rows.append((len(last), [{"stretch": s, "n": n} for s, n in found.items()]))
            letters, held = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[done : done + len(piece)],
                    pa.array(letters, pa.int64()),
                    pa.array(held, pa.list_(pa.struct([("stretch", pa.string()), ("n", pa.int64())]))),
                ],
                names=["id", "letters", "held"],
            )
            done += len(piece)


HELD = "id {id}, letters bigint, held array<struct<stretch:string,n:bigint>>"


def joined_measures(body: DataFrame, found: DataFrame) -> DataFrame:
    """``id`` and the ``measures`` of every row of ``body`` (id, text), for ratios of any number.

    Distinct stretches are told by joins of their letters with the ratios;
    rows of a text meet them by stretch.
    """
    body = body.select("id", F.col("text").cast("string").alias("text"))
    held = body.mapInArrow(_stretch_batches, HELD.format(id=body.schema["id"].dataType.simpleString()))
    held = staged(held.withColumn("row", F.monotonically_increasing_id()), "held")
    each = held.select("row", F.explode("held").alias("x")).select("row", "x.stretch", "x.n")
    places = F.sequence(F.lit(1), F.length("stretch") - F.lit(ORDER - 1))
    grams = F.transform(places, lambda at: F.substr("stretch", at, F.lit(ORDER)))
    letters = each.select("stretch").distinct().select("stretch", F.explode(grams).alias("gram"))
    told = letters.join(found, "gram", "left").groupBy("stretch")
    told = staged(told.agg(F.coalesce(F.sum("ratio"), F.lit(0.0)).alias("total")), "stretches")
    most = F.lit(max(_BEST.values()))
    best = F.when(F.col("total") > 0, F.array_repeat("total", F.least("n", most).cast("int")))
    sums = each.join(told, "stretch").groupBy("row").agg(
        F.sum(F.col("n") * F.col("total")).alias("total"),
        F.sum("n").alias("n"),
        F.sort_array(F.flatten(F.collect_list(best)), False).alias("best"),
    )
    own = {
        "average": F.col("total") / F.col("letters"),
        **{name: F.get("best", F.lit(rank - 1)) for name, rank in _BEST.items()},
        "size": F.log1p("n"),
    }
    return held.drop("held").join(sums, "row", "left").select(
        "id", *[F.coalesce(c, F.lit(0.0)).alias(name) for name, c in own.items()]
    )


MEASURES = f"struct<{','.join(f'{f}:double' for f in FEATURES)}>"


def measures(text: Column, shared) -> Column:
    """Per text the ``FEATURES``, from a broadcast model."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [shared.value.measures(piece) for piece in pieces(texts)]
            columns = [np.concatenate(c) for c in zip(*parts)] or [np.zeros(0)] * len(FEATURES)
            yield pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], names=FEATURES)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, MEASURES)(text.cast("string"))


def calibrate(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights, the constant last; Newton steps on standardised features."""
    if not len(labels):
        return np.zeros(features.shape[1] + 1)
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.column_stack([(features - mean) / spread, np.ones(len(features))])
    w, keep = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - labels) + keep * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    scale = w[:-1] / spread
    return np.append(scale, w[-1] - (scale * mean).sum())


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    folds: int = 4,
    held_out: int = 2,
    max_grams: int = MAX_GRAMS,
    calibration_rows: int = CALIBRATION_ROWS,
) -> DataFrame:
    """Per row: key, ``held_out``, ``score`` between 0 and 1, and ``predicted`` (score at least 0.3).

    Labels are learned only from rows whose crc32 of the key modulo ``folds``
    is not ``held_out``; NULL keys and NULL labels teach nothing and NULL keys
    are not held out. A tenth of the training rows, at most
    ``calibration_rows``, fits the calibration and is not counted. NULL and
    empty texts get the score of a text without any evidence. With no labels
    all scores are 0.5. Repeated rows are scored alike, one by one; a key that
    is labelled twice counts as toxic if any of its labels is.
    """
    spark = docs.sparkSession
    known = (
        labels.where(F.col(label).isNotNull() & (id_crc(key, folds) != held_out))
        .groupBy(F.col(key).alias("id"))
        .agg(F.max(F.col(label)).alias("toxic"))
    )
    apart = F.pmod(F.xxhash64("id"), F.lit(10)) == 0
    body = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    counted = staged(known.where(~apart), "labels")
    if counted.count() <= BROADCAST_LABELS:  # else the texts are shuffled by key
        counted = F.broadcast(counted)
    counts = staged(gram_counts(body.join(counted, "id").select("text", "toxic")), "grams")
    if counts.isEmpty():
        told = body.select("id", *[F.lit(0.0).alias(f) for f in FEATURES])
    else:
        found = ratios(counts)
        if found.count() > max_grams:
            told = joined_measures(body, found)
        else:
            shared = spark.sparkContext.broadcast(ToxicModel.of(found))
            told = body.select("id", measures(F.col("text"), shared).alias("m")).select("id", "m.*")
    told = staged(told, "measures")
    checked = told.join(known.where(apart), "id").select("id", *FEATURES, "toxic")
    below = drawn_below(calibration_rows, max(1, known.where(apart).count()))
    chosen = F.pmod(F.xxhash64(F.lit("calibration"), F.col("id")), F.lit(DRAWS)) < below
    rows = checked.where(chosen).select(*FEATURES, "toxic").orderBy(*FEATURES, "toxic").toPandas()
    *weights, constant = calibrate(
        rows[FEATURES].to_numpy(float).reshape(-1, len(FEATURES)), rows["toxic"].to_numpy(float)
    )
    logit = F.lit(float(constant))
    for name, weight in zip(FEATURES, weights):
        logit = logit + F.col(name) * F.lit(float(weight))
    score = 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-500.0)), F.lit(500.0))))
    return told.select(
        F.col("id").alias(key),
        F.coalesce(id_crc("id", folds) == held_out, F.lit(False)).alias("held_out"),
        score.alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
