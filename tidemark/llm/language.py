"""Language of a text by sparse multinomial logistic regression.

Features are hashed n-grams of one to ``ORDERS`` letters, weighted by their
frequency in the text and inverse document frequency. Weights are trained by
follow-the-regularised-leader (FTRL-Proximal) with L1 and L2 penalties, so
most are zero, and a temperature fitted on rows kept out of the training makes
the probabilities honest.

Document frequencies cover all labelled training texts and are one vector of
``BUCKETS`` numbers. The weights are fitted on a sample of at most about
``sample`` labelled rows of each language, chosen by a hash of the key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import id_crc, pieces, splitmix

ORDERS = 3
BUCKETS = 1 << 15
SAMPLE = 1_000
DRAWS = 1 << 62
MAX_LANGUAGES = 1_000
TEXTS_AT_ONCE = 128
UNKNOWN = "und"
SCALE = 100.0
_SEEDS = splitmix(np.arange(1, ORDERS + 1)) | np.uint64(1)
_LETTER: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTER[0][points]


def grams(texts: list[str | None]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Per order the text and the bucket of every n-gram, and how many letters each text has.

    Texts are lower-cased; what lies between letters counts as one space.
    """
    lowered = ["" if t is None else t.lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    points = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lowered)), sizes)
    letter = _is_letter(points)
    letters = np.bincount(owner[letter], minlength=len(lowered))
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    points, owner = np.where(letter, points, 32)[kept].astype(np.uint64), owner[kept]
    out, total = [], np.zeros(len(points), np.uint64)
    for n in range(ORDERS):
        total = total[: len(total) - 1] if n else total
        if not len(total):
            break
        total = total * _SEEDS[n] + points[n:]
        same = owner[n:] == owner[: len(owner) - n]
        hashed = (total * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
        out.append((owner[: len(owner) - n][same], hashed.astype(np.int64)[same]))
    return out, letters


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, texts_seen = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for piece in pieces(batch.column(0)):
            per_order = grams(piece)[0]
            for begin in range(0, len(piece), TEXTS_AT_ONCE):
                held = np.zeros((min(TEXTS_AT_ONCE, len(piece) - begin), BUCKETS), bool)
                for owner, bucket in per_order:
                    own = slice(*np.searchsorted(owner, [begin, begin + TEXTS_AT_ONCE]))
                    held[owner[own] - begin, bucket[own]] = True
                found += held.sum(axis=0)
            texts_seen += len(piece)
    where = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(where, -1)), pa.array(np.append(found[where], texts_seen))], names=["bucket", "texts"]
    )


def document_frequencies(texts: DataFrame) -> DataFrame:
    """``bucket``, ``texts``: in how many texts each bucket occurs; bucket -1 holds the number of texts."""
    found = texts.mapInArrow(_frequencies, "bucket bigint, texts bigint")
    return found.groupBy("bucket").agg(F.sum("texts").alias("texts"))


@dataclass
class LanguageModel:
    """Weights by bucket, already times the inverse document frequencies."""

    labels: list[str]
    weights: np.ndarray
    constant: np.ndarray
    temperature: float

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        per_order, letters = grams(texts)
        total = np.zeros((len(texts), len(self.labels)))
        count = np.zeros(len(texts))
        for owner, bucket in per_order:
            if not len(owner):
                continue
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            total[owner[starts]] += np.add.reduceat(self.weights[bucket], starts, axis=0)
            count += np.bincount(owner, minlength=len(texts))
        return total / np.maximum(count, 1)[:, None] + self.constant, letters

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        if not self.labels:
            yield from ((UNKNOWN, 0.0) for _ in texts)
            return
        logits, letters = self.logits(texts)
        p = softmax(logits / self.temperature)
        for row, best, some in zip(p, p.argmax(axis=1), letters):
            yield (self.labels[best], float(row[best])) if some else (UNKNOWN, 0.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    classes: int,
    rounds: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.01,
) -> np.ndarray:
    """FTRL-Proximal on sparse rows (buckets, values); the constant is the last bucket and not penalised by L1."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        own, pull = z[at], np.full((len(z[at]), 1), l1)
        pull[-1] = 0.0
        w = (np.sign(own) * pull - own) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(own) <= pull] = 0.0
        return w

    order = np.random.default_rng(11)
    for _ in range(rounds):
        for k in order.permutation(len(rows)):
            at = np.append(rows[k][0], BUCKETS)
            x = np.append(rows[k][1], 1.0)[:, None]
            w = weights(at)
            p = softmax((x * w).sum(axis=0))
            p[labels[k]] -= 1
            g = x * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(slice(None))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, between 1/20 and 20."""
    if not len(labels):
        return 1.0
    tried = np.geomspace(0.05, 20, 121)
    loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


def _trainer(labels: list[str], idf: np.ndarray):
    """Fits on the rows of one task; their number is bounded by the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {name: k for k, name in enumerate(labels)}
        rows: list[tuple[np.ndarray, np.ndarray]] = []
        wanted: list[int] = []
        for batch in batches:
            names = batch.column(1).to_pylist()
            wanted.extend(at[name] for name in names)
            for piece in pieces(batch.column(0)):
                found = [np.zeros(0, np.int64)] * len(piece)
                per_order, _ = grams(piece)
                for k in range(len(piece)):
                    found[k] = np.concatenate([b[slice(*np.searchsorted(o, [k, k + 1]))] for o, b in per_order])
                for buckets in found:
                    held, counts = np.unique(buckets, return_counts=True)
                    rows.append((held, counts * idf[held] * (SCALE / max(1, len(buckets)))))
        y = np.array(wanted, np.int64)
        aside = np.arange(len(rows)) % 5 == 4
        weights = ftrl([r for r, a in zip(rows, aside) if not a], y[~aside], len(labels))
        kept = [r for r, a in zip(rows, aside) if a]
        logits = np.array([(weights[b] * v[:, None]).sum(axis=0) + weights[-1] for b, v in kept])
        temperature = fit_temperature(logits.reshape(-1, len(labels)), y[aside])
        where = np.append(np.flatnonzero(weights[:-1].any(axis=1)), BUCKETS)
        out = [*weights[where].tolist(), [temperature]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*where.tolist(), -1], pa.int64()), pa.array(out, pa.list_(pa.float64()))], names=["bucket", "w"]
        )

    return run


def drawn_below(sample: int, rows: int) -> int:
    """The draws, of ``DRAWS``, that take about ``sample`` of ``rows``; never none for a sample of any rows."""
    return min(DRAWS, DRAWS * sample // rows)


def train(known: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """A model from rows (id, text, lang) without NULLs."""
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; is this the right column?")
    labels = [r[0] for r in counts]
    if not labels:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    found = dict(document_frequencies(known.select("text")).collect())
    idf = np.log((1 + found.get(-1, 0)) / (1 + np.array([found.get(b, 0) for b in range(BUCKETS)]))) + 1
    share = F.create_map(*[F.lit(x) for name, n in counts for x in (name, drawn_below(sample, n))])
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col("id")), F.lit(DRAWS))
    rows = known.where(draw < share[F.col("lang")]).select("text", "lang", F.xxhash64("id", "text").alias("h"))
    one = rows.repartition(1).sortWithinPartitions("h", "lang").select("text", "lang")
    fitted = dict(one.mapInArrow(_trainer(labels, idf), "bucket bigint, w array<double>").collect())
    weights = np.zeros((BUCKETS, len(labels)))
    for bucket, w in fitted.items():
        if 0 <= bucket < BUCKETS:
            weights[bucket] = w
    return LanguageModel(
        labels, weights * idf[:, None] * SCALE, np.array(fitted[BUCKETS]), float(fitted[-1][0])
    )


PREDICTION = "struct<lang:string,score:double>"
_PREDICTION = pa.struct([("lang", pa.string()), ("score", pa.float64())])


class LanguageIdentifier:
    """A trained model as a column: ``predict(text)`` holds ``lang`` and ``score``.

    ``und`` with score 0 stands for NULL texts and texts without a letter.
    """

    def __init__(self, known: DataFrame, sample: int = SAMPLE):
        self.model = train(known, sample)
        self._shared = known.sparkSession.sparkContext.broadcast(self.model)

    def predict(self, text: Column) -> Column:
        shared = self._shared

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = shared.value
            for texts in batches:
                rows = [r for piece in pieces(texts) for r in model.predict(piece)]
                yield pa.StructArray.from_arrays(
                    [pa.array([r[k] for r in rows], t.type) for k, t in enumerate(_PREDICTION)],
                    fields=list(_PREDICTION),
                )

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, PREDICTION)(text.cast("string"))


def training_rows(docs: DataFrame, key: str, text: str, lang: str, folds: int, held_out: int) -> DataFrame:
    known = docs.where(
        F.col(text).isNotNull() & F.col(lang).isNotNull() & (id_crc(key, folds) != held_out)
    )
    return known.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))


def identify(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = 5,
    held_out: int = 0,
    sample: int = SAMPLE,
) -> DataFrame:
    """Per row: key, ``held_out``, ``lang_pred``, ``score`` between 0 and 1.

    Learns from rows with text, language and key whose crc32 of the key modulo
    ``folds`` is not ``held_out``. NULL keys are not held out and not learned
    from. ``und`` with score 0 stands for NULL texts, texts without a letter,
    and everything if there is nothing to learn from. Repeated rows are
    predicted one by one. Other columns are not read.
    """
    known = training_rows(docs, key, text, lang, folds, held_out)
    found = LanguageIdentifier(known, sample).predict(F.col(text))
    rows = docs.select(
        F.col(key),
        F.coalesce(id_crc(key, folds) == held_out, F.lit(False)).alias("held_out"),
        found.alias("found"),
    )
    return rows.select(key, "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
