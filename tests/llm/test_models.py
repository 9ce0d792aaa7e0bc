"""Toxicity and language, by accuracy on rows kept out."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from cases import ODD

from tidemark.llm import language, toxicity

MIDDLE = "/root/testdata/sf0.01"


def test_toxicity_on_rows_kept_out(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{n}.parquet") for n in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out").toPandas()
    assert all(zlib.crc32(str(k).encode()) % 4 == 2 for k in rows["doc_id"])
    score, label = rows["score"].to_numpy(), rows["toxic"].to_numpy()
    above = (score[label == 1][:, None] > score[label == 0][None, :]).mean()
    assert above > 0.85
    assert ((rows["score"] >= 0.3) == (rows["predicted"] == 1)).all() and rows["score"].between(0, 1).all()


def test_toxicity_of_odd_texts(spark, frame):
    rows = [(100 + k, "good day to you all " * 3 + ("you vile toad" if k % 3 == 0 else "")) for k in range(120)]
    docs = frame(ODD + rows).withColumnRenamed("lang", "toxic").withColumnRenamed("source", "score")
    known = [(k, None, int((k - 100) % 3 == 0)) for k, _ in rows] + [(None, 1, 1), (7, 1, None), (103, 1, 1)]
    labels = spark.createDataFrame(known, "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).toPandas()
    assert len(got) == len(ODD) + len(rows)
    own = got[got.doc_id >= 100]
    assert (own.predicted == ((own.doc_id - 100) % 3 == 0)).all()
    assert got[got.doc_id.isin([1, 2, 3])].score.nunique() == 1
    empty = toxicity.toxicity(frame([]), labels)
    assert empty.collect() == []
    blank = toxicity.toxicity(frame(ODD), labels.limit(0)).toPandas()
    assert (blank.score == 0.5).all()


def plain_ratios(texts):
    """Log ratio of every counted gram, letter by letter, from texts and labels."""
    order, counts = toxicity.ORDER, (Counter(), Counter())
    for text, label in texts:
        if words := (text or "").lower().split():
            line = " " * (order - 1) + " ".join(words) + " "
            counts[label].update(line[k - order + 1 : k + 1] for k in range(order - 1, len(line)))

    def model(held):
        cut = toxicity.cuts([sum(c == k for c in held.values()) for k in (1, 2, 3, 4)])
        total, kept = Counter(), Counter()
        for gram, c in held.items():
            total[gram[:-1]] += c
            kept[gram[:-1]] += cut[min(c, 3) - 1]

        def p(gram, below):
            if not total[gram[:-1]]:
                return below
            c = held[gram]
            own = c - cut[min(c, 3) - 1] if c else 0
            return (own + kept[gram[:-1]] * below) / total[gram[:-1]]

        return p

    grams = set(counts[0]) | set(counts[1])
    lower = [
        model(Counter(longer[1:] for longer in {g[-size - 1 :] for g in grams})) for size in range(1, order)
    ]
    toxic, ordinary = model(counts[1]), model(counts[0])
    alphabet, out = len({g[-1] for g in grams}) + 1, {}
    for gram in grams:
        shared = 1 / alphabet
        for size, p in enumerate(lower, 1):
            shared = p(gram[-size:], shared)
        out[gram] = math.log(toxic(gram, shared) / ordinary(gram, shared))
    return out


def test_toxicity_reads_runs_to_their_end(spark, frame):
    """Texts of one run each, unlike at the beginning, told apart only by what follows."""
    rng = np.random.default_rng(5)

    def glued(k):
        start = "".join(chr(0x4E00 + c) for c in rng.integers(0, 3000, 40))
        return start + ("你这个卑鄙的蛤蟆滚出去吧" if k % 3 == 0 else "今天花园里的天气非常好啊") + start[:20]

    rows = [(k, glued(k)) for k in range(240)]
    labels = spark.createDataFrame([(k, None, int(k % 3 == 0)) for k, _ in rows], "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(frame(rows), labels).toPandas()
    held = got[got.held_out]
    assert len(held) > 20 and (held.predicted == (held.doc_id % 3 == 0)).all()


def test_toxicity_with_more_counts_than_are_broadcast(spark, frame):
    """The scores are those of all counts: rare words, long runs, repeated rows and NULL keys."""
    rng = np.random.default_rng(6)
    said = ["".join(chr(97 + c) for c in rng.integers(0, 6, rng.integers(2, 7))) for _ in range(400)]

    def text(k):
        words = [said[i] for i in rng.integers(0, 400, 20)] + (["vile" + said[k]] if k % 3 == 0 else [])
        return (" " if k % 5 else "-").join(words)

    rows = [(100 + k, text(k)) for k in range(150)]
    docs = frame(ODD + rows + rows[:3])
    labels = spark.createDataFrame([(k, None, int((k - 100) % 3 == 0)) for k, _ in rows], "doc_id bigint, quality int, toxic int")
    whole = toxicity.toxicity(docs, labels).toPandas().sort_values(["doc_id", "score"])
    for limit in (40, 0):
        got = toxicity.toxicity(docs, labels, max_grams=limit).toPandas().sort_values(["doc_id", "score"])
        assert np.allclose(got.score, whole.score, rtol=0, atol=1e-9) and len(got) == len(whole) == len(ODD) + 153


def test_toxicity_measures_against_plain_kneser_ney(spark, frame):
    """Counts, ratios and measures of whole texts, again with plain loops."""
    rng = np.random.default_rng(8)
    said = ["".join(chr(97 + c) for c in rng.integers(0, 5, rng.integers(1, 6))) for _ in range(60)]
    texts = [(" ".join(said[i] for i in rng.integers(0, 60, 15)), k % 2) for k in range(40)]
    texts += [("-".join(said[:20]), 1), ("", 0), (None, 1), ("\u00df\U0001f600 Ab\tc", 0)]
    counts = toxicity.gram_counts(spark.createDataFrame(texts, "text string, toxic int"))
    found = toxicity.ratios(counts)
    want = plain_ratios(texts)
    got = {r["gram"]: r["ratio"] for r in found.collect()}
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-9 for g in want)
    own = toxicity.ToxicModel.of(found).measures([t for t, _ in texts] + ["zzzz zz"])
    for k, text in enumerate([t for t, _ in texts] + ["zzzz zz"]):
        line = " " * (toxicity.ORDER - 1) + " ".join((text or "").lower().split()) + " "
        told = [want.get(line[i - toxicity.ORDER + 1 : i + 1], 0.0) for i in range(toxicity.ORDER - 1, len(line))]
        parts, at = [], 0
        for word in (text or "").lower().split():
            for begin in range(0, len(word) + 1, toxicity.LETTERS):
                parts.append(sum(told[at + begin : at + min(begin + toxicity.LETTERS, len(word) + 1)]))
            at += len(word) + 1
        best = sorted((max(p, 0.0) for p in parts), reverse=True) + [0.0] * 5
        plain = [sum(told) / len(told) if parts else 0.0, *best[:3], best[4], math.log1p(len(parts))]
        assert np.allclose([m[k] for m in own], plain, rtol=0, atol=1e-9)


def test_language_on_rows_kept_out(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert all(zlib.crc32(str(k).encode()) % 5 == 0 for k in held["doc_id"])
    assert (held.lang == held.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()


def test_language_of_odd_texts(frame, spark):
    rows = [(100 + k, ("the house and the garden " if k % 2 else "das haus und der garten ") * 4) for k in range(60)]
    docs = frame(ODD, None).unionByName(
        spark.createDataFrame([(k, t, "en" if k % 2 else "de", "s", 1) for k, t in rows], frame([]).schema)
    )
    got = language.identify(docs.withColumnRenamed("source", "score")).toPandas()
    assert len(got) == len(ODD) + 60
    assert (got[got.doc_id.isin([1, 2, 3])].lang_pred == "und").all()
    assert (got[got.doc_id.isin([1, 2, 3])].score == 0).all()
    own = got[got.doc_id >= 100]
    assert (own.lang_pred == ["en" if k % 2 else "de" for k in own.doc_id]).all()
    nothing = language.identify(frame(ODD)).toPandas()
    assert (nothing.lang_pred == "und").all()
    assert language.identify(frame([])).collect() == []


def test_language_sample_of_a_hot_language(spark):
    """However many rows a language has, the share does not round to nothing."""
    for rows in (10, 5_000, 10**9 + 1, 10**12):
        below = language.drawn_below(1000, rows)
        assert math.isclose(below / language.DRAWS, min(1.0, 1000 / rows), rel_tol=1e-6)
    known = spark.range(40_000).selectExpr("id", "'a b' text", "if(id < 39000, 'x', 'y') lang")
    model = language.train(known, sample=200)
    assert model.labels == ["x", "y"]


def test_ftrl_is_sparse_and_calibrated():
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(400):
        label = int(rng.integers(2))
        held = np.unique(np.append(rng.integers(10, 2000, 20), label))
        rows.append((held, np.ones(len(held))))
        labels.append(label)
    weights = language.ftrl(rows, np.array(labels), 2, l1=1.0)
    assert (weights[:2] != 0).all() and (weights[10:2000] != 0).mean() < 0.5
    logits = np.array([[4.0, 0.0]] * 100)
    truth = np.array([0] * 75 + [1] * 25)
    assert abs(language.softmax(logits[0] / language.fit_temperature(logits, truth))[0] - 0.75) < 0.02


def test_document_frequencies_count_each_text_once(spark):
    texts = [f"ab{'c' * (k % 3)} x{k % 7}y" for k in range(3 * language.TEXTS_AT_ONCE + 5)] + ["", None, "1 2"]
    wanted = Counter()
    for text in texts:
        wanted.update({int(b) for _, buckets in language.grams([text])[0] for b in buckets})
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    found = dict(language.document_frequencies(frame).collect())
    assert found.pop(-1) == len(texts) and found == dict(wanted)
