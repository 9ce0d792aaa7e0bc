from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import ODD
from helpers import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.packing import END_ID, Example, Packer, WordIds, pack_documents, pack_examples, sequences
from tidemark.llm.queries import WORD_MODEL, op13_packing

LIBRARY = Tokenizer.from_file(WORD_MODEL)
EXAMPLES = "example_id bigint, ids array<int>, first bigint"


def library_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, END_ID]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def check(rows, ids_of, sequence=4096, segments=64, loss=None, padded=False):
    """Every id of every row lies in one piece; sequences keep all limits and have no gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r[0]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids_of)
    for key, parts in by_doc.items():
        left = list(ids_of[key])  # one list of ids for each row with this key
        for start in sorted((p for p in parts if p["start"] == 0), key=lambda p: p["doc_tokens"]):
            assert start["doc_tokens"] in [len(x) for x in left]
        assert sum(p["length"] for p in parts) == sum(map(len, left))
        if len(left) == 1:
            at = 0
            for p in sorted(parts, key=lambda p: p["start"]):
                assert (p["start"], p["doc_tokens"], p["length"] > 0) == (at, len(left[0]), True)
                at += p["length"]
                assert p["ids_crc32"] == crc(left[0][p["start"] : at])
                if "ids" in p:
                    assert p["ids"] == left[0][p["start"] : at]
            assert at == len(left[0])
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= sequence and len(parts) <= segments
        assert loss is None or sum(p["loss_tokens"] for p in parts) <= loss
        assert padded or at == sequence or at & (at - 1) == 0


def by_key(rows):
    out = defaultdict(list)
    for key, text in rows:
        out[key].append(library_ids(text))
    return out


def test_words_equal_the_library():
    letters = list("aAbBcZ'sst .,!?09éÉßİıſΣσς\x0b\x0c\x1c\x85\r\n\t漢字한글가<|>ǅﬁ\x00")
    letters += ["́", "̈", "​", " ", "\U0001f916", "<|endoftext|>", "<|startoftext|>", "'ll", "don't", "क़", "ǰ", "ŉ", "ÿ."]
    random.seed(1)
    texts = ["".join(random.choices(letters, k=random.randint(0, 30))) for _ in range(5000)] + ["", None, "   "]
    coder = WordIds(WORD_MODEL)
    for first in range(0, len(texts), 100):
        part = texts[first : first + 100]
        assert [x.tolist() for x in coder.encode(part, END_ID)] == [library_ids(t) for t in part]
    assert coder.encode([], END_ID) == []


@pytest.mark.parametrize("with_ids", [True, False])
def test_odd_texts(frame, with_ids):
    docs = frame(ODD).withColumnRenamed("source", "start").withColumnRenamed("lang", "ids")
    rows = pack_documents(docs, WORD_MODEL, with_ids=with_ids).collect()
    check(rows, by_key(ODD))
    assert {r["doc_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}


def test_empty(spark, frame):
    assert pack_documents(frame([]), WORD_MODEL).collect() == []
    assert pack_examples(spark.createDataFrame([(1, [], None), (2, None, 3)], EXAMPLES)).collect() == []


def test_many_short_texts_need_no_padding(frame):
    """The limit on segments ends sequences early; they end at a power of two."""
    rows = [(i, "a b c" if i % 3 else "") for i in range(3000)]
    check(pack_documents(frame(rows).coalesce(1), WORD_MODEL, window=100).collect(), by_key(rows))


def random_examples(seed, n, longest):
    random.seed(seed)
    out = []
    for i in range(n):
        size = random.randint(1, longest)
        out.append((i, [random.randint(0, 60_000) for _ in range(size)], random.choice([None, 0, size // 2, size])))
    return out


@pytest.mark.parametrize("cut", [True, False])
def test_three_limits_hold(spark, cut):
    examples = random_examples(2, 400, 300)
    df = spark.createDataFrame(examples, EXAMPLES).coalesce(2)
    rows = pack_examples(df, loss_from="first", sequence=256, segments=5, loss=100, cut=cut, window=50).collect()
    check(rows, {k: [ids] for k, ids, _ in examples}, 256, 5, 100, padded=True)
    for r in rows:
        first = next(f for k, _, f in examples if k == r["example_id"]) or 0
        assert r["loss_tokens"] == max(0, r["start"] + r["length"] - max(r["start"], first))
    if not cut:  # what fits a sequence is whole
        small = {k for k, ids, f in examples if len(ids) <= 256 and len(ids) - (f or 0) <= 100}
        assert len([r for r in rows if r["example_id"] in small]) == len(small)


def test_largest_dot_product_is_placed_next():
    packer = Packer((100, 4, 40), cut=False, window=8)
    for key, (size, free) in enumerate([(30, 0), (60, 50), (10, 0), (40, 40), (35, 30)]):
        assert list(packer.add(Example([key], np.arange(size, dtype=np.uint32), 0, size, free))) == []
    left, waiting, order = [100, 4, 40], dict(enumerate([(30, 30), (60, 10), (10, 10), (40, 0), (35, 5)])), []
    mean = [sum(v[d] for v in waiting.values()) / 5 for d in (0, 1)]
    while True:
        fits = {k: v for k, v in waiting.items() if v[0] <= left[0] and v[1] <= left[2] and left[1]}
        if not fits:
            break
        best = max(fits, key=lambda k: fits[k][0] * left[0] * mean[0] / 100**2 + fits[k][1] * left[2] * mean[1] / 40**2)
        order.append(best)
        size, loss = waiting.pop(best)
        left = [left[0] - size, left[1] - 1, left[2] - loss]
    assert [p.key[0] for p in next(packer.finish())] == order


def test_sequences_are_laid_out(spark):
    examples = [(1, [5, 6, 7], 1), (2, [8, 9], None), (3, list(range(20)), 20)]
    packed = pack_examples(spark.createDataFrame(examples, EXAMPLES).coalesce(1), loss_from="first", sequence=10)
    rows = sequences(packed, "example_id", sequence=10, pad=99).collect()
    for r in rows:
        size = 10 if r["n_tokens"] & (r["n_tokens"] - 1) else r["n_tokens"]
        assert [len(r[n]) for n in ("input_ids", "segment_ids", "position_ids", "loss_mask")] == [size] * 4
    assert sum(m for r in rows for m in r["loss_mask"]) == 4


def test_table(spark):
    docs = {r["doc_id"]: [library_ids(r["text"])] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op13_packing(spark, SMALL).withColumn("loss_tokens", F.lit(0)).collect()
    check(rows, docs)
    full = [r["sequence_id"] for r in rows]
    assert sum(map(len, (x for xs in docs.values() for x in xs))) <= 4096 * len(set(full))
