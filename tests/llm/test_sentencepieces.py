from __future__ import annotations

import random

import pytest
import sentencepiece
from cases import ODD

from tidemark.llm.queries import PIECE_MODEL
from tidemark.llm.sentencepieces import PieceCodec, PieceModel, PrefixTable, encode_documents, merge


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


@pytest.fixture(scope="module")
def own():
    return PrefixTable(PieceModel.read(PIECE_MODEL))


def test_random_texts(own, library):
    rng = random.Random(2)
    alphabet = list("abc the in▁  \n\t<>/s0x41é🤖ß…ñ执벨 ")
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        ids = own.encode(text).tolist()
        assert ids == library.encode(text)
        assert own.decode(ids) == library.decode(ids)


def test_random_ids(own, library):
    rng = random.Random(3)
    for _ in range(2000):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(0, 31999)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids)


def test_pairs_are_compatible_as_plain_merges_say(own):
    rng = random.Random(4)
    pieces = [p for p in own.rank if len(p) < 8]
    for _ in range(3000):
        a, b = rng.choice(pieces), rng.choice(pieces)
        assert own.compatible(a, b) == (merge(a + b, own.rank) == [a, b])


def test_tables(own):
    for word in ("▁unbelievably", "▁▁▁▁▁x", "ation▁", "🤖a"):
        last = own.table(word)
        for end in range(1, len(word) + 1):
            piece = merge(word[:end], own.rank)[-1]
            assert last[end] == own.ids.get(piece, -1)


def test_odd_texts(frame, library):
    docs = frame(ODD).withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    got = sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in encode_documents(docs, PIECE_MODEL).collect()), key=repr)
    ids = [(k, library.encode(t or "")) for k, t in ODD]
    assert got == sorted([(k, i, library.decode(i)) for k, i in ids], key=repr)
    assert encode_documents(frame([]), PIECE_MODEL).collect() == []
    codec = PieceCodec(docs.sparkSession, PIECE_MODEL)
    apart = docs.select("doc_id", codec.encode(docs["text"]).alias("i"))
    apart = apart.select("doc_id", "i", codec.decode(apart["i"]).alias("d")).collect()
    assert sorted(map(tuple, apart), key=repr) == got


def test_models_that_need_more_are_refused():
    with pytest.raises(ValueError):
        PieceModel.parse(b"\x0a\x05\x0a\x03abc")
