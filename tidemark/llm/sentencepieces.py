"""Byte-pair encoding with a SentencePiece model by a table of prefixes.

The encoding of every prefix of a text ends in exactly one token. If that
token is known for all shorter prefixes, it is found for the next one among
the vocabulary entries that end there (an Aho-Corasick automaton lists them):
it is the one that is *compatible* with the last token of the prefix before
it, which means that merging the two strings alone yields these two tokens.
The table costs one pass; the ids are then read off from its end backwards.

Compatibility is a question about two tokens only, so its answers are kept.
A merge never crosses a place where no vocabulary entry can lie, here a space
after another character and the characters that stand in no longer entry, so
texts are cut there and the tables of frequent words are kept as well.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
KEPT_WORDS = 120_000
KEPT_PAIRS = 400_000
NONE = float("-inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and raw value of each protobuf field."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class PieceModel:
    """Vocabulary of a SentencePiece BPE model; its size is fixed by the model file."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool = True
    _whole: list[str] | None = field(default=None, repr=False)
    _encoder: PrefixTable | None = field(default=None, repr=False)

    @classmethod
    def read(cls, path: str) -> PieceModel:
        with open(path, "rb") as file:
            return cls.parse(file.read())

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        pieces, scores, kinds = [], [], []
        trainer, normalizer = {3: 1}, {3: 1, 4: 1, 5: 1}
        for number, value in _fields(data):
            if number == 1:
                entry = {2: struct.pack("<f", 0), 3: NORMAL} | dict(_fields(value))
                pieces.append(entry[1].decode())
                scores.append(struct.unpack("<f", entry[2])[0])
                kinds.append(entry[3])
            elif number == 2:
                trainer |= dict(_fields(value))
            elif number == 3:
                normalizer |= dict(_fields(value))
        if trainer[3] != 2 or USER in kinds or UNUSED in kinds or BYTE not in kinds:
            raise ValueError("needs a BPE model with byte fallback and without user-defined pieces")
        if normalizer.get(2) or normalizer[4] or not normalizer[5] or trainer.get(24):
            raise ValueError("needs a model that leaves texts as they are but for escaped spaces")
        return cls(pieces, scores, kinds, bool(normalizer[3]))

    def encoder(self) -> PrefixTable:
        """One encoder for a worker, with its caches, as long as it holds the model."""
        if self._encoder is None:
            self._encoder = PrefixTable(self)
        return self._encoder

    def rank(self) -> dict[str, float]:
        return {p: s for p, s, k in zip(self.pieces, self.scores, self.kinds) if k == NORMAL}

    def whole(self) -> list[str]:
        """Entries that are their own encoding; the others can never be a token."""
        if self._whole is None:
            rank = self.rank()
            self._whole = [p for p in rank if len(p) == 1 or len(merge(p, rank)) == 1]
        return self._whole


def merge(text: str, rank: dict[str, float]) -> list[str]:
    """Plain BPE of a short string: join the best-scored neighbours, leftmost first, until none is left."""
    parts = list(text)
    while len(parts) > 1:
        best, where = None, -1
        for i in range(len(parts) - 1):
            score = rank.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, where = score, i
        if best is None:
            break
        parts[where : where + 2] = [parts[where] + parts[where + 1]]
    return parts


class PrefixTable:
    """Encoder and decoder for one model, with its caches; one lives in each worker."""

    def __init__(self, model: PieceModel):
        self.rank = model.rank()
        self.dummy_prefix = model.dummy_prefix
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == NORMAL}
        self.pieces = model.pieces
        self.sizes = [len(p) for p in model.pieces]
        self.automaton = ahocorasick.Automaton()
        for piece in model.whole():
            self.automaton.add_word(piece, self.ids[piece])
        self.automaton.make_automaton()
        bytes_ = [0] * 256
        self.text_of: list[bytes] = []
        for i, (piece, kind) in enumerate(zip(model.pieces, model.kinds)):
            if kind == BYTE:
                bytes_[int(piece[1:-1], 16)] = i
                self.text_of.append(bytes([int(piece[1:-1], 16)]))
            else:
                unseen = b" \xe2\x81\x87 " if kind == UNKNOWN else b""
                self.text_of.append(piece.replace(SPACE, " ").encode() if kind == NORMAL else unseen)
        self.byte_ids = bytes_
        self.is_byte = [k == BYTE for k in model.kinds]
        self.words: dict[str, array] = {}
        self.older: dict[str, array] = {}
        self.pairs: dict[int, bool] = {}
        self.steps: dict[str, tuple[list[float], list[str], list[str]]] = {}
        self.cut = self._cutter()

    def _cutter(self) -> re.Pattern:
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            return re.compile("(?s).+")
        alone = "" if any("\n" in p for p in self.rank) else "\n"
        return re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + ("|\n" if alone else ""))

    def history(self, token: str) -> tuple[list[float], list[str], list[str]]:
        """Scores of the merges that make up a token, in order, and its first and last part before each."""
        found = self.steps.get(token)
        if found is None:
            parts, scores, first, last = list(token), [], [token[0]], [token[-1]]
            while len(parts) > 1:
                options = [self.rank.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
                score = max(options)
                where = options.index(score)
                parts[where : where + 2] = [parts[where] + parts[where + 1]]
                scores.append(score)
                first.append(parts[0])
                last.append(parts[-1])
            found = self.steps[token] = (scores + [NONE], first, last)
        return found

    def compatible(self, left: str, right: str) -> bool:
        """Whether ``left + right`` alone is encoded as these two tokens.

        Replays the merges inside both, best score first; they are
        incompatible if a merge across their border comes first at any time.
        On equal scores the leftmost merge is first.
        """
        scores_a, _, last = self.history(left)
        scores_b, first, _ = self.history(right)
        i = j = 0
        while True:
            across, a, b = self.rank.get(last[i] + first[j], NONE), scores_a[i], scores_b[j]
            if across > a and across >= b:
                return False
            if a < b:
                j += 1
            elif a == NONE:
                return True
            else:
                i += 1

    def table(self, text: str) -> list[int]:
        """For every prefix of ``text`` the last token of its encoding; -1 for a character without an entry.

        Position 0 stands for the empty prefix.
        """
        last = [-1] * (len(text) + 1)
        pairs, sizes = self.pairs, self.sizes
        for end, token in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            start = end - sizes[token]
            if start == 0:
                last[end] = token
                continue
            before = last[start]
            key = before << 32 | token
            fits = pairs.get(key)
            if fits is None:
                left = self.pieces[before] if before >= 0 else text[start - 1]
                fits = self.compatible(left, self.pieces[token])
                if before >= 0:
                    if len(pairs) >= KEPT_PAIRS:
                        pairs.clear()
                    pairs[key] = fits
            if fits:
                last[end] = token
        return last

    def encode_word(self, text: str) -> array:
        last = self.table(text)
        sizes, back, end = self.sizes, [], len(text)
        while end:
            token = last[end]
            if token >= 0:
                back.append(token)
                end -= sizes[token]
            else:
                end -= 1
                back.extend([self.byte_ids[b] for b in reversed(text[end].encode())])
        back.reverse()
        return array("i", back)

    def encode(self, text: str) -> array:
        out = array("i")
        if not text:
            return out
        words, older = self.words, self.older
        for word in self.cut.findall((SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)):
            ids = words.get(word)
            if ids is None:
                ids = older.get(word)
                if ids is None:
                    ids = self.encode_word(word)
                if len(word) <= 64:
                    if len(words) >= KEPT_WORDS:  # what was not met since the last time goes
                        older = self.older = words
                        words = self.words = {}
                    words[word] = ids
            out.extend(ids)
        return out

    def decode(self, ids) -> str:
        """Text of ids: spaces restored, the added one removed, broken byte sequences replaced byte by byte."""
        of = self.text_of
        raw = b"".join([of[i] for i in ids])
        if self.dummy_prefix and len(ids) and not self.is_byte[ids[0]] and raw[:1] == b" " and ids[0] != 0:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _replace_each(raw)


def _replace_each(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(raw[at : at + error.start].decode())
            out.append("�")
            at += error.start + 1
    return "".join(out)


class PieceCodec:
    """``encode(text)`` and ``decode(ids)`` as columns.

    A NULL text is encoded as an empty one, to no ids; NULL ids decode to an
    empty text. The broadcast holds the vocabulary only.
    """

    def __init__(self, spark: SparkSession, path: str):
        model = PieceModel.read(path)
        model.whole()
        self._shared = spark.sparkContext.broadcast(model)

    def encode(self, text: Column) -> Column:
        shared = self._shared

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            table = shared.value.encoder()
            for texts in batches:
                offsets, flat = np.zeros(len(texts) + 1, np.int32), array("i")
                for k, value in enumerate(texts, 1):
                    flat.extend(table.encode(value.as_py() or ""))
                    offsets[k] = len(flat)
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(flat, np.int32)))

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, "array<int>")(text.cast("string"))

    def round_trip(self, text: Column) -> Column:
        """Struct of ``ids`` and the text ``decoded`` from them, in one worker instead of one for each."""
        shared = self._shared

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            table = shared.value.encoder()
            for texts in batches:
                offsets, flat, decoded = np.zeros(len(texts) + 1, np.int32), array("i"), []
                for k, value in enumerate(texts, 1):
                    ids = table.encode(value.as_py() or "")
                    flat.extend(ids)
                    offsets[k] = len(flat)
                    decoded.append(table.decode(ids))
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(flat, np.int32)))
                yield pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], names=["ids", "decoded"])
                del texts, lists, decoded, flat
                pa.default_memory_pool().release_unused()

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, "struct<ids:array<int>,decoded:string>")(text.cast("string"))

    def decode(self, ids: Column) -> Column:
        shared = self._shared

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            table = shared.value.encoder()
            for lists in batches:
                flat, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
                yield pa.array(
                    [table.decode(flat[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])], pa.string()
                )

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, "string")(F.coalesce(ids, F.array().cast("array<int>")))


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ids and decoded text of every row; other columns are not read.

    NULL and empty texts give no ids and an empty decoded text; a repeated
    row is repeated in the result; an empty table gives an empty result.
    """
    codec = PieceCodec(docs.sparkSession, path)
    rows = docs.select(F.col(key), codec.round_trip(F.col(text)).alias("coded"))
    return rows.select(key, "coded.ids", "coded.decoded")
