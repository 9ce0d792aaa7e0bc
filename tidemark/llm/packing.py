"""Packing of examples into training sequences by vector bin packing.

An example asks for three things at once: tokens, one segment, and tokens that
bear loss. A sequence has a limit on each. Sequences are filled one after the
other: of the waiting examples that fit, the one whose demand has the largest
dot product with what is left of the limits is placed next, every dimension
weighted by the mean demand for it. What no whole example fills is filled by
cutting one, and a sequence that ends early (too many segments, too much loss,
or the last of a task) gives back its end down to a power of two, which needs
no padding.

Every task packs the rows of its own partition as they stream by, so nothing
is shuffled and a task holds at most ``WINDOW`` waiting rests of at most one
sequence each. Sequence numbers carry the partition number in their upper
bits. A task that is run again reads the same file split in the same order and
gives the same sequences; give rows that come from a shuffle in a written table.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import pieces

SEQUENCE = 4096
SEGMENTS = 64
WINDOW = 1024
END_ID = 2
#: Words whose ids a worker remembers; then it starts anew.
REMEMBERED = 600_000
#: Characters that are encoded together; common words are looked up once for each piece.
PIECE = 4 << 20
_MARKS = frozenset(".,;:!?")
_SHIFT = 33


def _byte_letters() -> dict[int, int]:
    """Byte-level models write a byte that is not visible as the next letter from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: 0x100 + n for n, b in enumerate(b for b in range(0x100) if b not in shown)}


_BYTE_LETTERS = _byte_letters()


class WordIds:
    """Ids of texts by a tokenizer that reads white-space separated words independently.

    Equal to ``encode(text, add_special_tokens=False).ids`` of the whole text,
    as its normaliser and its splitting never join across ASCII white space.
    Every distinct word is encoded once. A plain word, letters below U+0250
    with one mark after it at most, is a fixed point of its normaliser once it
    is lower-cased and one or two units of its splitting, so its parts go
    straight to the tokenizer's model; every other word takes all steps.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.units: dict[str, list[int]] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(0, dtype=np.int64)

    def _unit(self, unit: str) -> list[int]:
        found = self.units.get(unit)
        if found is None:
            shown = unit if unit.isascii() else unit.encode().decode("latin-1").translate(_BYTE_LETTERS)
            found = self.units[unit] = [token.id for token in self.tokenizer.model.tokenize(shown)]
        return found

    def _learn(self, words: list[str]) -> None:
        ids: list[list[int] | None] = []
        other = []
        for word in words:
            stem, mark = (word[:-1], word[-1]) if word[-1:] in _MARKS else (word, "")
            if stem.isalpha() and (stem.isascii() or (max(stem) < "\u0250" and "\u0130" not in stem)):
                stem = self._unit(stem.lower())
                ids.append(stem + self._unit(mark) if mark else stem)
            else:
                other.append(word)
                ids.append(None)
        if other:
            coded = iter(self.tokenizer.encode_batch_fast(other, add_special_tokens=False))
            ids = [next(coded).ids if found is None else found for found in ids]
        first, known = len(self.place), len(self.ids)
        self.place.update(zip(words, range(first, first + len(words))))
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        fresh = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(sizes.sum()))
        self.ids = np.concatenate([self.ids, fresh])
        self.starts = np.concatenate([self.starts, known + np.cumsum(sizes) - sizes])

    def encode(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        """Ids of each text (NULL: empty), followed by ``end``."""
        if not texts:
            return []
        if len(self.place) > REMEMBERED:
            self.forget()
        split = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
        bounds = np.asarray(split.offsets, dtype=np.int64)
        coded = pc.dictionary_encode(split.values[bounds[0] : bounds[-1]])
        words = coded.dictionary.to_pylist()
        fresh = [w for w in words if w not in self.place]
        if fresh:
            self._learn(fresh)
        at = np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))
        starts = np.append(self.starts, len(self.ids))
        ids = np.append(self.ids, np.uint32(end))
        sizes = np.append(np.diff(starts), 1)
        bounds = bounds - bounds[0]
        order = at[np.asarray(coded.indices)] if len(words) else np.zeros(0, dtype=np.int64)
        order = np.insert(order, bounds[1:], len(self.starts))  # the end id, after each text
        lengths = sizes[order]
        ends = np.cumsum(lengths)
        small = np.int32 if max(ends[-1], len(ids)) < 1 << 31 else np.int64
        flat = ids[np.arange(ends[-1], dtype=small) + np.repeat((starts[order] - ends + lengths).astype(small), lengths)]
        return np.split(flat, ends[bounds[1:] + np.arange(len(texts))][:-1])


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


class Example:
    """What is not placed yet of an example: its ids from ``start`` on."""

    __slots__ = ("key", "ids", "start", "total", "loss_from")

    def __init__(self, key, ids: np.ndarray, start: int, total: int, loss_from: int):
        self.key, self.ids, self.start, self.total, self.loss_from = key, ids, start, total, loss_from

    def head(self, tokens: int, loss: int) -> int:
        """Length of the longest beginning within both limits."""
        return min(len(self.ids), tokens, max(0, self.loss_from - self.start) + loss)

    def loss(self, length: int | None = None) -> int:
        end = self.start + (len(self.ids) if length is None else length)
        return max(0, end - max(self.start, self.loss_from))

    def take(self, length: int) -> tuple[Example, Example | None]:
        rest = None
        if length < len(self.ids):
            rest = Example(self.key, self.ids[length:], self.start + length, self.total, self.loss_from)
        return Example(self.key, self.ids[:length], self.start, self.total, self.loss_from), rest


class Packer:
    """Fills sequences from a bounded pool of waiting examples."""

    def __init__(self, limits: tuple[int, int, int], cut: bool = True, window: int = WINDOW):
        self.limits, self.cut, self.window = limits, cut, window
        self.waiting: list[Example | None] = [None] * window
        self.tokens = np.zeros(window, dtype=np.int64)
        self.losses = np.zeros(window, dtype=np.int64)
        self.free = list(range(window))

    def _wait(self, example: Example) -> None:
        at = self.free.pop()
        self.waiting[at] = example
        self.tokens[at], self.losses[at] = len(example.ids), example.loss()

    def _leave(self, at: int) -> Example:
        example = self.waiting[at]
        self.waiting[at] = None
        self.tokens[at] = self.losses[at] = 0
        self.free.append(at)
        return example

    def add(self, example: Example) -> Iterator[list[Example]]:
        """Sequences that are full after this example has come."""
        size, _, most_loss = self.limits
        while example is not None:
            head = example.head(size, most_loss)
            if head == size:
                whole, example = example.take(head)
                yield [whole]
            elif head == len(example.ids) or self.cut:
                break
            else:  # examples stay whole, but this one is more than a sequence holds
                part, example = example.take(head)
                self._wait(Example(part.key, part.ids.copy(), part.start, part.total, part.loss_from))
                if len(self.free) < 2:
                    yield self._fill()
        if example is not None:
            # a copy, so that the rest does not keep the ids of its whole batch
            self._wait(Example(example.key, example.ids.copy(), example.start, example.total, example.loss_from))
        while len(self.free) < 2:
            yield self._fill()

    def finish(self) -> Iterator[list[Example]]:
        while len(self.free) < self.window:
            yield self._fill()

    def _fill(self) -> list[Example]:
        size, segments, most_loss = self.limits
        held = self.window - len(self.free)
        weight_tokens = self.tokens.sum() / held / size**2
        weight_loss = self.losses.sum() / held / most_loss**2
        left = [size, segments, most_loss]
        placed: list[Example] = []
        while left[0] and left[1]:
            at = length = 0
            if left[1] > 1 or not self.cut:
                # every example asks for one segment, so that dimension adds the same to all
                product = self.tokens * (weight_tokens * left[0]) + self.losses * (weight_loss * left[2])
                product[(self.tokens > left[0]) | (self.losses > left[2])] = 0.0
                at = int(np.argmax(product))
                length = int(self.tokens[at]) if product[at] > 0 else 0
            if not length and self.cut:
                at, length = self._longest_head(left)
            if not length:
                break
            part, rest = self._leave(at).take(length)
            if rest is not None:
                self._wait(rest)
            placed.append(part)
            left = [left[0] - length, left[1] - 1, left[2] - part.loss()]
        if left[0] and self.cut:
            self._give_back(placed, size - left[0])
        return placed

    def _longest_head(self, left: list[int]) -> tuple[int, int]:
        """The waiting example with the longest beginning that fits, whole ones first."""
        before_loss = self.tokens - self.losses
        heads = np.minimum(np.minimum(self.tokens, left[0]), before_loss + left[2])
        at = int(np.argmax(2 * heads + (heads == self.tokens)))
        return at, int(heads[at])

    def _give_back(self, placed: list[Example], total: int) -> None:
        """Shorten a sequence that is not full to a power of two."""
        excess = total - (1 << (total.bit_length() - 1))
        while excess:
            part = placed.pop()
            kept = max(0, len(part.ids) - excess)
            excess -= len(part.ids) - kept
            if kept:
                part, rest = part.take(kept)
                placed.append(part)
                self._return(rest)
            else:
                self._return(part)

    def _return(self, part: Example) -> None:
        """Waits again, joined to its own rest if that waits too."""
        follows = part.start + len(part.ids)
        for at, other in enumerate(self.waiting):
            if other is not None and other.start == follows and other.total == part.total and other.key is part.key:
                self._leave(at)
                part = Example(part.key, np.concatenate([part.ids, other.ids]), part.start, part.total, part.loss_from)
                break
        self._wait(part)


def _records(sequences: Iterator[list[Example]], schema: pa.Schema, number: Iterator[int]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    for placed in sequences:
        sequence, offset = next(number), 0
        for part in placed:
            ids = np.ascontiguousarray(part.ids, dtype="<u4")
            row = [part.key[0], part.start, len(ids), zlib.crc32(ids.tobytes()), part.total, sequence, offset, part.loss()]
            rows.append((*row, ids.astype(np.int32)) if "ids" in schema.names else tuple(row))
            offset += len(ids)
        size += offset
        if size > 1 << 20 or len(rows) > 20_000:
            yield _batch(rows, schema)
            rows, size = [], 0
    if rows:
        yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _schema(df: DataFrame, key: str, with_ids: bool) -> T.StructType:
    out = T.StructType([T.StructField(key, df.schema[key].dataType)])
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"):
        out = out.add(name, "long")
    return out.add("ids", T.ArrayType(T.IntegerType())) if with_ids else out


def _pack(rows: DataFrame, key: str, examples, limits, cut: bool, with_ids: bool, window: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _schema(rows, key, with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, cut, window)
        first = TaskContext.get().partitionId() << _SHIFT

        def sequences() -> Iterator[list[Example]]:
            for example in examples(batches):
                yield from packer.add(example)
            yield from packer.finish()

        yield from _records(sequences(), to_arrow_schema(schema), iter(range(first, first + (1 << _SHIFT))))

    return rows.mapInArrow(run, schema)


def _limits(sequence: int, segments: int, loss: int | None) -> tuple[int, int, int]:
    if min(sequence, segments) < 1 or (loss is not None and loss < 1):
        raise ValueError("limits must be at least 1")
    return sequence, segments, sequence if loss is None else loss


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = END_ID,
    sequence: int = SEQUENCE,
    segments: int = SEGMENTS,
    loss: int | None = None,
    with_ids: bool = True,
    window: int = WINDOW,
) -> DataFrame:
    """Whole texts as ids of a ``tokenizers`` file, cut freely and packed.

    One row per piece: ``key``, ``start`` (ids of its text before it),
    ``length``, ``ids_crc32`` (of little-endian unsigned 32-bit ids),
    ``doc_tokens``, ``sequence_id``, ``offset`` (in the sequence, without gaps),
    ``loss_tokens`` (all of them here) and ``ids``. Every sequence has
    ``sequence`` ids or a power of two, so none needs padding.

    A NULL or empty text has the ``end`` id alone. Rows are packed one by one,
    NULL and repeated keys too; other columns are not read; an empty table
    gives no rows. A very long text is cut into whole sequences as it comes.
    """
    limits = _limits(sequence, segments, loss)

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[Example]:
        coder = _word_ids(tokenizer)
        for batch in batches:
            keys = iter(batch.column(0).to_pylist())
            for texts in pieces(batch.column(1), PIECE):
                for ids in coder.encode(texts, end):
                    yield Example([next(keys)], ids, 0, len(ids), 0)

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("__text"))
    return _pack(rows, key, examples, limits, True, with_ids, window)


def pack_examples(
    examples: DataFrame,
    key: str = "example_id",
    ids: str = "ids",
    loss_from: str | None = None,
    sequence: int = SEQUENCE,
    segments: int = SEGMENTS,
    loss: int | None = None,
    cut: bool = False,
    with_ids: bool = True,
    window: int = WINDOW,
) -> DataFrame:
    """Examples that are ids already, such as chat examples whose last reply alone is trained.

    ``loss_from`` names the column with the number of leading ids that bear no
    loss (NULL, or no column: all ids bear loss). Without ``cut`` an example
    stays whole unless a sequence cannot hold it, and sequences may need
    padding. Rows as from ``pack_documents``; examples without ids give none.
    """
    limits = _limits(sequence, segments, loss)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Example]:
        for batch in batches:
            for name, values, first in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                found = values.values
                if found is not None and len(found):
                    array = np.asarray(found).astype(np.uint32)
                    yield Example([name], array, 0, len(array), first or 0)

    first = F.lit(0) if loss_from is None else F.col(loss_from)
    rows = examples.select(F.col(key), F.col(ids).cast("array<int>").alias("__ids"), first.cast("long").alias("__loss"))
    return _pack(rows, key, read, limits, cut, with_ids, window)


def sequences(packed: DataFrame, key: str = "doc_id", sequence: int = SEQUENCE, pad: int = 0) -> DataFrame:
    """One row per sequence: ``input_ids`` padded to its length, ``segment_ids`` and ``position_ids``.

    Segments count from 1, padding has segment 0; ``loss_mask`` is 1 where loss
    is taken (the last ``loss_tokens`` ids of each piece). ``packed`` has ``ids``.
    A group holds one sequence, so at most ``sequence`` ids.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "start", "loss_tokens", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("n_tokens"))
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    padding = F.when(power, 0).otherwise(sequence - F.col("n_tokens")).cast("int")

    def laid(each, filler):
        return F.concat(F.flatten(F.transform("p", each)), F.array_repeat(F.lit(filler), padding))

    def repeated(value, x):
        return F.array_repeat(value.cast("int"), x["length"].cast("int"))

    return rows.select(
        "sequence_id",
        "n_tokens",
        laid(lambda x: x["ids"], pad).alias("input_ids"),
        laid(lambda x, i: repeated(i + 1, x), 0).alias("segment_ids"),
        laid(lambda x: F.transform(F.sequence(x["start"], x["start"] + x["length"] - 1), lambda v: v.cast("int")), 0).alias(
            "position_ids"
        ),
        laid(
            lambda x: F.concat(
                F.array_repeat(F.lit(0), (x["length"] - x["loss_tokens"]).cast("int")),
                F.array_repeat(F.lit(1), x["loss_tokens"].cast("int")),
            ),
            0,
        ).alias("loss_mask"),
    )
