"""Training examples from conversations: one for each reply, with all turns before it as context.

A turn is written as ``[TURN]role``, a newline, its text and ``[/TURN]``, and a
conversation between ``<s>`` and ``</s>``. Control strings inside roles and
texts are broken by a backslash after their first character; one more is added
where a text has such backslashes already, so nothing is lost.

The context of an example is the whole conversation up to its reply, written
out, so the examples of a conversation are together as long as all prefixes of
it. They are made row by row in the order of the conversation, after its turns
were shuffled once; no task holds more of them than a batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed strings of the template, and of others that a text must not imitate.
CONTROL = ["<s>", "</s>", "[TURN]", "[/TURN]", "[INST]", "[/INST]"]
OPEN, CLOSE, BEGIN, END = "[TURN]", "[/TURN]", "<s>", "</s>"
REPLY = "assistant"
_REST = "|".join(re.escape(c[1:]) for c in CONTROL)
_BREAK = rf"([<\[])(\\*)({_REST})"
_JOIN = re.compile(rf"([<\[])\\(\\*)({_REST})")
_TURN = re.compile(r"\[TURN\](.*?)\n(.*?)\[/TURN\]", re.S)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _BREAK, "$1\\\\$2$3")


def unescaped(text: str) -> str:
    return _JOIN.sub(r"\1\2\3", text)


def _role(role: Column) -> Column:
    """A role on one line."""
    return F.regexp_replace(F.regexp_replace(escaped(role), r"\\", r"\\\\"), "\n", r"\\n")


def role_of(text: str) -> str:
    return unescaped(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S))


def examples(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per reply with all turns before it as ``context``, and one for turns after the last reply.

    ``example`` counts them from 0 in each conversation; ``context`` is the
    formatted conversation from its begin to the mark of this reply, and its
    first ``shared`` characters are the whole example before this one;
    ``target`` is the reply, the only part to train on, and NULL in a row
    without one; ``closing`` follows it.

    Turns go by ``turn``, NULL first, then by role and text, so ties have a
    fixed order; repeated rows are repeated turns. A NULL text or role is an
    empty one, and turns with a NULL key are one conversation. An empty table
    gives no rows. Other columns are not read.
    """
    rows = turns.select(
        F.col(key).alias("key"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).repartition("key")
    order = Window.partitionBy("key").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reply = F.col("role") == REPLY
    rows = rows.select(
        "key",
        "role",
        F.row_number().over(order).alias("at"),
        F.lead(F.lit(False), 1, True).over(order).alias("last"),
        F.coalesce(F.sum(reply.cast("long")).over(before), F.lit(0)).alias("example"),
        escaped(F.col("text")).alias("body"),
        F.concat(F.lit(OPEN), _role(F.col("role")), F.lit("\n")).alias("head"),
    )
    head = F.concat(F.when(F.col("at") == 1, F.lit(BEGIN)).otherwise(F.lit("")), F.col("head"))
    tail = F.concat(F.lit(CLOSE), F.when(F.col("last"), F.lit(END)).otherwise(F.lit("")))
    written = rows.select(
        "key", "example", "at",
        F.when(reply, head).otherwise(F.concat(head, "body", tail)).alias("context"),
        F.when(reply, F.col("body")).alias("target"),
        F.when(reply, tail).alias("closing"),
    )
    listed = F.array_sort(F.collect_list(F.struct("at", "context")))
    whole = written.groupBy("key", "example").agg(
        F.array_join(F.transform(listed, lambda x: x["context"]), "").alias("context"),
        F.max("target").alias("target"),
        F.coalesce(F.max("closing"), F.lit("")).alias("closing"),
    ).withColumnRenamed("key", key)  # before the window, so that its order is known to ``read_back``
    part = _text(F.col("context"))
    run = Window.partitionBy(key).orderBy("example").rowsBetween(Window.unboundedPreceding, -1)
    preceding = F.array_join(F.collect_list(part).over(run), "")
    return whole.select(
        key,
        "example",
        F.coalesce(F.sum(F.length(part).cast("long")).over(run), F.lit(0)).alias("shared"),
        F.concat(preceding, "context").alias("context"),
        "target",
        "closing",
    )


def _text(context: Column) -> Column:
    return F.concat(context, F.coalesce(F.col("target"), F.lit("")), F.col("closing"))


def materialise(found: DataFrame, key: str = "conv_id") -> DataFrame:
    """Training texts: ``text``, and the trainable characters from ``begin`` to ``end`` (exclusive).

    Rows without a reply are left out.
    """
    begin = F.length("context")
    return found.where(F.col("target").isNotNull()).select(
        key,
        "example",
        _text(F.col("context")).alias("text"),
        begin.cast("long").alias("begin"),
        (begin + F.length("target")).cast("long").alias("end"),
    )


READ = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each conversation from its examples, which come in order; two examples are held.

    An example whose context does not begin with the whole example before it is
    an error, so each holds all turns before its reply.
    """
    key, state = None, None

    def closed():
        turns, digest, chars, loss, before = state
        return (key, turns, digest.hexdigest(), chars, loss.hexdigest(), len(before))

    for batch in batches:
        done = []
        columns = [(v.as_py() for v in batch.column(k)) for k in range(5)]
        for own, shared, context, target, closing in zip(*columns):
            if state is None or own != key:
                if state is not None:
                    done.append(closed())
                key, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), ""]
            before = state[4]
            if shared != len(before):
                raise ValueError(f"an example of conversation {key} shares {shared} characters and not {len(before)}")
            if not context.startswith(before):
                raise ValueError(f"an example of conversation {key} does not begin with the example before it")
            state[4] = context + (target or "") + closing
            for match in _TURN.finditer(state[4], shared):
                state[0] += 1
                state[1].update(f"{role_of(match[1])}\n{unescaped(match[2])}\n".encode("utf-8", "surrogatepass"))
            if target is not None:
                plain = unescaped(target)
                state[2] += len(plain)
                state[3].update(plain.encode("utf-8", "surrogatepass"))
        yield _digests(done)
    if state is not None:
        yield _digests([closed()])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 6
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["key", *(part.split()[0] for part in READ.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def read_back(found: DataFrame, key: str = "conv_id") -> DataFrame:
    """What a reader of the examples gets back per conversation: turns, and all text under the loss mask.

    The context of each example must begin with the whole example before it,
    so it is all preceding turns; else the job fails.
    """
    rows = found.repartition(key).sortWithinPartitions(key, "example").select(
        F.col(key).cast("long").alias("key"), "shared", "context", "target", "closing"
    )
    return rows.mapInArrow(_read, f"key bigint, {READ}").withColumnRenamed("key", key)
