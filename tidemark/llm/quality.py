"""Quality of documents by weakly supervised rules.

Every rule votes good or bad or abstains. How often a rule votes each way on
good and on bad documents is estimated by expectation-maximisation from all
documents' votes alone; the posterior probability of good replaces the demand
that all rules pass. Everything is DataFrame functions: text measures are
taken per row without a shuffle, and the steps run on the table of vote
patterns, of which there are at most ``3 ** len(RULES)``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import SPACES, staged

WINDOW = 8
STEPS = 12
KEEP = 0.5
SYMBOLS = "#*$%&|<>"
_SPLIT = "[ \\t\\n\\x0B\\f\\r]+"
#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = ["the", "of", "and", "to", "in", "a", "is", "that", "der", "die", "und", "den", "von", "zu", "das",
                  "mit", "le", "la", "les", "de", "et", "des", "un", "une", "que", "el", "los", "en", "y", "las"]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _SPLIT), lambda w: w != "")


def _count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among a few ASCII ones."""
    left = text
    for c in characters:
        left = F.replace(left, F.lit(c), F.lit(""))
    return (F.length(text) - F.length(left)).cast("long")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key and the counts of each text; a NULL text has none of anything.

    Windows are hashed, and only texts with a repeated hash sort them, so that
    equal windows become neighbours and are compared word by word.
    """
    body = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    body = body.select("id", "t", words_of(F.col("t")).alias("w"))
    body = body.select("id", "t", "w", F.transform("w", lambda w: F.xxhash64(w)).alias("h"), F.size("w").alias("n"))
    # "h" is named more than once, so the optimizer keeps it a column and does not hash all words per window
    hashes = F.when(
        F.size("h") >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size("h") - WINDOW + 1), lambda i: F.xxhash64(F.slice(F.col("h"), i, WINDOW))
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    body = body.select("id", "t", "w", "n", hashes.alias("x"))
    twice = F.size(F.array_distinct("x")) < F.size("x")
    windows = F.when(
        twice, F.sort_array(F.transform("x", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    ).otherwise(F.array().cast("array<struct<x:bigint,i:int>>"))
    body = body.select("id", "t", "w", "n", windows.alias("s"))

    def same(one: Column, other: Column) -> Column:
        """Equal hashes, and then equal words; false beyond the ends."""
        equal = (one["x"] == other["x"]) & (
            F.slice(F.col("w"), one["i"] + 1, WINDOW) == F.slice(F.col("w"), other["i"] + 1, WINDOW)
        )
        return F.coalesce(equal, F.lit(False))

    repeated = F.filter(
        "s", lambda x, k: same(x, F.get(F.col("s"), k - 1)) | same(x, F.get(F.col("s"), k + 1))
    )
    starts = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.ltrim(x, F.lit(SPACES)) != "")
    body = body.select("id", "t", "w", "n", starts.alias("p"), lines.alias("l"))
    gaps = F.transform("p", lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("p"), k + 1) - at, F.lit(WINDOW))))
    t = F.col("t")
    return body.select(
        "id",
        F.col("n").cast("long").alias("n_words"),
        (F.length("t") - _count_of(t, SPACES)).alias("word_chars"),
        _count_of(t, SYMBOLS).alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.aggregate(gaps, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        (F.length("t") - F.length(F.regexp_replace("t", "\\p{Lu}+", ""))).cast("long").alias("n_upper"),
        _count_of(t, "0123456789").alias("n_digits"),
        _count_of(t, "!?").alias("n_marks"),
        _count_of(t, ".").alias("n_stops"),
        F.size(F.filter("w", lambda w: w.isin(FUNCTION_WORDS))).cast("long").alias("n_function"),
    )


RULES = (
    "size", "word_length", "symbols", "repeats", "lines", "capitals", "digits", "marks", "sentences", "function_words",
)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes by name: 1 good, -1 bad, 0 abstains."""
    n = F.col("n_words")
    length = _share(F.col("word_chars"), n)
    symbols = _share(F.col("n_symbols"), n)
    repeats = _share(F.col("n_repeat_words"), n)
    doubled = _share(F.col("n_dup_lines"), F.col("n_lines"))
    upper = _share(F.col("n_upper"), F.col("word_chars"))
    digits = _share(F.col("n_digits"), F.col("word_chars"))
    marks = _share(F.col("n_marks"), n)
    stops = _share(F.col("n_stops"), n)
    function = _share(F.col("n_function"), n)
    return {
        "size": _vote(n >= 50, (n < 20) | (n > 200_000)),
        "word_length": _vote((length >= 3) & (length <= 10), (length < 2.5) | (length > 14)),
        "symbols": _vote(symbols <= 0.01, symbols > 0.1),
        "repeats": _vote(repeats <= 0.02, repeats > 0.2),
        "lines": _vote((doubled == 0) & (F.col("n_lines") > 1), doubled > 0.3),
        "capitals": _vote(upper <= 0.1, upper > 0.3),
        "digits": _vote(digits <= 0.02, digits > 0.2),
        "marks": _vote(marks <= 0.05, marks > 0.2),
        "sentences": _vote((stops >= 0.005) & (stops <= 0.2), (n >= 50) & ((stops < 0.001) | (stops > 0.4))),
        "function_words": _vote(function >= 0.08, (n >= 20) & (function < 0.02)),
    }



@dataclass
class LabelModel:
    """Share of good documents, and per rule and class the chance of each vote."""

    prior: float
    chances: dict[str, dict[int, tuple[float, float]]]  # vote: (if good, if bad)

    @classmethod
    def start(cls) -> LabelModel:
        each = {1: (0.7, 0.2), 0: (0.2, 0.2), -1: (0.1, 0.6)}
        return cls(0.8, {name: dict(each) for name in RULES})

    def posterior(self) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name in RULES:
            logs = {v: math.log(g / b) for v, (g, b) in self.chances[name].items()}
            odds = odds + F.when(F.col(name) == 1, logs[1]).when(F.col(name) == -1, logs[-1]).otherwise(logs[0])
        return 1 / (1 + F.exp(-F.least(F.greatest(odds, F.lit(-500.0)), F.lit(500.0))))

    def step(self, patterns: DataFrame) -> LabelModel:
        """One round over all vote patterns; a few votes of each kind are added so that no chance is zero."""
        q = self.posterior()
        sums = [F.sum(F.col("n") * q).alias("good"), F.sum("n").alias("all")]
        for name in RULES:
            for vote in (1, 0, -1):
                here = F.col(name) == vote
                sums.append(F.sum(F.when(here, F.col("n") * q).otherwise(0.0)).alias(f"g_{name}_{vote}"))
                sums.append(F.sum(F.when(here, F.col("n") * (1 - q)).otherwise(0.0)).alias(f"b_{name}_{vote}"))
        got = patterns.agg(*sums).first()
        if not got["all"]:
            return self
        good, bad = got["good"], got["all"] - got["good"]
        add = {v: (20 * g, 20 * b) for v, (g, b) in LabelModel.start().chances[RULES[0]].items()}
        chances = {
            name: {
                v: (
                    (got[f"g_{name}_{v}"] + add[v][0]) / (good + 20),
                    (got[f"b_{name}_{v}"] + add[v][1]) / (bad + 20),
                )
                for v in (1, 0, -1)
            }
            for name in RULES
        }
        return LabelModel((good + 16) / (got["all"] + 20), chances)


def fit(votes: DataFrame, steps: int = STEPS) -> LabelModel:
    """Expectation-maximisation on all rows' votes, summed by pattern; stops when the share of good settles."""
    patterns = staged(votes.groupBy(*RULES).agg(F.count("*").alias("n")), "votes").coalesce(1)
    model = LabelModel.start()
    for _ in range(steps):
        before, model = model, model.step(patterns)
        if abs(before.prior - model.prior) < 1e-4:
            break
    return model


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """Per row: key, text counts, ``base_failed``, the votes, ``posterior`` and ``kept``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in 8-word
    windows that occur more than once. ``kept`` is false then, else whether the
    posterior is at least ``keep``. NULL and empty texts have no words and
    fail. Repeated rows are judged alike and all of them count as votes. NULL
    keys are kept as they are. Other columns are not read.
    """
    taken = staged(measured(docs, key, text), "measures")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    voted = taken.select("*", *[vote.alias(name) for name, vote in rules().items()])
    model = fit(voted)
    judged = voted.withColumn("base_failed", failed).withColumn("posterior", model.posterior())
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep)).withColumnRenamed("id", key)
