"""URL filter from association rules.

Spark's FP-growth finds combinations of URL tokens that go with bad or good
labels. Rules are kept if they are frequent and confident enough, whatever the
share of the labels, and say more than a shorter rule does; an inverted index
from a rule's rarest token finds those that apply to a URL. Given host and path rules come first. Everything is
DataFrame functions and Spark's own FP-growth.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import ascii_lower, staged

SUPPORT = 0.002
BALANCED = 0.6
DEVIATIONS = 4.0
LEAST_PAGES = 20
MARGIN = 0.02
BAD, GOOD = "label=bad", "label=good"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; NULL without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def given_rule(host: Column, path: Column, given: list[tuple[str, str, str]]) -> Column:
    """The longest rule (verdict, host, path) whose host is the url's or a parent of it and whose path begins the url's."""
    listed = F.array(
        *[
            F.struct(
                F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"),
                F.lit(h).alias("host"), F.lit(p).alias("path"),
            )
            for v, h, p in given
        ]
    ).cast("array<struct<size:int,rule:string,verdict:string,host:string,path:string>>")
    fits = F.filter(
        listed,
        lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
        & F.startswith(path, r["path"]),
    )
    return F.array_max(fits)


def tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host labels, path parts, file ending, query names, fragment; numbers are one token."""

    def named(kind: str, parts: Column) -> Column:
        plain = F.transform(parts, lambda x: F.regexp_replace(x, "[0-9]+", "#"))
        return F.transform(F.filter(plain, lambda x: x != ""), lambda x: F.concat(F.lit(kind + ":"), x))

    path, rest = path_of(url), F.coalesce(_rest(url), F.lit(""))
    query = F.regexp_extract(rest, "\\?([^#]*)", 1)
    scheme = F.coalesce(F.regexp_extract(url, "^([A-Za-z]+)://", 1), F.lit(""))
    return F.array_distinct(
        F.concat(
            named("scheme", F.array(scheme)),
            named("host", F.split(host_of(url), "\\.")),
            named("path", F.split(F.regexp_replace(path, "\\.[A-Za-z0-9]+$", ""), "/")),
            named("ending", F.array(F.regexp_extract(path, "\\.([A-Za-z0-9]+)$", 1))),
            named("query", F.transform(F.split(query, "&"), lambda q: F.regexp_extract(q, "^[^=]*", 0))),
            named("mark", F.array(F.when(F.contains(rest, F.lit("#")), F.lit("fragment")).otherwise(F.lit("")))),
        )
    )


def token_groups(rows: DataFrame, least: float) -> DataFrame:
    """``token``, ``group``, ``n``: tokens in at least ``least`` of the ``rows`` (items), and the first token of those in the same rows.

    Tokens that always occur together are told by their number of rows and two
    sums of the rows' 64-bit hashes.
    """
    ordered = F.array_sort("items")
    each = rows.select(
        F.explode("items").alias("token"),
        F.xxhash64(ordered).cast("decimal(20,0)").alias("a"),
        F.xxhash64(F.lit(7), ordered).cast("decimal(20,0)").alias("b"),
    )
    counted = each.groupBy("token").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    together = counted.where(F.col("n") >= least).groupBy("n", "a", "b").agg(
        F.min("token").alias("group"), F.collect_list("token").alias("tokens")
    )
    return together.select(F.explode("tokens").alias("token"), "group", "n")


def balanced_confidence(confidence: Column, lift: Column) -> Column:
    """Confidence of a rule if both labels were equally frequent, from its confidence and lift."""
    share = confidence / lift
    return lift / (lift + (1 - confidence) / (1 - share))


def _least_confidence(share: float, balanced: float) -> float:
    """The confidence that a rule of this balanced confidence has, for a label of this share."""
    return balanced * share / (balanced * share + (1 - balanced) * (1 - share))


def mine(
    labelled: DataFrame, support: float = SUPPORT, confidence: float | None = None, balanced: float = BALANCED
) -> tuple[DataFrame, DataFrame]:
    """Rules and token groups from rows (items, bad).

    Rules: ``rule``, ``items``, ``rarest`` of the items, ``verdict``,
    ``confidence``. Items are token groups, each named by its first token:
    tokens that occur in the same rows are one item, else a url of many query
    names would have as many item sets as these have subsets.

    Token sets must occur in a share ``support`` of the rows, and in at least
    ``LEAST_PAGES`` of them, with the rule's label. Rules need a class-balanced
    confidence of ``balanced``, or a plain one of ``confidence`` if that is
    given; ``confidence`` in the result is the one that was asked for. The
    share of their label must be ``DEVIATIONS`` standard deviations above its
    share in all rows. Rules are dropped if a rule with fewer of the same
    items and the same verdict is at most ``MARGIN`` less confident.
    """
    rows = staged(labelled.select("items", "bad").withColumn("row", F.monotonically_increasing_id()), "mined")
    total, share = rows.agg(F.count("*"), F.coalesce(F.avg(F.col("bad").cast("double")), F.lit(0.0))).first()
    support = max(support, min(1.0, LEAST_PAGES / max(1, total)))
    groups = staged(token_groups(rows, support * total - 1e-6).where(F.col("n") < total), "groups")
    tokens_ = rows.select("row", "bad", F.explode_outer("items").alias("token"))
    grouped = tokens_.join(groups, "token", "left").groupBy("row", "bad").agg(F.collect_set("group").alias("items"))
    grouped = grouped.select(
        F.array_append("items", F.when(F.col("bad"), F.lit(BAD)).otherwise(F.lit(GOOD))).alias("items")
    )
    least = confidence
    if least is None:
        least = min(_least_confidence(share, balanced), _least_confidence(1 - share, balanced))
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=least).fit(grouped).associationRules
    plain, lift = F.col("confidence"), F.col("lift")
    held = F.col("support") * total / plain
    base = plain / lift
    sure = plain - base >= DEVIATIONS * F.sqrt(base * (1 - base) / held)
    measure = balanced_confidence(plain, lift) if confidence is None else plain
    kept = (
        found.where(F.col("consequent")[0].isin(BAD, GOOD) & (lift > 1.05))
        .where(sure & ~F.arrays_overlap("antecedent", F.array(F.lit(BAD), F.lit(GOOD))))
        .select(
            F.array_sort("antecedent").alias("items"),
            F.when(F.col("consequent")[0] == BAD, "block").otherwise("allow").alias("verdict"),
            measure.alias("confidence"),
        )
        .where(F.col("confidence") >= (balanced if confidence is None else confidence) - 1e-9)
    )
    each = kept.select("items", "verdict", "confidence", F.explode("items").alias("group"))
    sizes = groups.select("group", "n").distinct()
    rarest = F.min(F.struct("n", "group"))["group"].alias("rarest")
    kept = staged(each.join(sizes, "group").groupBy("items", "verdict", "confidence").agg(rarest), "rules")
    # a shorter rule is met at its rarest item
    parts = kept.select(F.explode("items").alias("at"), "items", "verdict", "confidence")
    short = kept.select(
        F.col("rarest").alias("at"), F.col("items").alias("less"),
        F.col("verdict").alias("v"), F.col("confidence").alias("c"),
    )
    idle = (
        parts.join(short, "at")
        .where(
            (F.col("v") == F.col("verdict"))
            & (F.size("less") < F.size("items"))
            & (F.size(F.array_except("less", "items")) == 0)
            & (F.col("c") >= F.col("confidence") - MARGIN)
        )
        .select("items", "verdict")
        .distinct()
    )
    telling = kept.join(idle, ["items", "verdict"], "left_anti")
    return staged(telling.withColumn("rule", F.array_join("items", " & ")), "telling"), groups


def matches(urls: DataFrame, mined: DataFrame, groups: DataFrame) -> DataFrame:
    """``url``, ``mined``, ``found``: the most confident rule among those whose items a url has.

    A url has an item if it has one of its tokens, as rules that differ in
    such tokens alone are equal on the labelled rows. The index lists every
    rule under its rarest item; the other items are looked up in the url's
    own. Equal confidence goes to block, then by name.
    """
    used = groups.join(mined.select(F.explode("items").alias("group")).distinct(), "group", "left_semi")
    each = urls.select("url", F.explode("items").alias("token")).join(used.select("token", "group"), "token")
    own = each.groupBy("url").agg(F.collect_set("group").alias("own"))
    index = mined.select(F.col("rarest").alias("at"), "rule", "verdict", "confidence", "items")
    met = own.select("url", "own", F.explode("own").alias("at")).join(index, "at")
    whole = met.where(F.size(F.array_except("items", "own")) == 0)
    best = F.max(F.struct("confidence", "verdict", "rule"))
    return whole.groupBy("url").agg(best.alias("best")).select(
        "url", F.col("best.rule").alias("mined"), F.col("best.verdict").alias("found")
    )


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    given: list[tuple[str, str, str]],
    key: str = "page_id",
    url: str = "url",
    label_key: str = "doc_id",
    label: str = "quality",
    support: float = SUPPORT,
    confidence: float | None = None,
    balanced: float = BALANCED,
) -> DataFrame:
    """Per row: key, ``host``, ``path``, ``rule`` (given, or NULL), ``mined`` (or NULL), ``verdict``.

    A page is bad for mining if its label is 0, good if 1; pages without key,
    label or url teach nothing, and without any labelled page there are no
    mined rules. A given rule decides before mined ones; urls without either
    are allowed, NULL and empty ones included. Repeated rows are judged alike.
    Other columns are not read.
    """
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"))
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(label_key).alias("id")).agg(
        (F.min(label) == 0).alias("bad")
    )
    labelled = staged(
        rows.where(F.col("url").isNotNull()).join(known, "id").select(tokens(F.col("url")).alias("items"), "bad"),
        "labelled",
    )
    judged = rows.select(
        "id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("own", given_rule(F.col("host"), F.col("path"), given))
    if labelled.isEmpty():
        judged = judged.withColumn("mined", F.lit(None).cast("string")).withColumn("found", F.lit(None).cast("string"))
    else:
        distinct = rows.select("url").distinct().where(F.col("url").isNotNull())
        urls = distinct.select("url", tokens(F.col("url")).alias("items"))
        judged = judged.join(matches(urls, *mine(labelled, support, confidence, balanced)), "url", "left")
    return judged.select(
        F.col("id").alias(key),
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        "mined",
        F.coalesce("own.verdict", "found", F.lit("allow")).alias("verdict"),
    )
