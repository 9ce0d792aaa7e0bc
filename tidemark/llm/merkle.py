"""Merkle manifest of a table: one tree of SHA-256 digests per group, and one over the groups.

Rows are hashed to leaves once, sorted, and dealt to blocks of ``FANOUT **
BLOCK_LEVELS`` consecutive leaves of one group, aligned with the tree. A block
hashes its own levels. All levels above are made by a butterfly exchange of
blocks: in every round the blocks below one run of up to ``FANOUT`` nodes swap
the digests of those nodes, each block with one block of every other node, and
all of them hash the run, redundantly. So a block gathers the siblings on its
way to the root as it goes up, and nothing is handed down again. Where the last
node of a run covers fewer blocks than its neighbours, its blocks send to
several partners.

A round is one shuffle of block rows (one for ``FANOUT ** BLOCK_LEVELS`` leaves) and no group of it has
more than ``FANOUT`` rows. The number of rounds is the height of the tree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import staged

FANOUT = 16
BLOCK_LEVELS = 2
_BLOCK = FANOUT**BLOCK_LEVELS
_PART = 33  # bits of monotonically_increasing_id() below the partition number
_STEP = "struct<left:string,right:string>"


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of a string in UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def encoded(values: Sequence[Column]) -> Column:
    """Values in one string that no other values give: ``-`` for NULL, else bytes, ``:`` and the value."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def numbered(df: DataFrame, order: Sequence[Column], label: str, weight: str | None = None) -> DataFrame:
    """Rows in ``order`` with ``rank`` (rows before) and, for a ``weight``, ``before`` (its sum before).

    Written sorted to the shared folder, so numbers cannot change when a task
    runs again. Only one count for each written partition goes through one task.
    """
    rows = staged(df.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("part", F.shiftright("at", _PART))
    sums = {"rank": F.count(F.lit(1))} | ({"before": F.sum(weight)} if weight else {})
    sizes = rows.groupBy("part").agg(*[total.alias(f"{name}_of_part") for name, total in sums.items()])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", *[F.coalesce(F.sum(f"{n}_of_part").over(earlier), F.lit(0)).alias(f"{n}_start") for n in sums])
    rows = rows.join(F.broadcast(starts), "part")  # a row for each written partition
    rows = rows.withColumn("rank", F.col("rank_start") + F.col("at").bitwiseAND((1 << _PART) - 1))
    if weight:
        inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("before", F.col("before_start") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return rows.drop("at", "part", *[f"{n}_start" for n in sums])


def _div(value, by: int) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value / by).cast("long") if by > 1 else value


def _layout(leaves: DataFrame) -> tuple[DataFrame, int, int]:
    """One row per group: ``grp``, ``first`` (rank of its first leaf), ``n`` leaves, ``blocks``, ``place`` in
    order, and for every level of the tree of groups the holders it sends to.

    ``holders[t]``: blocks below its node of level t; ``holder[t]``: those of
    them before the group; ``slots[t]``: the most that a node of its run has.
    """
    found = leaves.groupBy("grp").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    found = found.withColumn("blocks", _div(F.col("n") - 1, _BLOCK) + 1)
    found = numbered(found, [F.col("first")], "merkle-groups", weight="blocks").withColumnRenamed("rank", "place")
    groups, most = found.agg(F.count(F.lit(1)), F.max("blocks")).first()
    rows, at = found, 0
    names = ("holders", "holder", "slots")
    while FANOUT**at < groups:
        node, run = _div("place", FANOUT**at), _div("place", FANOUT ** (at + 1))
        nodes = found.groupBy(node.alias("node")).agg(F.sum("blocks").alias("holders"), F.min("before").alias("from"))
        widest = nodes.groupBy(_div("node", FANOUT).alias("run")).agg(F.max("holders").alias(f"slots{at}"))
        rows = rows.withColumns({"node": node, "run": run}).join(nodes, "node").join(widest, "run")
        rows = rows.withColumn(f"holder{at}", F.col("before") - F.col("from")).withColumnRenamed("holders", f"holders{at}")
        rows = rows.drop("node", "run", "from")
        at += 1
    levels = [F.array(*[F.col(f"{n}{t}") for t in range(at)]).cast("array<long>").alias(n) for n in names]
    return rows.select("grp", "first", "n", "blocks", "place", *levels), at, most or 0


def _exchange(rows: DataFrame, active: Column, run: Column, child: Column, holders: Column, holder: Column, slots: Column) -> DataFrame:
    """One round: blocks of ``active`` rows swap nodes inside their run, hash it and note their siblings.

    Slot j of a run has one block of each of its nodes: of a node with
    ``holders`` blocks the one numbered ``j mod holders``. A block therefore
    sends to the slots ``holder``, ``holder + holders``, and so on below
    ``slots``, and is itself at home in the first of them.
    """
    state = F.struct("place", "block", "blocks", "node", "subroot", "path", "holders", "holder", "slots", "active")
    sent = (
        rows.withColumn("active", active)
        .withColumn("of", F.when(F.col("active"), run).otherwise(F.col("place")))
        .withColumn("child", F.when(F.col("active"), child).otherwise(F.lit(0).cast("long")))
        .withColumn("home", F.when(F.col("active"), holder).otherwise(F.col("block")))
        .withColumn("state", state)
        .withColumn("slot", F.explode(F.when(F.col("active"), F.sequence(holder, slots - 1, holders)).otherwise(F.array("block"))))
    )
    swapped = sent.groupBy("active", "of", "slot").agg(
        F.sort_array(
            F.collect_list(F.struct("child", "node", F.when(F.col("slot") == F.col("home"), F.col("state")).alias("state")))
        ).alias("met")
    )

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("met", keep), lambda x: x["node"]), "")

    arrived = swapped.select(
        F.when(F.col("active"), digest(joined(lambda x: F.lit(True)))).alias("parent"),
        F.transform(
            F.filter("met", lambda x: x["state"].isNotNull()),
            lambda h: F.struct(
                h["state"].alias("state"),
                joined(lambda x: x["child"] < h["child"]).alias("left"),
                joined(lambda x: x["child"] > h["child"]).alias("right"),
            ),
        ).alias("homes"),
    ).select("parent", F.inline("homes"))
    step = F.array(F.struct("left", "right").cast(_STEP))
    kept = [n for n in ("place", "block", "blocks", "subroot", "holders", "holder", "slots")]
    return arrived.select(
        *[F.col(f"state.{n}").alias(n) for n in kept],
        F.when(F.col("state.active"), F.col("parent")).otherwise(F.col("state.node")).alias("node"),
        F.when(F.col("state.active"), F.concat("state.path", step)).otherwise(F.col("state.path")).alias("path"),
    )


def _climb(blocks: DataFrame, most: int, levels: int) -> DataFrame:
    """Blocks with the digests of their group and of the table, and the path above the block."""
    rows = blocks.withColumn("path", F.array().cast(f"array<{_STEP}>")).withColumn("subroot", F.lit(None).cast("string"))
    width = 1
    while width < most:  # inside groups: a node of this round covers `width` blocks
        node = _div("block", width)
        first = _div(node, FANOUT) * (FANOUT * width)
        rows = _exchange(
            rows,
            active=F.col("blocks") > width,
            # runs of one group are named by the group and their number: `most` bounds the number
            run=F.col("place") * most + _div(node, FANOUT),
            child=node % FANOUT,
            holders=F.least(F.lit(width).cast("long"), F.col("blocks") - node * width),
            holder=F.col("block") % width,
            slots=F.least(F.lit(width).cast("long"), F.col("blocks") - first),
        )
        width *= FANOUT
    rows = rows.withColumn("subroot", F.col("node"))
    for level in range(levels):  # over groups
        node = _div("place", FANOUT**level)
        rows = _exchange(
            rows,
            active=F.lit(True),
            run=_div(node, FANOUT),
            child=node % FANOUT,
            holders=F.col("holders")[level],
            holder=F.col("holder")[level] + F.col("block"),
            slots=F.col("slots")[level],
        )
    return rows


def manifest(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "doc_id",
    group: str = "source",
    presented: Mapping[str, Column] | None = None,
    with_path: bool = True,
) -> DataFrame:
    """Leaf, group root, table root and proof of every row.

    ``columns`` are hashed in that order. Leaves of a group ascend by ``key``
    (NULL first, equal keys by leaf); groups ascend bytewise, NULL first. Every
    ``FANOUT`` consecutive nodes give one, also a last run of one, until one is
    left; a lone leaf is its group's root.

    Returns ``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of all siblings, level
    by level, left to right), ``folded_root``, ``verified`` and, with
    ``with_path``, ``path`` (``left`` and ``right`` siblings of each level). ``presented`` names
    columns that are put to the proof with another value, as a copy to be
    checked: ``folded_root`` follows from the presented row and the stored
    siblings, and ``verified`` is whether it is the root.

    NULL in any column has an encoding of its own; repeated rows are leaves of
    their own; an empty table gives no rows; other columns are not read.
    """
    shown = [(presented or {}).get(c, F.col(c)) for c in columns]
    hashed = df.select(
        F.col(key).alias("k"),
        F.col(group).alias("grp"),
        digest(encoded([F.col(c) for c in columns])).alias("leaf"),
        *([digest(encoded(shown)).alias("copy")] if presented else []),
        F.monotonically_increasing_id().alias("row"),  # deals even identical rows to several tasks
    )
    order = [F.col(c).asc_nulls_first() for c in ("grp", "k", "leaf", "row")]
    leaves = numbered(staged(hashed, "merkle-leaves"), order, "merkle-sorted").drop("row")
    groups, levels, most = _layout(leaves)
    on = F.col("l.grp").eqNullSafe(F.col("g.grp"))
    placed = leaves.alias("l").join(groups.alias("g"), on).select("l.k", "l.rank", "l.leaf", *(["l.copy"] if presented else []), "g.*")
    at = F.col("rank") - F.col("first")
    inside = placed.withColumn("at", at).withColumn("block", _div("at", _BLOCK))
    known = ("n", "blocks", "holders", "holder", "slots")
    blocks = inside.groupBy("place", "block").agg(
        F.sort_array(F.collect_list(F.struct("at", "leaf", "k", *(["copy"] if presented else [])))).alias("leaves"),
        *[F.first(n).alias(n) for n in known],
    )
    blocks = staged(_with_levels(blocks), "merkle-blocks")
    tops = blocks.select("place", "block", F.col("top").alias("node"), "blocks", "holders", "holder", "slots")
    climbed = _climb(tops, most, levels).select("place", "block", "subroot", F.col("node").alias("root"), F.col("path").alias("upper"))
    return _proofs(blocks.select("place", "block", "leaves", "n", *_level_names()).join(climbed, ["place", "block"]), key, with_path)


def _level_names() -> list[str]:
    return [f"nodes{level}" for level in range(BLOCK_LEVELS + 1)]


def _with_levels(blocks: DataFrame) -> DataFrame:
    """The digests of each level inside a block; a small group ends below the top level of its block."""
    rows = blocks.withColumn("nodes0", F.transform("leaves", lambda x: x["leaf"]))
    for level in range(BLOCK_LEVELS):
        below = F.col(f"nodes{level}")
        runs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / FANOUT).cast("int"))
        hashed = F.transform(runs, lambda i: digest(F.array_join(F.slice(below, i * FANOUT + 1, FANOUT), "")))  # noqa: B023
        rows = rows.withColumn(f"nodes{level + 1}", F.when(F.col("n") > FANOUT**level, hashed).otherwise(below))
    return rows.withColumn("top", F.col(f"nodes{BLOCK_LEVELS}")[0])


def _proofs(rows: DataFrame, key: str, with_path: bool) -> DataFrame:
    def steps(at: Column) -> Column:
        found = []
        for level in range(BLOCK_LEVELS):
            nodes = F.col(f"nodes{level}")
            mine = F.floor(at / FANOUT**level).cast("int")
            first = F.floor(mine / FANOUT).cast("int") * FANOUT
            left = F.array_join(F.slice(nodes, first + 1, mine - first), "")
            right = F.array_join(F.slice(nodes, mine + 2, first + FANOUT - 1 - mine), "")
            step = F.struct(left.alias("left"), right.alias("right"))
            # no such level in a small group
            found.append(F.when(F.col("n") > FANOUT**level, F.array(step)).otherwise(F.array().cast(f"array<{_STEP}>")))
        return F.concat(*found, F.col("upper"))

    def proof(x: Column) -> Column:
        path = steps((x["at"] % _BLOCK).cast("int"))
        fields = [x["k"].alias(key), x["leaf"].alias("leaf"), (x["copy"] if "copy" in copied else x["leaf"]).alias("copy")]
        return F.struct(*fields, path.alias("path"))

    copied = rows.schema["leaves"].dataType.elementType.names
    found = rows.select("subroot", "root", F.inline(F.transform("leaves", proof)))
    siblings = F.aggregate("path", F.lit(""), lambda text, step: F.concat(text, step["left"], step["right"]))
    out = found.select(
        key,
        "leaf",
        "subroot",
        "root",
        digest(siblings).alias("proof_sha256"),
        fold(F.col("copy"), F.col("path")).alias("folded_root"),
        *(["path"] if with_path else []),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
