from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from cases import ODD
from helpers import SMALL, rows_of
from pyspark.sql import functions as F

from tidemark.llm import merkle, statements
from tidemark.llm.queries import op11_merkle
from tidemark.llm.text import ascii_lower, id_crc

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        levels.append(nodes)
    return levels


def path(levels, at):
    steps = []
    for nodes in levels[:-1]:
        first = at // 16 * 16
        steps.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 16])))
        at //= 16
    return steps


def plain(rows):
    groups = {}
    for key, text, lang, source, size in rows:
        shown = text
        if text is not None and key is not None and zlib.crc32(str(key).encode()) % 5 == 0:
            shown = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf, copy = (sha(encoded((key, source, lang, size, t))) for t in (text, shown))
        groups.setdefault(source, []).append((key is not None, key or 0, leaf, key, copy))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for place, source in enumerate(sources):
        for at, (_, _, leaf, key, copy) in enumerate(sorted(groups[source], key=lambda x: x[:3])):
            steps = path(trees[source], at) + path(top, place)
            node = copy
            for left, right in steps:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in steps))
            root = top[-1][0]
            out.append((key, leaf, trees[source][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def found(df):
    shown = F.when(id_crc("doc_id", 5) == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    out = merkle.manifest(df, COLUMNS, presented={"text": shown}, with_path=False)
    return rows_of(out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


def made(seed, sizes):
    random.seed(seed)
    rows, key = [], 0
    for source, n in sizes:
        for _ in range(n):
            key += random.randint(1, 3)
            text = random.choice([None, "", "Ab Ünï", "x y"])
            rows.append((key, text, random.choice([None, "en"]), source, random.choice([None, 5])))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "rows",
    [
        [],
        made(1, [("a", 1)]),
        made(2, [(None, 1), ("a", 16), ("b", 17)]) * 2 + [(None, "A", None, None, None)] * 3,
        # one, two and three levels of blocks; a run of one node at several levels
        made(3, [("a", 256), ("b", 257), ("c", 4097), ("é", 3), ("", 5)]),
        made(4, [(f"s{i}", random.choice([1, 2, 20])) for i in range(300)] + [("z", 5000)]),
    ],
    ids=["empty", "one", "repeated", "levels", "many groups"],
)
def test_equals_plain_tree(spark, rows):
    assert found(spark.createDataFrame(rows, DOCS)) == plain(rows)


def test_odd_texts_and_other_columns(spark):
    rows = [(k, t, None, None if i % 2 else "s", i) for i, (k, t) in enumerate(ODD)]
    df = spark.createDataFrame(rows, DOCS)
    clashing = df.withColumns({n: F.lit(1) for n in ("leaf", "root", "path", "rank", "block", "row", "at")})
    assert found(clashing) == plain(rows)


def test_path_folds_to_root(spark):
    df = spark.createDataFrame(made(5, [("a", 300), ("b", 2)]), DOCS)
    out = merkle.manifest(df, COLUMNS)
    assert out.where("verified").count() == 302
    assert out.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()
    changed = merkle.fold(F.sha2(F.lit("x").cast("binary"), 256), F.col("path"))
    assert out.where(changed == F.col("root")).isEmpty()


def test_table_equals_plain_and_statement(spark):
    duckdb = pytest.importorskip("duckdb")
    got = op11_merkle(spark, SMALL)
    names = sorted(got.columns)
    rows = rows_of(got.select(*names))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    told = connection.execute(f"SELECT {', '.join(names)} FROM ({statements.OP11})").fetchall()
    assert rows == sorted(told, key=repr)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    order = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert rows_of(got.select(*order)) == plain([tuple(r) for r in docs.collect()])
