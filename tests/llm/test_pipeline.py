from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
import sentencepiece
from cases import ODD
from helpers import SMALL

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm.decontamination import words_of
from tidemark.llm.pii import Pseudonymiser
from tidemark.llm.queries import PII_KEY, PIECE_MODEL
from tidemark.llm.simhash import fingerprint

ROOT = Path(__file__).resolve().parents[2]


def test_names():
    own = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in own) == list(range(1, 14))
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontamination", "pii", "sentencepiece"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [{r["doc_id"]: r for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        out.append({r["doc_id"]: r for r in docs.collect()})
    return out


def test_each_stage_against_brute_force(spark, steps):
    given, told, single, clean, private, pieces = steps
    assert all(given[k] == r for k, r in told.items()) and len(told) >= 0.98 * len(given)
    classes = {}
    for key in sorted(told):
        fp = fingerprint(told[key]["text"])
        near = [c for c, fps in classes.items() if any((fp ^ f).bit_count() <= 3 for f in fps)]
        classes[min([key, *near])] = {fp}.union(*[classes.pop(c) for c in near])
    assert single == {k: told[k] for k in classes}

    bench = [words_of(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in bench for i in range(max(1, len(w) - 9)) if w}

    def dirty(text):
        w = words_of(text)
        return any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    assert clean == {k: r for k, r in single.items() if not dirty(r["text"])}
    own = Pseudonymiser(PII_KEY)
    assert {k: r["text"] for k, r in private.items()} == {k: own.replace(r["text"])[0] for k, r in clean.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in private.values())
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    assert {k: (r["ids"], r["decoded"]) for k, r in pieces.items()} == {
        k: (library.encode(r["text"]), r["text"]) for k, r in private.items()
    }


def test_near_dedup_judges_rows_of_one_id_by_their_texts(spark, frame):
    """A clean text survives a copy under its id; of equal rows one stays; a class keeps one row."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (1, long), (5, long), (5, "another text altogether"), (7, "seven"), (7, "seven too"), (None, long)]
    docs = corpus_pipeline.near_dedup(spark, frame(rows), SMALL)
    assert docs.columns == frame([]).columns
    kept = sorted([(r["doc_id"], r["text"]) for r in docs.collect()], key=repr)
    assert kept == sorted([rows[0], *rows[3:]], key=repr)


def test_odd_documents(spark, frame):
    docs = frame(ODD)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == frame([]).columns
    kept = [r["doc_id"] for r in docs.collect()]
    assert kept.count(None) == 2 and kept.count(5) == 0 and kept.count(4) == 1  # nothing to learn from: all told
    assert all(not stage(spark, frame([]), SMALL).collect() for _, stage in corpus_pipeline.STAGES)


def test_the_rest_works_without(tmp_path):
    """The entry imports, and names its other queries, where this package is not there."""
    for name in ("__spark_entry__.py", "tidemark"):
        (tmp_path / name).symlink_to(ROOT / name)
    code = (
        "import sys; sys.modules['tidemark.llm'] = None\n"
        "import __spark_entry__ as e; n = e.queries(); assert n and not any(x.startswith('op') and x[2].isdigit() for x in n)\n"
        "assert 'pipeline' not in n and 'tidemark.llm.queries' not in sys.modules"
    )
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True)
