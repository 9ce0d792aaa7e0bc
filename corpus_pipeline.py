"""A corpus pipeline of stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import decontaminate
from tidemark.llm.language import UNKNOWN, LanguageIdentifier, training_rows
from tidemark.llm.pii import pseudonyms
from tidemark.llm.queries import PIECE_MODEL, PII_KEY
from tidemark.llm.sentencepieces import encode_documents
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.text import staged, table

LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score of at least ``LEAST_SCORE``; ``und`` goes.

    If no row has a language to learn from, nothing can be told and all stay.
    """
    known = LanguageIdentifier(training_rows(docs, "doc_id", "text", "lang", folds=5, held_out=0))
    if not known.model.labels:
        return docs
    found = known.predict(F.col("text"))
    return docs.where(found["score"] >= F.when(found["lang"] != UNKNOWN, LEAST_SCORE).otherwise(2.0))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: of those with the least doc_id, the one with the least text hash.

    A row is told by its doc_id and 128 bits of its text's hash, so another text
    under the same doc_id is judged by itself. Of rows equal in both one
    stays. Rows without a doc_id cannot be told apart and stay.
    """
    body = F.col("text")
    row = F.struct("doc_id", F.xxhash64(body).alias("__a"), F.xxhash64(F.lit(7), body).alias("__b"))
    known = docs.where(F.col("doc_id").isNotNull())
    found = near_duplicates(known.select(row.alias("row"), "text"), key="row")
    found = staged(found.select("row", (F.col("row") == F.col("component_id")).alias("least")), "near")
    rows = found.groupBy("row").agg(F.first("least").alias("least"), F.count(F.lit(1)).alias("n"))
    gone = rows.where(~F.col("least")).select("row.*")
    twice = rows.where(F.col("least") & (F.col("n") > 1)).select("row.*")
    on = ["doc_id", "__a", "__b"]
    told = docs.withColumns({c: row[c] for c in on[1:]})
    once = told.join(gone.unionByName(twice), on, "left_anti")
    one_of = told.join(twice, on, "left_semi").dropDuplicates(on)
    return once.unionByName(one_of).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a test item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by pseudonyms."""
    text = pseudonyms(F.col("text"), PII_KEY)["text"]
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document that is left."""
    rows = encode_documents(docs, PIECE_MODEL)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("sentencepiece", sentencepiece),
]
#: Language models, pseudonyms and subword ids cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
