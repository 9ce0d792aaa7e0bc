"""Registered queries of this package: thin digests of what its operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chat import examples, read_back
from tidemark.llm.decontamination import contamination
from tidemark.llm.language import identify
from tidemark.llm.merkle import manifest
from tidemark.llm.packing import pack_documents
from tidemark.llm.pii import pseudonymise
from tidemark.llm.quality import quality
from tidemark.llm.search import search
from tidemark.llm.sentencepieces import encode_documents
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.statements import OP2, OP5, OP7, OP11, OP12
from tidemark.llm.substrings import remove_repeats
from tidemark.llm.text import ascii_lower, id_crc, table
from tidemark.llm.toxicity import toxicity
from tidemark.llm.urls import filter_urls

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")

#: Verdict, host and path of the given URL rules.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: For the test tables only; a real key comes from the caller's vault.
PII_KEY = b"tidemark test tables"


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _sha(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    rows = encode_documents(table(spark, folder, "documents"), PIECE_MODEL)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        _sha(F.col("decoded")).alias("decoded_sha256"),
    )


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    schema = "conv_id bigint, turn bigint, role string, text string"
    own = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(examples(turns.unionByName(spark.createDataFrame(own, schema))))


def op6_urls(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(table(spark, folder, "pages"), table(spark, folder, "labels"), URL_RULES)


def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    rows = remove_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", _sha(F.col("kept")).alias("kept_sha256"))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    rows = pseudonymise(table(spark, folder, "documents"), PII_KEY)
    return rows.select("doc_id", F.size("spans").cast("long").alias("n_replaced"), "text", "spans")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    lowered = F.when(id_crc("doc_id", 5) == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    rows = manifest(
        table(spark, folder, "documents"),
        ["doc_id", "source", "lang", "n_chars", "text"],
        presented={"text": lowered},
        with_path=False,
    )
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    rows = pack_documents(table(spark, folder, "documents"), WORD_MODEL, with_ids=False)
    return rows.drop("loss_tokens")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_chat": op5_chat,
    "op6_urls": op6_urls,
    "op7_substrings": op7_substrings,
    "op8_language": op8_language,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    "op11_merkle": op11_merkle,
    "op12_search": op12_search,
    "op13_packing": op13_packing,
}
STATEMENTS: dict[str, str] = {
    "op2_decontamination": OP2,
    "op5_chat": OP5,
    "op7_substrings": OP7,
    "op11_merkle": OP11,
    "op12_search": OP12,
}
