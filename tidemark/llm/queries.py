"""The operators as queries over the test tables, with SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversations,
    decontaminate,
    exact,
    language,
    licences,
    packing,
    pieces,
    simhash,
    spelling,
    substring,
    suffixes,
    toxicity,
)
from tidemark.llm import pages as web
from tidemark.llm.base import held_out, query, table

RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def tokenizer() -> tuple[str, str]:
    """The ranks of the byte-level vocabulary and the pattern that splits text for it."""
    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


@query("op1_substring_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(table(spark, sf_dir, "documents"))


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


EXACT_SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""


@query("op3_exact_dedup", EXACT_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact.exact_dedup(docs).select("doc_id", *["keep_id", "group_size", "kept", "text_sha256"])


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~held_out("doc_id")))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    ids = F.crc32("ids").alias("ids_crc32")
    columns = ["doc_id", "start", "length", ids, "doc_tokens", "bucket", "sequence_id", "offset"]
    return packing.pack(docs, *tokenizer()).select(*columns)


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_html_text")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(spark, sf_dir, docs)
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    open_ids = ~held_out("doc_id")
    return toxicity.train(docs.where(open_ids), table(spark, sf_dir, "labels").where(open_ids))


@query("op10_licences")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@query("op11_sentencepiece")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.crc32(F.concat("starts", "stops")).alias("spans_crc32"),
    )


@query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op13_conversation_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.trie(table(spark, sf_dir, "conversations"))
