"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import (
    chat,
    conversations,
    decontaminate,
    divergence,
    html_main,
    jaccard_join,
    licenses,
    line_crf,
    ngram_lm,
    packing,
    quality_rules,
    simhash,
    token_files,
)
from tabulon.llm.common import crc_mod
from tabulon.llm.sql import SQL
from tabulon.sources.tables import read_table


def held_out(column: str) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(crc_mod(column, 3) == 1, F.lit(False))


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read_table(spark, sf, "documents").select("doc_id", "text"))


def op6_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    held = F.coalesce(crc_mod("doc_id", 10) == 0, F.lit(False))
    return (ngram_lm.language_model(docs.select("doc_id", "text", held.alias("held_out")),
                                    ~F.col("held_out"), order=3)
            .drop("text", "perplexity"))


def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    rules = quality_rules.fit_rules(docs, read_table(spark, sf, "labels"), usable=~held_out("_id"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "rule", "kept")


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf, "documents").select("doc_id", "text"),
                                        read_table(spark, sf, "benchmark"))
    return found.drop("items")


def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    model = line_crf.fit_lines(docs, read_table(spark, sf, "labels"), usable=~held_out("_id"))
    return line_crf.score_documents(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op3_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """Every message without quotes, with its place in the order of replies."""
    return chat.linked_messages(read_table(spark, sf, "conversations")).select(
        "conv_id", "turn", "role", F.sha2("text", 256).alias("text_sha256"),
        F.length("text").cast("long").alias("n_chars"), "reply_to",
        F.col("depth").cast("long").alias("depth"),
        F.array_join(F.col("path").cast("array<string>"), ">").alias("path"),
        "n_quoted", "n_linked")


def op4_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its group and the number of documents it links to."""
    return jaccard_join.near_copies(read_table(spark, sf, "documents")).drop("text_hash")


def op8_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    """Names and number of places of all notices, short ones included."""
    names = F.array_sort(F.array_union("licenses", "phrases"))
    return licenses.notices(read_table(spark, sf, "documents")).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        F.array_join(names, ",").alias("licenses"),
        (F.size("spans") + F.size("phrase_spans")).cast("long").alias("n_spans"))


def op9_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_main.main_text(read_table(spark, sf, "pages"))


def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return token_files.round_trip(read_table(spark, sf, "documents").select("doc_id", "text"),
                                  public_tokenizers.path("byte_bpe_50k.json"))


def op11_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.source_divergence(read_table(spark, sf, "documents"))


def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.audit(read_table(spark, sf, "conversations"))


def op13_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_copies(read_table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_quality_classifier, op3_chat_formatting, op4_jaccard_join,
    op5_packing, op6_lm_scoring, op7_quality_rules, op8_license_scans,
    op9_html_extraction, op10_token_files,
    op11_source_divergence, op12_conversation_repair, op13_simhash)}
