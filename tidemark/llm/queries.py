"""The registered corpus queries: each applies one operator, with its production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe_chunks,
    conversation_repair,
    embedding_whitening,
    language_ppm,
    license_lr,
    nn_descent,
    phrase_automata,
    quality_fm,
    simhash_golay,
    template_decontam,
    token_fst,
    toxicity_ordinal,
    url_cascade,
)
from tidemark.llm.frames import table


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_fm.score(docs, quality_fm.fit(docs, table(spark, sf_dir, "labels")))


def op2_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.digests(table(spark, sf_dir, "documents"))


def op3_template_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_decontam.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge(table(spark, sf_dir, "pages"))


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_license_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_lr.scan(docs, license_lr.fit(docs))


def op7_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_golay.near_duplicates(table(spark, sf_dir, "documents"))


def op8_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_ordinal.score(docs, toxicity_ordinal.fit(docs, table(spark, sf_dir, "labels")))


def op9_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_token_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_fst.token_counts(table(spark, sf_dir, "documents"))


def op11_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_ppm.predict(docs, language_ppm.fit(docs)).drop("bits")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.summary(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_quality_fm, op2_bpe_chunks, op3_template_decontam, op4_url_cascade, op5_nn_descent, op6_license_lr,
    op7_simhash_golay, op8_toxicity_ordinal, op9_phrase_automata, op10_token_fst, op11_language_ppm, op12_embedding_whitening,
    op13_conversation_repair)}
#: Where SQL can express the whole result at whole size; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op4_url_cascade": url_cascade.oracle(), "op13_conversation_repair": conversation_repair.oracle()}
