"""The operators as queries over the given tables: ``fn(spark, sf_dir) -> DataFrame``, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailtax.llm import (
    bpe, conversations, decontaminate, langid, licences, packing, quality, ranking, secrets, simhash, suffixes, topk, toxicity,
)
from mailtax.llm.common import fold

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(documents, labels.where(fold("doc_id", 5) != 0), label_col="toxic")
    return toxicity.score(documents, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), decoded=True)
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    )


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4).select("doc_id", "fingerprint", "component_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.train(documents.where(fold("doc_id", 3) != 1))
    return langid.identify(documents, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), 400).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("has_repeats"),
    )


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(documents, labels.where(fold("doc_id", 4) != 2), label_col="quality")
    return quality.score(documents, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_conversations(table(spark, sf_dir, "conversations"))


def op13_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_licence_scan, op2_toxicity, op3_bpe, op4_top_k, op5_simhash, op6_language, op7_packing, op8_secrets,
        op9_decontaminate, op10_repeats, op11_quality, op12_conversations, op13_ranking,
    )
    return {f.__name__: f for f in found}


def llm_sql() -> dict[str, str]:
    return {
        "op1_licence_scan": licences.scan_sql(),
        "op4_top_k": topk.top_k_sql(),
        "op9_decontaminate": decontaminate.decontaminate_sql(),
        "op13_ranking": ranking.rank_sql(),
    }
