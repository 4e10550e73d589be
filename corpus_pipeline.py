"""A training-data pipeline: languages, near duplicates, benchmark passages, secrets, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns the columns of ``documents``; the last one
returns token ids and what they decode to. ``run`` writes each stage's result and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailtax.functions.staging import cut
from mailtax.llm import bpe, decontaminate, langid, secrets, simhash
from mailtax.llm.common import fold
from mailtax.llm.queries import TOKENIZER, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that get a language; those called ``und`` (null texts and texts without letters) go."""
    return langid.keep_identified(docs, langid.train(docs.where(fold("doc_id", 3) != 1)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints of four-word shingles linked at 4 bits or less, the one with the smallest id."""
    return simhash.keep_first(docs, words=4, bits=4)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of ``benchmark``."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; ``n_chars`` follows the text."""
    out = secrets.redact(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit) of every document, and ``text``, what the ids decode to."""
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER), decoded=True)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("secrets", redact_secrets),
    ("bpe", encode_tokens),
]
ORACLE_SQL = None  # classifier, fingerprints and merges are beyond SQL; tests/llm hold it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
