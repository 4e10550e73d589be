"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtax.llm.common import Batches, bounded_sample, texts

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
TRAIN_ROWS = 20_000
CHUNK = 1 << 20
UNKNOWN = "und"


def ngram_counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams of 1 to 3 lower-case characters occur in the text."""
    counts = np.zeros(BUCKETS, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for begin in range(0, len(points), CHUNK):
        for n in ORDERS:
            part = points[begin:begin + CHUNK + n - 1]  # the last n-grams of a chunk reach into the next
            size = len(part) - n + 1
            if size <= 0:
                continue
            mixed = np.full(size, n, np.uint64)
            for k in range(n):
                mixed = (mixed ^ part[k:k + size]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(32)
            counts += np.bincount((mixed & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    return counts


@dataclass
class Model:
    """Languages, their log prior and log probability of each bucket, (BUCKETS, languages)."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray


def train(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS
) -> Model:
    """Fit on a sample of about ``rows`` rows at most, chosen by a hash of the id; rows without text or language do not count.

    Tasks count n-grams; the driver gets the summed counts alone, at most BUCKETS per language.
    """
    known = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.where("text is not null and lang is not null")

    def work(batches: Batches) -> Batches:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                counts = total.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                counts[:-1] += ngram_counts(text)
                counts[-1] += 1
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(counts[at])], ["lang", "bucket", "n"])

    parts = bounded_sample(known, rows, [F.col("id")]).select("text", "lang").mapInArrow(work, "lang string, bucket bigint, n bigint")
    summed = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(summed["lang"].unique())
    table = np.zeros((BUCKETS + 1, len(languages)))
    table[summed["bucket"].to_numpy(np.int64), np.searchsorted(languages, summed["lang"].to_numpy())] = summed["n"].to_numpy()
    counts, documents = table[:-1] + 0.5, table[-1]
    return Model(languages, np.log(documents / max(1, documents.sum())), np.log(counts / counts.sum(axis=0)).astype(np.float32))


def predictions(many: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and posterior of each text."""
    pred, score = [UNKNOWN] * len(many), np.zeros(len(many))
    judged = [i for i, t in enumerate(many) if t and model.languages and any(map(str.isalpha, t))]
    for begin in range(0, len(judged), 64):
        some = judged[begin:begin + 64]
        sparse = []
        for i in some:
            counts = ngram_counts(many[i])
            at = np.flatnonzero(counts)
            sparse.append((at, counts[at]))
        bucket, times = (np.concatenate(x) for x in zip(*sparse))
        first = np.cumsum([0] + [len(at) for at, _ in sparse[:-1]])
        logs = np.add.reduceat(model.weights[bucket] * times[:, None], first, axis=0) + model.prior
        for i, b, row in zip(some, logs.argmax(axis=1).tolist(), logs):
            pred[i], score[i] = model.languages[b], 1 / np.exp(row - row[b]).sum()
    return pred, score


def _shared(df: DataFrame, model: Model):
    """Broadcast as plain values: workers know no class of this package."""
    return df.sparkSession.sparkContext.broadcast((model.languages, model.prior, model.weights))


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id, lang_pred, score`` (posterior of the language, 0 to 1).

    Null texts and texts without a letter are ``und`` with score 0, and so is everything if the model knows no language. Ties go to
    the first language by name. Empty in, empty out.
    """
    rows, shared = texts(df, id_col, text_col, key=False), _shared(df, model)

    def work(batches: Batches) -> Batches:
        model = Model(*shared.value)
        for batch in batches:
            pred, score = predictions(batch.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def keep_identified(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that ``identify`` gives a language, however doubtful; all columns stay as they are.

    Rows with a null text or one without a letter go, and all go if the model knows no language. Repeated rows stay repeated.
    """
    shared = _shared(df, model)

    def work(batches: Batches) -> Batches:
        model = Model(*shared.value)
        for batch in batches:
            pred, _ = predictions(batch.column(batch.schema.get_field_index(text_col)).to_pylist(), model)
            yield batch.filter(pa.array([p != UNKNOWN for p in pred], pa.bool_()))

    return df.mapInArrow(work, df.schema)
