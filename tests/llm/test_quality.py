from __future__ import annotations

import re
import zlib

import numpy as np

from mailtax.llm import quality
from mailtax.llm.common import fold
from tests.llm.conftest import SF_DIR

MIDDLE = "/root/testdata/sf0.01"
LABELLED = "doc_id long, text string"


def plain_contexts(texts):
    index = quality.index_vectors()
    total = np.zeros((quality.BUCKETS, quality.DIMENSIONS))
    for text in texts:
        tokens = [zlib.crc32(t.encode()) % quality.BUCKETS for t in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff\s]+", text)]
        for i, t in enumerate(tokens):
            for j in range(max(0, i - quality.REACH), min(len(tokens), i + quality.REACH + 1)):
                if i != j:
                    total[t] += index[tokens[j]]
    return total


def plain_input(text, vectors, index):
    tokens = [zlib.crc32(t.encode()) % quality.BUCKETS for t in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff\s]+", text)]
    if not tokens:
        return np.zeros(quality.INPUTS)
    rows = np.array([vectors[t] for t in tokens], np.float64)
    pairs = [index[a] * index[b] for a, b in zip(tokens, tokens[1:])]
    around = np.mean(pairs, axis=0) if pairs else np.zeros(quality.DIMENSIONS)
    return np.concatenate([rows.mean(axis=0), rows.std(axis=0), around, [np.log(1 + len(tokens))]])


def test_word_vectors_by_brute_force(spark, rng, monkeypatch):
    words = ["the", "The", "Ärger", "!!", "a,b", "|", "x1"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string").repartition(4)
    want = plain_contexts(texts)
    got = quality.word_vectors(df)
    size = np.sqrt((want**2).sum(axis=1, keepdims=True))
    assert np.allclose(got[:-1], want / np.maximum(size, 1), atol=1e-6) and not got[-1].any()
    monkeypatch.setattr(quality, "PIECE", 5)  # long texts go in pieces
    total = np.zeros((quality.BUCKETS, quality.DIMENSIONS), np.int64)
    known = quality.Buckets()
    quality.add_contexts(total, [quality.buckets(t.encode(), known) for t in texts], quality.index_vectors())
    assert (total == want).all()


def test_scores_by_brute_force(spark, rng):
    texts = [(i, " ".join(rng.choices(["good", "prose", "of", "words", "&&&"], k=rng.randint(0, 30)))) for i in range(40)]
    documents = spark.createDataFrame(texts, LABELLED)
    labels = spark.createDataFrame([(i, int("&&&" not in t)) for i, t in texts], "doc_id long, label int")
    model = quality.train(documents, labels)
    n, index = model.network, quality.index_vectors()
    for r in quality.score(documents, model).collect():
        x = plain_input(dict(texts)[r.doc_id], model.vectors, index)
        hidden = [np.tanh(((x - n.shift) / n.scale * n.w1[:, j]).sum() + n.b1[j]) for j in range(n.w1.shape[1])]
        logit = (sum(h * w for h, w in zip(hidden, n.w2)) + float(np.ravel(n.b2)[0])) / n.temperature
        assert abs(r.score - 1 / (1 + np.exp(-logit))) < 1e-4


def test_held_out_documents(spark):
    documents, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(documents, labels.where(fold("doc_id", 4) != 2), label_col="quality")
    rows = quality.score(documents, model).join(labels, "doc_id").where(fold("doc_id", 4) == 2).collect()
    assert len(rows) > 60 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.score >= 0.7 for r in rows if r.quality]) > 0.95
    assert np.mean([r.score < 0.7 for r in rows if not r.quality]) > 0.8


def test_temperature_calibrates(rng):
    """Logits three times too large: the temperature brings them back, and frequencies follow the probabilities."""
    x = np.random.default_rng(1).normal(0, 2, 20_000)
    y = (np.random.default_rng(2).random(20_000) < 1 / (1 + np.exp(-x))).astype(float)
    t = quality.best_temperature(3 * x, y)
    assert abs(t - 3) < 0.15
    p = 1 / (1 + np.exp(-3 * x / t))
    for low in np.arange(0, 1, 0.2):
        some = (p >= low) & (p < low + 0.2)
        assert abs(p[some].mean() - y[some].mean()) < 0.03
    assert np.isfinite(quality.best_temperature(x, (x > 0).astype(float)))


def test_nonlinear_classes_are_learned():
    """Labels by the sign of a product, which no single layer can tell."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (3000, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    network = quality.fit(x[:2400], y[:2400])
    assert np.mean((network.probabilities(x[2400:]) > 0.5) == y[2400:]) > 0.9


def test_odd_rows(spark, odd, empty):
    texts = [(i, "clean words of prose here" if i % 3 else "&&& *** ###") for i in range(60)]
    documents = spark.createDataFrame(texts, LABELLED)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(50)] + [(0, 0), (None, 1), (51, None)], "doc_id long, label int")
    model = quality.train(documents, labels)
    rows = quality.score(odd, model).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in rows if r.doc_id == 4}) == 1
    assert quality.score(documents, model).where("score >= 0.7").count() == 40
    assert quality.score(empty, model).isEmpty()
    for few in (labels.limit(0), labels.where("label = 1")):
        assert all(0 <= r.score <= 1 for r in quality.score(odd, quality.train(documents, few)).collect())
    assert quality.score(odd, quality.train(empty, labels)).count() == 9


def test_query_is_the_contract(spark):
    from mailtax.llm.queries import op11_quality

    rows = op11_quality(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
