"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct words of a text and, as words are inflected, their first 4 and first 5 characters; the length of the text
does not count. The machine adds a weight per term and, for every two terms, the inner product of their factors, so
that a pair such as an insult with the mention of a group can count for more than the two words do. Half of the factors
count with a minus sign: with them few factors say that two kinds of words tell only where both kinds meet, which sums of
products of one sign cannot. It is trained by AdaGrad on a bounded sample.

Two kinds of terms have a place in the machine: those more frequent in one class, and words that tell in pairs, however
frequent each is in either class. The latter are found by the slope of the loss in all pair weights, a matrix of terms by
terms that is never written out: its outermost eigenvectors hold the words of both sides with opposite signs if the pairs
lie across, with one sign if any two of them tell. They are also where the factors start. A factor is used
if with it the machine foretells better a part of the sample that took no part. All other words have weight and factors 0: else the many plain
words of a long text would add up noise.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtax.functions.staging import cut
from mailtax.llm.common import Batches, bounded_sample, texts

BUCKETS = 1 << 26  # for whole words; as many again for beginnings of words
SIGNS = np.array([1.0, 1.0, -1.0, -1.0])  # of the factors
FACTORS = len(SIGNS)
TRAIN_ROWS = 6_000
LEAST_TEXTS = 3
LEAST_SHARE = 0.015  # of a class, so that a few copies of one text do not make its words telling
LEAST_Z = 5.0
LEAST_PAIRED = 0.004  # share of the sample that holds a word that may tell in pairs, however it is spread over the classes
WRONG_SHARE = 0.1  # expected among the words found by their pairs
STEPS = 60  # of the search for eigenvectors
LEAST_GAIN = 2.0  # standard errors of the held squared error
HELD = 5  # one text in so many judges the factors
TRIAL = 10
EPOCHS = 30
BATCH = 32
RATE = 0.3
SHRINK = 1e-4
WORD = re.compile(rb"[a-z0-9\x80-\xff']+")


def terms(text: bytes, cache: dict[bytes, tuple[int, int, int]]) -> np.ndarray:
    """Sorted buckets of the terms of a text; A-Z count as a-z."""
    words = set(WORD.findall(text.lower()))
    if len(cache) > 300_000:
        cache.clear()
    for w in words:
        if w not in cache:
            letters = w.decode(errors="replace")
            stems = (b"4" + letters[:4].encode(), b"5" + letters[:5].encode())
            cache[w] = (zlib.crc32(w) % BUCKETS, *(BUCKETS + zlib.crc32(x) % BUCKETS for x in stems))
    return np.unique(np.fromiter(chain.from_iterable([cache[w] for w in words]), np.int64, 3 * len(words)))


@dataclass
class Model:
    """Weights and factors of the terms that tell the classes apart (sorted buckets); all others have none."""

    bias: float
    used: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def places(self, bucket: np.ndarray) -> np.ndarray:
        """Where the terms among ``bucket`` that have weights lie in the model."""
        at = np.searchsorted(self.used, bucket)
        at[at == len(self.used)] = 0
        return at[self.used[at] == bucket] if len(self.used) else at[:0]

    def logits(self, at: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of texts whose places lie in ``at`` from ``first`` on; none may be empty."""
        v = self.factors[at]
        sums, squares = np.add.reduceat(v, first, axis=0), np.add.reduceat(v * v, first, axis=0)
        return self.bias + np.add.reduceat(self.weights[at], first) + 0.5 * (sums * sums - squares) @ SIGNS


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Start:
    """Where the factors of some terms (sorted buckets) begin."""

    used: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))

    def only(self, chosen: list[int]) -> Start:
        """With these factors and their terms alone."""
        factors = np.where(np.isin(np.arange(FACTORS), chosen), self.factors, 0)
        some = factors.any(axis=1)
        return Start(self.used[some], factors[some])


def _outer(times, size: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Values and vectors at both ends of the spectrum of a symmetric map, by Lanczos steps with full orthogonalisation."""
    q = rng.normal(size=size)
    basis, middle, beside = [q / np.linalg.norm(q)], [], []
    while True:
        z = times(basis[-1])
        middle.append(basis[-1] @ z)
        known = np.array(basis)
        for _ in range(2):
            z -= known.T @ (known @ z)
        norm = np.linalg.norm(z)
        if len(basis) == min(STEPS, size) or norm < 1e-9:
            break
        beside.append(norm)
        basis.append(z / norm)
    values, turned = np.linalg.eigh(np.diag(middle) + np.diag(beside, 1) + np.diag(beside, -1))
    return values, np.array(basis).T @ turned


def pair_terms(examples: list[np.ndarray], slope: np.ndarray, seed: int = 7) -> Start:
    """Words that tell in pairs, with factors to start from.

    ``slope`` is that of the loss in each text's logit, under a machine without terms; ``examples`` are their words.
    The outermost eigenvectors of sum(-slope * x x') without its diagonal (x: centred and scaled presence of the words)
    propose sides. A word stays if its entry stands out from those of most words by more than chance would let it, and the
    entries are found anew from the words that stayed.
    """
    flat = np.concatenate(examples) if examples else np.zeros(0, np.int64)
    used, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    row, rows, size = np.repeat(np.arange(len(examples)), [len(x) for x in examples]), len(examples), len(used)
    share = count / max(1, rows)
    if size < 3 or (share == 1).all():
        return Start()
    spread, push = np.maximum(np.sqrt(share * (1 - share)), 1 / rows), -slope
    own = (np.bincount(at, push[row], size) * (1 - 2 * share) + share**2 * push.sum()) / spread**2

    def times(q: np.ndarray) -> np.ndarray:
        side = (np.bincount(row, (q / spread)[at], rows) - share @ (q / spread)) * push
        return (np.bincount(at, side[row], size) - share * side.sum()) / spread - own * q

    values, vectors = _outer(times, size, np.random.default_rng(seed))
    factors = np.zeros((size, FACTORS))
    half = FACTORS // 2
    for factor, end in enumerate([*range(-1, -1 - half, -1), *range(half)]):
        if not -len(values) <= end < len(values) or values[end] * SIGNS[factor] <= 0:
            continue
        q = vectors[:, end] * math.sqrt(size)
        for _ in range(4):
            noise = max(1.4826 * float(np.median(np.abs(q))), 1e-12)
            order = np.argsort(-np.abs(q), kind="stable")
            chance = np.array([math.erfc(abs(q[k]) / noise / math.sqrt(2)) for k in order]) * size / np.arange(1, size + 1)
            kept = order[:np.flatnonzero(chance <= WRONG_SHARE).max(initial=-1) + 1]
            sides = np.zeros(size)
            if len(kept) < 2:
                break
            sides[kept] = q[kept] / np.abs(q[kept]).mean()
            q = SIGNS[factor] * times(sides)
        factors[:, factor] = np.clip(sides, -2, 2)
    some = np.abs(factors).sum(axis=1) > 0
    return Start(used[some], factors[some])


def fit(examples: list[np.ndarray], labels: np.ndarray, seed: int = 7, start: Start | None = None, epochs: int = EPOCHS) -> Model:
    """AdaGrad over small batches, both classes with the same total weight. ``examples``: buckets of telling terms."""
    rng = np.random.default_rng(seed)
    used = np.unique(np.concatenate(examples)) if examples else np.zeros(0, np.int64)
    model = Model(0.0, used, np.zeros(len(used)), rng.normal(0, 0.05, (len(used), FACTORS)))
    if start is not None:
        there = np.isin(start.used, used)
        model.factors[np.searchsorted(used, start.used[there])] += start.factors[there]
    positive = int(labels.sum())
    if not 0 < positive < len(labels):  # nothing to tell apart
        return Model(10.0 if positive else -10.0, used[:0], np.zeros(0), np.zeros((0, FACTORS)))
    if not len(used):
        return Model(float(np.log(positive / (len(labels) - positive))), used, model.weights, model.factors)
    known = [model.places(x) for x in examples]
    weight = np.where(labels == 1, len(labels) / (2 * positive), len(labels) / (2 * (len(labels) - positive)))
    step_w, step_v, step_b = np.full(len(used), 1e-4), np.full((len(used), FACTORS), 1e-4), 1e-4
    for _ in range(epochs):
        order = rng.permutation(len(known))
        for begin in range(0, len(order), BATCH):
            batch = order[begin:begin + BATCH]
            g = np.zeros(len(batch))
            some = [k for k, i in enumerate(batch) if len(known[i])]
            logit = np.full(len(batch), model.bias)
            if some:
                size = np.array([len(known[batch[k]]) for k in some])
                bucket, first = np.concatenate([known[batch[k]] for k in some]), np.cumsum(size) - size
                logit[some] = model.logits(bucket, first)
            g = weight[batch] * (_sigmoid(logit) - labels[batch]) / len(batch)
            step_b += g.sum() ** 2
            model.bias -= RATE * g.sum() / np.sqrt(step_b)
            if not some:
                continue
            each = np.repeat(g[some], size)
            term, at = np.unique(bucket, return_inverse=True)
            grad = np.bincount(at, each) + SHRINK * model.weights[term]
            step_w[term] += grad * grad
            v = model.factors[bucket]
            pull = each[:, None] * (np.repeat(np.add.reduceat(v, first, axis=0), size, axis=0) - v) * SIGNS
            grad_v = np.stack([np.bincount(at, pull[:, f]) for f in range(FACTORS)], axis=1) + SHRINK * model.factors[term]
            step_v[term] += grad_v * grad_v
            model.weights[term] -= RATE * grad / np.sqrt(step_w[term])
            model.factors[term] -= RATE * grad_v / np.sqrt(step_v[term])
    return model


def _all_logits(model: Model, examples: list[np.ndarray]) -> np.ndarray:
    known = [model.places(x) for x in examples]
    return np.array([model.logits(x, np.array([0]))[0] if len(x) else model.bias for x in known])


def fit_pairs(alone: list[np.ndarray], words: list[np.ndarray], labels: np.ndarray) -> Model:
    """The machine of the terms that tell by themselves, ``alone``, with those of the four proposed factors of ``words`` that
    lower the squared error on every HELD-th text, by LEAST_GAIN standard errors, when fitted on the others (TRIAL rounds)."""
    held = np.arange(len(labels)) % HELD == 0
    judged, rest = np.flatnonzero(held), np.flatnonzero(~held)
    if min(labels[judged].sum(), (1 - labels[judged]).sum(), labels[rest].sum(), (1 - labels[rest]).sum()) < 2:
        return fit(alone, labels)
    weight = np.where(labels == 1, 1 / labels.mean(), 1 / (1 - labels.mean()))
    slope = weight * (0.5 - labels)

    def machine(rows: np.ndarray, start: Start, epochs: int) -> Model:
        both = [np.union1d(alone[i], words[i][np.isin(words[i], start.used)]) for i in rows]
        return fit(both, labels[rows], start=start, epochs=epochs)

    def losses(model: Model) -> np.ndarray:
        logit = _all_logits(model, [np.union1d(alone[i], words[i]) for i in judged])
        return weight[judged] * (_sigmoid(logit) - labels[judged]) ** 2

    proposed = pair_terms([words[i] for i in rest], slope[rest])
    before, taken = losses(machine(rest, Start(), TRIAL)), []
    for factor in range(FACTORS):
        start = proposed.only([factor])
        if len(start.used):
            gain = before - losses(machine(rest, start, TRIAL))
            if gain.mean() > LEAST_GAIN * gain.std() / math.sqrt(len(gain)):
                taken.append(factor)
    final = pair_terms(words, slope).only(taken) if taken else Start()  # more texts find more words on the same ends
    return machine(np.arange(len(labels)), final, EPOCHS)


def train(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
    rows: int = TRAIN_ROWS,
) -> Model:
    """Fit on about ``rows`` labelled documents at most, chosen by a hash of the id; null labels and ids do not count, and of
    several labels of an id the highest does.

    The sample of labels has a known bound and is broadcast, so texts are not shuffled. Tasks hash the texts and count the
    terms by class; the driver gets the terms whose shares in the classes differ by LEAST_Z standard errors and the words
    that LEAST_PAIRED of the texts hold, and of each sampled document those terms alone.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = F.broadcast(bounded_sample(known, rows, [F.col("doc_id")]))
    labelled = texts(documents, id_col, text_col, key=False).join(sample, "doc_id").select("text", "label")

    def work(batches: Batches) -> Batches:
        cache: dict[bytes, tuple[int, int, int]] = {}
        for batch in batches:
            found = [terms(t, cache) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), batch.column("label")], ["terms", "label"])

    seen = cut(labelled.mapInArrow(work, "terms array<bigint>, label int").distinct())
    size = {row["label"]: row["count"] for row in seen.groupBy("label").count().collect()}
    zeros, ones = max(1, size.get(0, 0)), max(1, size.get(1, 0))
    counts = seen.select(F.explode("terms").alias("term"), "label").groupBy("term").agg(
        F.sum("label").alias("b"), F.sum(1 - F.col("label")).alias("a")
    )
    share = (F.col("a") + F.col("b")) / (zeros + ones)
    error = F.sqrt(share * (1 - share) * (1 / zeros + 1 / ones))
    apart = F.abs(F.col("b") / ones - F.col("a") / zeros)
    often = (F.col("a") + F.col("b") >= LEAST_TEXTS) & (F.greatest(F.col("a") / zeros, F.col("b") / ones) >= LEAST_SHARE)
    alone = often & (apart >= LEAST_Z * error)
    paired = (F.col("term") < BUCKETS) & (F.col("a") + F.col("b") >= max(LEAST_TEXTS, LEAST_PAIRED * (zeros + ones)))
    chosen = counts.where(alone | paired).select("term", alone.alias("alone"), paired.alias("paired")).toPandas()
    telling, words = (np.sort(chosen["term"].to_numpy(np.int64)[chosen[c].to_numpy(bool)]) for c in ("alone", "paired"))
    used = np.union1d(telling, words)

    def shorten(batches: Batches) -> Batches:
        for batch in batches:
            short = [x[np.isin(x, used)] for x in (row.values.to_numpy() for row in batch.column("terms"))]
            yield pa.RecordBatch.from_arrays([pa.array(short, pa.list_(pa.int64())), batch.column("label")], ["terms", "label"])

    got = seen.mapInArrow(shorten, "terms array<bigint>, label int").toPandas()
    found = [np.array(x, np.int64) for x in got["terms"]]
    # tasks end in any order; a hash, so that the held part is one of all kinds of texts
    order = sorted(range(len(got)), key=lambda i: (zlib.crc32(found[i].tobytes()), found[i].tobytes(), got["label"][i]))
    found, label = [found[i] for i in order], got["label"].to_numpy(np.int64)[order]
    return fit_pairs([x[np.isin(x, telling)] for x in found], [x[np.isin(x, words)] for x in found], label)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id, score`` (0 to 1). Null and empty texts and those without a word have the score of
    the bias alone. Empty in, empty out."""
    rows = texts(df, id_col, text_col, key=False)
    shared = df.sparkSession.sparkContext.broadcast((model.bias, model.used, model.weights, model.factors))  # plain values: workers know no class of this package

    def work(batches: Batches) -> Batches:
        model, cache = Model(*shared.value), {}
        for batch in batches:
            values = np.full(batch.num_rows, model.bias)
            for begin in range(0, batch.num_rows, 256):
                some = batch.column("text").slice(begin, 256).cast(pa.binary()).to_pylist()
                found = [model.places(terms(t, cache)) for t in some]
                at = [i for i, x in enumerate(found) if len(x)]
                if at:
                    first = np.cumsum([0] + [len(found[i]) for i in at[:-1]])
                    values[begin + np.array(at)] = model.logits(np.concatenate([found[i] for i in at]), first)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_sigmoid(values))], ["doc_id", "score"])

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
