"""Text quality by random-indexing word vectors and a two-layer network.

A token is a run of letters and digits or a run of other signs, as it is written. Each of BUCKETS hashed tokens has a fixed random
index vector of signs. Its context vector is the sum of the index vectors of the tokens up to REACH places away, over all documents;
no label is needed for that, so Spark sums it over the whole corpus. A text is pooled to the mean and the spread of its tokens'
unit context vectors, the mean product of the index vectors of neighbours (high where tokens repeat) and the logarithm of its length.

Two dense layers in numpy, fitted by Adam on a bounded sample of labelled documents, turn that into a logit. A part of the
sample is left out of the fit; it says when to stop, and the temperature that makes the probabilities fit best is found on it.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtax.functions.staging import cut
from mailtax.llm.common import Batches, bounded_sample, texts

BUCKETS = 1 << 13
DIMENSIONS = 32
REACH = 2
TRAIN_ROWS = 6_000
HIDDEN = 32
EPOCHS = 100
PATIENCE = 15
BATCH = 128
RATE = 3e-3
DECAY = 1e-3
HELD_BACK = 5  # every fifth labelled document of the sample is for stopping and temperature
PIECE = 1 << 16  # tokens that are looked up at once
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+")
INPUTS = 3 * DIMENSIONS + 1


def index_vectors(seed: int = 5) -> np.ndarray:
    """(BUCKETS + 1, DIMENSIONS) signs; the last row, which stands between texts, is zero."""
    signs = np.random.default_rng(seed).integers(0, 2, (BUCKETS + 1, DIMENSIONS)) * 2 - 1
    signs[-1] = 0
    return signs.astype(np.float32)


class Buckets(dict):
    """Token to bucket, remembered; forgets all when it grows large."""

    def __missing__(self, token: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[token] = found = zlib.crc32(token) % BUCKETS
        return found


def buckets(text: bytes, known: Buckets) -> np.ndarray:
    """Buckets of the tokens of a text in their order."""
    return np.fromiter((known[t] for t in TOKEN.findall(text)), np.int64)


def add_contexts(total: np.ndarray, many: list[np.ndarray], index: np.ndarray) -> None:
    """Add to ``total`` (BUCKETS, DIMENSIONS) what the texts' tokens have around them; nothing reaches into another text."""
    gap = np.full(REACH, BUCKETS)
    run = np.concatenate([gap] + [x for text in many for x in (text, gap)])
    for begin in range(0, len(run), PIECE):
        first, last = max(0, begin - REACH), min(len(run), begin + PIECE + REACH)
        part = run[first:last]
        own = slice(begin - first, min(len(run), begin + PIECE) - first)
        for d in range(DIMENSIONS):
            signs = index[part, d]
            around = np.zeros(len(part), np.float32)
            for step in range(1, REACH + 1):
                around[step:] += signs[:-step]
                around[:-step] += signs[step:]
            total[:, d] += np.bincount(part[own], around[own], BUCKETS + 1)[:BUCKETS].astype(np.int64)


def unit(contexts: np.ndarray) -> np.ndarray:
    """Context vectors of length 1 (those of unknown tokens 0), with a zero row for the gap."""
    size = np.sqrt((contexts.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return np.concatenate([contexts / np.maximum(size, 1), np.zeros((1, DIMENSIONS))]).astype(np.float32)


def pooled(text: np.ndarray, vectors: np.ndarray, index: np.ndarray) -> np.ndarray:
    """INPUTS numbers of a text, given its tokens' buckets; zeros for a text without any."""
    n = len(text)
    if not n:
        return np.zeros(INPUTS)
    sums = np.zeros((3, DIMENSIONS))
    for begin in range(0, n, PIECE):
        part = text[begin:begin + PIECE + 1]
        v = vectors[part[:PIECE]].astype(np.float64)  # else spreads near zero are noise
        sums[0] += v.sum(axis=0)
        sums[1] += (v * v).sum(axis=0)
        sums[2] += (index[part[:-1]] * index[part[1:]]).sum(axis=0, dtype=np.float64)
    mean = sums[0] / n
    spread = np.sqrt(np.maximum(sums[1] / n - mean * mean, 0))
    return np.concatenate([mean, spread, sums[2] / max(1, n - 1), [np.log1p(n)]])


def word_vectors(documents: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit context vectors from all rows; the driver gets the summed vectors alone, BUCKETS at most."""

    def work(batches: Batches) -> Batches:
        index, known, total = index_vectors(), Buckets(), np.zeros((BUCKETS, DIMENSIONS), np.int64)
        for batch in batches:
            add_contexts(total, [buckets(t, known) for t in batch.column("text").cast(pa.binary()).to_pylist()], index)
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(total[at, d]) for d in range(DIMENSIONS)]], ["bucket", *columns])

    columns = [f"d{d}" for d in range(DIMENSIONS)]
    rows = documents.select(F.col(text_col).alias("text")).where("text is not null")
    parts = rows.mapInArrow(work, ", ".join(["bucket bigint", *[f"{c} bigint" for c in columns]]))
    summed = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
    contexts = np.zeros((BUCKETS, DIMENSIONS))
    contexts[summed["bucket"].to_numpy(np.int64)] = summed[columns].to_numpy(np.float64)
    return unit(contexts)


@dataclass
class Network:
    """Inputs are shifted and scaled, then go through a layer of tanh and one of a single logit, divided by the temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    temperature: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1)
        return _sigmoid((hidden @ self.w2 + self.b2) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit))


def best_temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by halving steps on a logarithmic scale.

    The targets are pulled in as if either class had one more text, so that classes without an error do not ask for certainty.
    """
    y = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    at, step = 0.0, 1.0
    while step > 1e-3:
        at = min((at - step, at, at + step), key=lambda t: _loss(logit / np.exp(t), y))
        step /= 2
    return float(np.exp(np.clip(at, -2, 3)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network:
    """Adam on all but every HELD_BACK-th row, in a shuffled order. One class alone: its constant probability."""
    rng = np.random.default_rng(seed)
    size = x.shape[1]
    if len(y) < 2 * HELD_BACK or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Network(np.zeros(size), np.ones(size), np.zeros((size, 1)), np.zeros(1), np.zeros(1), np.log(share / (1 - share)), 1.0)
    order = rng.permutation(len(y))
    x, y = x[order], y[order].astype(np.float64)
    back = np.arange(len(y)) % HELD_BACK == 0
    shift, scale = x[~back].mean(axis=0), x[~back].std(axis=0) + 1e-6
    z = (x - shift) / scale
    weights = [rng.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    one, two = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    best, kept, since, t = np.inf, [w.copy() for w in weights], 0, 0
    own = np.flatnonzero(~back)

    def logits(rows: np.ndarray) -> np.ndarray:
        return np.tanh(z[rows] @ weights[0] + weights[1]) @ weights[2] + weights[3]

    for _ in range(EPOCHS):
        rng.shuffle(own)
        for begin in range(0, len(own), BATCH):
            rows = own[begin:begin + BATCH]
            hidden = np.tanh(z[rows] @ weights[0] + weights[1])
            g = (_sigmoid(hidden @ weights[2] + weights[3]) - y[rows]) / len(rows)
            down = np.outer(g, weights[2]) * (1 - hidden * hidden)
            grads = [z[rows].T @ down + DECAY * weights[0], down.sum(axis=0), hidden.T @ g + DECAY * weights[2], np.array([g.sum()])]
            t += 1
            for w, a, b, d in zip(weights, one, two, grads):
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                w -= RATE * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
        now = _loss(logits(np.flatnonzero(back)), y[back])
        since += 1
        if now < best - 1e-4:
            best, kept, since = now, [w.copy() for w in weights], 0
        if since >= PATIENCE:
            break
    weights = kept
    return Network(shift, scale, *kept, best_temperature(logits(np.flatnonzero(back)), y[back]))


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def train(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
    rows: int = TRAIN_ROWS,
) -> Model:
    """Word vectors from all ``documents``, the network from about ``rows`` labelled ones at most, chosen by a hash of the id.

    Null labels and ids do not count; of several labels of an id the highest does. The sample of labels has a known bound and is
    broadcast, so texts are not shuffled; tasks pool the texts and the driver gets INPUTS numbers for each.
    """
    vectors = word_vectors(documents, text_col)
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = F.broadcast(bounded_sample(cut(known), rows, [F.col("doc_id")]))
    labelled = texts(documents, id_col, text_col, key=False).join(sample, "doc_id").select("text", "label")
    shared = documents.sparkSession.sparkContext.broadcast(vectors)

    def work(batches: Batches) -> Batches:
        index, known = index_vectors(), Buckets()
        for batch in batches:
            x = [pooled(buckets(t, known), shared.value, index) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("label")], ["x", "label"])

    got = labelled.mapInArrow(work, "x array<double>, label int").toPandas()
    x = np.array(got["x"].tolist(), np.float64).reshape(-1, INPUTS)
    order = np.lexsort((*x.T, got["label"]))  # tasks end in any order
    return Model(vectors, fit(x[order], got["label"].to_numpy(np.int64)[order]))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id, score``, the probability of label 1.

    Null and empty texts and those of white space are pooled to zeros and get the score of that. Whole texts count, of any
    length, in pieces. Empty in, empty out.
    """
    rows = texts(df, id_col, text_col, key=False)
    n = model.network
    shared = df.sparkSession.sparkContext.broadcast((model.vectors, (n.shift, n.scale, n.w1, n.b1, n.w2, n.b2, n.temperature)))  # plain values

    def work(batches: Batches) -> Batches:
        vectors, parts = shared.value
        network, index, known = Network(*parts), index_vectors(), Buckets()
        for batch in batches:
            x = [pooled(buckets(t, known), vectors, index) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            p = network.probabilities(np.array(x).reshape(-1, INPUTS)).reshape(-1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
