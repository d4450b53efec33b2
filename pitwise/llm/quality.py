"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network with calibrated probabilities.

Every word bucket has a sparse random index vector. A word's vector is the sum of the index vectors of its neighbours over all documents, so the
vectors are counts that tasks add up and the shuffle merges. A document is the mean and the spread of its words' vectors. The network and its
temperature are fitted on a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import MAX_WORDS_CACHED, map_batches, pieces
from pitwise.session import materialize

BUCKETS = 8192          # hashed words
WIDTH = 32              # numbers of a word vector
NONZERO = 4             # entries of an index vector
REACH = 2               # neighbours on either side
_PAD, _REPEAT = 0, 1    # buckets of no word, and of a word equal to the one before it
_CHUNK = 100_000        # tokens whose contexts are added at once
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\s0-9a-z\x80-\xff]+")


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS_CACHED:
            self.clear()
        self[word] = value = 2 + xxhash.xxh3_64_intdigest(word) % (BUCKETS - 2)
        return value


def tokens(raw: bytes | None, buckets: _Buckets) -> np.ndarray:
    """Buckets of the words and runs of signs of a text; a token equal to the one before it is the repeat mark."""
    found = _TOKEN.findall(raw.lower()) if raw else []
    ids = np.fromiter(map(buckets.__getitem__, found), np.int64, len(found))
    same = np.flatnonzero(ids[1:] == ids[:-1]) + 1
    ids[same] = _REPEAT
    return ids


def index_vectors(seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of every bucket's index vector; the pad has none."""
    rng = np.random.default_rng(seed)
    places = rng.integers(0, WIDTH, (BUCKETS, NONZERO))
    signs = np.tile(np.array([1.0, -1.0] * (NONZERO // 2)), (BUCKETS, 1))
    signs[_PAD] = 0.0
    return places, signs


def add_contexts(ids: np.ndarray, places: np.ndarray, signs: np.ndarray, out: np.ndarray) -> None:
    """Adds, for each token of a padded sequence, the index vectors of its neighbours to its word's row of ``out`` (flat)."""
    for shift in (s for s in range(-REACH, REACH + 1) if s):
        own = ids[REACH:len(ids) - REACH]
        other = ids[REACH + shift:len(ids) - REACH + shift]
        at = (own[:, None] * WIDTH + places[other]).ravel()
        out += np.bincount(at, signs[other].ravel(), out.size)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all word buckets from the neighbours of words in all documents: BUCKETS x WIDTH numbers, whatever the input."""
    places, signs = index_vectors()
    buckets = _Buckets()

    def run(batches):
        total = np.zeros(BUCKETS * WIDTH)
        held, size = [], 0

        def flush():
            if held:
                add_contexts(np.concatenate([np.zeros(REACH, np.int64), *held]), places, signs, total)
                held.clear()
        for batch in pieces(batches):
            for raw in batch.column(0).to_pylist():
                ids = tokens(raw, buckets)
                if len(ids) > _CHUNK:       # a very long text goes piece by piece, each with the neighbours that its ends have
                    padded = np.concatenate((np.zeros(REACH, np.int64), ids, np.zeros(REACH, np.int64)))
                    for i in range(0, len(ids), _CHUNK):
                        add_contexts(padded[i:i + _CHUNK + 2 * REACH], places, signs, total)
                    continue
                held += [ids, np.zeros(REACH, np.int64)]
                size += len(ids)
                if size >= _CHUNK:
                    flush()
                    size = 0
        flush()
        rows = total.reshape(BUCKETS, WIDTH)
        rows[_PAD] = 0
        used = np.flatnonzero(rows.any(axis=1))
        if len(used):
            values = pa.array(rows[used].astype(np.int64).ravel(), pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * WIDTH, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), lists], names=["bucket", "v"])
    parts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "bucket int, v array<bigint>")
    merged = parts.groupBy("bucket").agg(*[F.sum(F.get("v", F.lit(i))).alias(f"v{i}") for i in range(WIDTH)])
    table = np.zeros((BUCKETS, WIDTH))
    for row in merged.collect():
        table[row[0]] = row[1:]
    table -= table.sum(axis=0) / max(1, np.count_nonzero(table.any(axis=1))) * (table.any(axis=1)[:, None])
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(length > 0, length, 1)).astype(np.float32)


def features_of(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the vectors of the tokens; zeros without tokens."""
    if not len(ids):
        return np.zeros(2 * WIDTH, np.float32)
    used, counts = np.unique(ids, return_counts=True)
    share = (counts / len(ids)).astype(np.float32)
    v = vectors[used]
    mean = share @ v
    return np.concatenate((mean, np.sqrt(np.maximum(share @ (v * v) - mean * mean, 0))))


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, features): mean and standard deviation of the word vectors of every document; zeros without words."""
    sent = docs.sparkSession.sparkContext.broadcast(vectors)       # BUCKETS x WIDTH numbers
    buckets = _Buckets()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = np.array([features_of(tokens(raw, buckets), sent.value) for raw in batch.column(1).to_pylist()], np.float32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * 2 * WIDTH, pa.int32()), pa.array(out.ravel(), pa.float32()))
        return pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "features"])
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")), run, "doc_id long, features array<float>")


class Network(NamedTuple):
    """Two layers over standardised features; probabilities are divided by a temperature in the logit. Without layers: a constant."""
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple
    temperature: float
    constant: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(((x - self.centre) / self.scale) @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, batch: int = 256, rate: float = 0.01, decay: float = 1e-4, seed: int = 0) -> Network:
    """Fits the network with Adam on four fifths of the rows, and the temperature on the rest.

    With fewer than ten rows of a class there is nothing to fit: the score is then the smoothed share of ones.
    """
    constant = float((y.sum() + 1) / (len(y) + 2))
    if min(y.sum(), len(y) - y.sum()) < 10:
        return Network(np.zeros(1), np.ones(1), (), 1.0, constant)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, used = order[::5], np.setdiff1d(order, order[::5])
    centre, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-6
    z, t = (x - centre) / scale, y.astype(np.float64)
    params = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        now = rate * (1 - epoch / epochs) + 1e-4
        shuffled = rng.permutation(used)
        for i in range(0, len(shuffled), batch):
            rows = shuffled[i:i + batch]
            h = np.tanh(z[rows] @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -40, 40))) - t[rows]) / len(rows)
            back = error[:, None] * params[2] * (1 - h * h)
            grads = [z[rows].T @ back + decay * params[0], back.sum(axis=0), h.T @ error + decay * params[2], error.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] -= now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(centre, scale, tuple(params), 1.0, constant)
    logits = net.logits(x[held])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.mean(np.logaddexp(0, -np.where(t[held] > 0, 1, -1) * logits / g)) for g in grid]
    return net._replace(temperature=float(grid[int(np.argmin(loss))]))


def fit_network(features: DataFrame, labelled: DataFrame) -> Network:
    """The network for (doc_id, features) of documents and (doc_id, label) of a bounded sample, 1 for good."""
    of = F.broadcast(labelled.select(F.col("doc_id").alias("_id"), "label"))       # at most the sample's bound
    rows = sorted((tuple(r) for r in features.join(of, F.col("doc_id") == F.col("_id")).select("doc_id", "features", "label").collect()), key=lambda r: r[:2])
    x = np.array([r[1] for r in rows], np.float64).reshape(len(rows), 2 * WIDTH)
    return train_network(x, np.array([int(r[2]) for r in rows], np.int64))


def quality_scores(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(doc_id, score) of every document; the score is the probability of label 1, empty and null texts included."""
    features = materialize(pooled(docs, word_vectors(docs)))
    sent = docs.sparkSession.sparkContext.broadcast(fit_network(features, labelled))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, 2 * WIDTH).astype(np.float64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sent.value.scores(x), pa.float64())], names=["doc_id", "score"])
    return map_batches(features, run, "doc_id long, score double")


def keep_good(docs: DataFrame, labelled: DataFrame, least: float = 0.7) -> DataFrame:
    """Documents whose score is at least ``least``, in the columns that came in. Scores follow each row's own text, so ids may repeat or be null."""
    vectors = word_vectors(docs)
    sample = docs.join(F.broadcast(labelled.select(F.col("doc_id").alias("_labelled_id"))), F.col("doc_id") == F.col("_labelled_id")).select("doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast((fit_network(pooled(sample, vectors), labelled), vectors))
    at, buckets = docs.columns.index("text"), _Buckets()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        net, table = sent.value
        out = np.array([features_of(tokens(raw, buckets), table) for raw in batch.column(at).cast(pa.binary()).to_pylist()])
        return batch.filter(pa.array(net.scores(out.astype(np.float64)) >= least))
    return map_batches(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))
