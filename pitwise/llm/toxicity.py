"""Toxicity by compression distance: windows are compressed with a dictionary of ordinary text, with and without toxic terms.

Both zstandard dictionaries begin with the same content, trained on windows of ordinary labelled documents, so that ordinary prose costs alike; the
toxic one goes on with the terms (words and beginnings of words) that labelled toxic documents have significantly more often. No dictionary is
trained on toxic windows: they are mostly ordinary prose, which then saves bytes too (figures in the README). A window's
gain is what the toxic dictionary saves. A document's score is a logistic function of how many of its windows reach each gain, fitted on other
labelled documents, so the thresholds are calibrated. Training uses a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import map_batches, pieces, words_of, WordHashes
from pitwise.llm.minhash import shingle_hashes, signature
from pitwise.session import materialize

WINDOW = 10             # words of a window
LEVEL = 12              # zstandard level: lower ones miss short matches
SHARED = 15_000         # bytes of the content that both dictionaries share
OWN = 12_000            # bytes of typical terms at most
GAINS = 12              # gains of this many bytes and more count alike
LEAST_RATIO = 25.0      # likelihood ratio of a typical term at least: chance alone reaches it once in 1.7 million terms
_PIECE = (5, 6)         # bytes of the beginnings of words that count as terms
_FLUSH = 200_000


class Dictionaries(NamedTuple):
    toxic: bytes
    ordinary: bytes


class Model(NamedTuple):
    """Dictionaries and a logistic function of the features; without weights the score is a constant."""
    dictionaries: Dictionaries
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    constant: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.constant)
        z = (x - self.centre) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[:-1] + self.weights[-1], -40, 40)))


def windows(text: bytes | None, size: int = WINDOW) -> list[bytes]:
    """Consecutive windows of normalised words, framed by spaces; the whole text is covered."""
    words = words_of(text)
    return [b" " + b" ".join(words[i:i + size]) + b" " for i in range(0, len(words), size)]


def terms_of(text: bytes | None) -> set[bytes]:
    """Distinct words of four bytes and more, framed by spaces, and beginnings of longer ones."""
    out = set()
    for w in set(words_of(text)):
        if len(w) >= 4:
            out.add(b" " + w + b" ")
        out.update(b" " + w[:k] for k in _PIECE if len(w) > k)
    return out


def term_counts(labelled: DataFrame) -> DataFrame:
    """(term, a, b): in how many toxic and other documents of (text, label) a term is."""
    def run(batches):
        seen: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array([t for t, _ in seen], pa.binary()), pa.array([y for _, y in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["term", "label", "n"])
            seen.clear()
            return out
        for batch in pieces(batches):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.update((t, label) for t in terms_of(text))
                if len(seen) > _FLUSH:
                    yield flush()
        if seen:
            yield flush()
    rows = labelled.select(F.col("text").cast("binary").alias("text"), F.col("label").cast("int").alias("label")).mapInArrow(run, "term binary, label int, n long")
    return rows.groupBy("term").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == 1, 0).otherwise(F.col("n"))).alias("b"))


def _likelihood_ratio(toxic: int, other: int) -> Column:
    """G squared of the two-by-two table of a term."""
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    part = lambda x, n: F.when(x <= 0, F.lit(0.0)).otherwise(x * F.log(x / n))
    total = float(toxic + other)
    fixed = sum(x * math.log(x / total) for x in (toxic, other) if x)
    return 2 * (part(a, total) + part(toxic - a, total) + part(b, total) + part(other - b, total) - part(a + b, total) - part(total - a - b, total) - F.lit(fixed))


def without_copies(sample: DataFrame) -> DataFrame:
    """Documents of (doc_id, text, ...) that share none of four least shingle hashes with a document of smaller id.

    A group of copies would make all its words look typical of its label.
    """
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_hashes(text, 5, hashes) for text in batch.column(1).to_pylist()]
        keys = [[int(k) * 4 + i for i, k in enumerate(signature(f, 4))] if len(f) else [] for f in found]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "keys"])
    keyed = map_batches(sample.select("doc_id", F.col("text").cast("binary").alias("text")), run, "doc_id long, keys array<long>").select("doc_id", F.explode("keys").alias("key"))
    first = keyed.groupBy("key").agg(F.min("doc_id").alias("first"))
    copies = keyed.join(first, "key").where("doc_id > first").select("doc_id").distinct()
    return sample.join(copies, "doc_id", "left_anti")


def typical_terms(labelled: DataFrame, toxic: int, other: int) -> list[bytes]:
    """Terms typical of toxic documents, the most typical first, OWN bytes of five at most.

    A term must be in three toxic documents, be four times as frequent in toxic documents, and have a likelihood ratio of LEAST_RATIO, which is the
    same for samples of any size: what a few documents show beyond chance is not thrown away because there are more of them.
    """
    counts = term_counts(labelled).where((F.col("a") >= 3) & (F.col("a") / toxic > 4 * (F.col("b") + 0.5) / other))
    found = counts.select("term", _likelihood_ratio(toxic, other).alias("g")).where(F.col("g") >= LEAST_RATIO).orderBy(F.desc("g"), "term").limit(OWN // 5)
    kept: list[bytes] = []
    for term in (bytes(r.term) for r in found.collect()):
        if not any(term in other_term for other_term in kept):        # a beginning whose word is there already adds nothing
            kept.append(term)
    return kept


def build_dictionaries(samples: list[bytes], toxic_terms: list[bytes]) -> Dictionaries:
    """Shared content trained on ordinary windows; then the toxic terms, the most typical last, where they are cheapest to refer to.

    The ordinary dictionary has zeros in their place, so that what ordinary windows refer to lies equally far back in both.
    """
    try:
        shared = zstandard.train_dictionary(SHARED + 1024, samples).as_bytes()[-SHARED:]
    except zstandard.ZstdError:         # too few samples to train on
        shared = b"".join(samples)[-SHARED:]
    own = b"".join(reversed(toxic_terms))[-OWN:]
    return Dictionaries(shared + own, shared + bytes(len(own)))


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content.rjust(8, b" "), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=dictionary, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)


def features_of(text: bytes | None, toxic: zstandard.ZstdCompressor, ordinary: zstandard.ZstdCompressor) -> list[float]:
    """Largest gain; logarithms of how many windows, and of which share of them, reach each gain. Zeros without words."""
    parts = windows(text)
    if not parts:
        return [0.0] * (1 + GAINS + 6)
    gains = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in parts])
    reach = np.bincount(np.clip(gains, 0, GAINS), minlength=GAINS + 1)[1:][::-1].cumsum()[::-1]
    return [float(gains.max()), *np.log1p(reach), *(np.log(reach[2:8] + 0.1) - math.log(len(gains)))]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights (the last one is the intercept) by Newton steps."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - centre) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        move = np.linalg.solve((z.T * (p * (1 - p) + 1e-9)) @ z + ridge * np.eye(len(w)), z.T @ (p - y) + ridge * w)
        w -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return centre, scale, w


def fit(docs: DataFrame, labelled: DataFrame) -> Model:
    """A model from (doc_id, text) and a bounded sample (doc_id, label), 1 for toxic.

    Seven tenths of the sample, by a hash of the id, give the terms and windows of the dictionaries, and the rest calibrates the thresholds: on
    documents whose terms were picked, chance terms would look better than they are. With fewer than five documents of either
    label in one of the parts the score is the smoothed share of toxic ones.
    """
    of = F.broadcast(labelled.select(F.col("doc_id").alias("_labelled_id"), F.col("label").cast("int").alias("label")))      # at most the sample's bound
    calibrates = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(10)) >= 7
    sample = materialize(without_copies(docs.join(of, F.col("doc_id") == F.col("_labelled_id")).where("text is not null").select("doc_id", "text", (F.col("label") == 1).cast("int").alias("label"), calibrates.alias("calibrates"))))
    sizes = {(r.label, r.calibrates): r["count"] for r in sample.groupBy("label", "calibrates").count().collect()}
    toxic, other = sizes.get((1, False), 0), sizes.get((0, False), 0)
    empty = np.zeros(0)
    if min((sizes.get((y, c), 0) for y in (0, 1) for c in (False, True))) < 5:
        ones = sum(n for (y, _), n in sizes.items() if y)
        return Model(Dictionaries(b"", b""), empty, empty, empty, (ones + 1) / (sum(sizes.values()) + 2))
    learns = sample.where("not calibrates")
    more = typical_terms(learns, toxic, other)
    ordinary = learns.where("label = 0").select(F.col("text").cast("binary").alias("text"))

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in batch.column(0).to_pylist():
            parts = windows(text)
            out += parts[::max(1, len(parts) // 5)][:6]
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["window"])
    samples = sorted(bytes(r.window) for r in map_batches(ordinary, spread, "window binary").collect())      # at most six for each document
    dictionaries = build_dictionaries(samples, more)
    rows = sorted((tuple(r) for r in with_features(sample.where("calibrates"), dictionaries, ["doc_id", "label"]).collect()), key=lambda r: (r[0], r[1], r[2]))
    x, y = np.array([r[2] for r in rows]), np.array([float(r[1] == 1) for r in rows])
    return Model(dictionaries, *fit_logistic(x, y), 0.0)


def with_features(docs: DataFrame, dictionaries: Dictionaries, keep: list[str]) -> DataFrame:
    """The kept columns and features, an array of numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)      # 54 KB at most
    made: dict[str, zstandard.ZstdCompressor] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.update(toxic=compressor(sent.value.toxic), ordinary=compressor(sent.value.ordinary))
        rows = [features_of(text, made["toxic"], made["ordinary"]) for text in batch.column(len(keep)).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "features"])
    rows = docs.select(*keep, F.col("text").cast("binary").alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_batches(rows, run, f"{fields}, features array<double>")


def toxicity_scores(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(doc_id, score) of every row; the score is the probability of label 1, empty and null texts included."""
    model = fit(docs.select("doc_id", "text"), labelled)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sent.value.scores(x), pa.float64())], names=["doc_id", "score"])
    return map_batches(with_features(docs.select(F.col("doc_id").cast("long"), "text"), model.dictionaries, ["doc_id"]), run, "doc_id long, score double")
