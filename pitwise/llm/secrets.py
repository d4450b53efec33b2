"""Secret scans: fixed patterns, and character Markov models that tell random strings from ordinary identifiers.

Two second-order models over folded characters are trained from samples: one on values that the fixed patterns find in the corpus, together with
strings drawn evenly from the usual alphabets, the other on ordinary words and identifiers of the corpus. A long run of key characters is
reported when its log-likelihood ratio per character is above a limit calibrated on ordinary strings held out of the training.
"""

from __future__ import annotations

import random
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import free_name, map_batches

#: Fixed patterns, in the order in which kinds of equal start are listed. The first three are the base; the model adds its own.
KINDS = ("assign", "access", "hex", "model")
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{4,}")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Characters are folded to these classes: each letter and digit by itself, the rest as one, and an edge mark.
_CLASSES = 64
_EDGE = 63


def _fold_table() -> np.ndarray:
    table = np.full(256, 62, np.int64)
    for i, c in enumerate(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"):
        table[c] = i
    return table


_FOLD = _fold_table()
_SHAPE = np.concatenate((np.zeros(26), np.ones(26), np.full(10, 2), [3, 4])).astype(np.int64)     # lower, upper, digit, other, edge


class MarkovModels(NamedTuple):
    """Log-likelihood ratio of each character after the two before it, and the limit per character."""
    ratio: np.ndarray
    limit: float

    def score(self, value: bytes) -> float:
        """Mean log-likelihood ratio per character, positive for random strings."""
        codes = _codes(value)
        return float(self.ratio[_context(codes), codes[2:]].mean())


def _codes(value: bytes) -> np.ndarray:
    return np.concatenate(([_EDGE, _EDGE], _FOLD[np.frombuffer(value, np.uint8)], [_EDGE]))


def _context(codes: np.ndarray) -> np.ndarray:
    """The character before, in full, and the shape of the one before that."""
    return codes[1:-1] * 5 + _SHAPE[codes[:-2]]


def _log_probabilities(values: list[bytes], smoothing: float) -> np.ndarray:
    counts = np.full((_CLASSES * 5, _CLASSES), 0.0)
    for value in values:
        codes = _codes(value)
        np.add.at(counts, (_context(codes), codes[2:]), 1)
    single = counts.sum(axis=0) + 1
    single /= single.sum()
    counts += smoothing * single            # an unseen context falls back on the frequencies of characters
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def drawn_strings(n: int, seed: int) -> list[bytes]:
    """Random strings of the usual alphabets and lengths."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    alphabets = ("0123456789abcdef", letters + "0123456789", letters.upper() + "0123456789", letters + letters.upper() + "0123456789", letters + letters.upper() + "0123456789+/", letters.upper() + "234567")
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(16, 48))).encode() for _ in range(n)]


def train(random_strings: list[bytes], ordinary: list[bytes], error: float = 1e-4, seed: int = 0) -> MarkovModels:
    """Fits both models; every fifth ordinary string is held out to set the limit that all but a share ``error`` of them stay below.

    Held-out strings are joined to the length of candidates, since a limit for short words would be too high for long runs. The limit is at least
    zero, where both models are equally likely.
    """
    drawn = drawn_strings(max(2000, len(random_strings)), seed)
    held, used = ordinary[::5], [v for i, v in enumerate(ordinary) if i % 5]
    models = MarkovModels(_log_probabilities(random_strings + drawn, 1.0) - _log_probabilities(used, 1.0), 0.0)
    rng = random.Random(seed)
    joined = []
    while held and len(joined) < 4000:
        value = b""
        while len(value) < 16:
            value += (rng.choice((b"", b"_", b"-", b"/")) if value else b"") + rng.choice(held)
        joined.append(value)
    scores = [models.score(v) for v in joined]
    return models._replace(limit=max(0.0, float(np.quantile(scores, 1 - error)) if scores else 0.0))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns in code points, leftmost and without overlap for each kind."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def find_spans(raw: bytes, models: MarkovModels) -> list[tuple[str, int, int]]:
    """All spans, sorted by start and kind. The models judge runs of 16 key characters and more that no fixed pattern touches."""
    low = raw.lower()
    candidates = [m.span() for m in _CANDIDATE.finditer(raw)]
    found: list[tuple[str, int, int]] = []
    if candidates or b"AKIA" in raw or any(w in low for w in _KEYWORDS):
        found = base_spans(raw.decode("utf-8", "replace"))
    if candidates:
        wide = not raw.isascii()
        for a, b in candidates:
            if models.score(raw[a:b]) > models.limit:
                start = len(raw[:a].decode("utf-8", "replace")) if wide else a
                span = ("model", start, start + b - a)
                if not any(s < span[2] and span[1] < e for k, s, e in found if k != "model"):
                    found.append(span)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def training_strings(docs: DataFrame, max_documents: int) -> tuple[list[bytes], list[bytes]]:
    """(values that fixed patterns find, ordinary runs of letters, digits and signs) of about ``max_documents`` documents at most.

    The documents are taken by a hash of id and text, with a share that follows from their number; of each, at most 40 runs spread over the whole
    text are used. This sample only trains the models.
    """
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).where("text is not null")
    n = texts.count()
    if n > max_documents:
        texts = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(max_documents / n * (1 << 30)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds, values = [], []
        for raw in batch.column(1).to_pylist():
            text = raw.decode("utf-8", "replace")
            spans = base_spans(text)
            for kind, a, b in spans:
                value = _ASSIGN.match(text, a).group(2) if kind == "assign" else text[a:b]
                kinds.append(True)
                values.append(value.encode())
            if not spans:
                runs = [r for r in _RUN.findall(raw) if len(r) < 16]        # longer ones are what the models will have to judge
                kept = runs[::max(1, len(runs) // 40)][:41]
                kinds += [False] * len(kept)
                values += kept
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.bool_()), pa.array(values, pa.binary())], names=["secret", "value"])
    rows = map_batches(texts, run, "secret boolean, value binary").groupBy("secret", F.substring("value", 1, 200).alias("value")).count()
    found: dict[bool, list[bytes]] = {True: [], False: []}
    for row in rows.orderBy("secret", "value").toLocalIterator():
        found[row.secret].append(bytes(row.value))
    return found[True], found[False]


def scan(docs: DataFrame, models: MarkovModels) -> DataFrame:
    """Documents with spans: an array of (kind, start, end) in code points, end exclusive. Null texts count as empty."""
    name = free_name(docs, "spans")
    if name != "spans":
        raise ValueError("documents already have spans")
    columns = docs.columns
    at = columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(models)         # 320 x 64 numbers
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(raw, sent.value)] if raw else [] for raw in batch.column(at).cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], names=[*columns, "spans"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_batches(docs, run, f"{fields}, spans array<struct<kind string, start int, end int>>")


def fit(docs: DataFrame, max_documents: int = 4000, error: float = 1e-4) -> MarkovModels:
    """Models trained from a bounded sample of the documents."""
    return train(*training_strings(docs, max_documents), error=error)


def secret_digest(docs: DataFrame, models: MarkovModels) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_model, base_sha256, spans (kind:start:end, comma-joined)."""
    found = scan(docs.select("doc_id", "text"), models)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "model")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, models: MarkovModels, mark: str = "[secret]") -> DataFrame:
    """Documents whose spans are replaced by ``mark``, in the columns that came in; overlapping spans are replaced as one."""
    columns = docs.columns
    at = columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def cut(raw: bytes) -> str:
        text, parts, last = raw.decode("utf-8", "replace"), [], 0
        for _, a, b in find_spans(raw, sent.value):
            if a >= last:
                parts += [text[last:a], mark]
            last = max(last, b)
        return "".join([*parts, text[last:]])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array([cut(t) if t else t if t is None else "" for t in batch.column(at).cast(pa.binary()).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], names=columns)
    return map_batches(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))
