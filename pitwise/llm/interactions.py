"""How filters interact: survivors of every subset of five filters, by part and label, and what each order of them would remove.

A document fails some of the filters, which is a mask of five bits. Its survival word has 32 bits, one for each subset of the filters: set where
the document fails none of the subset. The sums of the words' bits, position by position, are the survivors of every subset. They are taken with
carry-save adders: three words become a word of sums and a word of carries, until two words are left for each power of two. Everything that an
audit asks for is a difference of such counts, so no order of filters is ever applied to the documents.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import map_batches
from pitwise.session import materialize

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
CLASSES = ("all", "good", "toxic")
#: Survival word of each mask of failures: bit s is set where the subset s holds no failing filter.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not mask & s) for mask in range(SUBSETS)], np.uint32)
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

MIN_WORDS = 50
MIN_DISTINCT = 65       # per cent of the words
MAX_CAPITALS = 5        # per cent of the code points
SIGNS = b"#$%&*|"
_CAPITALS = bytes(range(65, 91))
_CONTINUATION = bytes(range(128, 192))
_MAX_PARTS = 10_000     # parts whose counts a task holds at once


def own_failures(raw: bytes) -> int:
    """Mask of the filters A to D that a text fails: few words, repeated words, capitals, signs. Words are split at ASCII white space."""
    words = raw.split()
    points = len(raw) - (0 if raw.isascii() else len(raw) - len(raw.translate(None, _CONTINUATION)))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    signs = any(s in raw for s in SIGNS)
    return (len(words) < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT * len(words)) << 1 | (100 * capitals > MAX_CAPITALS * points) << 2 | signs << 3


def document_failures(docs: DataFrame, part: Column) -> DataFrame:
    """(doc_id, part, fails): one row per document with its mask of all five filters.

    E fails where a smaller doc_id has the same text, which is told by its 128-bit hash. A null text is an empty one, a null part the empty
    part. Rows of one id with one text have no smaller id among them; rows without an id are neither smaller than others nor do they fail E.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [raw or b"" for raw in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([own_failures(t) for t in texts], pa.int32()), pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary())],
                                          names=["doc_id", "part", "own", "digest"])
    narrow = docs.select(F.col("doc_id").cast("long"), F.coalesce(part, F.lit("")).alias("part"), F.col("text").cast("binary"))
    rows = materialize(map_batches(narrow, run, "doc_id long, part string, own int, digest binary"))
    known = rows.where("doc_id is not null")
    # joined on the id as well, so that a large group of copies is spread over all tasks
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    later = F.col("is_first").isNull().cast("int")
    return known.join(firsts, ["doc_id", "digest"], "left").select("doc_id", "part", (F.col("own") + 16 * later).alias("fails")).unionByName(
        rows.where("doc_id is null").select("doc_id", "part", F.col("own").alias("fails")))


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the words have each bit set: three words at a time go through an adder, and carries count double."""
    counts, weight = np.zeros(SUBSETS, np.int64), 1
    while len(words):
        carries = [words[:0]]
        while len(words) >= 3:
            n = len(words) // 3
            a, b, c = words[:n], words[n:2 * n], words[2 * n:3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate((half ^ c, words[3 * n:]))
        counts += weight * ((words[:, None] >> np.arange(SUBSETS, dtype=np.uint32)) & 1).sum(axis=0, dtype=np.int64)
        words, weight = np.concatenate(carries), 2 * weight
    return counts


def subset_survivors(marked: DataFrame) -> DataFrame:
    """One row per part of (part, fails, good, toxic) with survivors: for each class of CLASSES, in order, one count for every subset of filters.

    Tasks add up by part before the shuffle. ``good`` and ``toxic`` are booleans.
    """
    width = len(CLASSES) * SUBSETS

    def run(batches):
        held: dict[str, np.ndarray] = {}

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *[pa.array([c[k] for c in held.values()], pa.int64()) for k in range(width)]], names=["part", *[f"n{k}" for k in range(width)]])
            held.clear()
            return out
        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            code = parts.indices.to_numpy(zero_copy_only=False)
            words = WORDS[batch.column(1).to_numpy(zero_copy_only=False)]
            masks = [np.ones(len(code), bool), *[batch.column(k).to_numpy(zero_copy_only=False).astype(bool) for k in (2, 3)]]
            order = np.argsort(code, kind="stable")
            ends = np.searchsorted(code[order], np.arange(len(parts.dictionary) + 1))
            for k, part in enumerate(parts.dictionary.to_pylist()):
                at = order[ends[k]:ends[k + 1]]
                counts = np.concatenate([positional_popcounts(words[at[m[at]]]) for m in masks])
                held[part] = held.get(part, 0) + counts
            if len(held) > _MAX_PARTS:
                yield flush()
        if held:
            yield flush()
    names = [f"n{k}" for k in range(width)]
    counted = marked.select("part", "fails", "good", "toxic").mapInArrow(run, "part string, " + ", ".join(f"{n} bigint" for n in names))
    return counted.groupBy("part").agg(*[F.sum(n).alias(n) for n in names]).select("part", F.array(*names).alias("survivors"))


def order_counts(survivors: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every step of every order, 120 x 5 each, from the survivors of the subsets (classes x 32)."""
    total, everything = survivors[0], SUBSETS - 1
    orders = np.array(list(permutations(range(len(FILTERS)))))
    bits = 1 << orders
    after = np.cumsum(bits, axis=1)         # each filter is there once, so sums are unions
    before = after - bits
    lost = survivors[:, before] - survivors[:, after]
    alone = total[everything - (1 << np.arange(len(FILTERS)))] - total[everything]
    failing = total[0] - total[1 << np.arange(len(FILTERS))]
    n = len(FILTERS)
    size = [bin(s).count("1") for s in range(SUBSETS)]
    shapley = np.array([sum(factorial(size[s]) * factorial(n - 1 - size[s]) * (int(total[s]) - int(total[s | 1 << f])) for s in range(SUBSETS) if not s >> f & 1) for f in range(n)])
    return {"kept": total[after], "removed": lost[0], "redundant": failing[orders] - lost[0], "unique_fails": alone[orders],
            "good_lost": lost[1], "toxic_lost": lost[2], "shapley": shapley[orders]}


def order_report(survivors: DataFrame) -> DataFrame:
    """(part, filter_order, step, COUNTS): 600 rows for every part of ``subset_survivors``."""
    orders = ["".join(o) for o in permutations(FILTERS)]
    n = len(FILTERS)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = batch.column(0).to_pylist()
        found = [order_counts(np.array(s, np.int64).reshape(len(CLASSES), SUBSETS)) for s in batch.column(1).to_pylist()]
        steps = len(orders) * n
        columns = [pa.array([p for p in parts for _ in range(steps)], pa.string()), pa.array([o for o in orders for _ in range(n)] * len(parts), pa.string()),
                   pa.array(list(range(1, n + 1)) * len(orders) * len(parts), pa.int32()), *[pa.array(np.concatenate([f[c].ravel() for f in found]), pa.int64()) for c in COUNTS]]
        return pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *COUNTS])
    return map_batches(survivors.select("part", "survivors"), run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS))


def audit(docs: DataFrame, labels: DataFrame, part: Column | None = None) -> DataFrame:
    """The report over documents and labels (doc_id, quality, toxic) for each value of ``part`` (default: source).

    A document is good or toxic where any label of its id says 1; others, and documents without an id, are neither. An empty table has no parts.
    """
    marked = document_failures(docs, F.col("source") if part is None else part)
    flags = [F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*flags)
    neither = [F.lit(False).alias("good"), F.lit(False).alias("toxic")]
    joined = marked.where("doc_id is not null").join(known, "doc_id", "left").select("part", "fails", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    return order_report(subset_survivors(joined.unionByName(marked.where("doc_id is null").select("part", "fails", *neither))))


def audit_sql() -> str:
    """The report in SQL, every order applied to every document."""
    fails = lambda f: f"substr(m, {FILTERS.index(f) + 1}, 1) = '1'"
    letters = "(VALUES " + ", ".join(f"('{f}')" for f in FILTERS) + ")"
    return rf"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
least_ids AS (SELECT text, min(doc_id) AS first FROM w GROUP BY text),
lab AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.doc_id, part, concat(CAST(len(w) < {MIN_WORDS} AS INT), CAST(100 * len(list_distinct(w)) < {MIN_DISTINCT} * len(w) AS INT),
        CAST(100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > {MAX_CAPITALS} * length(w.text) AS INT), CAST(regexp_matches(w.text, '[#$%&*|]') AS INT),
        CAST(w.doc_id IS NOT NULL AND w.doc_id > first AS INT)) AS m, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM w JOIN least_ids USING (text) LEFT JOIN lab ON w.doc_id = lab.doc_id),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM {letters} AS a(x), {letters} AS b(x), {letters} AS c(x), {letters} AS d(x), {letters} AS e(x)
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, k AS step, substr(filter_order, k, 1) AS letter, left(filter_order, k) AS done FROM o, (SELECT unnest(range(1, 6)) AS k)),
g AS (SELECT part, good, toxic, m, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT part, filter_order, step, letter, n, good, toxic, m,
        {" OR ".join(f"(contains(done, '{f}') AND {fails(f)})" for f in FILTERS)} AS gone,
        {" OR ".join(f"(contains(left(done, step - 1), '{f}') AND {fails(f)})" for f in FILTERS)} AS gone_before,
        {" OR ".join(f"(letter = '{f}' AND {fails(f)})" for f in FILTERS)} AS failing, length(replace(m, '0', '')) AS failed
      FROM g, s),
r AS (SELECT part, filter_order, CAST(step AS INT) AS step, letter, sum(CASE WHEN NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN failing AND NOT gone_before THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN failing AND gone_before THEN n ELSE 0 END) AS redundant, sum(CASE WHEN failing AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN failing AND NOT gone_before AND good THEN n ELSE 0 END) AS good_lost, sum(CASE WHEN failing AND NOT gone_before AND toxic THEN n ELSE 0 END) AS toxic_lost
      FROM x GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in COUNTS[:-1])}, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r"""
