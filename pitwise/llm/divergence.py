"""How far sources diverge from each other and from their language in the terms they use.

Terms are counted in tasks without a table of terms. A buffer of text is cut into terms by array operations, and terms are packed by length: up to
eight bytes into one 64-bit word, up to sixteen into two, longer ones into buckets of fixed-width bytes, one for each number of words. Words are
sorted by radix, sixteen bits at a time, byte rows by their bytes, and runs of equal terms are counted. Runs of several buffers are
merged the same way before they leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitwise.llm.common import pieces
from pitwise.session import materialize

MIN_DOCUMENTS = 10
TOP = 10
SCALE = 1_000_000_000
BUFFER = 4 << 20        # bytes of text that are sorted at once
HELD = 3 << 19          # merged terms that a task holds before it passes them on
_WORDS = 2              # packed words of a short term at most
#: A-Z to a-z and every byte that is not of a term to a space: terms are runs of letters and of everything beyond ASCII.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def radix_order(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """``order`` sorted stably by the keys (uint64, the last weighs least): sixteen bits at a time, from the least; equal digits are passed over."""
    for key in reversed(keys):
        varying = int(np.bitwise_or.reduce(key ^ key[0])) if len(key) else 0
        for shift in range(0, 64, 16):
            if varying >> shift & 0xFFFF:
                digits = ((key >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
                order = order[np.argsort(digits[order], kind="stable")]
    return order


class Runs:
    """Counted terms of one bucket: packed words (or rows of bytes), a group for each, occurrences, and documents."""

    def __init__(self, keys: list[np.ndarray], group: np.ndarray, n: np.ndarray, documents: np.ndarray):
        self.keys, self.group, self.n, self.documents = keys, group, n, documents

    def __len__(self) -> int:
        return len(self.group)


def _sorted(keys: list[np.ndarray], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by term and group, and where in it a new term or group begins."""
    order = radix_order([group.astype(np.uint64)], np.arange(len(group)))
    if keys[0].dtype == np.uint64:
        order = radix_order(keys, order)
    else:
        order = order[np.argsort(keys[0][order], kind="stable")]
    new = np.ones(len(order), bool)
    new[1:] = group[order[1:]] != group[order[:-1]]
    for key in keys:
        s = key[order]
        new[1:] |= s[1:] != s[:-1]
    return order, new


def counted(keys: list[np.ndarray], group: np.ndarray, document: np.ndarray) -> Runs:
    """Runs of the terms of one bucket; terms come document by document."""
    order, new = _sorted(keys, group)
    first = np.flatnonzero(new)
    d = document[order]
    in_document = new.copy()
    in_document[1:] |= d[1:] != d[:-1]
    return Runs([k[order[first]] for k in keys], group[order[first]], np.diff(np.append(first, len(order))), np.add.reduceat(in_document.astype(np.int64), first))


def merged(parts: list[Runs], one_document: bool = False) -> Runs:
    """Runs of one bucket as one, counts added up; pieces of one document count as one document."""
    if len(parts) == 1:
        return parts[0]
    keys = [np.concatenate(k) for k in zip(*(p.keys for p in parts))]
    group, n, documents = (np.concatenate([getattr(p, name) for p in parts]) for name in ("group", "n", "documents"))
    order, new = _sorted(keys, group)
    first = np.flatnonzero(new)
    add = np.maximum if one_document else np.add
    return Runs([k[order[first]] for k in keys], group[order[first]], np.add.reduceat(n[order], first), add.reduceat(documents[order], first))


def term_runs(raw: bytes, starts: np.ndarray, groups: np.ndarray) -> dict[int, Runs]:
    """Runs by bucket (number of packed words) of documents that lie one after the other in ``raw``, each ending with a byte that is not of a term."""
    codes = np.frombuffer(raw.translate(_TERM_BYTES), np.uint8)
    inside = np.concatenate(([False], codes != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, length = edges[::2], edges[1::2] - edges[::2]
    document = np.searchsorted(starts, begin, side="right") - 1
    size = (length + 7) // 8
    padded = np.concatenate((codes, np.zeros(8, np.uint8)))
    out = {}
    for words in np.unique(size).tolist():
        at = np.flatnonzero(size == words)
        b, n, doc = begin[at], length[at], document[at]
        if words <= _WORDS:
            keys = []
            for w in range(words):
                key = np.zeros(len(at), np.uint64)
                for i in range(8 * w, 8 * w + 8):
                    byte = padded[np.minimum(b + i, len(padded) - 1)].astype(np.uint64)
                    key = (key << np.uint64(8)) | np.where(i < n, byte, np.uint64(0))
                keys.append(key)
        else:       # few rows: rows of bytes, padded with zeros, which no term has
            rows = np.zeros((len(at), 8 * words), np.uint8)
            for k, (start, stop) in enumerate(zip(b.tolist(), (b + n).tolist())):
                rows[k, :stop - start] = codes[start:stop]
            keys = [rows.view(f"S{8 * words}").ravel()]
        out[words] = counted(keys, groups[doc], doc)
    return out


def _terms(runs: Runs) -> pa.Array:
    """The terms of runs as strings."""
    if runs.keys[0].dtype != np.uint64:
        return pa.array([k.decode() for k in runs.keys[0].tolist()], pa.string())
    rows = np.stack(runs.keys, axis=1).astype(">u8").view(np.uint8).reshape(len(runs), -1)
    used = rows != 0
    offsets = np.concatenate(([0], np.cumsum(used.sum(axis=1)))).astype(np.int32)
    return pa.StringArray.from_buffers(len(runs), pa.py_buffer(offsets), pa.py_buffer(rows[used]))


def count_terms(docs: DataFrame, groups: list[str], buffer: int = BUFFER, most_held: int = HELD) -> DataFrame:
    """(groups..., term, n, documents) of partial counts: occurrences, and documents with the term, of what a task held at once.

    Every group of ``groups`` (string columns) that occurs has a row for the empty term as well, with zeros. Null texts have no terms. A document is a
    row; one that is longer than a buffer is cut between terms, and its pieces count as one document.
    """
    width = len(groups)

    def run(batches) -> Iterator[pa.RecordBatch]:
        names: dict[tuple, int] = {}
        texts, ids, size = [], [], 0
        held: dict[int, list[Runs]] = {}
        entries = 0

        def batch_of(group: np.ndarray, terms: pa.Array, n: np.ndarray, documents: np.ndarray) -> pa.RecordBatch:
            listed = list(names)
            columns = [pa.DictionaryArray.from_arrays(pa.array(group, pa.int32()), pa.array([g[k] for g in listed], pa.string())).cast(pa.string()) for k in range(width)]
            return pa.RecordBatch.from_arrays([*columns, terms, pa.array(n, pa.int64()), pa.array(documents, pa.int64())], names=[*groups, "term", "n", "documents"])

        def add(found: dict[int, Runs]) -> int:
            for words, runs in found.items():
                held.setdefault(words, []).append(runs)
            return sum(map(len, found.values()))

        def sort_buffer() -> int:
            starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
            found = term_runs(b" ".join(texts) + b" ", starts, np.array(ids, np.int32))
            texts.clear()
            ids.clear()
            return add(found)

        def long_document(text: bytes, group: int) -> int:
            parts: dict[int, list[Runs]] = {}
            text = text.translate(_TERM_BYTES)
            start = 0
            while start < len(text):
                stop = text.find(b" ", start + buffer)
                stop = len(text) if stop < 0 else stop
                for words, runs in term_runs(text[start:stop] + b" ", np.zeros(1, np.int64), np.array([group], np.int32)).items():
                    parts.setdefault(words, []).append(runs)
                start = stop
            return add({words: merged(runs, one_document=True) for words, runs in parts.items()})

        def compact() -> int:
            for words in held:
                held[words] = [merged(held[words])]
            return sum(len(r[0]) for r in held.values())

        def flush() -> Iterator[pa.RecordBatch]:
            for runs in held.values():
                for r in runs:
                    for i in range(0, len(r), 1 << 16):
                        part = Runs([k[i:i + (1 << 16)] for k in r.keys], *(getattr(r, name)[i:i + (1 << 16)] for name in ("group", "n", "documents")))
                        yield batch_of(part.group, _terms(part), part.n, part.documents)
            held.clear()

        for batch in pieces(batches):
            columns = [batch.column(k).to_pylist() for k in range(width + 1)]
            for *group, text in zip(*columns):
                at = names.setdefault(tuple(group), len(names))
                if not text:
                    continue
                if len(text) > buffer:
                    entries += long_document(text, at)
                else:
                    texts.append(text)
                    ids.append(at)
                    size += len(text)
                if size > buffer:
                    entries += sort_buffer()
                    size = 0
                if entries > most_held:
                    entries = compact()
                    if entries > most_held // 2:
                        yield from flush()
                        entries = 0
        if texts:
            sort_buffer()
        compact()
        yield from flush()
        if names:
            zero = np.zeros(len(names), np.int64)
            yield batch_of(np.arange(len(names)), pa.array([""] * len(names)), zero, zero)
    fields = ", ".join(f"`{g}` string" for g in groups)
    return docs.select(*groups, F.col("text").cast("binary").alias("text")).mapInArrow(run, f"{fields}, term string, n long, documents long")


def kept_terms(docs: DataFrame, min_documents: int) -> DataFrame:
    """(lang, term, n, by) of terms in at least ``min_documents`` documents of the language, by: (source, n) of its sources that have the term.

    The row of the empty term lists all sources of the language. All sources of a term meet in one task: one row for each task and source at most.
    """
    parts = count_terms(docs, ["lang", "source"]).repartition("lang", "term")
    sums = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    by_term = sums.groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("by"))
    return by_term.where((F.col("documents") >= min_documents) | (F.col("term") == "")).select("lang", "term", "n", "by")


def _p(n: str, total: str, v: str) -> str:
    """1 + floor(SCALE * (n + 2) / (total + 2 v)) in decimals, whose products hold 38 digits."""
    return f"(1 + (cast({SCALE} as decimal(10,0)) * cast({n} + 2 as decimal(20,0))) div cast({total} + 2 * {v} as decimal(20,0)))"


def _f(p: str = "p", q: str = "q") -> str:
    return f"((({p} - {q}) * ({p} - {q})) div ({p} + {q}))"


def divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) over documents (text, lang, source; nulls count as empty).

    A group is a source of a language. Each kept term has a share p of its group, smoothed and scaled to whole numbers, and two shares p and q
    differ by floor((p - q)^2 / (p + q)). Part ``pair``: the sum of that over all kept terms for every other source of the language. Part ``term``: the ``top`` terms
    that a group has and uses most above its language. All sums are of whole numbers. Documents are rows, so repeated rows count each time; an empty table has no groups.

    Sources are compared on counts: how many terms have these counts in these two sources. Terms that only one of two sources has are told apart from
    what the source has in all, so no pair of sources without common terms is ever formed from terms.
    """
    rows = docs.select("text", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")])
    kept = materialize(kept_terms(rows, min_documents))
    terms = kept.where("term <> ''")
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    uses = terms.select("lang", "term", F.col("n").alias("lang_n"), F.explode("by").alias("u")).select("lang", "term", "lang_n", "u.source", "u.n")
    totals = uses.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    listed = kept.where("term = ''").select("lang", F.explode("by.source").alias("source"))
    groups = materialize(listed.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total")))
    pairs = _pair_values(terms, uses, groups).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    shares = uses.where("n > 0").join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), F.expr(_p("n", "total", "v")).alias("p"), F.expr(_p("lang_n", "lang_total", "v")).alias("q")).where("p > q")
    most = shares.select("lang", "source", F.lit("term").alias("part"), "item", F.expr(_f()).alias("value")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.unionByName(most)


def _pair_values(terms: DataFrame, uses: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, value) for each two sources of a language, both ways.

    value = sum over terms of f(p, q). Over the terms that a source has, f against a share of zero occurrences is summed from a histogram of the source's counts; terms
    that both have are taken out of that and put in with their counts; terms that neither has count by their number.
    """
    two = groups.select("lang", "source", "total", "v").join(groups.select("lang", F.col("source").alias("other"), F.col("total").alias("other_total")), "lang").where("source <> other")
    none = _p("0L", "other_total", "v")
    counts = uses.groupBy("lang", "source", "n").agg(F.count("*").alias("k"))
    alone = counts.join(two, ["lang", "source"]).select("lang", "source", "other", "k", F.expr(_p("n", "total", "v")).alias("p"), F.expr(none).alias("q")).groupBy("lang", "source", "other").agg(
        F.sum(F.expr(f"k * {_f()}")).alias("alone"), F.sum("k").alias("has"))
    pair = F.explode(F.flatten(F.transform("by", lambda a: F.transform(F.filter("by", lambda b: a["source"] < b["source"]), lambda b: F.struct(
        a["source"].alias("source"), b["source"].alias("other"), a["n"].alias("n"), b["n"].alias("m"))))))
    common = terms.select("lang", pair.alias("x")).groupBy("lang", "x.source", "x.other", "x.n", "x.m").agg(F.count("*").alias("k"))
    shares = common.join(two, ["lang", "source", "other"]).select(
        "lang", "source", "other", "k", F.expr(_p("n", "total", "v")).alias("p"), F.expr(_p("m", "other_total", "v")).alias("q"),
        F.expr(_p("0L", "total", "v")).alias("p0"), F.expr(_p("0L", "other_total", "v")).alias("q0"))
    both = shares.groupBy("lang", "source", "other").agg(F.sum("k").alias("shared"), F.sum(F.expr(f"k * ({_f()} - {_f('p', 'q0')} - {_f('q', 'p0')})")).alias("change"))
    each = two.where("source < other").join(alone.select("lang", "source", "other", "alone", "has"), ["lang", "source", "other"], "left")
    back = alone.select("lang", F.col("source").alias("other"), F.col("other").alias("source"), F.col("alone").alias("alone_back"), F.col("has").alias("has_back"))
    all_of = each.join(back, ["lang", "source", "other"], "left").join(both, ["lang", "source", "other"], "left").fillna(0, ["alone", "has", "alone_back", "has_back", "shared", "change"])
    neither = f"(v - has - has_back + shared) * {_f(_p('0L', 'total', 'v'), none)}"
    value = F.when(F.col("v") > 0, F.expr(f"alone + alone_back + change + {neither}")).otherwise(F.lit(0)).cast("long")
    half = all_of.select("lang", "source", "other", value.alias("value"))
    return half.unionByName(half.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))


def divergence_sql(min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> str:
    """The report in SQL: every kept term with its count in every group of its language."""
    p = lambda n, total: f"(1 + {SCALE}::HUGEINT * ({n} + 2) // ({total} + 2 * v))"
    f = "CAST((p - q) * (p - q) // (p + q) AS BIGINT)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= {min_documents}),
l AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
full_counts AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, lang_n FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
totals AS (SELECT lang, source, sum(n) AS total FROM full_counts GROUP BY lang, source),
s AS (SELECT lang, source, term, n, {p("n", "total")} AS p, {p("lang_n", "lang_total")} AS q FROM full_counts JOIN totals USING (lang, source) JOIN l USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum({f}) AS value FROM (SELECT lang, source, term, p FROM s) AS a JOIN (SELECT lang, source, term, p AS q FROM s) AS b
          ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
          UNION ALL SELECT lang, source, 'term', term, {f} FROM s WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM every QUALIFY part = 'pair' OR rank <= {top}"""
