"""Language identification by rank-order profiles.

A language's profile is the ranks of its most frequent n-grams of one to three letters, counted over all its learning documents; words are padded with
a blank on both sides. A document's most frequent n-grams are held against each profile: an n-gram's out-of-place distance is how far its
rank in the document is from its rank in the profile, and the largest rank where the profile lacks it. The language with the least sum wins.

An n-gram is one number, three code points of 21 bits each, so that counting is sorting of numbers. Equal counts rank by code points.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitwise.llm.common import map_batches, pieces

TOP = 300               # ranks of a profile and of a document
MAX_LANGUAGES = 4096    # a profile table is sent to every task: TOP ranks of so many languages at most
UNKNOWN = "und"
_BLANK = 32
_LETTERS_END = 0x32400  # beyond it there are no letters
_PIECE = 1 << 18        # code points that are counted at once
_FLUSH = 1 << 20        # counts that a task holds before it passes them on


@cache
def _symbols() -> np.ndarray:
    """Lower-case letter of each code point, a blank for all others. Letters that become two in lower case stay as they are."""
    table = np.full(_LETTERS_END + 1, _BLANK, np.uint64)
    for code in range(_LETTERS_END):
        letter = chr(code)
        if letter.isalpha():
            lower = letter.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def _counted(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal n-grams added up, ascending by n-gram."""
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.zeros(0, np.int64)
    return grams[first], np.add.reduceat(counts, first) if len(first) else counts


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams, ascending, and how often it has each. A long text is counted in pieces that share two symbols, so no n-gram is lost."""
    table = _symbols()
    held, seen = np.array([_BLANK], np.uint64), []
    for start in range(0, len(text), _PIECE):
        codes = np.frombuffer(text[start:start + _PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = [_BLANK] if start + _PIECE >= len(text) else []
        s = np.concatenate((held, table[np.minimum(codes, _LETTERS_END)], np.array(ends, np.uint64)))
        keep = np.concatenate(([True], (s[1:] != _BLANK) | (s[:-1] != _BLANK)))      # runs of blanks count as one
        new = len(held)
        s = s[keep]
        one = s[new:][s[new:] != _BLANK]
        two = (s[new - 1:-1] << np.uint64(42)) | (s[new:] << np.uint64(21))
        a, b, c = (s[max(0, new - 2):][k:len(s) - max(0, new - 2) - 2 + k] for k in range(3))
        three = ((a << np.uint64(42)) | (b << np.uint64(21)) | c)[b != _BLANK]
        seen.append(np.unique(np.concatenate((one << np.uint64(42), two, three)), return_counts=True))
        held = s[-2:]
    if len(seen) == 1:
        return seen[0]
    if not seen:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return _counted(np.concatenate([g for g, _ in seen]), np.concatenate([n for _, n in seen]))


class Profiles(NamedTuple):
    languages: list[str]        # ascending
    grams: np.ndarray           # all n-grams of any profile, ascending
    ranks: np.ndarray           # languages x n-grams; -1 where the profile lacks it


def count_grams(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text). Tasks add up before the shuffle, in tables of a bounded size."""
    def run(batches):
        seen: dict[str, list] = {}
        held = 0

        def flush():
            for lang, parts in seen.items():
                grams, counts = _counted(np.concatenate([g for g, _ in parts]), np.concatenate([n for _, n in parts]))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])
            seen.clear()
        for batch in pieces(batches):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    by_lang.setdefault(lang, []).append(text)
            for lang, found in by_lang.items():
                counts = gram_counts(" ".join(found))
                seen.setdefault(lang, []).append(counts)
                held += len(counts[0])
            if held > _FLUSH:
                yield from flush()
                held = 0
        yield from flush()
    counted = texts.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_profiles(texts: DataFrame, top: int = TOP) -> Profiles:
    """Profiles of the languages of (lang, text); rows without a language are left out, null texts say nothing, repeated rows count each time.

    A language whose texts have no letter has no profile. More than MAX_LANGUAGES languages are refused, since profiles are sent to every task.
    """
    known = texts.where(F.col("lang").isNotNull())
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    ranked = count_grams(known).withColumn("rank", rank).where(F.col("rank") <= top)
    if (n := known.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()) > MAX_LANGUAGES:
        raise ValueError(f"{n} languages and more; at most {MAX_LANGUAGES} profiles are compared")
    rows = ranked.select("lang", "gram", "rank").collect()          # top x languages
    languages = sorted({r.lang for r in rows})
    grams = np.array(sorted({r.gram for r in rows}), np.uint64)
    ranks = np.full((len(languages), len(grams)), -1, np.int32)
    for k, lang in enumerate(languages):
        own = [(r.gram, r["rank"] - 1) for r in rows if r.lang == lang]
        ranks[k, np.searchsorted(grams, np.array([g for g, _ in own], np.uint64))] = [r for _, r in own]
    return Profiles(languages, grams, ranks)


def nearest(text: str | None, profiles: Profiles, top: int = TOP) -> tuple[str, float]:
    """The language of least out-of-place distance (of equal ones the first by name), and how near it is: one less the share of the largest distance.

    UNKNOWN and zero for null, texts without a letter, and where no profile was learnt.
    """
    grams, counts = gram_counts(text or "")
    if not len(grams) or not profiles.languages:
        return UNKNOWN, 0.0
    mine = grams[np.argsort(-counts, kind="stable")[:top]]
    at = np.minimum(np.searchsorted(profiles.grams, mine), len(profiles.grams) - 1)
    ranks = np.where(profiles.grams[at] == mine, profiles.ranks[:, at], -1)
    distance = np.where(ranks < 0, top, np.abs(ranks - np.arange(len(mine)))).sum(axis=1)
    best = int(np.argmin(distance))
    return profiles.languages[best], 1.0 - int(distance[best]) / (top * len(mine))


def predict_languages(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; equal texts get equal answers, an empty table stays empty, other columns are not read."""
    sent = docs.sparkSession.sparkContext.broadcast(profiles)       # at most MAX_LANGUAGES x TOP ranks

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [nearest(text, sent.value) for text in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                          names=["doc_id", "lang_pred", "score"])
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, lang_pred string, score double")


def languages_sql(top: int = TOP) -> str:
    """The query in SQL: profiles of the rows that are not held out, ranks of every document, least distance. The checksum of the id is taken bit by bit."""
    bits = "list_transform(range(8 * length(id)), lambda i: (ascii(id[i // 8 + 1]) >> (i % 8)::INTEGER) & 1)"
    crc = f"xor(list_reduce([4294967295] || {bits}, lambda a, b: xor(a >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, ' ' || unnest(regexp_extract_all(lower(text), '\p{{L}}+')) || ' ' AS w FROM d),
g AS (SELECT doc_id, substr(w, i, k) AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS sizes(k))),
c AS (SELECT doc_id, g, count(*) AS n FROM g WHERE g <> ' ' GROUP BY doc_id, g),
r AS (SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, g) - 1 AS r FROM c QUALIFY r < {top}),
fold AS (SELECT doc_id, lang, {crc} % 3 AS fold FROM (SELECT *, doc_id::VARCHAR AS id FROM d)),
p AS (SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, g) - 1 AS r FROM c JOIN fold USING (doc_id) WHERE lang IS NOT NULL AND fold <> 1 GROUP BY lang, g QUALIFY r < {top}),
s AS (SELECT doc_id, l.lang, sum(CASE WHEN p.r IS NULL THEN {top} ELSE abs(p.r - r.r) END) AS distance, count(*) AS k
      FROM r CROSS JOIN (SELECT DISTINCT lang FROM p) AS l LEFT JOIN p ON p.lang = l.lang AND p.g = r.g GROUP BY doc_id, l.lang),
b AS (SELECT doc_id, lang, 1 - distance::DOUBLE / ({top} * k) AS score FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY distance, lang) = 1)
SELECT doc_id, fold = 1 AS held_out, coalesce(b.lang, '{UNKNOWN}') AS lang_pred, coalesce(score, 0) AS score FROM fold LEFT JOIN b USING (doc_id)"""
