"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton is built over words from items of a bounded number of words (``words_per_pass``); more items mean more passes over
the documents, so its size, which is what every task gets, never follows the benchmark. Documents are streamed through it word by
word. The longest matching length at each word tells which words lie in an occurrence of a window of ``window`` item words (an item
with fewer words is one window itself).
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import free_name, pieces, words_of

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the items of each window of ``window`` words."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        coded = []
        for item, words in items:
            if words:
                coded.append((item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]))
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        self.shortest = min([window, *(len(codes) for _, codes in coded)])
        self._windows(coded)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, q, c)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, c)
        return cur

    def _split(self, p: int, q: int, c: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _windows(self, coded: list[tuple[object, list[int]]]) -> None:
        """For each state: the state that holds its last ``window`` words (or -1), the items there, and short items on its way up."""
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        self.full = [-1] * len(self.len)
        for s in order[1:]:
            if self.len[s] >= self.window:
                self.full[s] = s if self.len[self.link[s]] < self.window else self.full[self.link[s]]
        self.items: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, set]]] = {}
        for item, codes in coded:
            s = 0
            for i, c in enumerate(codes):
                s = self.next[s][c]
                if i + 1 >= self.window:
                    self.items.setdefault(self.full[s], set()).add(item)
            if len(codes) < self.window:
                at = self.short.setdefault(s, [])
                for n, names in at:
                    if n == len(codes):
                        names.add(item)
                        break
                else:
                    at.append((len(codes), {item}))
        self.up = [-1] * len(self.len)      # nearest state upward, the state itself included, that holds a short item
        for s in order[1:]:
            self.up[s] = s if s in self.short else self.up[self.link[s]]

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """(word is hit) and the items with windows in the words."""
        n = len(words)
        hit = np.zeros(n + 1, np.int32)
        found: set = set()
        if n < self.shortest or not self.vocabulary:
            return hit[:n].astype(bool), found
        codes = np.fromiter(map(self.vocabulary.get, words, itertools.repeat(-1)), np.int64, n)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (codes >= 0).view(np.int8), [0]))))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start >= self.shortest:
                self._run(codes[start:end].tolist(), start, hit, found)
        return np.cumsum(hit[:n]) > 0, found

    def _run(self, codes: list[int], start: int, hit: np.ndarray, found: set) -> None:
        nxt, link, length, window = self.next, self.link, self.len, self.window
        s = matched = 0
        for i, c in enumerate(codes, start + 1):
            while s and c not in nxt[s]:
                s = link[s]
                matched = length[s]
            s = nxt[s].get(c, 0)
            matched = matched + 1 if s else 0
            if matched >= window:
                hit[i - window] += 1
                hit[i] -= 1
                found |= self.items[self.full[s]]
            u = self.up[s]
            while u > 0:
                most = matched if u == s else length[u]
                for m, names in self.short[u]:
                    if m <= most:
                        hit[i - m] += 1
                        hit[i] -= 1
                        found |= names
                u = self.up[link[u]]


def _passes(items: DataFrame, words_per_pass: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items in lots of a bounded number of words; a larger single item is a lot of its own."""
    lot, size = [], 0
    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).where("text is not null")
    for row in rows.toLocalIterator():
        words = words_of(bytes(row.text))
        if lot and size + len(words) > words_per_pass:
            yield lot
            lot, size = [], 0
        if words:
            lot.append((row.item, words))
            size += len(words)
    if lot:
        yield lot


_HITS = "n_words long, hits array<int>, items array<string>"


def scan_documents(docs: DataFrame, items: DataFrame, window: int = 10, words_per_pass: int = 2_000_000) -> DataFrame:
    """Adds n_words, hits (start and end word of each hit span, flat) and items (ids of the items found, distinct) to documents.

    Null or empty texts have no words. Items without words are never found; an item with a null id hits but is not named; rows with
    one item id are one item. Extra columns of both frames are ignored or kept; documents must not have the added names.
    """
    clash = {"n_words", "hits", "items"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"documents already have {sorted(clash)}")
    out, added = docs, False
    for lot in _passes(items, words_per_pass):
        out, added = _scan(out, lot, window, added), True
    return out if added else _scan(out, [], window, False)


def _scan(docs: DataFrame, lot: list, window: int, again: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(lot)       # at most words_per_pass words
    names = [c for c in docs.columns if c not in ("n_words", "hits", "items")]
    text_at = names.index("text")
    built: dict[str, SuffixAutomaton] = {}

    def run(batches):
        automaton = built.get("it") or built.setdefault("it", SuffixAutomaton(sent.value, window))
        for batch in pieces(batches):
            columns = {c: [] for c in ("n_words", "hits", "items")}
            old_hits = batch.column("hits").to_pylist() if again else itertools.repeat(None)
            old_items = batch.column("items").to_pylist() if again else itertools.repeat(None)
            for text, spans, found in zip(batch.column(text_at).cast(pa.binary()).to_pylist(), old_hits, old_items):
                words = words_of(text)
                hit, names_found = automaton.scan(words)
                if again and spans:
                    for a, b in zip(spans[::2], spans[1::2]):
                        hit[a:b] = True
                    names_found = names_found | set(found)
                columns["n_words"].append(len(words))
                columns["hits"].append(np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).tolist())
                columns["items"].append(sorted(x for x in names_found if x is not None))
            kept = [batch.column(c) for c in names]
            added = [pa.array(columns["n_words"], pa.int64()), pa.array(columns["hits"], pa.list_(pa.int32())), pa.array(columns["items"], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(kept + added, names=[*names, *columns])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names)
    return docs.mapInArrow(run, f"{fields}, {_HITS}")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, words_per_pass: int = 2_000_000) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    scanned = scan_documents(docs.select("doc_id", "text"), items, window, words_per_pass)
    spans = F.sequence(F.lit(0), F.size("hits") - 2, F.lit(2))
    n_hit = F.when(F.size("hits") > 0, F.aggregate(spans, F.lit(0).cast("long"), lambda a, i: a + F.element_at("hits", i + 2) - F.element_at("hits", i + 1))).otherwise(F.lit(0).cast("long"))
    return scanned.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")).cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def _without(text: bytes, hits: list[int], min_span: int) -> bytes:
    """The text without the hit spans of at least ``min_span`` words; white space around a span shrinks to one space or newline."""
    at = [m.span() for m in _WORD.finditer(text)]
    parts, last = [], 0
    for a, b in zip(hits[::2], hits[1::2]):
        if b - a >= min_span:
            parts.append(text[last:at[a][0]])
            last = at[b - 1][1]
    parts.append(text[last:])
    kept = parts[0]
    for part in parts[1:]:
        gap = b"\n" if kept[-1:] == b"\n" or part[:1] == b"\n" else b" "
        kept = kept.rstrip() + gap + part.lstrip(b" \t\r\n.,;:!?") if kept.strip() else part.lstrip(b" \t\r\n.,;:!?")
    return kept


def remove_spans(docs: DataFrame, items: DataFrame, window: int = 10, min_span: int = 1, max_coverage: float = 0.5, words_per_pass: int = 2_000_000) -> DataFrame:
    """Documents without contaminated spans, in the columns that came in.

    Spans of at least ``min_span`` words go from the text; a document whose hit words are more than ``max_coverage`` of all its words
    goes as a whole. Others, null and empty texts included, are untouched. Documents need a text; ids may repeat or be null.
    """
    hidden = {c: free_name(docs, "_was_" + c) for c in docs.columns if c.lower() in ("n_words", "hits", "items")}
    scanned = scan_documents(docs.withColumnsRenamed(hidden), items, window, words_per_pass)
    hit_words = F.aggregate("hits", F.struct(F.lit(0).alias("n"), F.lit(-1).alias("sign")), lambda a, x: F.struct((a["n"] + a["sign"] * x).alias("n"), (-a["sign"]).alias("sign")), lambda a: a["n"])
    scanned = scanned.where((F.size("hits") == 0) | (hit_words <= F.col("n_words") * F.lit(float(max_coverage)))).drop("n_words", "items")
    names = [c for c in scanned.columns if c != "hits"]

    def cut(batches):
        for batch in pieces(batches):
            hits = batch.column("hits")
            texts = batch.column("text")
            if any(len(h) for h in hits):
                values = texts.to_pylist()
                for i, h in enumerate(hits.to_pylist()):
                    if h:
                        values[i] = _without(values[i].encode("utf-8", "surrogatepass"), h, min_span).decode("utf-8", "replace")
                texts = pa.array(values, texts.type)
            yield pa.RecordBatch.from_arrays([texts if c == "text" else batch.column(c) for c in names], names=names)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scanned.schema.fields if f.name != "hits")
    return scanned.mapInArrow(cut, fields).withColumnsRenamed({v: k for k, v in hidden.items()})

