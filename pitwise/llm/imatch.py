"""Document fingerprints by I-Match over several randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies within a band. Its lower end is a share of the documents, so the lexicon has
at most (mean number of distinct terms of a document) / (that share) terms, however many documents there are; it is sent to every task.
A fingerprint is the hash of a document's sorted distinct lexicon terms, followed by one short hash for each random subset of the
lexicon. Subsets come in levels that keep ever fewer terms, so that long and short documents both have subsets with a few terms of theirs.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitwise.llm.common import map_batches, pieces, words_of

#: Shares of the lexicon that the subsets of a level keep, and subsets per level.
LEVELS = (1 / 4, 1 / 16, 1 / 64, 1 / 256, 1 / 1024, 1 / 4096)
SUBSETS = 24
_FLUSH = 200_000        # terms that a task counts before it passes the counts on


class Lexicon(NamedTuple):
    index: dict[bytes, int]         # terms by their place in sorted order
    offsets: np.ndarray             # per term: where its subsets begin
    subsets: np.ndarray             # numbers of the subsets that hold the term, term after term
    hashes: np.ndarray              # a hash of each term


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(term, n): how many texts have the term. Tasks add up before the shuffle, in tables of a bounded size."""
    def count(batches):
        seen: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])
            seen.clear()
            return out
        for batch in pieces(batches):
            for text in batch.column(0).to_pylist():
                seen.update(set(words_of(text)))
                if len(seen) > _FLUSH:
                    yield flush()
        if seen:
            yield flush()
    return texts.mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))


def lexicon_terms(docs: DataFrame, least_share: float, most_share: float) -> list[bytes]:
    """Sorted terms that at least ``least_share`` and at most ``most_share`` of all documents have."""
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    n = docs.count()
    band = document_frequencies(texts).where((F.col("n") >= n * least_share) & (F.col("n") <= n * most_share) & (F.col("n") > 1)).select("term")
    return sorted(bytes(r.term) for r in band.toLocalIterator())


def build_lexicon(terms: list[bytes], seed: int = 0) -> Lexicon:
    """Draws the subsets of each term by a hash of the term."""
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(t, seed) for t in terms), np.uint64, len(terms))
    member = []
    for level, share in enumerate(LEVELS):
        for k in range(SUBSETS):
            salt = np.uint64(xxhash.xxh3_64_intdigest(f"{seed}:{level}:{k}".encode()))
            x = (hashes ^ salt) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(32)
            at = np.flatnonzero(x < np.uint64(int(share * 2.0 ** 64)))
            member.append(np.stack([at, np.full(len(at), level * SUBSETS + k)]))
    pairs = np.concatenate(member, axis=1)
    pairs = pairs[:, np.lexsort((pairs[1], pairs[0]))]
    return Lexicon({t: i for i, t in enumerate(terms)}, np.searchsorted(pairs[0], np.arange(len(terms) + 1)), pairs[1].astype(np.int16), hashes)


_SIZE = 8 + 2 * len(LEVELS) * SUBSETS


def fingerprint(text: bytes | None, lexicon: Lexicon) -> bytes:
    """Eight bytes for the whole lexicon, then two for each subset; a subset without terms of the text has zeros.

    The terms are a sorted set, and the hash of a part of it adds up mixed hashes of its terms. A text without lexicon terms has the hash of
    all its sorted distinct words in front, so equal texts always agree.
    """
    words = set(words_of(text))
    found = sorted(i for i in map(lexicon.index.get, words) if i is not None)
    if not found:
        return xxhash.xxh3_64_digest(b" ".join(sorted(words)) if words else text or b"", 1) + bytes(_SIZE - 8)
    terms = np.array(found)
    starts, counts = lexicon.offsets[terms], lexicon.offsets[terms + 1] - lexicon.offsets[terms]
    hashes = lexicon.hashes[terms]
    at = np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)
    subset = lexicon.subsets[at]
    sums = np.zeros(len(LEVELS) * SUBSETS, np.uint64)
    np.add.at(sums, subset, np.repeat(hashes, counts))
    sums = (sums ^ (sums >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    parts = ((sums >> np.uint64(32)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    parts[np.bincount(subset, minlength=len(parts)) == 0] = 0
    return xxhash.xxh3_64_digest(hashes.tobytes()) + parts.tobytes()


def likeness(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """From 0 to 1, pair by pair: the largest share, over the levels, of subsets that agree among those that either document has terms in.

    A level counts at least half of its subsets, so that a single shared term is not taken for likeness. Equal fingerprints have 1.
    """
    x, y = (np.frombuffer(b"".join(side), np.uint8).reshape(len(side), _SIZE) for side in (a, b))
    same_all = (x == y).all(axis=1)
    x, y = (np.ascontiguousarray(side[:, 8:]).view(np.uint16).reshape(len(side), len(LEVELS), SUBSETS) for side in (x, y))
    either = ((x != 0) | (y != 0)).sum(axis=2)
    same = ((x == y) & (x != 0)).sum(axis=2)
    return np.where(same_all, 1.0, (same / np.maximum(either, SUBSETS // 2)).max(axis=1)) if len(a) else np.zeros(0)


def with_fingerprints(docs: DataFrame, lexicon: Lexicon, name: str = "fingerprint") -> DataFrame:
    """Documents with the fingerprint of their whole text (null counts as empty); the name must be free."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"documents already have {name}")
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)       # bounded by the band's lower end
    columns = docs.columns
    at = columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(t, sent.value).hex() for t in batch.column(at).cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], names=[*columns, name])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_batches(docs, run, f"{fields}, `{name}` string")


def _numbers(values: list[int]) -> Column:
    """An array constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _bucket(k: Column, cuts: list[int]) -> Column:
    """How many cuts are at most ``k``, looked up in two steps of about the square root of the number of cuts."""
    if not cuts:
        return F.lit(0)
    step = max(1, math.isqrt(len(cuts)))
    least = lambda c: c <= k
    coarse = F.size(F.filter(_numbers(cuts[::step]), least))
    fine = F.size(F.filter(F.slice(_numbers(cuts), (coarse - 1) * step + 1, F.lit(step)), least))
    return F.when(coarse > 0, (coarse - 1) * step + fine).otherwise(F.lit(0))


def next_in_order(rows: DataFrame, keys: DataFrame, key: str, tie: Column, names: list[str], buckets: int) -> DataFrame:
    """Rows with next_<name>: the values of the row that follows by ``key``, then by ``tie``; after the last row comes the first.

    Nulls of the key come last. The key's range is cut at quantiles; the first key of a bucket goes to the bucket before it as well, so a
    row finds its successor within its own bucket and no single task sees the whole order. Only bounds of buckets reach the driver. ``keys`` has
    the key of every row, so that the bounds need not wait for what the rows cost.
    """
    k = F.col(key).cast("long")
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = keys.agg(F.percentile_approx(k, shares, 50_000).alias("cuts")).first().cuts if buckets > 1 else []
    cuts = sorted(set(cuts or []))
    bucket = F.when(k.isNull(), F.lit(len(cuts) + 1)).otherwise(_bucket(k, cuts)).cast("int")
    held = rows.withColumn("_bucket", bucket).withColumn("_tie", tie)
    firsts = {r["_bucket"]: r["least"] for r in keys.withColumn("_bucket", bucket).groupBy("_bucket").agg(F.min(k).alias("least")).collect()}
    order = sorted(firsts)
    if not order:
        return rows.select("*", *[F.col(n).alias(f"next_{n}") for n in names])
    before = dict(zip(order[1:] + order[:1], order))        # the bucket that needs the first key of this one
    least = F.get(_numbers([firsts[b] if firsts.get(b) is not None else 0 for b in range(len(cuts) + 2)]), F.col("_bucket"))
    to = F.get(_numbers([before.get(b, -1) for b in range(len(cuts) + 2)]), F.col("_bucket")).cast("int")
    own = F.struct(F.lit(False).alias("ahead"), F.col("_bucket").alias("bucket"))
    is_first = k.isNull() | (k == least)
    dealt = held.withColumn("_copy", F.explode(F.when(is_first, F.array(own, F.struct(F.lit(True).alias("ahead"), to.alias("bucket")))).otherwise(F.array(own))))
    dealt = dealt.withColumn("_ahead", F.col("_copy.ahead")).withColumn("_bucket", F.col("_copy.bucket"))
    window = W.partitionBy("_bucket").orderBy("_ahead", F.col(key).asc_nulls_last(), "_tie")
    leads = dealt.select("*", *[F.lead(n).over(window).alias(f"next_{n}") for n in names])
    return leads.where("not _ahead").drop("_bucket", "_copy", "_tie", "_ahead")


def edited_fingerprints(docs: DataFrame, least_share: float = 0.001, most_share: float = 0.2, buckets: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last quarter of its code points replaced by as many first ones of the next document by doc_id (or all it has).
    Texts cross the shuffle compressed. Null texts count as empty. Rows with one id follow each other by a hash of their text; rows without an id come last.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    sent = spark.sparkContext.broadcast(build_lexicon(lexicon_terms(texts, least_share, most_share)))      # bounded by the band's lower end

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(1).to_pylist()
        packer = zstandard.ZstdCompressor(level=3)
        columns = [pa.array([packer.compress(t) for t in values], pa.binary()), pa.array([fingerprint(t, sent.value) for t in values], pa.binary()),
                   pa.array(np.array([xxhash.xxh3_64_intdigest(t) for t in values], np.uint64).view(np.int64))]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "packed", "print", "tie"])
    packed = map_batches(texts.select("doc_id", F.col("text").cast("binary").alias("text")), pack, "doc_id long, packed binary, print binary, tie long")
    buckets = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = next_in_order(packed, texts.select("doc_id"), "doc_id", F.col("tie"), ["packed", "print"], buckets)

    def edit(batch: pa.RecordBatch) -> pa.RecordBatch:
        unpack = zstandard.ZstdDecompressor().decompress
        own, following = (batch.column(c).to_pylist() for c in ("print", "next_print"))
        sizes, hashes, prints = [], [], []
        for raw, after in zip(batch.column("packed").to_pylist(), batch.column("next_packed").to_pylist()):
            text = unpack(raw).decode("utf-8", "replace")
            part = len(text) // 4
            edited = (text[:len(text) - part] + unpack(after).decode("utf-8", "replace")[:part]).encode()
            sizes.append(len(text))
            hashes.append(hashlib.sha256(edited).hexdigest())
            prints.append(fingerprint(edited, sent.value))
        columns = [pa.array(sizes, pa.int64()), pa.array(hashes), pa.array([p.hex() for p in own]), pa.array([p.hex() for p in prints]), pa.array(likeness(own, prints)), pa.array(likeness(own, following))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    wanted = placed.select("doc_id", "packed", "print", "next_packed", "next_print")
    return map_batches(wanted, edit, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
