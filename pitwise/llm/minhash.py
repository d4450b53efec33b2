"""Near-duplicate detection with circulant MinHash.

Two permutations of the 32-bit numbers make the whole signature: the first mixes the shingles, the second is applied to the mixed
numbers moved back by 0, 1, 2, ... places in a circle, and the smallest value at each place is one coordinate. Coordinates are
banded; documents that share a band are candidates, and a link holds only if it is confirmed on the full shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import WordHashes, map_batches
from pitwise.llm.components import connected_components, gathered
from pitwise.session import materialize

_CHUNK = 1024       # shingles whose coordinates are computed at once


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def shingle_hashes(text: bytes | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text: A-Z lower-cased, words between ASCII white space.

    A text with fewer words than ``size`` has one shingle, all its words; without words it has none.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(words) - width + 1 + i])
    return np.unique(out)


def _first_permutation(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers."""
    x = x * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(12)
    return x


def _second_permutation(x: np.ndarray) -> np.ndarray:
    """Another permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least second permutation of the first one moved back by k places."""
    mixed = _first_permutation((shingles >> np.uint64(32)).astype(np.uint32))
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    out = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(mixed), _CHUNK):
        np.minimum(out, _second_permutation(mixed[None, i:i + _CHUNK] - shifts).min(axis=1), out=out)
    return out


_SETS = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def _signed(values) -> list[int]:
    return np.array(values, np.uint64).view(np.int64).tolist()


def shingle_sets(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, a 128-bit hash of the set, one hash per band) for every row."""
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, firsts, seconds, banded = [], [], [], []
        for text in batch.column(1).to_pylist():
            found = shingle_hashes(text, shingle, hashes)
            counts.append(len(found))
            raw = found.tobytes()
            firsts.append(xxhash.xxh3_64_intdigest(raw))
            seconds.append(xxhash.xxh64_intdigest(raw, 1))
            if len(found):
                sig = signature(found, bands * rows).reshape(bands, rows)
                banded.append(_signed([xxhash.xxh3_64_intdigest(part.tobytes(), k) for k, part in enumerate(sig)]))
            else:
                banded.append([])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(_signed(firsts), pa.int64()), pa.array(_signed(seconds), pa.int64()), pa.array(banded, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")), run, _SETS)


def parity_sketch(shingles: np.ndarray) -> bytes:
    """Bits that say for each slot whether an odd number of shingles fell into it; at least twice as many slots as shingles, a power of two.

    Two sketches differ in at most as many bits as the sets differ in shingles, however their shingles collide.
    """
    bits = max(256, 1 << (2 * len(shingles) - 1).bit_length())
    return np.packbits((np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def _full_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles, sketch) with the full set as sorted 64-bit hashes."""
    hashes = WordHashes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_hashes(text, shingle, hashes) for text in batch.column(1).to_pylist()]
        offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
        values = pa.array(np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64), pa.int64())
        sketches = pa.array([parity_sketch(found) for found in sets], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), values), sketches], names=["id", "shingles", "sketch"])
    return map_batches(texts, run, "id long, shingles array<long>, sketch binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    union = F.size("of_a") + F.size("of_b") - F.col("common")
    return pairs.join(right, "b").join(left, "a").withColumn("common", common).where(100 * F.col("common") >= percent * union).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 32, rows: int = 4) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (it is that document).

    Documents link when their sets of word shingles have 100 * intersection >= percent * union. Equal sets are one node. Nodes that
    share one of ``bands`` bands of ``rows`` coordinates are candidates. First each node is held against the smallest node it shares
    a band with; then, in every band bucket that still holds several components, all pairs of different components are confirmed, so
    no link of a bucket that could join two components is left out, and links within a component, which change nothing, are
    never listed. At similarity s a link escapes all bands with probability (1 - s**rows)**bands, below 1e-7 for 0.8 and the
    defaults. Null and empty texts have an empty set and link with nothing; rows without an id have no component (null) and are kept;
    rows that share an id are one document with several texts.
    """
    sets = materialize(shingle_sets(docs, shingle, bands, rows))
    has = sets.where("n_shingles > 0 and doc_id is not null")
    nodes = has.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    entries = nodes.select("id", "n", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("members")).where("members > 1").drop("members")
    members = materialize(entries.join(buckets, "key"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text")).join(members.select("id").distinct(), "id", "left_semi")
    full = materialize(_full_sets(texts, shingle))
    first = members.where("id > leader").groupBy(F.col("id").alias("b")).agg(F.min("leader").alias("a"))
    links = gathered(_confirmed(first, full, percent))
    known = connected_components(links)
    labels = connected_components(gathered(links.unionByName(_confirmed(cross_pairs(members, known, full, percent), full, percent))))
    of_set = nodes.select("set_a", "set_b", "id").join(labels, nodes["id"] == labels["node"], "left").select("set_a", "set_b", F.coalesce("component", "id").alias("least"))
    joined = sets.drop("bands").join(of_set, ["set_a", "set_b"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("least")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


_BLOCK = 4096       # rows of a block of a large bucket
_ELEMENTS = 2_000_000       # 64-bit words of sketches that are compared at once


def cross_pairs(members: DataFrame, known: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of nodes that share a bucket, lie in different components and may reach the threshold by size and sketch.

    In each bucket the component with most members is left out on one side. Pairs are compared by their parity sketches within blocks of
    at most _BLOCK rows a side, and a large bucket is dealt to as many tasks as it has pairs of blocks. The two bounds are exact, so what they
    drop cannot link; only what passes both becomes a row.
    """
    placed = members.join(known, members["id"] == known["node"], "left").select("key", "id", "n", F.coalesce("component", "id").alias("component"))
    counted = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    largest = counted.groupBy("key").agg(F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("all"), F.count("*").alias("parts")).where("parts > 1")
    largest = largest.select("key", F.col("top.component").alias("top"), F.ceil(F.col("all") / _BLOCK).cast("int").alias("blocks"), F.ceil((F.col("all") - F.col("top.c")) / _BLOCK).cast("int").alias("minor_blocks"))
    shards = 4 * int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = placed.join(largest, "key").join(full.select("id", "sketch"), "id")
    block = lambda n: F.pmod(F.xxhash64(F.lit("block"), "id"), n).cast("int")
    cell = lambda i, j: F.when((F.col("blocks") == 1) & (F.col("minor_blocks") == 1), F.pmod("key", F.lit(shards))).otherwise(F.xxhash64("key", i, j))
    columns = ["key", "id", "n", "component", "sketch"]
    all_side = F.transform(F.sequence(F.lit(0), F.col("minor_blocks") - 1), lambda i: F.struct(cell(i, block(F.col("blocks"))).alias("cell"), F.lit(False).alias("minor")))
    minor_side = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(cell(block(F.col("minor_blocks")), j).alias("cell"), F.lit(True).alias("minor")))
    sides = F.when(F.col("component") == F.col("top"), all_side).otherwise(F.concat(all_side, minor_side))
    dealt = rows.select(*columns, F.explode(sides).alias("side")).select("side.cell", "side.minor", *columns)

    def compare(table: pa.Table) -> pa.Table:
        found = _sketch_pairs(table, percent)
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})
    return dealt.groupBy("cell").applyInArrow(compare, "a long, b long").distinct()


def _sketch_pairs(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a minor row and any row of the same key, of different components, that pass the bounds of size and sketch."""
    key, ids, n, component = (table.column(c).to_numpy() for c in ("key", "id", "n", "component"))
    minor = table.column("minor").to_numpy(zero_copy_only=False).astype(bool)
    sketches = table.column("sketch").to_pylist()
    order = np.lexsort((n, key))
    edges = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1], [True]))) if len(order) else []
    first, second = [], []
    for start, end in zip(edges[:-1], edges[1:]):
        at = order[start:end]
        queries, rows = at[minor[at]], at[~minor[at]]
        bits = np.array([len(sketches[r]) for r in rows])
        sizes = n[rows]
        for width in sorted({*bits.tolist(), *(len(sketches[q]) for q in queries)}):
            same = np.flatnonzero((bits == width) | (bits == 2 * width))
            if not len(same):
                continue
            held_all = _sketch_table(sketches, rows[same], width)
            for q in queries:
                own = len(sketches[q])
                if own not in (width, 2 * width):
                    continue
                use = same if own == width else same[bits[same] == width]       # the narrower of the two widths decides
                low, high = np.searchsorted(sizes[use], [-(-percent * n[q] // 100), n[q] * 100 // percent + 1])
                use = use[low:high]
                use = use[component[rows[use]] != component[q]]
                if not len(use):
                    continue
                mine = _sketch_table(sketches, np.array([q]), width)
                held = held_all[np.searchsorted(same, use)]
                step = max(1, _ELEMENTS // held.shape[1])
                apart = np.concatenate([np.bitwise_count(held[i:i + step] ^ mine).sum(axis=1, dtype=np.int64) for i in range(0, len(held), step)])
                near = rows[use[apart * (100 + percent) <= (100 - percent) * (n[rows[use]] + n[q])]]
                first.append(np.minimum(ids[near], ids[q]))
                second.append(np.maximum(ids[near], ids[q]))
    if not first:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.stack([np.concatenate(first), np.concatenate(second)]), axis=1)
    return pairs[0], pairs[1]


def _sketch_table(sketches: list[bytes], rows: np.ndarray, width: int) -> np.ndarray:
    """Sketches of ``width`` bytes as 64-bit words; one of twice the width is folded, which keeps its bound."""
    out = np.empty((len(rows), width), np.uint8)
    for i, r in enumerate(rows):
        raw = np.frombuffer(sketches[r], np.uint8)
        out[i] = raw if len(raw) == width else raw[:width] ^ raw[width:]
    return out.view(np.uint64)


def deduplicate(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 32, rows: int = 4) -> DataFrame:
    """Documents of which each group of near copies keeps the one with the smallest id, in the columns that came in.

    Rows that are equal in id and text become one. Rows without an id stay.
    """
    gone = near_duplicates(docs, shingle, percent, bands, rows).where("not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    return left.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(left.where("doc_id is null"))
