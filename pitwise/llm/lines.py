"""Removal of repeated passages by overlapping windows of consecutive lines, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import free_name


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def window_starts(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, text_hash, position, wa, wb): every window of consecutive lines with a 128-bit hash of its lines."""
    lines = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), _lines(F.col("text")).alias("lines")).where(F.size("lines") >= window)
    hashed = lines.select("doc_id", "text_hash", F.transform("lines", lambda x: F.xxhash64(x)).alias("a"), F.transform("lines", lambda x: F.xxhash64(F.lit("second"), x)).alias("b"))
    at = F.sequence(F.lit(0), F.size("a") - window)
    windows = F.transform(at, lambda i: F.struct(
        i.alias("position"), F.xxhash64(*[F.get("a", i + k) for k in range(window)]).alias("wa"), F.xxhash64(F.lit("second"), *[F.get("b", i + k) for k in range(window)]).alias("wb")))
    return hashed.select("doc_id", "text_hash", F.inline(windows))


def later_occurrences(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, text_hash, starts): sorted starts of windows that occur earlier, earlier in the order of doc_id (null last), text hash, position."""
    windows = window_starts(docs, window)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "position")
    first = windows.groupBy("wa", "wb").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1").select("wa", "wb", "first")
    later = windows.join(first, ["wa", "wb"]).where(place != F.col("first"))
    return later.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("position")).alias("starts"))


def mark_repeated_lines(docs: DataFrame, window: int = 3) -> DataFrame:
    """Documents with n_lines, n_removed and kept_text (must be free names).

    Windows of ``window`` consecutive lines are compared over all documents. The first occurrence stays; a line that any later
    occurrence covers goes, overlapping occurrences count as one stretch. The earliest place of a line is never covered, so no
    content disappears from the corpus. Texts with fewer lines than the window are untouched, empty lines are lines, null texts stay
    null with no lines. Rows equal in id and text count as one occurrence and are cut alike.
    """
    clash = {"n_lines", "n_removed", "kept_text"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"documents already have {sorted(clash)}")
    names = {c: free_name(docs, c) for c in ("_cut_id", "_cut_hash", "_cut_starts")}
    cuts = later_occurrences(docs.select("doc_id", "text"), window).select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "text_hash", "starts"), names.values())])
    ident, text_hash, starts = (F.col(n) for n in names.values())
    joined = docs.join(cuts, docs["doc_id"].eqNullSafe(ident) & (F.xxhash64(docs["text"]) == text_hash), "left")
    lines = _lines(F.col("text"))
    total, m = F.size(lines), F.size(starts)
    low = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get(starts, k - 1) + window)
    high = lambda k: F.when(k == m, total).otherwise(F.get(starts, k))
    gaps = F.transform(F.sequence(F.lit(0), m), lambda k: F.slice(lines, low(k) + 1, F.greatest(high(k) - low(k), F.lit(0))))
    kept = F.flatten(gaps)
    cut = starts.isNotNull()
    return joined.select(
        *docs.columns, F.when(F.col("text").isNull(), 0).otherwise(total).cast("long").alias("n_lines"),
        F.when(cut, total - F.size(kept)).otherwise(0).cast("long").alias("n_removed"), F.when(cut, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("kept_text"))


def drop_repeated_lines(docs: DataFrame, window: int = 3) -> DataFrame:
    """Documents with shortened texts, in the columns that came in; those of which no line is left go."""
    names = {c: free_name(docs, "_was_" + c) for c in docs.columns if c.lower() in ("n_lines", "n_removed", "kept_text")}
    marked = mark_repeated_lines(docs.withColumnsRenamed(names), window).where("n_removed < n_lines or n_lines = 0")
    columns = [F.col("kept_text").alias(c) if c == "text" else F.col(names.get(c, c)).alias(c) for c in docs.columns]
    return marked.select(columns)
