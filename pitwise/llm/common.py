"""What several operators of this subpackage share: reading, words, bounded label samples, output columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z and every byte that is not of a word ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` to a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: A hash table of words is emptied at this many entries, so that a task's memory is bounded for any vocabulary.
MAX_WORDS_CACHED = 100_000

#: Rows of an Arrow batch that a task turns into Python objects at once.
PIECE_ROWS = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-case words of UTF-8 bytes: digits, letters and everything beyond ASCII. Null has none."""
    return text.translate(WORD_BYTES).split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, computed once for each word while it stays in the table."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS_CACHED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in small slices."""
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(start, PIECE_ROWS)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply a function of small Arrow batches to every partition."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def labelled_sample(labels: DataFrame, value: str, learn: Column, max_rows: int) -> DataFrame:
    """(doc_id, label) of about ``max_rows`` labelled rows at most, taken by a hash of the id.

    Null ids and labels are left out; of repeated ids the largest label counts. The share taken is ``max_rows`` over the number of
    rows, so the size is bounded whatever the table holds (a binomial, within a few per cent), and the frame may be broadcast.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(value).isNotNull() & learn).groupBy("doc_id").agg(F.max(value).alias("label"))
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
    return rows


def fold(modulus: int) -> Column:
    """crc32 of the id as text, modulo: the folds of the classifiers."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def held_out(modulus: int, remainder: int) -> Column:
    """Whether a row is kept out of learning: by its fold, and always without an id."""
    return F.coalesce(fold(modulus) == remainder, F.lit(True))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def sha256(text: Column) -> Column:
    """Lower-case hex of the UTF-8 bytes; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
