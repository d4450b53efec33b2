"""A corpus pipeline over documents: quality, repeated lines, near copies, benchmark passages, and a mix by target weights.

Each stage works on everything its predecessor kept and is written as Parquet before the next one reads it, in the shared folder that
spark.checkpoint.dir names (in the warehouse folder where none is set, as in tests). A lost executor so costs at most one stage's tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwise.llm import decontam, lines, minhash, mixing, quality
from pitwise.llm.common import fold, free_name, labelled_sample, read
from pitwise.llm.queries import MAX_LABELLED, labelled_domains

#: Target shares of the tokens in the mix.
WEIGHTS = {"good": 0.97, "toxic": 0.03}


def _counted(docs: DataFrame) -> DataFrame:
    """Documents whose n_chars is that of the text they have now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.7 or more."""
    return quality.keep_good(docs, labelled_sample(read(spark, sf_dir, "labels"), "quality", fold(4) != 2, MAX_LABELLED), least=0.7)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows; documents of which nothing is left go."""
    return _counted(lines.drop_repeated_lines(docs, window=3))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links at a similarity of 0.8 over five-word shingles."""
    return minhash.deduplicate(docs, shingle=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of ten words and more of a benchmark item; documents that are mostly such passages go."""
    return _counted(decontam.remove_spans(docs, read(spark, sf_dir, "benchmark"), window=10, max_coverage=0.5))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the rate that fits the target weights and how many copies of them to take; those of which none is taken go.

    Each document that is more likely good than toxic is taken once at least, whatever the share of toxic tokens, and none of them decides how often others are taken.
    Where documents have columns of these names already, the new ones have an underscore in front.
    """
    own = {c: free_name(docs, f"own_{c}") for c in docs.columns if c.lower() in ("n_tokens", "posterior", "rate", "copies", "draw")}
    mixed = mixing.mix(docs.withColumnsRenamed(own), labelled_domains(spark, sf_dir), WEIGHTS, whole="good").where("copies > 0")
    return mixed.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns], *[F.col(c).alias(free_name(docs, c)) for c in ("rate", "copies")])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", drop_poor),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources to target weights", mix_to_targets),
]

#: The classifier and the fitted rates have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def _folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/pipeline-{uuid.uuid4().hex}"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, in order; the result reads what the last stage wrote."""
    docs, folder = read(spark, sf_dir, "documents"), _folder(spark)
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
