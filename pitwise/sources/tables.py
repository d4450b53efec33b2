"""CSV tables in, cleaned tables and result bundles out. Paths may be local or on any Hadoop file system."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pitwise.functions.scalars import NULL_TOKENS, nan_to_null, null_tokens_to_null, parse_date

log = logging.getLogger(__name__)


def list_files(spark: SparkSession, directory: str, pattern: str) -> list[str]:
    """Sorted paths matching a glob inside a directory, through the Hadoop file system API."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(directory.rstrip("/"))
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        raise FileNotFoundError(f"directory does not exist: {directory}")
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(path, pattern)) or []
    return sorted(str(s.getPath()) for s in found)


def _stem(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, *, mode: str = "PERMISSIVE",
               multi_line: bool = False) -> DataFrame:
    """One CSV table; without a schema, types are inferred. Missing-value tokens and NaN become null.

    ``multi_line`` allows line breaks inside quotes, at the price of one task per file.
    """
    # missing-value tokens would turn a number column into text, so text is read first when there is no schema
    reader = spark.read.option("header", True).option("mode", mode).option("multiLine", multi_line).option("escape", '"')
    if schema is not None:
        text = reader.csv(path)
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return text.select(*[_typed(f, text.columns) for f in wanted])
    text = reader.csv(path)
    cleaned = text.select(*[null_tokens_to_null(F.col(f"`{c}`")).alias(c) for c in text.columns])
    return infer_types(cleaned)


def _typed(field: T.StructField, columns: Sequence[str]):
    if field.name not in columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    text = null_tokens_to_null(F.col(f"`{field.name}`"))
    if isinstance(field.dataType, T.DateType):
        return parse_date(text).alias(field.name)
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        return text.try_cast("double").try_cast(field.dataType).alias(field.name)     # '3.0' is a whole number too
    if isinstance(field.dataType, T.DoubleType):
        return nan_to_null(text.try_cast("double")).alias(field.name)
    return text.try_cast(field.dataType).alias(field.name)


def infer_types(text: DataFrame) -> DataFrame:
    """Narrowest of boolean, long, double and string that every non-null cell of a column fits, in one pass."""
    checks = []
    for i, c in enumerate(text.columns):
        cell = F.col(f"`{c}`")
        checks += [F.count(cell).alias(f"n{i}"), F.count(cell.try_cast("long")).alias(f"l{i}"), F.count(cell.try_cast("double")).alias(f"d{i}"),
                   F.count_if(F.lower(cell).isin("true", "false")).alias(f"b{i}")]
    row = text.agg(*checks).first() if checks else {}
    out = []
    for i, c in enumerate(text.columns):
        cell, n = F.col(f"`{c}`"), row[f"n{i}"]
        kind = ("double" if n == 0 else "long" if row[f"l{i}"] == n else "double" if row[f"d{i}"] == n else "boolean" if row[f"b{i}"] == n else "string")
        out.append((cell if kind == "string" else cell.try_cast(kind)).alias(c))
    return text.select(*out)


def load_tables(spark: SparkSession, directory: str, *, schemas: Mapping[str, T.StructType | str] | None = None, on_error: str = "raise") -> dict[str, DataFrame]:
    """Every ``*.csv`` of a directory, named by file stem, in sorted order.

    ``on_error='raise'``: a missing directory, no file or an unreadable file is an error.
    ``on_error='skip'``: unreadable files are logged and left out; nothing found gives an empty dictionary.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be 'raise' or 'skip'")
    try:
        paths = list_files(spark, directory, "*.csv")
    except FileNotFoundError:
        if on_error == "skip":
            return {}
        raise
    tables: dict[str, DataFrame] = {}
    for path in paths:
        try:
            table = read_table(spark, path, (schemas or {}).get(_stem(path)))
            if not table.columns:
                raise ValueError("no columns")
            tables[_stem(path)] = table
        except Exception as exc:
            if on_error == "raise":
                raise
            log.error("skipping %s: %s", path, exc)
    if not tables and on_error == "raise":
        raise FileNotFoundError(f"no CSV file in {directory}")
    return tables


def require_tables(tables: Mapping[str, DataFrame], names: Iterable[str]) -> None:
    absent = [n for n in names if n not in tables]
    if absent:
        raise FileNotFoundError(f"missing required tables: {', '.join(absent)}")


def with_row_order(df: DataFrame, name: str = "row_order") -> DataFrame:
    """Unique position by (file, offset in file) for callers without a key of their own.

    The number follows the order in which a reader sees the files, so it must be written down (or
    checkpointed) before it may decide anything.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def write_tables(tables: Mapping[str, DataFrame], directory: str, *, suffix: str = "_clean", fmt: str = "csv") -> dict[str, str]:
    """One folder per non-empty table; empty ones are skipped with a warning."""
    paths = {}
    for name, df in tables.items():
        if df.isEmpty():
            log.warning("table %s is empty, skipping", name)
            continue
        paths[name] = write_table(df, f"{directory.rstrip('/')}/{name}{suffix}", fmt=fmt)
    return paths


def write_table(df: DataFrame, path: str, *, fmt: str = "csv", partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def write_bundle(bundle: Mapping[str, DataFrame], directory: str, names: Mapping[str, str], *, fmt: str = "csv") -> dict[str, str]:
    """Write the parts of a result bundle under their fixed names; parts that are absent are left out."""
    return {k: write_table(bundle[k], f"{directory.rstrip('/')}/{n}", fmt=fmt) for k, n in names.items() if isinstance(bundle.get(k), DataFrame)}


def write_splits(df: DataFrame, path: str, *, split: str = "split", fmt: str = "parquet") -> str:
    """All splits in one folder, one partition directory per split."""
    return write_table(df, path, fmt=fmt, partition_by=[split])


def schema_metadata(df: DataFrame) -> DataFrame:
    """``(features, data_types)`` of a frame."""
    return df.sparkSession.createDataFrame(df.dtypes, "features string, data_types string")


def read_modeling_table(spark: SparkSession, path: str, *, dates: Sequence[str]) -> DataFrame:
    """CSV whose date columns are typed as dates."""
    df = read_table(spark, path)
    return df.withColumns({c: parse_date(c) for c in dates if c in df.columns})
