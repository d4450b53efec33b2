"""Clean every CSV table of a directory."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pitwise.operators.cleaning import clean_table
from pitwise.sources.tables import load_tables, with_row_order, write_tables


def clean_directory(spark: SparkSession, source: str, target: str, *, drop_threshold: float = 0.40, fmt: str = "csv") -> dict[str, str]:
    """Write ``<name>_clean`` for each non-empty table and return the paths; unreadable files are skipped."""
    paths = {}
    for name, table in load_tables(spark, source, on_error="skip").items():
        if not table.isEmpty():
            table = clean_table(with_row_order(table), order_by="row_order", drop_threshold=drop_threshold).orderBy("row_order").drop("row_order")
        paths.update(write_tables({name: table}, target, fmt=fmt))
    return paths
