"""Table cleaning: sparse columns, imputation, date columns, outlier clipping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from pitwise.functions.scalars import is_numeric, parse_datetime
from pitwise.operators.counts import CountStore, count_store
from pitwise.operators.ordering import forward_fill
from pitwise.session import materialize


def null_shares(df: DataFrame) -> dict[str, float]:
    """Missing share of every column in one pass."""
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    return {c: row[c] / max(row["__n"], 1) for c in df.columns}


def drop_sparse_columns(df: DataFrame, threshold: float = 0.40) -> DataFrame:
    """Drop columns whose missing share is above the threshold."""
    shares = null_shares(df)
    return df.drop(*[c for c in df.columns if shares[c] > threshold])


def keep_filled_columns(df: DataFrame, min_nonnull: float = 0.8) -> DataFrame:
    """Keep columns with at least this share of values."""
    shares = null_shares(df)
    return df.select(*[c for c in df.columns if 1 - shares[c] >= min_nonnull])


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column as text, the smallest among ties: ``(column, value, n)``.

    Counts are taken per (column, value) with partial aggregation, so a column of distinct values is spread over all
    tasks; the final pick is a minimum per column, not a sorted group.
    """
    types = {f.name: f.dataType for f in df.schema}
    cells = F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), _sort_key(c, types[c]).alias("sort"), F.col(c).cast("string").alias("value")) for c in columns]))
    counts = df.select(cells).where("value is not null").groupBy("column", "sort", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "sort", "value")).alias("b"))
    return best.select("column", F.col("b.value").alias("value"), (-F.col("b.n")).alias("n"))


def _sort_key(name: str, dtype: T.DataType):
    return F.col(name).cast("double") if is_numeric(dtype) and not isinstance(dtype, T.BooleanType) else F.lit(None).cast("double")


def fitted_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    return {r["column"]: r["value"] for r in modes(df, columns).collect()} if columns else {}


def _kinds(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Number columns, and the others, which are counted by their text."""
    types = {f.name: f.dataType for f in df.schema}
    numeric = [c for c in columns if is_numeric(types[c]) and not isinstance(types[c], T.BooleanType)]
    return numeric, [c for c in columns if c not in numeric]


def impute_values(df: DataFrame, columns: Sequence[str], store: CountStore | None = None) -> dict[str, object]:
    """Fill value per column: exact median for numbers, mode for the rest, ``Unknown`` without any value.

    Medians and modes come from one kept table of counts; ``store`` is one that holds these columns already.
    """
    numeric, other = _kinds(df, columns)
    if not columns:
        return {}
    store = store or count_store(df, numeric, other)
    medians = {c: q["median"] for c, q in store.fitted({"median": 0.5}, numeric).items()}
    found = {c: f["mode"] for c, f in store.texts.items() if f["n"]}
    return {**medians, **{c: found.get(c, "Unknown") for c in other}}


def fill_with(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace missing cells by fitted values. A numeric column becomes double when its fill value is fractional."""
    types = {f.name: f.dataType for f in df.schema}
    filled = {}
    for c, v in values.items():
        if v is None or c not in types:
            continue
        dtype = types[c]
        if is_numeric(dtype) and isinstance(v, float) and not v.is_integer():
            dtype = T.DoubleType()
        elif v == "Unknown" and not isinstance(dtype, T.StringType):
            dtype = T.StringType()
        filled[c] = F.coalesce(F.col(c).cast(dtype), F.lit(v).cast(dtype))
    return df.withColumns(filled)


def impute(df: DataFrame) -> DataFrame:
    """Fill every column that has gaps."""
    shares = null_shares(df)
    return fill_with(df, impute_values(df, [c for c in df.columns if shares[c] > 0]))


def date_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "date" in c.lower()]


def standardize_dates(df: DataFrame, *, order_by: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parse date columns (unreadable text becomes null), then carry dates forward in row order."""
    columns = list(columns) if columns is not None else date_columns(df)
    types = {f.name: f.dataType for f in df.schema}
    parsed = df.withColumns({c: parse_datetime(c) for c in columns if isinstance(types[c], T.StringType)})
    return forward_fill(parsed, columns, order_by=order_by) if columns else parsed


def clippable(df: DataFrame) -> list[str]:
    """Numeric columns by the default name rule: neither ``id`` nor ``is_`` anywhere in the name."""
    return [f.name for f in df.schema if is_numeric(f.dataType) and not isinstance(f.dataType, T.BooleanType)
            and "id" not in f.name.lower() and "is_" not in f.name.lower()]


def clip_bounds(df: DataFrame, columns: Sequence[str], multiplier: float = 1.5, min_distinct: int = 5,
                store: CountStore | None = None) -> dict[str, tuple[float, float]]:
    """Interquartile bounds of columns that vary enough; distinct values and quartiles come from the same kept counts."""
    if not columns:
        return {}
    store = store or count_store(df, columns)
    varied = [c for c in columns if c in store.numbers and store.numbers[c]["distinct"] >= min_distinct]
    bounds = {}
    for c, q in store.fitted({"q1": 0.25, "q3": 0.75}, varied).items():
        spread = q["q3"] - q["q1"]
        if spread:
            bounds[c] = (q["q1"] - multiplier * spread, q["q3"] + multiplier * spread)
    return bounds


def clip_iqr(df: DataFrame, multiplier: float = 1.5, columns: Sequence[str] | None = None, store: CountStore | None = None) -> DataFrame:
    """Clip to the interquartile bounds on both sides; clipped columns become double. ``store`` holds counts of these columns."""
    bounds = clip_bounds(df, list(columns) if columns is not None else clippable(df), multiplier, store=store)
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c).cast("double"), F.lit(high)), F.lit(low)))
        for c, (low, high) in bounds.items()})


def drop_duplicate_rows(df: DataFrame, order_by: str) -> DataFrame:
    """Distinct rows apart from the position column; the first position of each row stays."""
    columns = [c for c in df.columns if c != order_by]
    return df.groupBy(*columns).agg(F.min(order_by).alias(order_by)).select(*df.columns)


def clean_table(df: DataFrame, *, order_by: str, drop_threshold: float = 0.40, multiplier: float = 1.5) -> DataFrame:
    """Distinct rows, dates, sparse columns, gaps, outliers, in this order.

    The distinct rows are kept, since statistics of the whole table are fitted on them. One table of counts gives the medians, the modes
    and, with the gaps moved to their fill values, the bounds of the clipped columns.
    """
    work = materialize(drop_duplicate_rows(df, order_by))
    work = standardize_dates(work, order_by=order_by, columns=[c for c in date_columns(work) if c != order_by])
    body = work.drop(order_by)
    shares = null_shares(body)
    work = work.drop(*[c for c in body.columns if shares[c] > drop_threshold])
    gaps = [c for c in work.columns if c != order_by and shares[c] > 0]
    clips = [c for c in clippable(work) if c != order_by]
    numeric, other = _kinds(work, gaps)
    store = count_store(work, list(dict.fromkeys([*numeric, *clips])), other)
    fills = impute_values(work, gaps, store)
    return clip_iqr(fill_with(work, fills), multiplier, clips, store.with_missing_as(fills))
