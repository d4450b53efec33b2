"""Global order without a global sort: exact quantiles, ranks, forward fill and positional splits.

Everything rests on one idea. Values are counted per distinct value (partial aggregation), distinct
values are cut into buckets of about equal depth, bucket totals give the running count before each
bucket, and only the inside of a bucket is windowed. No window ever spans a whole column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pitwise.session import materialize

SMALL = 1_000_000    # distinct values that one window task holds; more values make more buckets, not larger ones
MOST_RANGES = 10_000     # ranges of a forward fill, the one place where a window sees one row per range


def as_number(c: str | Column, dtype: T.DataType) -> Column:
    """Order-preserving number for a numeric, date, timestamp or boolean column."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(F.to_timestamp(c)).cast("double")
    return c.cast("double")


def exact_number(c: str | Column, dtype: T.DataType) -> Column:
    """The part of a value that a double cannot hold: whole numbers, dates, instants and decimals of up to 18 digits as a long, else 0.

    ``(as_number, exact_number)`` sorts and compares like the value itself, since the double never decreases where the value grows.
    """
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(F.to_timestamp(c))
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return c.cast("long")
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        return (c * F.lit(10 ** dtype.scale)).cast("long")
    return F.lit(0).cast("long")


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long counts ``(by…, column, value double, exact long, n)`` of numeric columns, nulls and NaN left out."""
    types = {f.name: f.dataType for f in df.schema}
    cells = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), as_number(c, types[c]).alias("value"), exact_number(c, types[c]).alias("exact")) for c in columns]))
    return (df.select(*by, cells).where("value is not null and not isnan(value)")
            .groupBy(*by, "column", "value", "exact").agg(F.count(F.lit(1)).alias("n")))


def ranged(df: DataFrame, value: str, cuts: Sequence[float], name: str) -> DataFrame:
    """Add the range (a double column's place among the cuts) by binary search; without finite cuts all rows share one."""
    finite = sorted({c for c in cuts if abs(c) != float("inf")})
    if not finite:
        return df.withColumn(name, F.lit(0.0))
    return Bucketizer(splits=[float("-inf"), *finite, float("inf")], inputCol=value, outputCol=name).transform(df)


def _bucketed(counts: DataFrame, buckets: int) -> DataFrame:
    """Add ``bucket`` by equal-depth edges over the distinct values, all columns sketched in one pass."""
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    rows = counts.groupBy("column").agg(F.percentile_approx("value", shares, 10 * buckets).alias("cuts")).collect()
    parts = [ranged(counts.where(F.col("column") == r["column"]), "value", r["cuts"] or [], "bucket") for r in sorted(rows, key=lambda r: r["column"])]
    return reduce(DataFrame.unionByName, parts) if parts else counts.withColumn("bucket", F.lit(0.0))


def buckets_for(distinct: int, small: int = SMALL, edges: int | None = None) -> int:
    """How many buckets keep about ``small`` distinct values each; 0 for one window over all."""
    return (edges or max(2, -(-distinct // max(small, 1)))) if distinct > small else 0


def settled_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), small: int = SMALL, edges: int | None = None) -> tuple[DataFrame, int]:
    """Value counts and the number of buckets they need (one sketch pass); counts in buckets are kept, since they are read several times."""
    row = df.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    buckets = buckets_for(max(row), small, edges)
    counts = value_counts(df, columns, by)
    return (materialize(counts) if buckets else counts), buckets


def running_counts(counts: DataFrame, by: Sequence[str] = (), *, buckets: int = 0) -> DataFrame:
    """Add ``before`` (rows of the group with a smaller value) and ``total`` (rows of the group), exact.

    Counts in buckets are read several times: pass the result of ``settled_counts``.
    """
    group = [*by, "column"]
    whole = Window.partitionBy(*group)
    counts = counts if "exact" in counts.columns else counts.withColumn("exact", F.lit(0).cast("long"))
    if not buckets:
        earlier = whole.orderBy("value", "exact").rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumns({"before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "total": F.sum("n").over(whole)})
    cut = _bucketed(counts, buckets)
    per_bucket = cut.groupBy(*group, "bucket").agg(F.sum("n").alias("__n"))
    earlier = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("bucket").alias("__bucket"),
                                F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"),
                                F.sum("__n").over(whole).alias("total"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]) & (
        F.col("bucket") == F.col("__bucket"))
    inside = Window.partitionBy(*group, "bucket").orderBy("value", "exact").rowsBetween(Window.unboundedPreceding, -1)
    return (cut.withColumn("__in", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(offsets, same).withColumn("before", F.col("__offset") + F.col("__in"))
            .select(*group, "value", "exact", "n", "before", "total"))


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], by: Sequence[str] = (), *,
              small: int = SMALL, edges: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: ``(by…, column, n, <label>…)``.

    Columns without any value have no row.
    """
    counts, buckets = settled_counts(df, columns, by, small, edges)
    return quantiles_of_counts(counts, probabilities, by, buckets=buckets)


def quantiles_of_counts(counts: DataFrame, probabilities: Mapping[str, float], by: Sequence[str] = (), *,
                        buckets: int = 0) -> DataFrame:
    """As ``quantiles``, from counts ``(by…, column, value, n)`` that are already aggregated."""
    group = [*by, "column"]
    placed = running_counts(counts, by, buckets=buckets)
    picks, results = [], []
    for label, p in probabilities.items():
        position = (F.col("total") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
            picks.append(F.max(F.when(here, F.col("value"))).alias(f"__{side}_{label}"))
        lo, hi = F.col(f"__lo_{label}"), F.col(f"__hi_{label}")
        share = (F.col("n") - 1) * F.lit(float(p))
        results.append((lo + (hi - lo) * (share - F.floor(share))).alias(label))
    return placed.groupBy(*group).agg(F.max("total").alias("n"), *picks).select(*group, "n", *results)


def fitted_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], **kw) -> dict[str, dict[str, float]]:
    """Quantiles as a small driver-side dictionary, one entry per column."""
    if not columns:
        return {}
    return {r["column"]: {k: r[k] for k in ("n", *probabilities)} for r in quantiles(df, columns, probabilities, **kw).collect()}


def average_ranks(df: DataFrame, columns: Sequence[str], *, small: int = SMALL, edges: int | None = None) -> DataFrame:
    """Mean rank of each distinct value, ties shared: ``(column, value, rank)``."""
    counts, buckets = settled_counts(df, columns, (), small, edges)
    placed = running_counts(counts, buckets=buckets)
    return placed.select("column", "value", (F.col("before") + (F.col("n") + 1) / 2).alias("rank"))


def row_positions(df: DataFrame, by: Sequence[tuple[str, str]], *, name: str = "position", range_rows: int = SMALL) -> DataFrame:
    """Add each row's place, from one, in an order of several columns: ``by`` holds ``(column, "asc" or "desc")``, nulls last in both directions.

    Rows are cut into ranges of the whole key, numbered within their range and shifted by the rows of the ranges before; no window holds more than
    a range, and no window without partitions more than one row per range. Rows that agree in all of ``by`` follow in the order of a hash of
    their other columns, so that a frequent value is cut as well and a second run numbers alike; only equal rows are interchangeable.
    """
    keys = [F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last() for c, way in by]
    rest = [c for c in df.columns if c not in {c for c, _ in by}]
    placed = df.withColumn("__tie", F.xxhash64(*rest) if rest else F.lit(0).cast("long"))
    ranges = max(1, -(-df.count() // range_rows))
    cut = placed.repartitionByRange(ranges, *keys, "__tie") if ranges > 1 else placed
    cut = materialize(cut.withColumn("__range", F.spark_partition_id() if ranges > 1 else F.lit(0)))          # ranges may fall anew when they are computed again
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)                            # one row per range
    before = cut.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).select("__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__range").orderBy(*keys, "__tie")
    return (cut.withColumn("__at", F.row_number().over(inside)).join(before, "__range")
            .select(*df.columns, (F.col("__before") + F.col("__at")).alias(name)))


def order_statistic(df: DataFrame, column: str, positions: Sequence[int], *, small: int = SMALL, edges: int | None = None) -> dict[int, tuple[float, int, int, int]]:
    """For each zero-based position of the sorted column: the value there as a double and exactly, the number of smaller rows, and of equal rows."""
    counts, buckets = settled_counts(df, [column], (), small, edges)
    placed = running_counts(counts, buckets=buckets)
    row = placed.agg(*[_at(p).alias(str(p)) for p in positions]).first()
    return {p: tuple(row[str(p)]) for p in positions}


def _at(position: int) -> Column:
    """Aggregate: the value that covers a position."""
    return F.max(F.when((F.col("before") <= position) & (F.lit(position) < F.col("before") + F.col("n")), F.struct("value", "exact", "before", "n")))


def forward_fill(df: DataFrame, columns: Sequence[str], *, order_by: str, max_missing: float = 0.5,
                 bucket_rows: int | None = None) -> DataFrame:
    """Carry the last known value forward along a unique integer ``order_by``, dense or sparse.

    A column is filled only if less than ``max_missing`` of it is missing; leading gaps stay. Rows are cut into ranges at quantiles of the
    positions; each range is filled on its own, and the last value before it comes from a table with one row per range, so no
    window without partitions sees more rows than there are ranges.
    """
    shares = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    chosen = [c for c in columns if 0 < shares[c] < shares["__n"] * max_missing]
    if not chosen:
        return df
    ranges = min(MOST_RANGES, -(-shares["__n"] // (bucket_rows or 100_000)))
    cuts = df.approxQuantile(order_by, [i / ranges for i in range(1, ranges)], 0.25 / ranges) if ranges > 1 else []
    cut = ranged(df.withColumn("__position", F.col(order_by).cast("double")), "__position", cuts, "__range").drop("__position")
    last = [F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(order_by), F.col(c).alias("v")))).alias(f"__{c}") for c in chosen]
    ends = cut.groupBy("__range").agg(*last)
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    carries = ends.select("__range", *[F.last(f"__{c}", ignorenulls=True).over(earlier)["v"].alias(f"__{c}") for c in chosen])
    inside = Window.partitionBy("__range").orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
    filled = cut.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in chosen})
    return (filled.join(carries, "__range", "left")
            .select(*[F.coalesce(c, f"__{c}").alias(c) if c in chosen else F.col(c) for c in df.columns]))


def split_bounds(total: int, train_ratio: float = 0.70, val_ratio: float = 0.15) -> tuple[int, int]:
    """Row positions at which validation and test begin."""
    if total == 0:
        raise ValueError("nothing to split: the input has no rows")
    if total < 3:
        raise ValueError("a train/val/test split needs at least three rows")
    if train_ratio <= 0 or val_ratio <= 0 or train_ratio + val_ratio >= 1:
        raise ValueError("ratios must be positive and must leave rows for the test split")
    first = max(1, int(total * train_ratio))
    second = max(first + 1, min(int(total * (train_ratio + val_ratio)), total - 1))
    if not 0 < first < second < total:
        raise ValueError("these ratios leave no rows for the test split")
    return first, second


def chronological_split(df: DataFrame, *, sort_by: str, tie_by: str, train_ratio: float = 0.70,
                        val_ratio: float = 0.15, name: str = "split", small: int = SMALL, edges: int | None = None) -> DataFrame:
    """Add ``split`` (train, val, test) by position in ``(sort_by, tie_by)`` order; ``tie_by`` is a unique number.

    Only the two boundary positions are located: first the sort value they fall on, then the tie value among the rows with exactly that
    sort value. Rows whose sort value is null or NaN come last, after infinity. The data itself is never sorted, and numbers are compared exactly.
    """
    types = {f.name: f.dataType for f in df.schema}
    s, s_exact = as_number(sort_by, types[sort_by]), exact_number(sort_by, types[sort_by])
    t, t_exact = as_number(tie_by, types[tie_by]), exact_number(tie_by, types[tie_by])
    missing = s.isNull() | F.isnan(s)
    size = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("missing")).first()
    positions = split_bounds(size["n"], train_ratio, val_ratio)
    present = size["n"] - size["missing"]
    found = order_statistic(df, sort_by, [p for p in positions if p < present], small=small, edges=edges) if positions[0] < present else {}
    here = {p: (~missing & (s == found[p][0]) & (s_exact == found[p][1])) if p in found else missing for p in positions}
    place = {p: p - int(found[p][2]) if p in found else p - present for p in positions}
    group = F.when(here[positions[0]], F.lit(positions[0])).when(here[positions[1]], F.lit(positions[1]))
    second = positions[0] if found.get(positions[0], (None,) * 2)[:2] == found.get(positions[1], (None,) * 2)[:2] else positions[1]     # one value holds both
    ties, buckets = settled_counts(df.select(group.alias("__g"), F.col(tie_by)).where("__g is not null"), [tie_by], ["__g"], small, edges)
    placed = running_counts(ties, ["__g"], buckets=buckets)
    row = placed.agg(*[F.max(F.when((F.col("__g") == g) & (F.col("before") <= place[p]) & (F.lit(place[p]) < F.col("before") + F.col("n")), F.struct("value", "exact"))).alias(str(p))
                       for p, g in zip(positions, (positions[0], second))]).first()
    below = []
    for p in positions:
        k, k_exact = row[str(p)]
        earlier = (~missing & ((s < found[p][0]) | ((s == found[p][0]) & (s_exact < found[p][1])))) if p in found else ~missing
        below.append(earlier | (here[p] & ((t < k) | ((t == k) & (t_exact < k_exact)))))
    return df.withColumn(name, F.when(below[0], "train").when(below[1], "val").otherwise("test"))


def split_summary(df: DataFrame, *, sort_by: str, name: str = "split") -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("rows"), F.min(sort_by).alias("start_date"), F.max(sort_by).alias("end_date"))


def seeded_sample(df: DataFrame, *, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in an order fixed by a hash of the key and the seed; the same rows on every run."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)).limit(n)
