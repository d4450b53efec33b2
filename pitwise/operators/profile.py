"""Statistical profiles: outliers, numeric and categorical fields, histograms, months, coverage, correlation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations
from math import factorial, pi

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitwise.functions.scalars import correlation_strength, parse_date, pct, to_number
from pitwise.operators.counts import CountStore, count_store, per_column
from pitwise.operators.joins import top_k
from pitwise.operators.ordering import SMALL, buckets_for, fitted_quantiles, quantiles_of_counts, running_counts, settled_counts
from pitwise.session import materialize


def _numbers(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    return df.select(*keep, *[to_number(c).alias(c) for c in columns])


def long_cells(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """``(keep…, column, value)`` with one row per cell, narrow, no shuffle."""
    return df.select(*keep, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])))


# -- outliers ----------------------------------------------------------------------------------

def iqr_outliers(df: DataFrame, columns: Sequence[str], *, row_id: str, label: str | None = None, table: str = "",
                 k: int = 5, multiplier: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """Interquartile outliers of each column: a summary and the ``k`` largest offending values.

    A column takes part with at least four numbers and a spread above zero; bounds are exclusive.
    """
    numbers = _numbers(df, columns, row_id, *([label] if label else []))
    fitted = {c: q for c, q in fitted_quantiles(numbers, columns, {"q1": 0.25, "q3": 0.75}).items()
              if q["n"] >= 4 and q["q3"] - q["q1"] != 0}
    spark = df.sparkSession
    rows = [(c, int(q["n"]), q["q1"], q["q3"], q["q3"] - q["q1"], q["q1"] - multiplier * (q["q3"] - q["q1"]),
             q["q3"] + multiplier * (q["q3"] - q["q1"])) for c, q in fitted.items()]
    bounds = spark.createDataFrame(rows, "column string, non_null_count long, q1 double, q3 double, iqr double, low double, high double")
    cells = long_cells(numbers, list(fitted) or columns, F.col(row_id).cast("string").alias("row_id"),
                       (F.col(label).cast("string") if label else F.lit("")).alias("label"))
    outside = cells.join(bounds, "column").where("value < low or value > high")
    counted = outside.groupBy("column").agg(F.count(F.lit(1)).alias("outlier_count"))
    summary = bounds.join(counted, "column", "left").select(
        F.lit(table).alias("table_name"), F.col("column").alias("column_name"), "non_null_count",
        *[F.round(c, 4).alias(n) for c, n in (("q1", "q1"), ("q3", "q3"), ("iqr", "iqr"), ("low", "lower_bound"), ("high", "upper_bound"))],
        F.coalesce("outlier_count", F.lit(0)).alias("outlier_count"),
        pct(F.coalesce("outlier_count", F.lit(0)), F.col("non_null_count")).alias("outlier_pct"))
    examples = top_k(outside, by=["column"], order_by=[F.col("value").desc(), F.col("row_id")], k=k).select(
        F.lit(table).alias("table_name"), F.col("column").alias("column_name"), "row_id", "label", "value", F.col("rank").cast("long").alias("rank"))
    return summary, examples


# -- numeric fields ----------------------------------------------------------------------------

def field_counts(df: DataFrame, numbers: Sequence[str], categories: Sequence[str] = ()) -> CountStore:
    """The counts that ``numeric_profile``, ``histogram`` and ``categorical_profile`` share: one pass over the table for all three."""
    plain = [c for c in numbers if c in categories]
    texts = {c: f"__{c}" for c in plain}          # a column that is both is counted as a number and by its own text
    wide = df.select(*[to_number(c).alias(c) for c in numbers], *[F.col(c).alias(texts.get(c, c)) for c in categories])
    store = count_store(wide, numbers, [texts.get(c, c) for c in categories])
    if not texts:
        return store
    back = F.coalesce(per_column({t: c for c, t in texts.items()}, "string"), F.col("column"))
    named = {v: k for k, v in texts.items()}
    return CountStore(store.counts.withColumn("column", back), store.numbers, {named.get(c, c): f for c, f in store.texts.items()}, store.small)


def numeric_profile(df: DataFrame, columns: Sequence[str], table: str = "", store: CountStore | None = None) -> DataFrame:
    """Counts, five-number summary, mean, standard deviation, bias-corrected skewness and kurtosis, 4 places.

    Moments are centred sums around the exact mean, computed from per-value counts, which quantiles need
    anyway: the table is read once for the counts, which are kept, and everything after works on distinct values.
    ``store`` is one of ``field_counts`` that other profiles of the table share.
    """
    store = store or field_counts(df, columns)
    facts = {c: f for c, f in store.numbers.items() if c in columns}
    middles = store.quantiles({"q1": 0.25, "median": 0.5, "q3": 0.75}, columns)
    n = F.col("n").cast("double")
    var = F.col("m2") / n
    constant = F.col("m2") == 0
    g1 = F.try_divide(F.col("m3") / n, F.pow(var, F.lit(1.5)))
    g2 = F.try_divide(F.col("m4") / n, var * var) - 3
    skew = F.when(n >= 3, F.when(constant, 0.0).otherwise(g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))))
    kurt = F.when(n >= 4, F.when(constant, 0.0).otherwise(
        (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * g2 + 6)))
    std = F.when(n > 1, F.sqrt(F.try_divide(F.col("m2"), n - 1))).otherwise(0.0)
    known = {k: per_column({c: f[k] for c, f in facts.items()}, t) for k, t in (
        ("rows", "long"), ("missing", "long"), ("distinct", "long"), ("min", "double"), ("mean", "double"), ("max", "double"))}
    joined = store.moments().join(middles, "column").withColumns({k: c for k, c in known.items()})
    return joined.select(
        F.lit(table).alias("table_name"), F.col("column").alias("column_name"), F.col("n").alias("non_null_count"),
        (F.col("rows") - F.col("n")).alias("missing_count"), pct(F.col("rows") - F.col("n"), F.col("rows")).alias("missing_pct"),
        F.col("distinct").alias("distinct_count"), *[F.round(c, 4).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")],
        F.round(std, 4).alias("std"), F.round(skew, 4).alias("skew"), F.round(F.abs(skew), 4).alias("abs_skew"),
        F.round(kurt, 4).alias("kurtosis"))


def _three_digits(c: Column) -> Column:
    """Bin edges keep three decimals, or three significant digits below one."""
    magnitude = F.floor(F.log10(F.abs(c)))
    fine = F.when(c == 0, c).when(F.abs(c) >= 1, F.round(c, 3)).otherwise(
        F.round(c * F.pow(F.lit(10.0), 2 - magnitude), 0) / F.pow(F.lit(10.0), 2 - magnitude))
    return F.coalesce(fine, c)


def histogram(df: DataFrame, columns: Sequence[str], *, max_bins: int = 8, exact_up_to: int = 10, store: CountStore | None = None) -> DataFrame:
    """``(column_name, kind, bin, bin_start, bin_end, count)``.

    Few distinct values are listed as they are; otherwise equal-width bins, closed on the right, the lowest edge
    widened by 0.1 % of the range, empty bins included.
    """
    store = store or field_counts(df, columns)
    facts = {c: f for c, f in store.numbers.items() if c in columns and f["n"]}
    bounds = {"lo": ("min", "double"), "hi": ("max", "double"), "distinct": ("distinct", "long")}
    bins = F.least(F.lit(max_bins), F.col("distinct")).cast("int").alias("bins")

    def spanned(frame: DataFrame) -> DataFrame:
        out = frame.select("*", *[per_column({c: f[k] for c, f in facts.items()}, t).alias(name) for name, (k, t) in bounds.items()])
        return out.select("*", bins)

    placed = spanned(store.number_counts().where(F.col("column").isin(list(facts))))
    spans = spanned(df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, facts)).cast("array<string>")).alias("column")))
    few = placed.where(F.col("distinct") <= exact_up_to).select(
        F.col("column").alias("column_name"), F.lit("exact_frequency").alias("kind"),
        F.row_number().over(Window.partitionBy("column").orderBy("value")).alias("bin"),
        F.round("value", 4).alias("bin_start"), F.round("value", 4).alias("bin_end"), F.col("n").alias("count"))
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    position = F.ceil((F.col("value") - F.col("lo")) / width)
    clamped = F.greatest(F.lit(1), F.least(position, F.col("bins"))).cast("int")
    filled = (placed.where(F.col("distinct") > exact_up_to).withColumn("bin", clamped)
              .groupBy("column", "bin").agg(F.sum("n").alias("count")))
    frame = spans.where(F.col("distinct") > exact_up_to).select(
        "column", "lo", "hi", "bins", F.explode(F.sequence(F.lit(1), F.col("bins"))).alias("bin"))
    low_edge = F.when(F.col("bin") == 1, F.col("lo") - (F.col("hi") - F.col("lo")) * 0.001).otherwise(
        F.col("lo") + (F.col("bin") - 1) * width)
    wide = frame.join(filled, ["column", "bin"], "left").select(
        F.col("column").alias("column_name"), F.lit("equal_width_bins").alias("kind"), "bin",
        F.round(_three_digits(low_edge), 4).alias("bin_start"),
        F.round(_three_digits(F.col("lo") + F.col("bin") * width), 4).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"))
    return few.unionByName(wide)


def histogram_json(hist: DataFrame) -> DataFrame:
    """Histogram rows folded to one JSON payload per column; at most a few bins each."""
    item = F.when(F.col("kind") == "exact_frequency", F.to_json(F.struct(F.col("bin_start").alias("value"), "count"))).otherwise(
        F.to_json(F.struct("bin_start", "bin_end", "count")))
    parts = F.array_sort(F.collect_list(F.struct("bin", item.alias("item"))))
    return hist.groupBy("column_name").agg(F.first("kind").alias("distribution_type"), F.concat(
        F.lit("["), F.concat_ws(", ", F.transform(parts, lambda p: p["item"])), F.lit("]")).alias("distribution"))


# -- categorical fields ------------------------------------------------------------------------

def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))
    return cells.where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def top_frequencies(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """Most frequent values per column; ties in value order."""
    counts = category_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    best = top_k(counts, by=["column"], order_by=[F.col("n").desc(), F.col("value")], k=k)
    return best.join(totals, "column").select(
        F.col("column").alias("column_name"), F.col("rank").cast("long").alias("rank"), "value", F.col("n").alias("count"), pct("n", "total").alias("pct"))


def categorical_profile(df: DataFrame, columns: Sequence[str], table: str = "", k: int = 5, store: CountStore | None = None) -> DataFrame:
    """Counts, mode and the top values as JSON, from kept counts (``store``: those that other profiles of the table share)."""
    store = store or field_counts(df, [], columns)
    counts = store.text_counts().where(F.col("column").isin(list(columns)))
    basics = counts.groupBy("column").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_count"))
    best = top_k(counts, by=["column"], order_by=[F.col("n").desc(), F.col("value")], k=k).join(
        basics.select("column", F.col("n").alias("total")), "column")
    item = F.struct("value", F.col("n").alias("count"), pct("n", "total").alias("pct"))
    tops = best.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("rank", item.alias("item")))).alias("tops"))
    rows = per_column({c: f["rows"] for c, f in store.texts.items()}, "long")
    first = F.col("tops")[0]["item"]
    return basics.join(tops, "column").select(
        F.lit(table).alias("table_name"), F.col("column").alias("column_name"), F.col("n").alias("non_null_count"),
        (rows - F.col("n")).alias("missing_count"), pct(rows - F.col("n"), rows).alias("missing_pct"), "distinct_count",
        first["value"].alias("mode_value"), first["count"].alias("mode_count"), first["pct"].alias("mode_pct"),
        F.to_json(F.transform("tops", lambda t: t["item"])).alias("top_values"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Class balance: value, count and share of all rows in percent."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("pct", pct("count", F.lit(counts.agg(F.sum("count")).scalar())))


# -- time --------------------------------------------------------------------------------------

def monthly_profile(df: DataFrame, date: str, *, table: str = "", min_baseline: int = 100, tolerance_pct: float = 40.0) -> DataFrame:
    """Rows per month against the median of the same calendar month, gap months included.

    First and last month are edges and take no part in baselines or verdicts.
    """
    counted = df.select(F.trunc(parse_or_date(df, date), "month").alias("month")).where("month is not null").groupBy("month").agg(
        F.count(F.lit(1)).alias("n"))
    span = counted.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    months = span.where("first is not null").select("first", "last", F.explode(F.sequence(
        "first", "last", F.expr("interval 1 month"))).alias("month"))
    edge = (F.col("month") == F.col("first")) | (F.col("month") == F.col("last"))
    full = months.join(counted, "month", "left").select(
        "month", F.month("month").alias("calendar_month"), F.coalesce("n", F.lit(0)).alias("row_count"), edge.alias("is_edge_month"))
    # one row per month from here on
    inner = full.where("not is_edge_month").select(
        F.col("calendar_month").alias("__cal"), F.lit("rows").alias("column"), F.col("row_count").cast("double").alias("value"))
    counts = inner.groupBy("__cal", "column", "value").agg(F.count(F.lit(1)).alias("n"))
    base = quantiles_of_counts(counts, {"baseline_median": 0.5}, ["__cal"]).select("__cal", "baseline_median")
    out = full.join(base, F.col("calendar_month") == F.col("__cal"), "left").drop("__cal")
    diff = F.when(F.col("baseline_median") > 0, F.round((F.col("row_count") - F.col("baseline_median")) / F.col("baseline_median") * 100, 4))
    judged = ~F.col("is_edge_month") & F.coalesce(F.col("baseline_median") >= F.greatest(F.lit(min_baseline), F.lit(1)), F.lit(False))
    out = out.withColumn("pct_diff_from_baseline", diff)
    return out.select(
        F.lit(table).alias("table_name"), F.date_format("month", "yyyy-MM").alias("year_month"), "calendar_month", "row_count",
        "baseline_median", "pct_diff_from_baseline",
        F.when(judged, F.when(F.abs("pct_diff_from_baseline") <= tolerance_pct, "passed").otherwise("failed")).otherwise("skipped").alias("volume_status"),
        F.when(judged, F.when(F.col("row_count") > 0, "passed").otherwise("failed")).otherwise("skipped").alias("gap_status"),
        "is_edge_month")


def parse_or_date(df: DataFrame, date: str) -> Column:
    """Typed date columns are taken as they are, text is parsed."""
    return parse_date(date) if dict(df.dtypes)[date] == "string" else F.to_date(date)


def date_coverage(df: DataFrame, date: str, *, table: str = "") -> DataFrame:
    """One row: valid dates, span, distinct days and months, gap months, rows per month."""
    days = df.select(parse_or_date(df, date).alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    months = days.where("d is not null").groupBy(F.trunc("d", "month").alias("m")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("days"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    counts = months.groupBy(F.lit("rows").alias("column"), F.col("n").cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    median = quantiles_of_counts(counts, {"median": 0.5}).select("median").scalar()
    stats = days.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("d").isNotNull(), F.col("n"))), F.lit(0)).alias("valid"))
    spans = months.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.coalesce(F.sum("days"), F.lit(0)).alias("unique_days"),
                       F.count(F.lit(1)).alias("unique_months"), F.max("n").alias("max_n"))
    wide = F.when(F.col("lo").isNotNull(), (F.year("hi") - F.year("lo")) * 12 + F.month("hi") - F.month("lo") + 1).otherwise(0)
    both = spans.select(
        F.lit(table).alias("table_name"), F.lit(date).alias("date_column"),
        F.lit(stats.select("rows").scalar()).alias("rows"), F.lit(stats.select("valid").scalar()).alias("valid_dates"),
        F.col("lo").alias("min_date"), F.col("hi").alias("max_date"), "unique_days", "unique_months",
        wide.cast("long").alias("months_in_range"), (wide - F.col("unique_months")).cast("long").alias("gap_months"),
        F.coalesce(F.floor(median).cast("long"), F.lit(0)).alias("median_monthly_rows"), F.coalesce("max_n", F.lit(0)).alias("max_monthly_rows"),
        F.coalesce(F.datediff("hi", "lo").cast("long"), F.lit(0)).alias("span_days"))
    return both.withColumn("invalid_dates", F.col("rows") - F.col("valid_dates"))


def season_volume(df: DataFrame, season: str, *, tolerance_pct: float = 20.0) -> DataFrame:
    """Rows per season against the median of all seasons but the latest (all, if there is only one)."""
    counted = df.where(F.col(season).isNotNull()).groupBy(F.col(season).alias("season")).agg(F.count(F.lit(1)).alias("row_count"))
    latest = counted.agg(F.max("season")).scalar()
    lonely = counted.agg(F.count(F.lit(1))).scalar() == 1
    base = counted.where((F.col("season") < latest) | lonely).select(F.lit("rows").alias("column"), F.col("row_count").cast("double").alias("value"))
    median = quantiles_of_counts(base.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), {"median": 0.5}).select("median").scalar()
    diff = F.round((F.col("row_count") - F.col("median")) / F.greatest(F.col("median"), F.lit(1.0)) * 100, 4)
    usual = F.col("row_count").between(F.col("median") * (1 - tolerance_pct / 100), F.col("median") * (1 + tolerance_pct / 100))
    out = counted.withColumn("median", F.lit(median)).withColumn("pct_vs_median", diff)
    return out.select("season", "row_count", "pct_vs_median", F.when(usual, "passed").otherwise("failed").alias("volume_status"))


# -- relationships -----------------------------------------------------------------------------

def guarded_corr(x: Column, y: Column, weight: Column | None = None) -> Column:
    """Pearson correlation as an aggregate; null instead of an error when a side is constant.

    Uses covariance and deviations, which Spark updates in one pass without cancellation.
    """
    if weight is None:
        both = x.isNotNull() & y.isNotNull()
        a, b = F.when(both, x), F.when(both, y)
        spread = F.stddev_pop(a) * F.stddev_pop(b)
        return F.when(spread > 0, F.covar_pop(a, b) / spread)
    n, sx, sy = F.sum(weight), F.sum(x * weight), F.sum(y * weight)
    cov = n * F.sum(x * y * weight) - sx * sy
    spread = F.sqrt(F.greatest(n * F.sum(x * x * weight) - sx * sx, F.lit(0.0))) * F.sqrt(F.greatest(n * F.sum(y * y * weight) - sy * sy, F.lit(0.0)))
    return F.when(spread > 0, cov / spread)


def correlation_matrix(df: DataFrame, columns: Sequence[str], *, complete_rows: bool = False) -> DataFrame:
    """Pairwise Pearson correlations in long form, all pairs in one aggregation."""
    numbers = _numbers(df, columns)
    if complete_rows:
        numbers = numbers.dropna()
    pairs = list(combinations(columns, 2))
    row = numbers.agg(*[guarded_corr(F.col(a), F.col(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells += [F.struct(F.lit(x).alias("left"), F.lit(y).alias("right"), F.col(f"r{i}").alias("r")) for x, y in ((a, b), (b, a))]
    cells += [F.struct(F.lit(c).alias("left"), F.lit(c).alias("right"), F.lit(1.0).alias("r")) for c in columns]
    return row.select(F.inline(F.array(*cells))).withColumn("r", F.round("r", 4))


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, strongest positive first."""
    numbers = _numbers(df, [*columns, target])
    row = numbers.agg(*[guarded_corr(F.col(c), F.col(target)).alias(c) for c in columns])
    return (row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.round(c, 4).alias("r")) for c in columns])))
            .orderBy(F.col("r").desc_nulls_last()))


def correlation_pair(df: DataFrame, left: str, right: str, *, table: str = "", min_rows: int = 100) -> DataFrame:
    """``correlation_pairs`` of one pair."""
    return correlation_pairs(df, [(left, right)], table=table, min_rows=min_rows)


def _varied_corr(x: str, y: str, weight: str) -> Column:
    """Weighted correlation of centred columns; null where one of them is constant."""
    varied = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varied, guarded_corr(F.col(x), F.col(y), F.col(weight)))


def correlation_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], *, table: str = "", min_rows: int = 100, small: int = SMALL) -> DataFrame:
    """Pearson and Spearman of several pairs, each on its own complete rows; the stronger one decides sign and strength.

    All pairs share one pass: rows are counted per pair and distinct values, the counts are kept, and ranks are taken per pair and side from
    them. Spearman is the weighted Pearson of shared ranks. Pairs of fewer than ``min_rows`` rows are left out, repeated pairs stay.
    """
    if not pairs:
        raise ValueError("correlations need at least one pair of columns")
    numbers = _numbers(df, list(dict.fromkeys(c for p in pairs for c in p)))
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("pair"), F.col(a).alias("x"), F.col(b).alias("y")) for i, (a, b) in enumerate(pairs)]))
    counts = materialize(numbers.select(cells).where("x is not null and y is not null and not isnan(x) and not isnan(y)")
                         .groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("w")))
    facts = counts.groupBy("pair").agg(
        F.sum("w").alias("n"), *[(F.sum(F.col(c) * F.col("w")) / F.sum("w")).alias(f"mean_{c}") for c in "xy"],
        F.greatest(F.approx_count_distinct("x"), F.approx_count_distinct("y")).alias("distinct")).collect()
    buckets = buckets_for(max((r["distinct"] for r in facts), default=0), small)
    sides = counts.select(F.inline(F.array(*[F.struct(F.concat("pair", F.lit(f":{c}")).alias("column"), F.col(c).alias("value"), "w") for c in "xy"])))
    sides = sides.groupBy("column", "value").agg(F.sum("w").alias("n"))
    placed = running_counts(materialize(sides) if buckets else sides, buckets=buckets)
    rank = F.col("before") + (F.col("n") + 1) / 2 - (F.col("total") + 1) / 2        # around zero
    centred = counts
    for c in "xy":
        of_side = placed.where(F.col("column").endswith(f":{c}")).select(
            F.substring_index("column", ":", 1).cast("int").alias("pair"), F.col("value").alias(c), rank.alias(f"r{c}"))
        mean = per_column({str(r["pair"]): r[f"mean_{c}"] for r in facts}, "double")
        centred = (centred.join(of_side, ["pair", c]).withColumn("column", F.col("pair").cast("string")).withColumn(f"d{c}", F.col(c) - mean).drop("column"))
    found = centred.groupBy("pair").agg(F.sum("w").alias("shared_rows"), _varied_corr("dx", "dy", "w").alias("p"), _varied_corr("rx", "ry", "w").alias("s"))
    stronger = F.abs(F.coalesce("s", F.lit(0.0))) > F.abs(F.coalesce("p", F.lit(0.0)))
    value = F.when(stronger, F.col("s")).otherwise(F.col("p"))
    left, right = (F.array(*[F.lit(p[i]) for p in pairs])[F.col("pair")] for i in (0, 1))
    return found.where(F.col("shared_rows") >= min_rows).select(
        F.lit(table).alias("table_name"), left.alias("left_column"), right.alias("right_column"), "shared_rows",
        F.round("p", 4).alias("pearson"), F.round("s", 4).alias("spearman"),
        F.when(stronger, "spearman").otherwise("pearson").alias("stronger_method"), F.round(value, 4).alias("stronger_value"),
        F.when(value >= 0, "positive").otherwise("negative").alias("direction"),
        correlation_strength(value).alias("strength"))


def linear_fit(df: DataFrame, x: str, y: str, *, log: bool = False) -> DataFrame:
    """Slope, intercept and correlation of a straight line, on log10 scales if asked."""
    pairs = _numbers(df, [x, y]).dropna()
    if log:
        pairs = pairs.where((F.col(x) > 0) & (F.col(y) > 0)).select(*[F.log10(c).alias(c) for c in (x, y)])
    return pairs.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                     guarded_corr(F.col(x), F.col(y)).alias("r"), F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, value: str, by: Sequence[str], multiplier: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest values inside the fences) and outlier count per group.

    Works on value counts, so a group that holds most of the rows is as cheap as its distinct values.
    """
    counts, wide = settled_counts(_numbers(df, [value], *by), [value], by)
    box = quantiles_of_counts(counts, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, buckets=wide)
    box = box.select(*[F.col(b).alias(f"__{b}") for b in by], "q1", "median", "q3", F.col("n").alias("total"))
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by])
    spread = (F.col("q3") - F.col("q1")) * multiplier
    inside = F.col("value").between(F.col("q1") - spread, F.col("q3") + spread)
    return counts.join(box, same).groupBy(*by, "q1", "median", "q3", "total").agg(
        F.min(F.when(inside, F.col("value"))).alias("low_whisker"), F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers")).withColumnRenamed("total", "n")


TERMS = 8            # powers of the distance from a bin's centre that are kept
PER_WIDTH = 8        # bins to a bandwidth
REACH = 9.0          # bandwidths beyond which the kernel is taken as zero


def _hermite(terms: int) -> list[list[float]]:
    """Coefficients of the Hermite polynomials He_0, He_1, …, lowest power first: He_k+1(z) = z He_k(z) - k He_k-1(z)."""
    rows = [[1.0], [0.0, 1.0]]
    for k in range(1, terms - 1):
        up, two_back = [0.0, *rows[k]], rows[k - 1] + [0.0] * 2
        rows.append([u - k * b for u, b in zip(up, two_back)])
    return rows[:terms]


def kde_grid(df: DataFrame, column: str, points: int = 300) -> DataFrame:
    """Gaussian density with Scott's bandwidth on an even grid between minimum and maximum.

    Values are summed into bins of an eighth of the bandwidth: a bin keeps its count and the sums of the first powers of d, the distance
    from its centre in bandwidths, |d| <= 1/16. With exp(-(z - d)^2 / 2) = exp(-z^2 / 2) * sum of He_k(z) d^k / k!, the terms left out are
    below 1.09 * (1/16)^8 / sqrt(8!) * 1.1 < 1.4e-12 by Cramer's inequality, and a bin reaches grid points of nine bandwidths only, beyond which
    the kernel is below 1e-17: densities are right to 1.5e-12 of the kernel's height. The shuffles hold one row per occupied bin and one per grid
    point of each task, whatever the number of rows or distinct values.
    """
    numbers = _numbers(df, [column]).where(F.col(column).isNotNull() & ~F.isnan(column))
    stats = numbers.agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"), F.stddev_samp(column).alias("sd")).first()
    if stats["n"] < 2:
        raise ValueError("a density needs at least two values")
    if not stats["sd"]:
        raise ValueError("a density needs values that differ")
    lo, width = stats["lo"], stats["sd"] * stats["n"] ** (-1 / 5)
    step, size = (stats["hi"] - lo) / (points - 1), width / PER_WIDTH
    placed = numbers.select(F.floor((F.col(column) - lo) / size).alias("bin"), F.col(column).alias("v"))
    centre = F.lit(lo) + (F.col("bin") + 0.5) * size
    d = (F.col("v") - centre) / width
    powers = placed.groupBy("bin").agg(*[F.sum(F.pow(d, F.lit(k)) / factorial(k)).alias(f"s{k}") for k in range(TERMS)])
    table = _hermite(TERMS)
    terms = [reduce(lambda a, b: a + b, [F.col(f"s{k}") * table[k][j] for k in range(j, TERMS) if table[k][j]]).alias(f"c{j}") for j in range(TERMS)]
    first = F.greatest(F.lit(0), F.ceil((centre - lo - REACH * width) / step)).cast("int")
    last = F.least(F.lit(points - 1), F.floor((centre - lo + REACH * width) / step)).cast("int")
    met = powers.select(centre.alias("centre"), *terms, first.alias("first"), last.alias("last")).where("first <= last")
    met = met.withColumn("point", F.explode(F.sequence("first", "last"))).withColumn("z", (lo + F.col("point") * step - F.col("centre")) / width)
    series = reduce(lambda a, j: a * F.col("z") + F.col(f"c{j}"), range(TERMS - 2, -1, -1), F.col(f"c{TERMS - 1}"))
    scale = stats["n"] * width * (2 * pi) ** 0.5
    sums = met.groupBy("point").agg((F.sum(F.exp(-F.col("z") * F.col("z") / 2) * series) / scale).alias("density"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))        # points that no bin reaches have a density of zero
    return grid.join(sums, "point", "left").select("point", (F.lit(lo) + F.col("point") * step).alias("x"), F.coalesce("density", F.lit(0.0)).alias("density"))
