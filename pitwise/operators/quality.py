"""Declarative quality rules: all rules of a table are counted in one pass.

A rule is a failing predicate plus an optional applicable predicate. Counting is one aggregation per
table; the few sample values come from a second branch over failing rows only, limited to five per rule
on the map side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitwise.functions.scalars import differs, holds, parse_datetime, pct
from pitwise.operators.joins import top_k

SAMPLE = 5
RECORD_SCHEMA = (
    "dimension string, table_name string, check_name string, description string, expectation_type string, status string, "
    "applicable_rows long, failed_rows long, failed_pct double, missing_columns string, sample_unexpected_values string")

# Date layouts as regular expression and reader pattern.
LAYOUTS = {
    "%Y-%m-%d": (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    "%Y-%m-%d %H:%M:%S": (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d H:m:s"),
}


@dataclass(frozen=True)
class Rule:
    """``failed`` counts against the table when true; null counts as false."""

    name: str
    columns: tuple[str, ...]
    failed: Column
    kind: str = "predicate"
    description: str = ""
    applicable: Column | None = None
    sample: tuple[str, ...] = ()

    def missing(self, df: DataFrame) -> list[str]:
        return [c for c in self.columns if c not in df.columns]


def between(column: str, low=None, high=None, *, name: str | None = None, description: str = "") -> Rule:
    """Inclusive bounds; missing values pass."""
    c = F.col(column)
    low_ok = c >= F.lit(low) if low is not None else F.lit(True)
    high_ok = c <= F.lit(high) if high is not None else F.lit(True)
    return Rule(name or f"{column}_between", (column,), ~(low_ok & high_ok), "expect_column_values_to_be_between", description)


def in_set(column: str, values: Iterable, *, name: str | None = None, description: str = "") -> Rule:
    return Rule(name or f"{column}_in_set", (column,), ~F.col(column).isin(*values), "expect_column_values_to_be_in_set", description)


def matches_regex(column: str, pattern: str, *, name: str | None = None, description: str = "") -> Rule:
    return Rule(name or f"{column}_matches_regex", (column,), ~F.col(column).cast("string").rlike(pattern),
                "expect_column_values_to_match_regex", description)


def matches_layout(column: str, layout: str, *, name: str | None = None, description: str = "") -> Rule:
    """Text must have the date layout and name a real date."""
    pattern, reader = LAYOUTS[layout]
    text = F.col(column).cast("string")
    good = text.rlike(pattern) & F.try_to_timestamp(text, F.lit(reader)).isNotNull()
    return Rule(name or f"{column}_matches_layout", (column,), text.isNotNull() & ~good, "expect_column_values_to_match_strftime_format", description)


def not_null(column: str, *, name: str | None = None, description: str = "") -> Rule:
    return Rule(name or f"{column}_required", (column,), F.col(column).isNull(), "expect_column_values_to_not_be_null",
                description or f"{column} must be present.")


def predicate(name: str, columns: Sequence[str], failed: Column, *, applicable: Column | None = None, description: str = "",
              sample: Sequence[str] = ()) -> Rule:
    return Rule(name, tuple(columns), failed, "predicate", description, applicable, tuple(sample))


def mismatch(name: str, left: Column, right: Column, columns: Sequence[str], **kw) -> Rule:
    """Fails when the sides differ or either is missing."""
    return predicate(name, columns, differs(left, right), **kw)


def run_checks(df: DataFrame, rules: Sequence[Rule], *, table: str, dimension: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Check records of one table, in the fixed record schema."""
    spark = df.sparkSession
    if not rules:
        return no_checks(spark, dimension)
    runnable = [(i, r) for i, r in enumerate(rules) if not r.missing(df)]
    counts = [F.count(F.lit(1)).alias("__rows")]
    for i, r in runnable:
        applies = F.lit(True) if r.applicable is None else holds(r.applicable)
        counts += [F.count_if(applies).alias(f"__a{i}"), F.count_if(applies & holds(r.failed)).alias(f"__f{i}")]
    records = []
    for i, r in enumerate(rules):
        absent = r.missing(df)
        records.append(F.struct(
            F.lit(i).alias("__id"), F.lit(r.name).alias("check_name"), F.lit(r.description).alias("description"),
            F.lit(r.kind).alias("expectation_type"),
            F.lit("skipped").alias("status") if absent else F.when(F.col(f"__f{i}") == 0, "passed").otherwise("failed").alias("status"),
            (F.col("__rows") if absent else F.col(f"__a{i}")).alias("applicable_rows"),
            (F.lit(None).cast("long") if absent else F.col(f"__f{i}")).alias("failed_rows"),
            F.lit(", ".join(absent)).alias("missing_columns")))
    counted = df.agg(*counts).select(F.inline(F.array(*records)))
    if runnable:
        counted = counted.join(_samples(df, runnable, order_by), "__id", "left")
    else:
        counted = counted.withColumn("sample", F.lit(None).cast("string"))
    return counted.select(
        F.lit(dimension).alias("dimension"), F.lit(table).alias("table_name"), "check_name", "description", "expectation_type", "status",
        "applicable_rows", "failed_rows", pct("failed_rows", "applicable_rows").alias("failed_pct"), "missing_columns",
        F.coalesce("sample", F.lit("[]")).alias("sample_unexpected_values"))


def _samples(df: DataFrame, rules: Sequence[tuple[int, Rule]], order_by: Sequence[str]) -> DataFrame:
    texts = []
    for i, r in rules:
        applies = F.lit(True) if r.applicable is None else holds(r.applicable)
        shown = F.struct(*[F.col(c) for c in (r.sample or r.columns)])
        text = F.to_json(shown) if r.sample or len(r.columns) != 1 else F.coalesce(F.col(r.columns[0]).cast("string"), F.lit("null"))
        texts.append(F.when(applies & holds(r.failed), text).alias(f"__s{i}"))
    hits = F.array(*[F.struct(F.lit(i).alias("__id"), F.col(f"__s{i}").alias("text")) for i, _ in rules])
    failing = df.select(*order_by, *texts).select(*order_by, F.inline(F.filter(hits, lambda h: h["text"].isNotNull())))
    first = top_k(failing, by=["__id"], order_by=[*[F.col(c) for c in order_by], F.col("text")], k=SAMPLE, rank="__rank")
    kept = F.array_sort(F.collect_list(F.struct("__rank", "text")))
    return first.groupBy("__id").agg(F.to_json(F.transform(kept, lambda s: s["text"])).alias("sample"))


def no_checks(spark, dimension: str) -> DataFrame:
    row = (dimension, "n/a", "no_checks_ran", "No matching table was found.", "n/a", "skipped", 0, None, None, "", "[]")
    return spark.createDataFrame([row], RECORD_SCHEMA)


def finalize(parts: Sequence[DataFrame], dimension: str, spark=None) -> DataFrame:
    """All records of a dimension in report order."""
    records = reduce(DataFrame.unionByName, parts) if parts else no_checks(spark, dimension)
    return records.orderBy("status", F.col("failed_pct").desc_nulls_last(), "table_name", "check_name")


def summarize(checks: DataFrame) -> DataFrame:
    """Checks run, failed, skipped and failed rows per dimension and table."""
    out = checks.groupBy("dimension", "table_name").agg(
        F.count("check_name").alias("checks_run"), F.count_if(F.col("status") == "failed").alias("failed_checks"),
        F.count_if(F.col("status") == "skipped").alias("skipped_checks"),
        F.coalesce(F.sum("failed_rows"), F.lit(0)).alias("total_failed_rows"))
    return out.orderBy("dimension", F.col("failed_checks").desc(), F.col("total_failed_rows").desc(), "table_name")


def report_lines(checks: DataFrame, named: int = 3) -> DataFrame:
    """One verdict and sentence per dimension, naming up to three failed checks in report order: most failed rows in percent first."""
    failed = F.col("status") == "failed"
    place = F.struct((-F.coalesce("failed_pct", F.lit(-1.0))).alias("pct"), "table_name", "check_name")
    names = F.transform(F.slice(F.array_sort(F.collect_list(F.when(failed, place))), 1, named), lambda p: p["check_name"])
    grouped = checks.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("status") == "passed").alias("passed"),
        F.count_if(failed).alias("failed"), F.count_if(F.col("status") == "skipped").alias("skipped"), names.alias("names"))
    text = F.when(F.col("failed") == 0, F.format_string("%s: all %d executed checks passed.", "dimension", F.col("checks") - F.col("skipped"))).otherwise(
        F.format_string("%s: %d of %d executed checks failed (%s).", "dimension", "failed", F.col("checks") - F.col("skipped"),
                        F.array_join("names", ", ")))
    verdict = F.when(F.col("failed") == 0, "passed").otherwise("failed")
    return grouped.select("dimension", verdict.alias("status"), "checks", "passed", "failed", "skipped", text.alias("report")).orderBy("dimension")


def profile_line(dimension: str, text: Column, df: DataFrame) -> DataFrame:
    """Report line of a dimension that is described rather than judged; ``text`` is an aggregate over ``df``."""
    none = F.lit(0).cast("long")
    return df.agg(text.alias("report")).select(F.lit(dimension).alias("dimension"), F.lit("passed").alias("status"), none.alias("checks"), none.alias("passed"), none.alias("failed"),
                                               none.alias("skipped"), "report")


# -- completeness ------------------------------------------------------------------------------

def table_completeness(df: DataFrame, table: str, *, min_rows: int = 1) -> DataFrame:
    nulls = [F.col(f"`{c}`").isNull().cast("long") for c in df.columns]
    per_row = reduce(lambda a, b: a + b, nulls)
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(per_row), F.lit(0)).alias("missing_cells"),
                 F.count_if(per_row > 0).alias("rows_with_missing"))
    width = max(len(df.columns), 1)
    return row.select(
        F.lit(table).alias("table_name"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"), "missing_cells",
        pct("missing_cells", F.col("rows") * width).alias("missing_cells_pct"), "rows_with_missing",
        pct("rows_with_missing", "rows").alias("rows_with_missing_pct"), F.lit(min_rows).cast("long").alias("expected_min_rows"),
        F.when(F.col("rows") >= min_rows, "passed").otherwise("failed").alias("size_status"))


def field_completeness(df: DataFrame, table: str, required: Sequence[str] = ()) -> DataFrame:
    """Missing cells per column from one aggregation, with the pattern of columns that have gaps."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__m{i}") for i, c in enumerate(df.columns)])
    cells = F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.lit("required" if c in required else "optional").alias("field_role"),
        F.col(f"__m{i}").alias("missing_count")) for i, c in enumerate(df.columns)]))
    out = row.select("__rows", cells)
    share = pct("missing_count", "__rows")
    return out.select(F.lit(table).alias("table_name"), "column_name", "field_role", "missing_count", share.alias("missing_pct"))


def missing_patterns(fields: DataFrame, high: float = 20.0) -> DataFrame:
    return fields.where("missing_count > 0").withColumn(
        "pattern", F.when(F.col("missing_pct") >= high, "high_missingness").otherwise("some_missingness"))


# -- uniqueness --------------------------------------------------------------------------------

def exact_duplicates(df: DataFrame, table: str) -> DataFrame:
    """Rows that repeat an earlier row."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("d")).select(
        F.lit(table).alias("table_name"), "rows", F.col("d").alias("exact_duplicate_rows"), pct("d", "rows").alias("exact_duplicate_pct"))


def unique_fields(df: DataFrame, table: str, columns: Sequence[str], *, strict: bool = True) -> DataFrame:
    """Surplus copies per column. Counts go through (column, value) groups, one shuffle for all columns."""
    spark = df.sparkSession
    present = [c for c in columns if c in df.columns]
    absent = [c for c in columns if c not in df.columns]
    rows = F.lit(df.agg(F.count(F.lit(1))).scalar())
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in present])))
    groups = cells.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    found = groups.groupBy("column_name").agg(F.sum(F.when(F.col("v").isNotNull(), F.col("n") - 1).otherwise(0)).alias("duplicate_count"))
    status = F.when(F.col("duplicate_count") == 0, "passed").otherwise("failed") if strict else F.lit(None).cast("string")
    out = found.select(F.lit(table).alias("table_name"), "column_name", status.alias("status"), "duplicate_count",
                       pct("duplicate_count", rows).alias("duplicate_pct"))
    if strict and absent:
        skipped = spark.createDataFrame([(table, c, "skipped", None, None) for c in absent], out.schema)
        out = out.unionByName(skipped)
    return out


def unique_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Surplus copies and duplicated groups over rows whose key is complete."""
    spark = df.sparkSession
    schema = "table_name string, key_fields string, status string, duplicate_count long, duplicate_groups long, duplicate_pct double"
    if any(k not in df.columns for k in keys):
        return spark.createDataFrame([(table, ", ".join(keys), "skipped", None, None, None)], schema)
    rows = F.lit(df.agg(F.count(F.lit(1))).scalar())
    groups = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d"), F.count_if(F.col("n") > 1).alias("g"))
    return found.select(F.lit(table).alias("table_name"), F.lit(", ".join(keys)).alias("key_fields"),
                        F.when(F.col("d") == 0, "passed").otherwise("failed").alias("status"), F.col("d").alias("duplicate_count"),
                        F.col("g").alias("duplicate_groups"), pct("d", rows).alias("duplicate_pct"))


def uniqueness_summary(exact: DataFrame, strict: DataFrame, subset: DataFrame, fuzzy: DataFrame) -> DataFrame:
    """Issues and affected rows per kind of uniqueness check."""
    def line(df, kind, issue, rows):
        return df.agg(F.count_if(issue).alias("issue_count"), F.coalesce(F.sum(rows), F.lit(0)).alias("affected_rows")).select(
            F.lit(kind).alias("check_type"), "issue_count", "affected_rows")
    return (line(exact, "exact_duplicates", F.col("exact_duplicate_rows") > 0, F.col("exact_duplicate_rows"))
            .unionByName(line(strict, "strict_unique_fields", F.col("status") == "failed", F.col("duplicate_count")))
            .unionByName(line(subset, "subset_duplicates", F.col("status") == "failed", F.col("duplicate_count")))
            .unionByName(line(fuzzy, "fuzzy_duplicate_candidates", F.lit(True), F.lit(1).cast("long"))))


# -- summaries over profiles -------------------------------------------------------------------

def profile_summary(numeric: DataFrame, categorical: DataFrame, *, high_skew: float = 1.0, high_cardinality: int = 20) -> DataFrame:
    a = numeric.groupBy("table_name").agg(F.count(F.lit(1)).alias("numeric_fields_profiled"),
                                          F.count_if(F.col("abs_skew") >= high_skew).alias("high_skew_numeric_fields"))
    b = categorical.groupBy("table_name").agg(F.count(F.lit(1)).alias("categorical_fields_profiled"),
                                              F.count_if(F.col("distinct_count") >= high_cardinality).alias("high_cardinality_categorical_fields"))
    joined = a.join(b, "table_name", "full_outer")
    names = ("numeric_fields_profiled", "categorical_fields_profiled", "high_skew_numeric_fields", "high_cardinality_categorical_fields")
    return joined.select("table_name", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def relationship_summary(correlations: DataFrame, checks: DataFrame, *, strong: float = 0.6) -> DataFrame:
    top = F.greatest(F.abs("pearson"), F.abs("spearman"))
    a = correlations.groupBy("table_name").agg(F.count(F.lit(1)).alias("correlation_pairs_profiled"), F.count_if(top >= strong).alias("strong_pairs"))
    b = checks.groupBy("table_name").agg(F.count(F.lit(1)).alias("dependency_checks_run"),
                                         F.count_if(F.col("status") == "failed").alias("failed_dependency_checks"))
    names = ("correlation_pairs_profiled", "strong_pairs", "dependency_checks_run", "failed_dependency_checks")
    return a.join(b, "table_name", "full_outer").select("table_name", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


# -- timeliness --------------------------------------------------------------------------------

def timeliness_rules(column: str, today: Column, dtype: str) -> list[Rule]:
    """Dates can be read and do not lie in the future."""
    date = F.to_date(parse_datetime(column)) if dtype == "string" else F.to_date(column)
    return [predicate("date_values_are_parseable", [column], date.isNull()),
            predicate("no_future_dates", [column], date > today, applicable=date.isNotNull())]


def profile_verdicts(profile: DataFrame, *, table: str) -> DataFrame:
    """Volume, seasonal pattern and gap checks over a monthly profile."""
    judged, active = F.col("volume_status") != "skipped", F.col("row_count") > 0
    off = F.col("volume_status") == "failed"
    shown = ("year_month", "row_count", "baseline_median", "pct_diff_from_baseline")
    rules = [
        predicate("monthly_volume_within_expected_range", ["volume_status"], off, applicable=judged, sample=shown),
        predicate("seasonal_pattern_consistent", ["volume_status"], off, applicable=judged & active, sample=shown),
        predicate("no_unexpected_gap_months", ["gap_status"], F.col("gap_status") == "failed", applicable=F.col("gap_status") != "skipped",
                  sample=("year_month", "baseline_median")),
    ]
    return run_checks(profile, rules, table=table, dimension="timeliness", order_by=["year_month"])


def unique_key_check(df: DataFrame, keys: Sequence[str], *, table: str, dimension: str, name: str, description: str = "") -> DataFrame:
    """Key uniqueness as a check record; applicable rows have a complete key."""
    if any(k not in df.columns for k in keys):
        return run_checks(df, [predicate(name, keys, F.lit(False), description=description)], table=table, dimension=dimension)
    groups = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    sample = top_k(groups.where("__n > 1").select(F.lit(0).alias("__g"), F.to_json(F.struct(*keys)).alias("t")), by=["__g"],
                   order_by=[F.col("t")], k=SAMPLE).agg(F.to_json(F.array_sort(F.collect_list("t"))).alias("s"))
    counted = groups.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("a"), F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("f"))
    return counted.select(
        F.lit(dimension).alias("dimension"), F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), F.lit(description).alias("description"),
        F.lit("predicate").alias("expectation_type"), F.when(F.col("f") == 0, "passed").otherwise("failed").alias("status"),
        F.col("a").alias("applicable_rows"), F.col("f").alias("failed_rows"), pct("f", "a").alias("failed_pct"),
        F.lit("").alias("missing_columns"), F.coalesce(F.lit(sample.scalar()), F.lit("[]")).alias("sample_unexpected_values"))
