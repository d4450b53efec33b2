"""Scalar expressions: coercing casts, dates, seasons, keys, reasons and flags.

Comparisons with a null follow dataframe semantics rather than SQL three-valued logic:
``eq``/``cmp`` are false, ``differs`` is true.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F, types as T

# Text tokens that a CSV reader treats as missing.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Accepted date and timestamp layouts, tried in this order.
DATE_LAYOUTS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssXXX",
                "yyyy/MM/dd", "MM/dd/yyyy")


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


# -- null handling and comparisons -------------------------------------------------------------

def nan_to_null(c) -> Column:
    """NaN counts as missing everywhere in this library."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def null_tokens_to_null(c) -> Column:
    c = col(c)
    return F.when(~c.isin(*NULL_TOKENS), c)


def eq(a, b) -> Column:
    return F.coalesce(col(a) == col(b), F.lit(False))


def differs(a, b) -> Column:
    """True when the values differ or either is missing."""
    return ~eq(a, b)


def holds(predicate: Column) -> Column:
    """A predicate with null read as false."""
    return F.coalesce(predicate, F.lit(False))


def missing_mask(c, dtype: T.DataType | None = None) -> Column:
    """Null, or blank after trimming when the column is text."""
    c = col(c)
    if dtype is None or isinstance(dtype, T.StringType):
        return c.isNull() | (F.trim(c.cast("string")) == "")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


# -- coercing casts ----------------------------------------------------------------------------

def to_number(c) -> Column:
    """Number or null; booleans become 0/1, NaN becomes null."""
    return nan_to_null(col(c).try_cast("double"))


def parse_datetime(c, layouts: Iterable[str] = DATE_LAYOUTS) -> Column:
    """Timestamp or null. Every layout is tried, so mixed columns keep what can be read."""
    text = F.trim(col(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in layouts])


def parse_date(c, layouts: Iterable[str] = DATE_LAYOUTS) -> Column:
    return F.to_date(parse_datetime(c, layouts))


def safe_divide(a, b) -> Column:
    """Null for a zero or missing denominator and for an infinite result."""
    q = F.try_divide(col(a).cast("double"), col(b).cast("double"))
    return F.when(F.abs(q) < F.lit(float("inf")), q)


def stringify(c) -> Column:
    return col(c).cast("string")


def stringify_1dp(c) -> Column:
    """Text with one decimal, ties of the decimal value rounded away from zero."""
    c = col(c)
    return F.when(c.isNotNull(), F.format_string("%.1f", c.cast("double")))


# -- dates and seasons -------------------------------------------------------------------------

def age_at(date, born) -> Column:
    """Completed years on ``date``."""
    date, born = col(date), col(born)
    before_birthday = (F.month(date) < F.month(born)) | (
        (F.month(date) == F.month(born)) & (F.dayofmonth(date) < F.dayofmonth(born)))
    return (F.year(date) - F.year(born) - before_birthday.cast("int")).cast("long")


def age_at_season(season, born) -> Column:
    return (col(season).cast("long") - F.year(col(born))).cast("long")


def short_year_to_full(c) -> Column:
    year = col(c).cast("long")
    return F.when(year >= 90, year + 1900).otherwise(year + 2000)


def season_start_year(text, fallback_date) -> Column:
    """Start year of ``NN/NN`` text, else the season (July to June) that holds the date."""
    text, date = F.trim(col(text)), col(fallback_date)
    short = F.trim(F.split(text, "/")[0]).try_cast("int")
    by_text = F.when(short.isNotNull(), short_year_to_full(short))
    by_date = F.when(F.month(date) >= 7, F.year(date)).otherwise(F.year(date) - 1).cast("long")
    return F.when(holds(F.contains(text, F.lit("/"))), by_text).otherwise(F.when(date.isNotNull(), by_date))


def season_from_prefix(text) -> Column:
    """``20NN`` from the first two characters, null unless both are digits."""
    head = F.substring(col(text), 1, 2)
    return F.when(head.rlike(r"^[0-9]{2}$"), F.lit(2000) + head.try_cast("int")).cast("long")


def season_pair(text) -> Column:
    """Struct of the two short years in ``NN/NN``; null fields when the layout differs."""
    parts = [F.regexp_extract(col(text), r"^(\d{2})/(\d{2})$", g).try_cast("int") for g in (1, 2)]
    return F.struct(parts[0].alias("start"), parts[1].alias("end"))


def plus_days(date, days: int) -> Column:
    return F.date_add(col(date), days)


def plus_months(date, months: int) -> Column:
    """Calendar months, clamped to the end of shorter months."""
    return F.add_months(col(date), months)


def plus_years(date, years: int) -> Column:
    return F.add_months(col(date), 12 * years)


def date_only(ts) -> Column:
    return F.date_format(F.to_date(col(ts)), "yyyy-MM-dd")


def epoch_to_timestamp(seconds) -> Column:
    return F.timestamp_seconds(col(seconds))


def differs_by_more_than(a, b, seconds: int = 60) -> Column:
    """True when two timestamps are further apart than allowed; false if either is missing."""
    return holds(F.abs(F.unix_seconds(col(a)) - F.unix_seconds(col(b))) > seconds)


# -- keys, reasons, flags ----------------------------------------------------------------------

def composite_key(*parts, placeholders: Mapping[int, str] | None = None, default: str = "<NA>", sep: str = "_") -> Column:
    """Join parts to one key; a missing part is written as its placeholder."""
    placeholders = placeholders or {}
    return F.concat_ws(sep, *[
        F.coalesce(col(p).cast("string"), F.lit(placeholders.get(i, default))) for i, p in enumerate(parts)])


def reasons(rules: Iterable[tuple[str, Column]], sep: str = ";") -> Column:
    """All reasons whose predicate holds, in the given order; null when none does."""
    hits = [F.when(predicate, F.lit(reason)) for reason, predicate in rules]
    return F.nullif(F.concat_ws(sep, *hits), F.lit(""))


def same_flag(a, b) -> Column:
    return eq(a, b).cast("int")


def match_flag(c) -> Column:
    return col(c).isNotNull().cast("int")


def map_values(c, mapping: Mapping, fallback: Column | None = None) -> Column:
    """Literal lookup; values outside the mapping give the fallback, or null."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, col(c))
    return found if fallback is None else F.coalesce(found, fallback)


def correlation_strength(r) -> Column:
    r = F.abs(col(r))
    return (F.when(r >= 0.9, "very_high").when(r >= 0.7, "high").when(r >= 0.5, "moderate")
            .when(r >= 0.3, "weak").when(r.isNotNull(), "very_weak"))


def pct(part, whole) -> Column:
    """Percentage to four places; an empty whole counts as one."""
    return F.round(col(part).cast("double") / F.greatest(col(whole), F.lit(1)) * 100, 4)


# -- model column choice -----------------------------------------------------------------------

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES + (T.BooleanType,))


def select_model_columns(schema: T.StructType, *, target: str, excluded: Iterable[str] = (), leak_prefix: str = "target_") -> list[str]:
    """Columns that may be features: no target, no leak prefix, no dates, none of the excluded."""
    out_of_scope = set(excluded) | {target}
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in schema
            if f.name not in out_of_scope and not f.name.startswith(leak_prefix)
            and not f.name.endswith("_date") and not isinstance(f.dataType, dates)]
