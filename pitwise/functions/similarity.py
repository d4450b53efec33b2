"""Sequence similarity for candidate pairs.

Spark has no built-in for the matching-block ratio, so it runs as an Arrow-batched UDF. It is only
ever applied to pairs that survived blocking.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from pitwise.functions.scalars import col


@F.pandas_udf(T.DoubleType())
def _ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([
        None if a is None or b is None else SequenceMatcher(a=a, b=b).ratio() for a, b in zip(left, right)], dtype="float64")


def sequence_ratio(left, right) -> Column:
    """Matching-block ratio in 0..1. The left value is the reference: the ratio is not symmetric."""
    return _ratio(col(left), col(right))


def edit_similarity(left, right) -> Column:
    """``1 - levenshtein / longer length``; equal empty strings give 1."""
    left, right = col(left), col(right)
    longest = F.greatest(F.length(left), F.length(right))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(left, right) / longest)


def without_letters(c, left_out: Column, most: int) -> Column:
    """The different texts that are left of a text without up to ``left_out`` letters, itself included; ``left_out`` is at most ``most``."""
    def shorter(text: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))
        return F.when(F.length(text) > 0, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))

    step = found = F.array(col(c))
    for n in range(1, most + 1):
        step = F.when(left_out >= n, F.array_distinct(F.flatten(F.transform(step, shorter)))).otherwise(F.array().cast("array<string>"))
        found = F.concat(found, step)
    return F.array_distinct(found)


def possible_at(left, right, threshold: float) -> Column:
    """Cheap upper bound: the ratio cannot reach the threshold if the lengths are too far apart."""
    a, b = F.length(col(left)), F.length(col(right))
    return (2 * F.least(a, b)) >= F.lit(threshold - 1e-9) * (a + b)


_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def letter_counts(c) -> Column:
    """How often each of the 37 characters of normalised text occurs, and all others together."""
    c = col(c)
    one = [F.length(c) - F.length(F.translate(c, x, "")) for x in _LETTERS]
    return F.array(*one, F.length(F.translate(c, _LETTERS, "")))


def letters_allow(left: Column, right: Column, threshold: float) -> Column:
    """Upper bound by letters: matching blocks cannot hold more of a letter than either side has."""
    total = lambda counts: F.aggregate(counts, F.lit(0), lambda a, x: a + x)
    common = total(F.zip_with(left, right, lambda a, b: F.least(a, b)))
    return (2 * common) >= F.lit(threshold - 1e-9) * (total(left) + total(right))
