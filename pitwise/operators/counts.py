"""One kept table of counts per distinct value, which profiles, bins, fills and clips of a table all read.

The table itself is read once. A cell that is missing is counted too, as a row without value, so row totals and missing shares come from
the same counts; quantiles, moments and bins then work on distinct values, and what fits a line per column is held on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from pitwise.operators.ordering import SMALL, as_number, buckets_for, exact_number, quantiles_of_counts
from pitwise.session import materialize


def per_column(values: Mapping[str, object], dtype: str) -> Column:
    """The value that belongs to the row's ``column``, from a dictionary with an entry per column; null where it has none."""
    known = {c: v for c, v in values.items() if v is not None}
    if not known:
        return F.lit(None).cast(dtype)
    return F.create_map(*[x for c, v in known.items() for x in (F.lit(c), F.lit(v).cast(dtype))])[F.col("column")]


@dataclass(frozen=True)
class CountStore:
    """``counts`` is ``(kind, column, value, exact, text, n)``: numbers have a value, texts a text, missing cells neither.

    ``numbers`` and ``texts`` hold, per column, ``rows``, ``missing``, ``n``, ``distinct`` and for numbers ``min``, ``max`` and ``mean``,
    for texts ``mode`` (the smallest text among the most frequent). NaN counts as no number and as no missing cell. A column without
    rows has no entry.
    """

    counts: DataFrame
    numbers: dict[str, dict]
    texts: dict[str, dict]
    small: int = SMALL

    def number_counts(self) -> DataFrame:
        return self.counts.where("kind = 'number' and value is not null").select("column", "value", "exact", "n")

    def text_counts(self) -> DataFrame:
        return self.counts.where("kind = 'text' and text is not null").select("column", F.col("text").alias("value"), "n")

    def quantiles(self, probabilities: Mapping[str, float], columns: Sequence[str] | None = None) -> DataFrame:
        """Exact quantiles ``(column, n, <label>…)`` of all or some number columns; columns without a number have no row."""
        chosen = list(self.numbers) if columns is None else list(columns)
        counts = self.number_counts() if columns is None else self.number_counts().where(F.col("column").isin(chosen))
        most = max((self.numbers[c]["distinct"] for c in chosen if c in self.numbers), default=0)
        return quantiles_of_counts(counts, probabilities, buckets=buckets_for(most, self.small))

    def fitted(self, probabilities: Mapping[str, float], columns: Sequence[str]) -> dict[str, dict[str, float]]:
        """The quantiles of a few columns as a dictionary."""
        if not columns:
            return {}
        return {r["column"]: {k: r[k] for k in ("n", *probabilities)} for r in self.quantiles(probabilities, columns).collect()}

    def moments(self, powers: Sequence[int] = (2, 3, 4)) -> DataFrame:
        """``(column, m2, m3, …)``: sums of powers of the distance from the column's mean."""
        d = F.col("value") - per_column({c: f["mean"] for c, f in self.numbers.items()}, "double")
        return self.number_counts().withColumn("d", d).groupBy("column").agg(*[F.sum(F.pow("d", F.lit(k)) * F.col("n")).alias(f"m{k}") for k in powers])

    def with_missing_as(self, values: Mapping[str, object]) -> CountStore:
        """The counts after the missing cells of some number columns took a value, from the kept counts alone."""
        fills = {c: float(v) for c, v in values.items() if v is not None and c in self.numbers and self.numbers[c]["missing"]}
        if not fills:
            return self
        fill = F.when(F.col("kind") == "number", per_column(fills, "double"))
        held = {r["column"] for r in self.counts.where(F.col("value") == fill).select("column").distinct().collect()}
        numbers = dict(self.numbers)
        for c, v in fills.items():
            f = numbers[c]
            mean = v if not f["n"] else (f["mean"] * f["n"] + v * f["missing"]) / (f["n"] + f["missing"])
            numbers[c] = {**f, "missing": 0, "n": f["n"] + f["missing"], "distinct": f["distinct"] + (c not in held), "mean": mean,
                          "min": v if f["min"] is None else min(f["min"], v), "max": v if f["max"] is None else max(f["max"], v)}
        return replace(self, counts=self.counts.withColumn("value", F.coalesce("value", fill)), numbers=numbers)


def count_store(df: DataFrame, numbers: Sequence[str], texts: Sequence[str] = (), *, small: int = SMALL) -> CountStore:
    """Count the distinct values of number and text columns in one pass over the table, and keep the counts.

    Text columns may be of any type and are counted by their text. Neither kind need be given; a column may be both.
    """
    types = {f.name: f.dataType for f in df.schema}
    none = F.lit(None)
    cells = [F.struct(F.lit("number").alias("kind"), F.lit(c).alias("column"), as_number(c, types[c]).alias("value"),
                      exact_number(c, types[c]).alias("exact"), none.cast("string").alias("text")) for c in numbers]
    cells += [F.struct(F.lit("text").alias("kind"), F.lit(c).alias("column"), none.cast("double").alias("value"),
                       none.cast("long").alias("exact"), F.col(c).cast("string").alias("text")) for c in texts]
    if not cells:
        return CountStore(df.sparkSession.createDataFrame([], "kind string, column string, value double, exact long, text string, n long"), {}, {}, small)
    key = ["kind", "column", "value", "exact", "text"]
    present = F.when(F.col("kind") == "number", ~F.isnan("value") | F.col("value").isNull()).otherwise(True)
    rows = df.select(F.inline(F.array(*cells)))
    exact = F.when(F.col("value").isNotNull(), F.col("exact"))
    counts = materialize(rows.where(present).withColumn("exact", exact).groupBy(*key).agg(F.count(F.lit(1)).alias("n")))
    here = F.col("value").isNotNull() | F.col("text").isNotNull()
    facts = counts.groupBy("kind", "column").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(~here, F.col("n"))), F.lit(0)).alias("missing"), F.count_if(here).alias("distinct"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum(F.when(here, F.col("n")))).alias("mean"),
        F.min(F.when(here, F.struct((-F.col("n")).alias("n"), "text")))["text"].alias("mode")).collect()
    found = {kind: {r["column"]: {**{k: r[k] for k in ("rows", "missing", "distinct", *own)}, "n": r["rows"] - r["missing"]}
                    for r in facts if r["kind"] == kind} for kind, own in (("number", ("min", "max", "mean")), ("text", ("mode",)))}
    return CountStore(counts, found["number"], found["text"], small)
