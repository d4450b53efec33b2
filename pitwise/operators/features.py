"""Feature preparation fitted on the training rows only: imputation, scaling, one-hot and frequency encoding."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from pitwise.functions.scalars import is_numeric, select_model_columns
from pitwise.operators.cleaning import fitted_modes, null_shares
from pitwise.operators.ordering import chronological_split, fitted_quantiles, split_summary
from pitwise.session import materialize

MAX_NAMED_CATEGORIES = 2_000


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_name(value: str) -> str:
    return "`" + value.replace("`", "``") + "`"


@dataclass
class Preprocessor:
    """A saved-and-loadable ``PipelineModel`` plus the names of what it reads and writes."""

    model: PipelineModel
    feature_columns: list[str]
    numeric_columns: list[str]
    categorical_columns: list[str]
    feature_names: list[str]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Feature columns of new rows, next to the columns to keep."""
        return self.model.transform(df).select(*keep, *[F.col(_sql_name(n)) for n in self.feature_names])

    def save(self, path: str) -> None:
        """Write the fitted stages and, beside them, the column lists."""
        self.model.write().overwrite().save(f"{path}/model")
        spark = _session()
        names = json.dumps({k: getattr(self, k) for k in ("feature_columns", "numeric_columns", "categorical_columns", "feature_names")})
        spark.createDataFrame([(names,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/names")

    @classmethod
    def load(cls, path: str) -> "Preprocessor":
        names = json.loads(_session().read.text(f"{path}/names").first()["value"])
        return cls(PipelineModel.load(f"{path}/model"), **names)


def _session():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def usable_columns(train: DataFrame, *, target: str, excluded: Sequence[str] = (), columns: Sequence[str] | None = None) -> list[str]:
    """Feature candidates that hold at least one value in the training rows."""
    chosen = list(columns) if columns else select_model_columns(train.schema, target=target, excluded=excluded)
    shares = null_shares(train.select(*chosen))
    chosen = [c for c in chosen if shares[c] < 1]
    if not chosen:
        raise ValueError("no usable feature column")
    return chosen


def numeric_parameters(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """Median, and mean and population deviation after filling gaps with the median."""
    if not columns:
        return {}
    numbers = train.select(*[F.col(_sql_name(c)).cast("double").alias(c) for c in columns])
    medians = {c: q["median"] for c, q in fitted_quantiles(numbers, columns, {"median": 0.5}).items()}
    filled = [F.coalesce(F.nanvl(F.col(c), F.lit(None).cast("double")), F.lit(medians[c])) for c in columns]
    row = numbers.agg(*[f(e).alias(f"{n}{i}") for i, e in enumerate(filled) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (medians[c], row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def categories(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted categories per column, from one grouped count. Columns with too many raise: use the vector form."""
    if not columns:
        return {}
    cells = train.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(_sql_name(c)).cast("string").alias("v")) for c in columns])))
    distinct = cells.where("v is not null").distinct()
    sizes = distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
    wide = [r["column"] for r in sizes if r["n"] > MAX_NAMED_CATEGORIES]
    if wide:
        raise ValueError(f"too many categories for named columns, use form='vector': {', '.join(wide)}")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in distinct.collect():     # at most MAX_NAMED_CATEGORIES per column, checked above
        found[r["column"]].append(r["v"])
    return {c: sorted(v) for c, v in found.items()}


def fit_preprocessor(train: DataFrame, *, target: str, columns: Sequence[str] | None = None, excluded: Sequence[str] = (),
                     form: str = "columns") -> Preprocessor:
    """Median and mode filling, standard scaling, one-hot encoding.

    ``form='columns'`` writes ``numeric__x`` and ``categorical__c_v`` columns, unknown categories as all zeros.
    ``form='vector'`` writes one sparse ``features`` vector, for categories by the thousand.
    """
    chosen = usable_columns(train, target=target, excluded=excluded, columns=columns)
    types = {f.name: f.dataType for f in train.schema}
    numeric = [c for c in chosen if is_numeric(types[c])]
    text = [c for c in chosen if c not in numeric]
    scaled = numeric_parameters(train, numeric)
    common = fitted_modes(train, text)

    def number(c: str) -> str:
        median, mean, spread = scaled[c]
        value = f"coalesce(nanvl(cast({_sql_name(c)} as double), null), {median!r}D)"
        return f"({value} - {mean!r}D) / {(spread or 1.0)!r}D as {_sql_name('numeric__' + c)}"

    def filled(c: str) -> str:
        return f"coalesce(cast({_sql_name(c)} as string), {_sql_text(common[c])})"

    numbers = [number(c) for c in numeric]
    number_names = [f"numeric__{c}" for c in numeric]
    if form == "columns":
        known = categories(train, text)
        hot = [(f"categorical__{c}_{v}", f"if({filled(c)} = {_sql_text(v)}, 1D, 0D)") for c in text for v in known[c]]
        columns_sql = ", ".join(["*", *numbers, *[f"{e} as {_sql_name(n)}" for n, e in hot]])
        stages = [SQLTransformer(statement=f"SELECT {columns_sql} FROM __THIS__")]
        names = number_names + [n for n, _ in hot]
    elif form == "vector":
        filled_names = [f"filled__{c}" for c in text]
        columns_sql = ", ".join(["*", *numbers, *[f"{filled(c)} as {_sql_name(n)}" for c, n in zip(text, filled_names)]])
        first = SQLTransformer(statement=f"SELECT {columns_sql} FROM __THIS__")
        stages, inputs = [first], list(number_names)
        if text:
            work = first.transform(train)
            indexer = StringIndexer(inputCols=filled_names, outputCols=[f"index__{c}" for c in text],
                                    stringOrderType="alphabetAsc", handleInvalid="keep").fit(work)
            encoder = OneHotEncoder(inputCols=[f"index__{c}" for c in text], outputCols=[f"categorical__{c}" for c in text],
                                    dropLast=True, handleInvalid="error").fit(indexer.transform(work))
            stages += [indexer, encoder]
            inputs += [f"categorical__{c}" for c in text]
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
        names = ["features"]
    else:
        raise ValueError("form must be 'columns' or 'vector'")
    return Preprocessor(PipelineModel(stages=stages), chosen, numeric, text, names)


def build_feature_splits(df: DataFrame, *, target: str, sort_by: str, tie_by: str, train_ratio: float = 0.70, val_ratio: float = 0.15,
                         columns: Sequence[str] | None = None, excluded: Sequence[str] = (), form: str = "columns") -> dict[str, object]:
    """Chronological split, preprocessing fitted on train, all three parts transformed."""
    parts = materialize(chronological_split(df, sort_by=sort_by, tie_by=tie_by, train_ratio=train_ratio, val_ratio=val_ratio))
    train = parts.where("split = 'train'").drop("split")
    fitted = fit_preprocessor(train, target=target, columns=columns, excluded=[*excluded, tie_by], form=form)
    out: dict[str, object] = {"preprocessor": fitted, "split_summary": split_summary(parts, sort_by=sort_by)}
    for name in ("train", "val", "test"):
        rows = parts.where(F.col("split") == name).drop("split")
        out[name] = rows
        out[f"features_{name}"] = fitted.transform(rows, keep=[tie_by, target])
    return out


def frequency_table(train: DataFrame, column: str) -> DataFrame:
    """Share of all training rows per value: ``(value, share)``."""
    rows = F.lit(train.agg(F.count(F.lit(1))).scalar())
    return train.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg((F.count(F.lit(1)) / rows).alias("share"))


def frequency_encode(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each value by its share in the training rows; unseen or missing values become 0."""
    for c in columns:
        table = frequency_table(train, c).select(F.col("value").alias("__v"), F.col("share").alias("__s"))
        df = (df.join(table, df[c] == table["__v"], "left")
              .withColumn(c, F.coalesce("__s", F.lit(0.0))).drop("__v", "__s"))
    return df
