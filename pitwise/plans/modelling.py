"""From a modelling table to scored classifiers: fill, split, encode, oversample, train, choose, test."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from pitwise.functions.scalars import is_numeric
from pitwise.operators import models as K
from pitwise.operators.cleaning import fill_with, impute_values, keep_filled_columns
from pitwise.operators.features import frequency_encode, usable_columns
from pitwise.operators.ordering import chronological_split
from pitwise.session import materialize

# Columns that identify a row, date it or reveal the outcome.
LEAKING = (
    "transfer_key", "player_id", "player_full_name", "player_name", "source_club_id", "destination_club_id", "source_club_name", "destination_club_name",
    "source_club_dataset_name", "destination_club_dataset_name", "follow_up_window_end", "pre_transfer_market_value_date", "market_value_180d_prior_date",
    "market_value_365d_prior_date", "target_end_market_value_date", "target_failure_reason", "target_is_eligible", "exclusion_reason", "date_of_birth",
    "source_country_name", "destination_country_name", "pre_transfer_market_value_club_id", "pre_transfer_market_value_league_id", "valuation_cutoff_180d",
    "valuation_cutoff_365d", "player_window_start_180d", "player_window_end_180d", "player_window_start_365d", "player_window_end_365d",
    "source_api_cache_file", "destination_api_cache_file", "player_current_market_value", "highest_market_value_in_eur", "transfer_season",
    "source_competition_name", "destination_competition_name", "target_destination_matches_24m", "target_destination_minutes_24m",
    "target_destination_goals_24m", "target_destination_assists_24m", "target_end_market_value", "target_market_value_delta_24m")


def train_and_score(df: DataFrame, *, target: str, sort_by: str, tie_by: str, excluded: Sequence[str] = LEAKING, min_nonnull: float = 0.8,
                    oversample_to: float = 0.5, families: Mapping[str, Sequence[Mapping]] = K.GRID, depth: int = 10) -> dict[str, object]:
    """Results of every configuration on train and validation, and of the best ones and the baseline on test.

    Fill values and encodings are fitted on the training rows only, so nothing of the later rows leaks into them.
    """
    kept = keep_filled_columns(df, min_nonnull)
    parts = materialize(chronological_split(kept, sort_by=sort_by, tie_by=tie_by))
    train = parts.where("split = 'train'")
    columns = usable_columns(train, target=target, excluded=[*excluded, tie_by, "split"])
    types = {f.name: f.dataType for f in parts.schema}
    text = [c for c in columns if not is_numeric(types[c])]
    filled = fill_with(parts, impute_values(train, columns))
    encoded = frequency_encode(filled, filled.where("split = 'train'"), text)
    numbers = encoded.select(F.col(tie_by).cast("long").alias("key"), F.col(target).cast("int").alias(target), "split",
                             *[F.col(c).cast("double").alias(c) for c in columns])
    vectors = materialize(VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error").transform(numbers)
                          .select("key", target, "split", "features"))
    split = {name: vectors.where(F.col("split") == name).drop("split") for name in ("train", "val", "test")}
    balanced = materialize(K.oversample_minority(split["train"], label=target, key="key", ratio=oversample_to))
    results, models = K.train_grid(balanced.select(target, "features"), split["val"].select(target, "features"), target, families=families, depth=depth)
    baseline = K.class_metrics(K.majority_baseline(split["train"], split["test"], target), label=target, prediction="prediction").select(
        F.lit("majority").alias("model"), F.lit("").alias("params"), F.lit("test").alias("split"), "*")
    tested = K.score_best(results, models, split["test"], target).unionByName(baseline)
    return {"features": columns, "results": results, "best": K.best_configurations(results), "test_results": tested, "models": models}
