"""From the transfer modelling table to saved splits and a fitted preprocessor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pitwise.operators.features import build_feature_splits
from pitwise.sources.tables import schema_metadata, write_table

TARGET, SORT_BY = "transfer_success", "transfer_date"

# Columns that identify a row, date it or reveal the outcome.
EXCLUDED = (
    "transfer_key", "player_id", "player_full_name", "player_name", "source_club_id", "destination_club_id", "source_club_name", "destination_club_name",
    "source_club_dataset_name", "destination_club_dataset_name", "follow_up_window_end", "pre_transfer_market_value_date", "market_value_180d_prior_date",
    "market_value_365d_prior_date", "target_end_market_value_date", "target_failure_reason", "target_is_eligible", "target_minutes_window_start",
    "target_minutes_window_end")


def prepare_features(df: DataFrame, directory: str, *, tie_by: str, target: str = TARGET, sort_by: str = SORT_BY, train_ratio: float = 0.70,
                     val_ratio: float = 0.15, excluded: Sequence[str] = EXCLUDED, form: str = "vector", fmt: str = "parquet") -> dict[str, object]:
    """Split by date and ``tie_by`` (a unique number), fit on train, and write the raw and transformed parts, the preprocessor and its feature columns.

    Returns what ``build_feature_splits`` gives and the written paths. The vector form takes any number of categories.
    """
    parts = build_feature_splits(df, target=target, sort_by=sort_by, tie_by=tie_by, train_ratio=train_ratio, val_ratio=val_ratio, excluded=excluded, form=form)
    root = directory.rstrip("/")
    paths = {name: write_table(parts[name], f"{root}/{name}", fmt=fmt) for split in ("train", "val", "test") for name in (split, f"features_{split}")}
    parts["preprocessor"].save(f"{root}/preprocessor")
    paths["schema"] = write_table(schema_metadata(df.select(*parts["preprocessor"].feature_columns)), f"{root}/schema", fmt=fmt)
    return {**parts, "paths": {**paths, "preprocessor": f"{root}/preprocessor"}}
