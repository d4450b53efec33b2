"""Audited cohorts and follow-up labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from pitwise.functions.scalars import composite_key, holds, reasons
from pitwise.operators.asof import interval_aggregate
from pitwise.operators.joins import mark_duplicates
from pitwise.operators.timeline import LastValue, Totals, point_in_time


def window_rules(date: str, start: str, end: str, *, missing: str, before: str, after: str) -> list[tuple[str, Column]]:
    """Ordered reasons for a missing date and for dates outside the inclusive window."""
    d = F.col(date)
    return [(missing, d.isNull()), (before, d < F.to_date(F.lit(start))), (after, d > F.to_date(F.lit(end)))]


def audit(df: DataFrame, rules: Iterable[tuple[str, Column]], *, duplicate_keys: Sequence[str], order_by: str,
          duplicate_reason: str, name: str = "exclusion_reason") -> DataFrame:
    """Add every reason to exclude a row, in rule order, duplicates last.

    Duplicates are judged over all rows: a later copy is flagged even if the first copy is excluded too.
    """
    marked = mark_duplicates(df, duplicate_keys, order_by, "__copy")
    return marked.withColumn(name, reasons([*rules, (duplicate_reason, F.col("__copy"))])).drop("__copy")


def included(audited: DataFrame, name: str = "exclusion_reason") -> DataFrame:
    return audited.where(F.col(name).isNull())


def excluded(audited: DataFrame, name: str = "exclusion_reason") -> DataFrame:
    return audited.where(F.col(name).isNotNull())


def reason_counts(audited: DataFrame, name: str = "exclusion_reason", sep: str = ";") -> DataFrame:
    """Rows per single reason."""
    return audited.select(F.explode(F.split(name, sep)).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def entity_date_key(entity: str, date: str, *places: str) -> Column:
    return composite_key(entity, F.date_format(F.col(date), "yyyy-MM-dd"), *places, placeholders={1: "missing-date"})


class FollowUp(NamedTuple):
    """What a follow-up label is judged by: the outcome inside ``[date, date + months]`` of an entity at a place.

    ``activity`` rows carry their day in ``activity_on`` and their place under the cohort's name; ``valuations`` carry ``value`` on ``value_on``.
    """
    entity: str
    place: str
    date: str
    activity: DataFrame
    activity_on: str
    metrics: Mapping[str, Column]
    threshold_metric: str
    threshold: float
    valuations: DataFrame
    value_on: str
    value: str
    baseline: str
    months: int = 24
    value_ties: Sequence[str] = ()
    prefix: str = "target_"
    activity_where: Column | None = None
    valuations_where: Column | None = None

    def instants(self) -> dict[str, Column]:
        return {"before": F.date_sub(self.date, 1), "window_end": F.add_months(self.date, self.months)}

    def sources(self) -> dict[str, tuple[DataFrame, Column]]:
        """One source where both frames are the same one, so that it is read once."""
        out = {"activity": (self.activity, F.to_date(self.activity_on))}
        return out if self._shared() else {**out, "valuations": (self.valuations, F.to_date(self.value_on))}

    def _shared(self) -> bool:
        return self.valuations is self.activity and self.value_on == self.activity_on

    def probes(self) -> list[LastValue | Totals]:
        return [LastValue("activity" if self._shared() else "valuations", "window_end", {"__end_value": F.col(self.value)}, [F.col(t) for t in self.value_ties],
                          dated="__end_date", where=self.valuations_where),
                Totals("activity", "before", "window_end", {f"{self.prefix}{n}": e for n, e in self.metrics.items()}, inside=True, where=self.activity_where)]

    def judge(self, answered: DataFrame, reasons_for: Mapping[str, str] | None = None) -> DataFrame:
        """Label, eligibility and reasons from the answers of the probes.

        Success needs enough activity at the place and an end value not below the baseline.
        """
        texts = {
            "baseline": "missing_baseline_value", "end": "missing_follow_up_value",
            "inside": "no_value_inside_follow_up_window", "horizon": "incomplete_follow_up_window", **(reasons_for or {})}
        valued = self.valuations if self.valuations_where is None else self.valuations.where(self.valuations_where)
        horizon = F.lit(valued.where(F.col(self.entity).isNotNull()).agg(F.max(F.to_date(self.value_on))).scalar())
        work = answered.withColumn("follow_up_window_end", self.instants()["window_end"])
        end_value, end_date, base = F.col("__end_value"), F.col("__end_date"), F.col(self.baseline)
        failures = [(texts["baseline"], base.isNull()), (texts["end"], end_value.isNull()),
                    (texts["inside"], end_date.isNull() | holds(end_date <= F.col(self.date))),
                    (texts["horizon"], holds(F.col("follow_up_window_end") > horizon))]
        success = holds(F.col(f"{self.prefix}{self.threshold_metric}") >= self.threshold) & holds(end_value >= base)
        labelled = work.withColumns({
            f"{self.prefix}end_value": end_value, f"{self.prefix}end_value_date": end_date, f"{self.prefix}value_delta": end_value - base,
            f"{self.prefix}failure_reason": reasons(failures)})
        eligible = F.col(f"{self.prefix}failure_reason").isNull()
        return labelled.withColumns({f"{self.prefix}is_eligible": eligible, "success": F.when(eligible, success.cast("int"))}).drop("__end_value", "__end_date")


def follow_up_label(cohort: DataFrame, follow_up: FollowUp, *, reasons_for: Mapping[str, str] | None = None, points: DataFrame | None = None) -> DataFrame:
    """Outcome inside the follow-up window with the reasons why a row cannot be judged.

    Nothing dated after the window can enter: the end value is the last one at the window end and the totals stop there. Both come from one timeline.
    """
    f = follow_up
    answered = point_in_time(cohort, by=[f.entity], within=[f.place], on=[f.date], instants=f.instants(), sources=f.sources(), probes=f.probes(), points=points)
    return f.judge(answered, reasons_for)


def window_scores(
    cohort: DataFrame,
    activity: DataFrame,
    valuations: DataFrame,
    *,
    entity: str,
    place: str,
    date: str,
    activity_on: str,
    activity_place: str,
    sums: Mapping[str, Column],
    value_on: str,
    value_place: str,
    value: str,
    years: int = 3,
    pool_places: bool = True,
) -> DataFrame:
    """Sums of activity at the place and the highest value there within ``[date, date + years)``.

    With ``pool_places`` the statistics are shared by all rows of the same entity and date, as the weighted
    label defines them; otherwise they belong to the row's own place. Activity and values are reduced to the same blocks of days.
    """
    spans = cohort.select(entity, place, date).withColumn("__end", F.add_months(F.col(date), 12 * years))
    counted = activity.select(entity, F.col(activity_place).alias(place), F.to_date(activity_on).alias("__day"), *[e.alias(n) for n, e in sums.items()])
    valued = valuations.select(entity, F.col(value_place).alias(place), F.to_date(value_on).alias("__day"), F.col(value).alias("new_value"))
    facts = counted.unionByName(valued, allowMissingColumns=True)
    aggregates = {**{n: ("sum", F.col(n)) for n in sums}, "new_value": ("max", F.col("new_value"))}
    if pool_places:
        found = interval_aggregate(spans.distinct(), facts, by=[entity, place], start=date, end="__end", fact_on="__day", aggregates=aggregates)
        stats = found.groupBy(entity, date).agg(*[F.sum(n).alias(n) for n in sums], F.max("new_value").alias("new_value"))
        stats = stats.select(F.col(entity).alias("__entity"), F.col(date).alias("__date"), *sums, "new_value").hint("merge")     # as many rows as the cohort: not for the driver
        joined = cohort.join(stats, (cohort[entity] == stats["__entity"]) & (cohort[date] == stats["__date"]), "left").drop("__entity", "__date")
    else:
        ended = cohort.withColumn("__end", F.add_months(F.col(date), 12 * years))
        joined = interval_aggregate(ended, facts, by=[entity, place], start=date, end="__end", fact_on="__day", aggregates=aggregates, points=spans).drop("__end")
    return joined.withColumns({n: F.coalesce(n, F.lit(0)) for n in [*sums, "new_value"]})


def score_label(df: DataFrame, criteria: Sequence[tuple[Column, int]], minimum: int, *, score: str = "score", name: str = "success") -> DataFrame:
    """Weighted vote in whole points, so that no floating-point edge decides; a null criterion counts as missed."""
    points = None
    for passed, weight in criteria:
        value = F.when(holds(passed), F.lit(weight)).otherwise(F.lit(0))
        points = value if points is None else points + value
    return df.withColumn(score, points).withColumn(name, (F.col(score) >= minimum).cast("int"))


def metric_values(pairs: Mapping[str, Column], df: DataFrame) -> DataFrame:
    """One aggregation turned to long ``(metric, value)`` rows, values as text."""
    row = df.agg(*[e.cast("string").alias(f"m{i}") for i, e in enumerate(pairs.values())])
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"m{i}").alias("value")) for i, n in enumerate(pairs)])))
