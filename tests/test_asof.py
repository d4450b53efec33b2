"""As-of lookups and windowed totals against brute force on random data, one key holding most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitwise.operators.asof import asof_lookup, cumulative_history, interval_aggregate, interval_totals, lookback_totals

DAY0 = dt.date(2020, 1, 1)


def make(seed, n=400, keys=5, days=60, stamps=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.4 else rng.choice([None, *range(1, keys)])
        when = DAY0 + dt.timedelta(days=rng.randrange(days))
        if stamps:
            when = dt.datetime(when.year, when.month, when.day) + dt.timedelta(seconds=rng.randrange(86400))
        if rng.random() < 0.03:
            when = None
        rows.append((i, key, when, None if rng.random() < 0.2 else rng.randrange(100)))
    return rows


def frames(spark, stamps=False, seed=1):
    kind = "timestamp" if stamps else "date"
    anchors = spark.createDataFrame([r[:3] for r in make(seed, stamps=stamps)], f"id int, k int, at {kind}")
    history = spark.createDataFrame(make(seed + 1, stamps=stamps), f"pos int, k int, t {kind}, v int")
    return anchors, history


@pytest.mark.parametrize("stamps", [False, True])
@pytest.mark.parametrize("exact", [False, True])
def test_asof_equals_brute_force(spark, stamps, exact):
    anchors, history = frames(spark, stamps)
    got = {r["id"]: (r["p_v"], r["p_t"]) for r in asof_lookup(
        anchors, history, by=["k"], anchor_on="at", history_on="t", values=["v"], prefix="p_", order_ties_by=["pos"], allow_exact=exact).collect()}
    past = history.collect()
    assert len(got) == anchors.count()
    for a in anchors.collect():
        fits = [h for h in past if a["k"] is not None and a["at"] is not None and h["k"] == a["k"] and h["t"] is not None
                and (h["t"] <= a["at"] if exact else h["t"] < a["at"])]
        best = max(fits, key=lambda h: (h["t"], h["pos"]), default=None)
        assert got[a["id"]] == ((best["v"], best["t"]) if best else (None, None))


def test_asof_keeps_a_null_value_of_the_last_row(spark):
    history = spark.createDataFrame([(1, dt.date(2020, 1, 1), 5), (1, dt.date(2020, 1, 3), None)], "k int, t date, v int")
    anchors = spark.createDataFrame([(1, dt.date(2020, 1, 4))], "k int, at date")
    row = asof_lookup(anchors, history, by=["k"], anchor_on="at", history_on="t", values=["v"], prefix="p_").first()
    assert (row["p_v"], row["p_t"]) == (None, dt.date(2020, 1, 3))


def test_asof_empty_history_gives_nulls(spark):
    anchors, history = frames(spark)
    out = asof_lookup(anchors, history.where("false"), by=["k"], anchor_on="at", history_on="t", values=["v"], prefix="p_")
    assert out.count() == anchors.count() and out.where("p_v is not null").count() == 0


def test_lookback_totals_half_open(spark):
    anchors, facts = frames(spark)
    got = {r["id"]: (r["n_w"], r["s_w"]) for r in lookback_totals(
        anchors, facts, by=["k"], anchor_on="at", fact_on="t", metrics={"n": F.lit(1), "s": F.col("v")}, windows={"w": (-9, -1)}).collect()}
    rows = facts.collect()
    for a in anchors.collect():
        fits = [f for f in rows if a["k"] is not None and a["at"] is not None and f["k"] == a["k"] and f["t"] is not None
                and a["at"] - dt.timedelta(days=10) < f["t"] <= a["at"] - dt.timedelta(days=1)]
        assert got[a["id"]] == (len(fits), sum(f["v"] or 0 for f in fits))


def test_interval_totals_and_aggregates(spark):
    anchors, facts = frames(spark)
    anchors = anchors.withColumn("stop", F.add_months("at", 1))
    totals = {r["id"]: (r["x_n"], r["x_s"]) for r in interval_totals(
        anchors, facts, by=["k"], after="at", until="stop", fact_on="t", metrics={"n": F.lit(1), "s": F.col("v")}, prefix="x_").collect()}
    extremes = {r["id"]: (r["lo"], r["hi"], r["sum"]) for r in interval_aggregate(
        anchors, facts, by=["k"], start="at", end="stop", fact_on="t",
        aggregates={"lo": ("min", F.col("v")), "hi": ("max", F.col("v")), "sum": ("sum", F.col("v"))}).collect()}
    rows = facts.collect()
    for a in anchors.collect():
        same = [f for f in rows if a["k"] is not None and a["at"] is not None and f["k"] == a["k"] and f["t"] is not None]
        after = [f for f in same if a["at"] < f["t"] <= a["stop"]]
        assert totals[a["id"]] == (len(after), sum(f["v"] or 0 for f in after))
        values = [f["v"] for f in same if a["at"] <= f["t"] < a["stop"] and f["v"] is not None]
        assert extremes[a["id"]] == ((min(values), max(values), sum(values)) if values else (None, None, None))


@pytest.mark.parametrize("grain", ["month", "year"])
def test_long_intervals_use_whole_blocks(spark, grain):
    facts = spark.createDataFrame([(1, DAY0 + dt.timedelta(days=i), i) for i in range(0, 900, 7)], "k int, t date, v int")
    anchors = spark.createDataFrame([(i, 1, DAY0 + dt.timedelta(days=13 * i), DAY0 + dt.timedelta(days=13 * i + 400)) for i in range(30)], "id int, k int, at date, stop date")
    out = interval_aggregate(anchors, facts, by=["k"], start="at", end="stop", fact_on="t", grain=grain, aggregates={"s": ("sum", F.col("v")), "m": ("max", F.col("v"))})
    rows = facts.collect()
    for r in out.collect():
        values = [f["v"] for f in rows if r["at"] <= f["t"] < r["stop"]]
        assert (r["s"], r["m"]) == (sum(values), max(values))


def test_cumulative_history_drops_null_keys(spark):
    _, facts = frames(spark)
    out = cumulative_history(facts, by=["k"], on="t", metrics={"n": F.lit(1)})
    last = {r["k"]: r["n"] for r in out.groupBy("k").agg(F.max("cum_n").alias("n")).collect()}
    want = {r["k"]: r["n"] for r in facts.dropna(subset=["k", "t"]).groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert last == want and None not in last


def test_hot_key_rows_are_not_windowed_by_key(spark):
    """The window by key sees the reduced timeline only: raw anchors meet it in a join on key and day."""
    anchors, history = frames(spark)
    plan = asof_lookup(anchors, history, by=["k"], anchor_on="at", history_on="t", values=["v"], prefix="p_")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Aggregate" in plan and "Join" in plan
    window = plan[plan.index("Window ["):]
    assert "Aggregate" in window.split("Scan")[0], "the timeline must be aggregated below the window"


def test_clashing_result_columns_are_refused(spark):
    anchors, history = frames(spark)
    with pytest.raises(ValueError, match="prefix"):
        asof_lookup(anchors.withColumn("v", F.lit(1)), history, by=["k"], anchor_on="at", history_on="t", values=["v"])


def test_chain_with_points_equals_chain_without(spark):
    anchors, history = frames(spark)
    plain = with_points = anchors
    for i in range(2):
        args = dict(by=["k"], anchor_on="at", history_on="t", values=["v"], prefix=f"p{i}_", order_ties_by=["pos"], allow_exact=bool(i))
        plain, with_points = asof_lookup(plain, history, **args), asof_lookup(with_points, history, points=anchors, **args)
    assert sorted(map(str, plain.collect())) == sorted(map(str, with_points.collect()))


def test_interval_aggregate_passes_nothing_large_through_the_driver(spark):
    """A point for each anchor comes out of small files; neither the facts nor the points may be broadcast."""
    days = spark.range(400).select((F.col("id") % 7).alias("k"), F.expr("date_add(date'1996-01-01', cast(id * 5 as int))").alias("t"), F.col("id").alias("v"))
    anchors = days.select("k", "t", F.add_months("t", 36).alias("stop"))
    out = interval_aggregate(anchors, days, by=["k"], start="t", end="stop", fact_on="t", aggregates={"s": ("sum", F.col("v"))})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_interval_aggregate_meets_each_day_once_at_any_length(spark):
    """Intervals of 1 to 5,000 days, with some that hold nothing, against a loop over the facts; days before 1970 as well."""
    draw = random.Random(5)
    zero = dt.date(1965, 3, 1)
    facts = [(draw.choice("ab"), zero + dt.timedelta(draw.randrange(5000)), draw.randrange(100)) for _ in range(400)]
    asked = [(i, draw.choice("abc"), zero + dt.timedelta(draw.randrange(5000)), draw.choice([0, 1, 2, 3, 4, 15, 16, 17, 63, 64, 65, 255, 256, 700, 1023, 1024, 1096, 4096, 5000])) for i in range(300)]
    rows = [(i, k, s, s + dt.timedelta(n)) for i, k, s, n in asked]
    out = interval_aggregate(
        spark.createDataFrame(rows, "id int, k string, s date, e date"), spark.createDataFrame(facts, "k string, t date, v int"), by=["k"], start="s", end="e", fact_on="t",
        aggregates={"total": ("sum", F.col("v")), "low": ("min", F.col("v")), "high": ("max", F.col("v"))})
    got = {r["id"]: (r["total"], r["low"], r["high"]) for r in out.collect()}
    for i, k, s, e in rows:
        held = [v for f, t, v in facts if f == k and s <= t < e]
        assert got[i] == ((sum(held), min(held), max(held)) if held else (None, None, None))
