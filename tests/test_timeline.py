"""Fused timelines, exact totals and blocks of days against brute force."""

import datetime as dt
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pitwise.functions.exact import ExactMetrics, plan_limbs
from pitwise.operators.asof import BLOCK_DAYS, asof_lookup, interval_blocks, interval_totals
from pitwise.operators.timeline import LastValue, Totals, answers, attach, point_in_time

DAY0 = dt.date(2020, 1, 1)


def days(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def rows(seed, n=300):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice(x)
    return [(i, 0 if rng.random() < 0.4 else pick(None, 1, 2, 3), pick("a", "a", "b", None), days(pick(None, *range(80))) if rng.random() < 0.95 else None,
             rng.choice((None, rng.randrange(100))), rng.choice((None, rng.uniform(-1, 1) * 10.0 ** rng.randrange(-6, 17)))) for i in range(n)]


def test_all_questions_at_once_equal_brute_force(spark):
    asked, seen, other = rows(1), rows(2), rows(3)
    schema = "id int, k int, place string, day date, v int, x double"
    anchors = spark.createDataFrame(asked, schema).select("id", "k", "place", F.col("day").alias("at")).repartition(3)
    events, more = spark.createDataFrame(seen, schema), spark.createDataFrame(other, schema)
    out = point_in_time(anchors, by=["k"], within=["place"], on=["at"], instants={"at": F.col("at"), "back": F.date_sub("at", 20), "ahead": F.date_add("at", 10)},
                        sources={"events": (events, F.col("day")), "more": (more, F.col("day"))}, probes=[
                            LastValue("events", "at", {"last_v": F.col("v"), "last_id": F.col("id")}, [F.col("id")], strict=True, dated="last_day"),
                            LastValue("more", "ahead", {"even": F.col("id")}, [F.col("id")], where=F.col("id") % 2 == 0),
                            Totals("events", "back", "at", {"n": F.lit(1), "s": F.col("v"), "x": F.col("x")}),
                            Totals("more", "back", "ahead", {"own_n": F.lit(1), "own_x": F.col("x")}, inside=True, where=F.col("v").isNotNull())])
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(asked)
    for i, k, place, at, _, _ in asked:
        g = got[i]
        fit = lambda found, low, high: [r for r in found if at is not None and k is not None and r[1] == k and r[3] is not None and (low is None or r[3] > at + dt.timedelta(days=low)) and r[3] <= at + dt.timedelta(days=high)]
        last = max(fit(seen, None, -1), key=lambda r: (r[3], r[0]), default=None)
        assert (g.last_v, g.last_id, g.last_day) == ((last[4], last[0], last[3]) if last else (None, None, None))
        even = max((r for r in fit(other, None, 10) if r[0] % 2 == 0), key=lambda r: (r[3], r[0]), default=None)
        assert g.even == (even[0] if even else None)
        window = fit(seen, -20, 0)
        assert (g.n, g.s, g.x) == (len(window), sum(r[4] or 0 for r in window), float(sum(Fraction(r[5] or 0) for r in window)))
        own = [r for r in fit(other, -20, 10) if place is not None and r[2] == place and r[4] is not None]
        assert (g.own_n, g.own_x) == (len(own), float(sum(Fraction(r[5] or 0) for r in own)))


def test_chain_reads_its_anchors_twice_and_shuffles_four_times(spark):
    asked = spark.createDataFrame(rows(1), "id int, k int, place string, day date, v int, x double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        probes = [LastValue("e", "day", {f"v{i}": F.col("v")}) for i in range(4)] + [Totals("e", "back", "day", {"n": F.lit(1)}, inside=True), Totals("e", "back", "day", {"m": F.lit(1)})]
        out = point_in_time(asked.select("id", "k", "place", "day"), by=["k"], within=["place"], on=["day"], instants={"day": F.col("day"), "back": F.date_sub("day", 9)},
                            sources={"e": (asked, F.col("day"))}, probes=probes)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 4


def test_odd_inputs(spark):
    schema = "k int, day date, v double"
    empty, one = spark.createDataFrame([], schema), spark.createDataFrame([(1, DAY0, 2.0), (1, DAY0, 2.0), (None, DAY0, 1.0), (1, None, 1.0)], schema)
    ask = dict(by=["k"], on=["day"], instants={"day": F.col("day"), "before": F.date_sub("day", 1)})
    probes = [LastValue("e", "day", {"last": F.col("v")}), Totals("e", "before", "day", {"total": F.col("v")})]
    assert sorted(map(str, point_in_time(one.select("k", "day"), sources={"e": (empty, F.col("day"))}, probes=probes, **ask).select("last", "total").collect())) == ["Row(last=None, total=0.0)"] * 4
    assert point_in_time(empty.select("k", "day"), sources={"e": (one, F.col("day"))}, probes=probes, **ask).count() == 0
    got = point_in_time(one.select("k", "day"), sources={"e": (one, F.col("day"))}, probes=probes, **ask).collect()
    assert sorted((r.total, r.last) for r in got if r.k and r.day) == [(4.0, 2.0), (4.0, 2.0)] and len(got) == 4
    with pytest.raises(ValueError, match="total"):
        point_in_time(one.withColumn("total", F.lit(1)), sources={"e": (one, F.col("day"))}, probes=probes, **ask)
    two = spark.createDataFrame([(1, 9, DAY0)], "a int, b int, day date")
    found = answers(two.select(F.explode(F.array("a", "b")).alias("k"), "day"), sources={"e": (one, F.col("day"))}, probes=probes[1:], **ask)
    out = attach(attach(two, found, keys={"a": "k", "day": "day"}, totals=["total"]).withColumnRenamed("total", "total_a"), found, keys={"b": "k", "day": "day"}, totals=["total"]).first()
    assert (out.total_a, out.total) == (4.0, 0.0)


@pytest.mark.parametrize("values", [
    [1e17, 1.0, -1e17], [0.1] * 10, [1e300, 1e-300, -1e300], [5e-324, 1.5], [-0.1, -1e10, 3.3], [math.inf, 1.0], [math.nan, 2.0], [math.inf, -math.inf],
    [1.7e308, 1.7e308, -1.7e308], [0.0, -0.0], [2.0 ** 53, 1.0, 1.0], [-5e-324, 5e-324, -5e-324], []])
def test_totals_of_doubles_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    exact = ExactMetrics(df, {"s": F.col("v")})
    got = df.agg(*[F.sum(c).alias(n) for n, c in exact.columns.items()]).select(exact.total("s", {n: F.col(n) for n in exact.columns})).first()[0]
    want = float(sum(map(Fraction, values))) if all(map(math.isfinite, values)) else sum(values)
    assert got == want or (math.isnan(got) and math.isnan(want))


def test_only_doubles_are_cut(spark):
    df = spark.createDataFrame([(1, 2.0)], "i int, x double")
    assert set(plan_limbs(df, {"i": F.col("i"), "x": F.col("x"), "d": F.col("x").cast("decimal(9,2)")})) == {"x"}


def test_running_totals_hide_nothing(spark):
    facts = spark.createDataFrame([(1, days(0), 1e17), (1, days(1), 1.0), (1, days(2), 0.1), (1, days(3), -1e17)], "k int, day date, v double")
    anchors = spark.createDataFrame([(1, days(0), days(2)), (1, days(-1), days(3))], "k int, a date, b date")
    got = interval_totals(anchors, facts, by=["k"], after="a", until="b", fact_on="day", metrics={"v": F.col("v")}).orderBy("a").collect()
    assert [r.v for r in got] == [1.1, 1.1]


def test_blocks_make_up_every_interval_once(spark):
    rng = random.Random(5)
    spans = [(a, a + n) for a in (-70, -1, 0, 5, 31, 32, 100, 18_262) for n in (1, 2, 31, 32, 33, 64, 100, 700, 5_000)] + [(a, a + rng.randrange(1, 9_000)) for a in rng.choices(range(-500, 20_000), k=60)]
    df = spark.createDataFrame(spans, "a int, b int").select("a", "b", interval_blocks(F.col("a"), F.col("b")).alias("blocks"))
    for a, b, blocks in df.collect():
        covered = [d for w, i in blocks for d in (range(i * w, i * w + w) if w else range(max(a, i * BLOCK_DAYS[0]), min(b, (i + 1) * BLOCK_DAYS[0])))]
        assert sorted(covered) == list(range(a, b)) and len(blocks) <= 22


def test_one_key_with_a_third_of_all_instants_on_one_day(spark):
    hot = [(i, 0, dt.datetime(2024, 1, 1, 12) + dt.timedelta(microseconds=37 * i * i), i % 7) for i in range(3_000)]
    rest = [(10_000 + i, 1 + i % 50, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=17 * i), i) for i in range(6_000)]
    df = spark.createDataFrame(hot + rest, "id int, k int, ts timestamp, v int")
    history = df.where("id % 3 = 0")
    out = asof_lookup(df.select("id", "k", "ts"), history, by=["k"], anchor_on="ts", history_on="ts", values=["v"], prefix="p_", order_ties_by=["id"], allow_exact=False)
    got = {r["id"]: (r["p_v"], r["p_ts"]) for r in out.collect()}
    by_key = {}
    for i, k, ts, v in sorted(hot + rest, key=lambda r: (r[2], r[0])):
        by_key.setdefault(k, []).append((i, ts, v))
    for seen in by_key.values():
        for i, ts, _ in seen:
            before = [(t, v) for j, t, v in seen if j % 3 == 0 and t < ts]
            assert got[i] == ((before[-1][1], before[-1][0]) if before else (None, None))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "date_trunc(second" in plan, "windows are cut by second, which bounds them"
