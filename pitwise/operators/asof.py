"""Point-in-time lookups and windowed totals.

All operators here first shrink both inputs to one row per (key, time) with a partially aggregated
``groupBy``; only that reduced timeline is windowed by key, and results go back to the anchors with an
equi join on (key, time). A key that owns a third of the rows therefore costs one window over its
distinct days, while its rows stay spread over (key, day) partitions. For timestamps the timeline is
cut into seconds and days as well, and the last value is carried from one to the next.

Every operator reads its anchors twice: for the points in time it must answer, and to join the answers
back. In a chain, pass the frame the chain started from as ``points``, so that each step asks that frame
for its points instead of planning everything before it a second time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pitwise.functions.exact import ExactMetrics


def _not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def _join_back(anchors: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on plain equality; ``found`` is unique per key and holds no null keys.

    Both sides are merged: ``found`` has a row for each distinct point of the anchors, which the size of small files that it comes from does not show,
    so that the planner would pass it whole through the driver.
    """
    clash = sorted((set(found.columns) - set(keys)) & set(anchors.columns))
    if clash:
        raise ValueError(f"result columns already exist, choose a prefix: {', '.join(clash)}")
    renamed = found.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                           *[c for c in found.columns if c not in keys])
    condition = None
    for i, k in enumerate(keys):
        clause = anchors[k] == renamed[f"__k{i}"]
        condition = clause if condition is None else condition & clause
    return anchors.join(renamed.hint("merge"), condition, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def _last_known(rows: DataFrame, by: Sequence[str], at: str, units: Sequence[Callable[[str], Column]], last_row: int) -> DataFrame:
    """The asked rows (all without ``__ask``) of a timeline with the last ``__hit`` up to them, per key.

    Each unit of time, from the shortest, is windowed by itself, and what it ends with is carried over the units of the next length. A second of a key
    has at most a million instants and a day 86,400 seconds, so no window grows with what one key has on one day.
    """
    asked = "__ask = 1" if "__ask" in rows.columns else "true"
    if not units:
        frame = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, last_row)
        return rows.withColumn("__hit", F.last("__hit", ignorenulls=True).over(frame)).where(asked)
    unit = f"{at}u"
    cut = rows.withColumn(unit, units[0](at))
    ends = cut.groupBy(*by, unit).agg(F.max("__hit").alias("__hit"))        # hits begin with their time
    carried = _last_known(ends, by, unit, units[1:], -1).select(*by, unit, F.col("__hit").alias("__carry"))
    inside = Window.partitionBy(*by, unit).orderBy(at).rowsBetween(Window.unboundedPreceding, last_row)
    known = cut.withColumn("__hit", F.last("__hit", ignorenulls=True).over(inside)).where(asked).join(carried, [*by, unit], "left")
    return known.withColumn("__hit", F.coalesce("__hit", "__carry")).drop(unit, "__carry")


def asof_lookup(
    anchors: DataFrame,
    history: DataFrame,
    *,
    by: Sequence[str],
    anchor_on: str,
    history_on: str,
    values: Sequence[str],
    prefix: str = "",
    order_ties_by: Sequence[str] = (),
    allow_exact: bool = True,
    points: DataFrame | None = None,
) -> DataFrame:
    """Attach the last history row at or before the anchor time, per key.

    The whole row wins, also when some of its values are null. Rows with the same time are ordered by
    ``order_ties_by`` (then by the values themselves), the last one wins. Adds ``prefix + value`` columns and
    ``prefix + history_on``, the time of the matched row. ``by`` names must exist on both sides.
    """
    by, values, ties = list(by), list(values), list(order_ties_by)
    payload = list(dict.fromkeys(ties + values))
    row_type = {f.name: f.dataType for f in history.schema}
    is_day = isinstance(row_type[history_on], T.DateType)

    seen = _not_null(history, by + [history_on]).select(
        *by, F.col(history_on).alias("__t"), F.struct(*payload).alias("__row"), F.lit(0).alias("__ask"))
    asked = _not_null(anchors if points is None else points, by + [anchor_on]).select(
        *by, F.col(anchor_on).cast(row_type[history_on]).alias("__t"),
        F.lit(None).cast(seen.schema["__row"].dataType).alias("__row"), F.lit(1).alias("__ask"))
    # max ignores null structs, so anchor-only points stay null; struct order = (ties, values)
    timeline = seen.unionByName(asked).groupBy(*by, "__t").agg(
        F.max("__row").alias("__row"), F.max("__ask").alias("__ask"))
    point = F.when(F.col("__row").isNotNull(), F.struct(F.col("__t"), F.col("__row")))
    timeline = timeline.withColumn("__hit", point)

    units = [] if is_day else [lambda t: F.date_trunc("second", t), F.to_date]
    found = _last_known(timeline, by, "__t", units, 0 if allow_exact else -1)
    found = found.select(
        *by, F.col("__t").alias("__at"),
        *[F.col("__hit")["__row"][v].alias(f"{prefix}{v}") for v in values if v not in (history_on,)],
        F.col("__hit")["__t"].alias(f"{prefix}{history_on}"))
    keyed = anchors.withColumn("__at", F.col(anchor_on).cast(row_type[history_on]))
    return _join_back(keyed, found, [*by, "__at"]).drop("__at")


def daily_totals(facts: DataFrame, *, by: Sequence[str], on: str, metrics: Mapping[str, Column]) -> DataFrame:
    """Sum each metric per key and day, null keys and days dropped, empty sums as zero."""
    return (_not_null(facts.withColumn(on, F.to_date(on)), [*by, on]).groupBy(*by, on)
            .agg(*[F.coalesce(F.sum(e), F.lit(0)).alias(n) for n, e in metrics.items()]))


def cumulative_history(facts: DataFrame, *, by: Sequence[str], on: str, metrics: Mapping[str, Column], prefix: str = "cum_") -> DataFrame:
    """Daily totals per key followed by their running totals."""
    running = Window.partitionBy(*by).orderBy(on).rowsBetween(Window.unboundedPreceding, 0)
    daily = daily_totals(facts, by=by, on=on, metrics=metrics)
    return daily.select(*by, on, *[F.sum(m).over(running).alias(f"{prefix}{m}") for m in metrics])


def _timeline(anchors: DataFrame, facts: DataFrame, by: Sequence[str], anchor_on: str, fact_on: str,
              metrics: Mapping[str, Column]) -> DataFrame:
    """One row per key and day: metric totals of the facts, and whether an anchor asks for the day."""
    counted = _not_null(facts.withColumn("__t", F.to_date(fact_on)), [*by, "__t"]).select(
        *by, "__t", *[e.alias(n) for n, e in metrics.items()], F.lit(0).alias("__ask"))
    asked = _not_null(anchors.withColumn("__t", F.to_date(anchor_on)), [*by, "__t"]).select(
        *by, "__t", F.lit(1).alias("__ask"))
    return counted.unionByName(asked, allowMissingColumns=True).groupBy(*by, "__t").agg(
        *[F.sum(n).alias(n) for n in metrics], F.max("__ask").alias("__ask"))


def lookback_totals(
    anchors: DataFrame,
    facts: DataFrame,
    *,
    by: Sequence[str],
    anchor_on: str,
    fact_on: str,
    metrics: Mapping[str, Column],
    windows: Mapping[str, tuple[int, int]],
    name: str = "{metric}_{window}",
    points: DataFrame | None = None,
) -> DataFrame:
    """Sums over fixed day windows relative to the anchor day.

    ``windows`` maps a label to inclusive day offsets: the half-open look-back ``(T-180, T-1]`` is
    ``(-179, -1)``. A key without facts in the window gives 0. All windows share one pass.
    """
    line = _timeline(anchors if points is None else points, facts, by, anchor_on, fact_on, metrics).withColumn("__n", F.unix_date("__t"))
    columns = []
    for label, (low, high) in windows.items():
        frame = Window.partitionBy(*by).orderBy("__n").rangeBetween(low, high)
        columns += [F.coalesce(F.sum(m).over(frame), F.lit(0)).alias(name.format(metric=m, window=label)) for m in metrics]
    found = line.select(*by, F.col("__t").alias("__at"), "__ask", *columns).where("__ask = 1").drop("__ask")
    names = [c for c in found.columns if c not in (*by, "__at")]
    out = _join_back(anchors.withColumn("__at", F.to_date(anchor_on)), found, [*by, "__at"]).drop("__at")
    return out.withColumns({n: F.coalesce(n, F.lit(0)) for n in names})


def interval_totals(
    anchors: DataFrame,
    facts: DataFrame,
    *,
    by: Sequence[str],
    after: str,
    until: str,
    fact_on: str,
    metrics: Mapping[str, Column],
    prefix: str = "",
    points: DataFrame | None = None,
) -> DataFrame:
    """Sums over ``after < day <= until`` for per-row bounds such as calendar months.

    Two probes of the running total per distinct interval; no range join. No facts give 0. Totals are exact: doubles are added as
    whole numbers, so that taking one running total from another loses nothing.
    """
    exact = ExactMetrics(facts, metrics)
    source = anchors if points is None else points
    spans = _not_null(source.select(*by, F.to_date(after).alias("__a"), F.to_date(until).alias("__u")).distinct(),
                      [*by, "__a", "__u"])
    probes = spans.select(*by, "__a", "__u", F.inline(F.array(
        F.struct(F.col("__a").alias("__t"), F.lit(-1).alias("__sign")),
        F.struct(F.col("__u").alias("__t"), F.lit(1).alias("__sign")))))
    line = _timeline(probes, facts, by, "__t", fact_on, exact.columns)
    running = Window.partitionBy(*by).orderBy("__t").rowsBetween(Window.unboundedPreceding, 0)
    at = line.select(*by, "__t", "__ask", *[F.coalesce(F.sum(m).over(running), F.lit(0)).alias(m) for m in exact.columns]).where("__ask = 1")
    sums = probes.join(at, [*by, "__t"]).groupBy(*by, "__a", "__u").agg(*[F.sum(F.col("__sign") * F.col(m)).alias(m) for m in exact.columns])
    found = sums.select(*by, "__a", "__u", *[exact.total(m, {c: F.col(c) for c in exact.columns}).alias(f"{prefix}{m}") for m in metrics])
    keyed = anchors.withColumns({"__a": F.to_date(after), "__u": F.to_date(until)})
    out = _join_back(keyed, found, [*by, "__a", "__u"]).drop("__a", "__u")
    return out.withColumns({f"{prefix}{m}": F.coalesce(f"{prefix}{m}", F.lit(0)) for m in metrics})


def interval_aggregate(
    anchors: DataFrame,
    facts: DataFrame,
    *,
    by: Sequence[str],
    start: str,
    end: str,
    fact_on: str,
    aggregates: Mapping[str, tuple[str, Column]],
    grain: str = "month",
    points: DataFrame | None = None,
) -> DataFrame:
    """``sum``/``min``/``max`` over ``start <= day < end``; no facts give null.

    An interval is cut at the blocks of the greatest length, a power of four of days, that is not longer than itself: the rest of the block that it begins in,
    the part of the one that it ends in, and at most three whole ones between. Facts and these points are reduced to days, and each day gets what its block
    holds from it on and up to it, by two running windows. Facts are blocked only by lengths that some interval has. A busy key costs one window over the
    distinct days of a block, and all joins are on plain equality. ``grain`` (month or year) is of no effect.
    """
    if grain not in ("month", "year"):
        raise ValueError(f"unknown grain {grain!r}")
    how = {"sum": F.sum, "min": F.min, "max": F.max}
    names = list(aggregates)
    again = [how[kind](n).alias(n) for n, (kind, _) in aggregates.items()]

    source = anchors if points is None else points
    asked = _not_null(source.select(*by, F.to_date(start).alias("__s"), F.to_date(end).alias("__e")), [*by, "__s", "__e"]).where("__s < __e")
    spans = asked.distinct()
    parts = spans.withColumn("__p", F.explode(span_parts(F.unix_date("__s"), F.unix_date("__e")))).select(*by, "__s", "__e", "__p.*")
    lengths = asked.agg(F.collect_set(block_length(F.datediff("__e", "__s")))).scalar()

    dated = _not_null(facts.withColumn("__d", F.unix_date(F.to_date(fact_on))), [*by, "__d"])
    dated = dated.select(*by, F.explode(lengths).alias("__w"), "__d", *[expr.alias(n) for n, (_, expr) in aggregates.items()], F.lit(0).alias("__ask"))
    line = dated.unionByName(parts.select(*by, "__w", "__d", F.lit(1).alias("__ask")), allowMissingColumns=True).groupBy(*by, "__w", "__d").agg(
        *again, F.max("__ask").alias("__ask")).withColumn("__i", F.floor(F.col("__d") / F.col("__w")))
    block = Window.partitionBy(*by, "__w", "__i").rowsBetween(Window.unboundedPreceding, 0)
    up, down = block.orderBy("__d"), block.orderBy(F.col("__d").desc())
    at = line.select(*by, "__w", "__d", "__ask", *[how[kind](n).over(w).alias(f"{side}{n}") for side, w in (("__to_", up), ("__from_", down)) for n, (kind, _) in aggregates.items()])
    at = at.where("__ask = 1").drop("__ask").hint("merge")        # as many rows as spans, however small the files they come from
    met = parts.join(at, [*by, "__w", "__d"]).select(*by, "__s", "__e", *[F.when(F.col("__on"), F.col(f"__from_{n}")).otherwise(F.col(f"__to_{n}")).alias(n) for n in names])
    found = met.groupBy(*by, "__s", "__e").agg(*again)
    keyed = anchors.withColumns({"__s": F.to_date(start), "__e": F.to_date(end)})
    return _join_back(keyed, found, [*by, "__s", "__e"]).drop("__s", "__e")


def block_length(days: Column) -> Column:
    """The greatest power of four up to ``days``, 4 ** 10 at most."""
    length = F.lit(1)
    for k in range(1, 11):
        length = F.when(days >= 4 ** k, 4 ** k).otherwise(length)
    return length


def span_parts(start: Column, stop: Column) -> Column:
    """What makes up the days from ``start`` up to ``stop``: (w, d, on), of the block of w days that holds day d the days from d on, or up to d where ``on`` is false. Each day once."""
    w = block_length(stop - start)
    first, last = (F.floor(day / w).cast("int") for day in (start, stop - 1))
    part = lambda day, on: F.struct(w.alias("__w"), day.cast("int").alias("__d"), F.lit(on).alias("__on"))
    whole = F.when(first + 1 < last, F.transform(F.sequence(first + 1, last - 1), lambda i: part(i * w, True)))
    return F.concat(F.array(part(start, True)), F.coalesce(whole, F.array().cast(WHOLE_PARTS)), F.when(first < last, F.array(part(stop - 1, False))).otherwise(F.array().cast(WHOLE_PARTS)))


WHOLE_PARTS = "array<struct<__w: int, __d: int, __on: boolean>>"


#: Lengths of the blocks that ``interval_blocks`` cuts days into, each four of the one before.
BLOCK_DAYS = (32, 128, 512, 2048)


def interval_blocks(start: Column, stop: Column) -> Column:
    """What makes up the days from ``start`` up to ``stop``: blocks (w days, number i, from day w * i on), each day once, and where w is 0 the blocks of 32 days that hold the rest."""
    up = lambda w: F.ceil(start / w).cast("int")
    down = lambda w: F.floor(stop / w).cast("int")
    none = F.array().cast("array<int>")
    run = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(none)
    named = lambda numbers, w: F.transform(numbers, lambda i: F.struct(F.lit(w).alias("w"), i.alias("i")))
    least = BLOCK_DAYS[0]
    cut = lambda day: (day % least != 0) | (up(least) >= down(least))
    ends = F.array(F.when(cut(start), F.floor(start / least).cast("int")), F.when(cut(stop), F.floor((stop - 1) / least).cast("int")))
    found = [named(F.array_distinct(F.array_compact(ends)), 0)]
    for k, w in enumerate(BLOCK_DAYS):
        whole = run(up(w), down(w))
        if k + 1 < len(BLOCK_DAYS):        # what longer blocks cover is left to them
            longer = BLOCK_DAYS[k + 1]
            whole = F.when(up(longer) < down(longer), F.concat(run(up(w), up(longer) * 4), run(down(longer) * 4, down(w)))).otherwise(whole)
        found.append(named(whole, w))
    return F.concat(*found)
