"""Several point-in-time questions answered by one timeline per key.

All sources and all instants that anchors ask about become rows of one frame, which is reduced to one row per key and day before it is
windowed by key. Whatever is asked (last known values, totals between two instants, totals at a place) is a running maximum or a running total of that
frame at an instant, so a chain of lookups costs two shuffles for the timeline and one join back, however many questions there are. No frame
slides: a total between two instants is the difference of two running totals, exact for whole numbers, decimals and doubles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitwise.functions.exact import ExactMetrics


class LastValue(NamedTuple):
    """The last row of a source at or before an instant (before its day if ``strict``); of rows of one day the last by ``ties``, then by the values."""
    source: str
    at: str
    values: Mapping[str, Column]        # result names and what they are of the source's row
    ties: Sequence[Column] = ()
    strict: bool = False
    dated: str | None = None            # result name of the matched day
    where: Column | None = None


class Totals(NamedTuple):
    """Sums over the rows of a source with ``after < day <= until``; with ``inside`` over those that agree in the ``within`` columns as well. No rows give 0."""
    source: str
    after: str
    until: str
    metrics: Mapping[str, Column]
    inside: bool = False
    where: Column | None = None


def _present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def answers(points: DataFrame, *, by: Sequence[str], on: Sequence[str], instants: Mapping[str, Column], sources: Mapping[str, tuple[DataFrame, Column]],
            probes: Sequence[LastValue | Totals], within: Sequence[str] = ()) -> DataFrame:
    """One row per distinct (by, within, on) of ``points`` with the result columns of all probes.

    ``instants`` are dates computed from ``on`` columns; ``sources`` are frames with ``by`` columns (and ``within`` columns where a probe is ``inside``) and the day of
    their rows. Points with a null key or a null ``on``, and rows with a null key or day, are left out; a null ``within`` agrees with nothing.
    """
    by, on, within = list(by), list(on), list(within)
    bits = {name: 1 << k for k, name in enumerate(instants)}
    events, running, wanted = [], [], {}
    for name, (frame, day) in sources.items():
        mine = [(k, p) for k, p in enumerate(probes) if p.source == name]
        inside = any(isinstance(p, Totals) and p.inside for _, p in mine)
        columns = {}
        for k, p in mine:
            only = (lambda c, p=p: c if p.where is None else F.when(p.where, c))
            if isinstance(p, LastValue):
                row = F.struct(F.unix_date(day).alias("n"), *[t.alias(f"t{i}") for i, t in enumerate(p.ties)], *[v.alias(f"v{i}") for i, v in enumerate(p.values.values())])
                columns[f"__hit{k}"] = only(row)
                running.append((f"__hit{k}", F.max(f"__hit{k}"), False, -1 if p.strict else 0))
            else:
                exact = ExactMetrics(frame if p.where is None else frame.where(p.where), p.metrics)
                wanted[k] = exact
                for part, column in exact.columns.items():
                    columns[f"__sum{k}_{part}"] = only(column)
                    running.append((f"__sum{k}_{part}", F.sum(f"__sum{k}_{part}"), p.inside, 0))
        rows = frame.select(*by, *(within if inside else []), F.unix_date(day).alias("__n"), *[c.alias(n) for n, c in columns.items()])
        events.append(_present(rows, [*by, "__n"]))
    asks = F.explode(F.array(*[F.struct(F.lit(bits[name]).alias("bit"), F.unix_date(at).alias("n")) for name, at in instants.items()]))
    asked = _present(points, [*by, *on]).select(*by, *within, F.struct(*on).alias("__for"), asks.alias("__a")).where("__a.n is not null").select(
        *by, *within, "__for", F.col("__a.n").alias("__n"), F.col("__a.bit").alias("__ask"))
    line = asked
    for rows in events:
        line = line.unionByName(rows, allowMissingColumns=True)
    reduced = line.groupBy(*by, *within, "__for", "__n").agg(F.bit_or("__ask").alias("__ask"), *[(F.max(c) if c.startswith("__hit") else F.sum(c)).alias(c) for c, *_ in running])
    # windows by key first: their shuffle serves those by key and within, and the grouping below
    for own in (False, True):
        frame = Window.partitionBy(*by, *(within if own else [])).orderBy("__n")
        found = {c: total.over(frame.rangeBetween(Window.unboundedPreceding, last)) for c, total, inside, last in running if inside == own}
        reduced = reduced.withColumns(found) if found else reduced
    asks_for = lambda name: F.col("__ask").bitwiseAND(F.lit(bits[name])) != 0
    pivot = [F.bit_or("__ask").alias("__asked")]
    for k, p in enumerate(probes):
        if isinstance(p, LastValue):
            pivot.append(F.max(F.when(asks_for(p.at), F.col(f"__hit{k}"))).alias(f"__hit{k}"))
        else:
            for parts in wanted[k].parts.values():
                for c in (f"__sum{k}_{part}" for part in parts):
                    at = [F.sum(F.when(asks_for(i), F.col(c))) for i in (p.until, p.after)]
                    pivot.append((F.coalesce(at[0], F.lit(0)) - F.coalesce(at[1], F.lit(0))).alias(c))
    grouped = reduced.where("__ask is not null").groupBy(*by, *within, "__for").agg(*pivot)
    results = []
    for k, p in enumerate(probes):
        if isinstance(p, LastValue):
            results += [F.col(f"__hit{k}")[f"v{i}"].alias(n) for i, n in enumerate(p.values)]
            results += [F.date_from_unix_date(F.col(f"__hit{k}")["n"]).alias(p.dated)] if p.dated else []
        else:
            both = F.col("__asked").bitwiseAND(F.lit(bits[p.after] | bits[p.until])) == (bits[p.after] | bits[p.until])
            known = both if not p.inside else both & F.expr(" and ".join(f"`{w}` is not null" for w in within))
            for n, parts in wanted[k].parts.items():
                total = wanted[k].total(n, {part: F.col(f"__sum{k}_{part}") for part in parts})
                results.append(F.when(known, total).otherwise(F.lit(0)).alias(n))
    return grouped.select(*by, *within, *[F.col("__for")[c].alias(c) for c in on], *results)


def attach(anchors: DataFrame, found: DataFrame, *, keys: Mapping[str, str], within: Mapping[str, str] | None = None, totals: Sequence[str] = ()) -> DataFrame:
    """Anchors with the answers of their keys (anchor column to answer column); ``totals`` are 0 where nothing was asked, and names must be free."""
    within = within or {}
    taken = {*keys.values(), *within.values()}
    clash = sorted((set(found.columns) - taken) & set(anchors.columns))
    if clash:
        raise ValueError(f"result columns already exist: {', '.join(clash)}")
    renamed = found.select(*[F.col(c).alias(f"__key_{c}") for c in taken], *[c for c in found.columns if c not in taken])
    condition = F.lit(True)
    for mine, theirs in keys.items():
        condition = condition & (anchors[mine] == renamed[f"__key_{theirs}"])
    for mine, theirs in within.items():
        condition = condition & anchors[mine].eqNullSafe(renamed[f"__key_{theirs}"])
    out = anchors.join(renamed, condition, "left").drop(*[f"__key_{c}" for c in taken])
    return out.withColumns({n: F.coalesce(n, F.lit(0)) for n in totals}) if totals else out


def total_names(probes: Sequence[LastValue | Totals]) -> list[str]:
    return [n for p in probes if isinstance(p, Totals) for n in p.metrics]


def point_in_time(anchors: DataFrame, *, by: Sequence[str], on: Sequence[str], instants: Mapping[str, Column], sources: Mapping[str, tuple[DataFrame, Column]],
                  probes: Sequence[LastValue | Totals], within: Sequence[str] = (), points: DataFrame | None = None) -> DataFrame:
    """Anchors with the result columns of all probes; see ``answers``. In a chain, ``points`` is the frame it started from, so that this is not planned twice."""
    found = answers(anchors if points is None else points, by=by, on=on, instants=instants, sources=sources, probes=probes, within=within)
    return attach(anchors, found, keys={c: c for c in [*by, *on]}, within={c: c for c in within}, totals=total_names(probes))
