"""Totals of doubles without rounding, as sums of whole numbers.

A finite double is a whole multiple of the lowest bit that any value of the column has. Cut into limbs of 32 bits, by fixed exponents, it becomes a
few whole numbers whose sums are exact in any order, so that running totals can be subtracted from each other without losing what a larger number hid.
How many limbs are needed follows the span of the exponents, which one aggregation finds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

_BITS = 32
_MASK = (1 << _BITS) - 1


class Limbs(NamedTuple):
    """How a column of doubles is cut: the exponent of the lowest bit, the number of limbs, and whether it has values that are not finite."""
    low: int
    count: int
    odd: bool

    def cut(self, value: Column) -> list[Column]:
        """The limbs of a value, lowest first; with odd ones three more columns: one for NaN, and one each for the two infinities."""
        finite = (F.when(~F.isnan(value) & (F.abs(value) < math.inf), value) if self.odd else value).cast("double")
        out = []
        for k in range(self.count):         # remainders and divisions by powers of two are exact
            below = finite % F.lit(2.0 ** (self.low + _BITS * (k + 1))) if k + 1 < self.count else finite
            out.append((below / F.lit(2.0 ** (self.low + _BITS * k))).cast("long"))
        if self.odd:
            out += [F.isnan(value).cast("long"), (value == math.inf).cast("long"), (value == -math.inf).cast("long")]
        return out

    @property
    def width(self) -> int:
        return self.count + 3 * self.odd

    def total(self, sums: Sequence[Column]) -> Column:
        """The double nearest to what sums of limbs stand for."""
        start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("out"))

        def add(state: Column, limb: Column) -> Column:
            return F.transform(F.array(limb + state["carry"]), lambda x: F.struct(
                F.shiftright(x, _BITS).alias("carry"), F.concat(state["out"], F.array(x.bitwiseAND(F.lit(_MASK)))).alias("out")))[0]

        def settled(limbs: Column) -> Column:
            return F.aggregate(limbs, start, add, lambda s: F.concat(s["out"], F.array(s["carry"])))

        exponents = [self.low + _BITS * (k - 1) for k in range(self.count + 1)]
        scales = F.array(*[F.array(F.lit(2.0 ** (e // 2)), F.lit(2.0 ** (e - e // 2))) for e in exponents])      # in halves, which no double overflows

        def value(limbs: Column) -> Column:
            """Of limbs that are not negative: the first 53 bits as one double, and what follows, with a last bit for anything below, as another."""
            down = F.reverse(limbs)
            first = F.array_position(F.transform(down, lambda x: x != 0), F.lit(True)).cast("int")
            at = lambda k: F.coalesce(F.get(down, first - 1 + k), F.lit(0).cast("long"))
            rest = at(1) % 2048
            more = F.exists(F.slice(down, first + 3, F.size(down)), lambda x: x != 0).cast("long")
            head, tail = at(0).cast("double") * float(_MASK + 1) + (at(1) - rest).cast("double"), ((rest * (_MASK + 1) + at(2)) * 2 + more).cast("double")
            scale = F.get(scales, F.size(down) - first)
            return F.when(first == 0, F.lit(0.0)).otherwise((head + tail * 2.0 ** -33) * scale[0] * scale[1])
        limbs = F.array(*[F.coalesce(s, F.lit(0).cast("long")) for s in sums[:self.count]])
        both = F.transform(F.array(limbs), lambda x: F.struct(settled(x).alias("up"), settled(F.transform(x, lambda y: -y)).alias("down")))[0]
        number = F.transform(F.array(both), lambda b: F.when(F.element_at(b["up"], -1) < 0, -value(b["down"])).otherwise(value(b["up"])))[0]
        if not self.odd:
            return number
        nan, up, down = (F.coalesce(s, F.lit(0)) > 0 for s in sums[self.count:])
        return F.when(nan | (up & down), F.lit(math.nan)).when(up, F.lit(math.inf)).when(down, F.lit(-math.inf)).otherwise(number)


def plan_limbs(df: DataFrame, values: Mapping[str, Column]) -> dict[str, Limbs]:
    """How to cut each value, from one aggregation over the frame; values that are not doubles or floats are left out, and nothing runs without any."""
    types = {f.name: f.dataType for f in df.select(*[v.alias(n) for n, v in values.items()]).schema}
    doubles = {n: v.cast("double") for n, v in values.items() if isinstance(types[n], (T.DoubleType, T.FloatType))}
    if not doubles:
        return {}
    stats = []
    for k, v in enumerate(doubles.values()):
        finite = F.when(~F.isnan(v) & (F.abs(v) < math.inf) & (v != 0), F.abs(v))
        stats += [F.min(finite).alias(f"a{k}"), F.max(finite).alias(f"z{k}"), F.coalesce(F.max(F.isnan(v) | (F.abs(v) == math.inf)), F.lit(False)).alias(f"o{k}")]
    row = df.agg(*stats).first()
    out = {}
    for k, name in enumerate(doubles):
        least, most = row[f"a{k}"], row[f"z{k}"]
        low, high = (max(math.frexp(least)[1] - 53, -1074), math.frexp(most)[1]) if least else (0, 1)
        out[name] = Limbs(low, -(-(high - low) // _BITS), row[f"o{k}"])
    return out


class ExactMetrics:
    """Metrics as columns that may be added and subtracted freely, and the way back to totals."""

    def __init__(self, facts: DataFrame, metrics: Mapping[str, Column]):
        self.limbs = plan_limbs(facts, metrics)
        self.columns: dict[str, Column] = {}
        self.parts: dict[str, list[str]] = {}
        for name, expr in metrics.items():
            cut = self.limbs[name].cut(expr.cast("double")) if name in self.limbs else [expr]
            self.parts[name] = [name] if name not in self.limbs else [f"{name}__limb{k}" for k in range(len(cut))]
            self.columns.update(zip(self.parts[name], cut))

    def total(self, name: str, sums: Mapping[str, Column]) -> Column:
        """The total of a metric from the sums of its columns."""
        found = [sums[p] for p in self.parts[name]]
        return self.limbs[name].total(found) if name in self.limbs else found[0]
