"""Lookups, outer joins with a side indicator, blocked pair joins, consistency against a parent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitwise.functions.scalars import differs


def lookup(df: DataFrame, dim: DataFrame, *, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left join to a dimension that is pruned to its keys and the wanted columns first.

    ``on`` maps columns of ``df`` to key columns of ``dim``; ``take`` maps columns of ``dim`` to output names. No
    broadcast hint: Catalyst and AQE broadcast the pruned side when its measured size allows it.
    """
    side = dim.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(on.values())],
                      *[F.col(c).alias(n) for c, n in take.items()])
    condition = reduce(lambda a, b: a & b, [df[c] == side[f"__k{i}"] for i, c in enumerate(on)])
    return df.join(side, condition, "left").drop(*[f"__k{i}" for i in range(len(on))])


def role_lookup(df: DataFrame, dim: DataFrame, *, key: str, roles: Mapping[str, str], take: Sequence[str]) -> DataFrame:
    """Join one dimension once per role: role ``source`` on ``from_id`` adds ``source_<column>``."""
    for role, fk in roles.items():
        df = lookup(df, dim, on={fk: key}, take={c: f"{role}_{c}" for c in take})
    return df


def null_safe_left_join(left: DataFrame, right: DataFrame, *, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left join in which a missing key matches a missing key."""
    side = right.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(on.values())],
                        *[F.col(c).alias(n) for c, n in take.items()])
    condition = reduce(lambda a, b: a & b, [left[c].eqNullSafe(side[f"__k{i}"]) for i, c in enumerate(on)])
    return left.join(side, condition, "left").drop(*[f"__k{i}" for i in range(len(on))])


def outer_with_side(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on ``keys`` (null matches null) plus ``side``: both, left_only or right_only.

    Non-key columns must have distinct names. Planned as a left join and an anti join: AQE splits a hot key in
    either of them, which it cannot do in a full outer join, and the two share their shuffles.
    """
    names = [f"__r_{k}" for k in keys]
    r = right.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[c for c in right.columns if c not in keys], F.lit(1).alias("__r"))
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[n]) for k, n in zip(keys, names)])
    first = left.join(r, condition, "left").withColumn("side", F.when(F.col("__r").isNull(), "left_only").otherwise("both")).drop("__r", *names)
    rest = unmatched(right, left, keys).withColumn("side", F.lit("right_only"))
    return first.unionByName(rest, allowMissingColumns=True)


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows without a partner (null matches null)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys])
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    return left.join(r, condition, "left_anti")


def parent_consistency(child: DataFrame, parent: DataFrame, *, on: Mapping[str, str], child_col: str, parent_col: str) -> DataFrame:
    """One row: children whose value and parent value both exist, and how many of them disagree."""
    joined = lookup(child, parent, on=on, take={parent_col: "__parent"})
    both = F.col(child_col).isNotNull() & F.col("__parent").isNotNull()
    return joined.agg(F.count_if(both).alias("applicable_rows"),
                      F.count_if(both & differs(child_col, "__parent")).alias("failed_rows"))


def block_pairs(df: DataFrame, *, block: str, order_by: str, columns: Sequence[str], where=None, cell: int = 1000) -> DataFrame:
    """Unordered pairs of different members inside each block, the earlier one by ``(order_by, columns)`` on the left.

    Blocks of any size are compared in full. Members of a block are dealt to about ``members / cell`` salts, and each pair of salts is
    a join key of its own, so a large block is spread over many tasks and every pair is met exactly once. ``where`` takes a function of
    the two sides' columns, given as ``name -> Column``, and is part of the join condition: pairs it rejects are never written.
    Block sizes are counted before the join, with partial aggregation.
    """
    columns = list(dict.fromkeys([order_by, *columns]))
    members = df.select(block, *columns).where(F.col(block).isNotNull()).distinct()
    sizes = members.groupBy(block).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    sizes = sizes.select(F.col(block).alias("__b"), F.ceil(F.col("__n") / cell).cast("int").alias("__salts"))
    dealt = members.join(sizes, members[block] == sizes["__b"]).drop("__b")
    dealt = dealt.select(block, F.struct(*columns).alias("__m"), "__salts", F.pmod(F.xxhash64(*columns), F.col("__salts")).cast("int").alias("__s"))
    left = dealt.select(F.col(block).alias("__b"), F.col("__m").alias("__x"), F.col("__s").alias("__i"), F.explode(F.sequence("__s", F.col("__salts") - 1)).alias("__j"))
    right = dealt.select(block, F.col("__m").alias("__y"), F.explode(F.sequence(F.lit(0), "__s")).alias("__k"), F.col("__s").alias("__l"))
    ordered = F.col("__x") < F.col("__y")
    met = (F.col("__b") == F.col(block)) & (F.col("__i") == F.col("__k")) & (F.col("__j") == F.col("__l")) & ((F.col("__i") < F.col("__j")) | ordered)
    if where is not None:
        met = met & where(lambda c: F.col(f"__x.{c}"), lambda c: F.col(f"__y.{c}"))
    first, second = F.when(ordered, F.col("__x")).otherwise(F.col("__y")), F.when(ordered, F.col("__y")).otherwise(F.col("__x"))
    pairs = left.join(right, met).select(block, first.alias("__x"), second.alias("__y"))
    return pairs.select(block, *[F.col(f"__x.{c}").alias(f"left_{c}") for c in columns], *[F.col(f"__y.{c}").alias(f"right_{c}") for c in columns])


def large_blocks(df: DataFrame, *, block: str, columns: Sequence[str], above: int = 20) -> DataFrame:
    """``(block, members)`` of blocks with more than ``above`` distinct members: a report of unspecific keys, nothing is left out for it."""
    members = df.select(block, *columns).where(F.col(block).isNotNull()).distinct()
    return members.groupBy(block).agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > above)


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One whole row per key: the last by ``order_by``. Partially aggregated, so no key is gathered."""
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in order_by if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("__best"))
    return best.select(*keys, *[F.col("__best")[c].alias(c) for c in rest]).select(*df.columns)


def mark_duplicates(df: DataFrame, keys: Sequence[str], order_by: str, name: str = "is_duplicate") -> DataFrame:
    """Flag every copy after the first by a unique ``order_by``; null keys equal null keys.

    The first position per key is found with a partially aggregated ``groupBy`` and joined back, so a key
    shared by a third of all rows is split by AQE instead of sorted in one window task.
    """
    return _with_first(df, keys, order_by).withColumn(name, F.col(order_by) != F.col("__first")).drop("__first", "__copies")


def mark_all_copies(df: DataFrame, keys: Sequence[str], order_by: str, name: str = "is_duplicate") -> DataFrame:
    """Flag every member of a group of copies, the first included."""
    return _with_first(df, keys, order_by).withColumn(name, F.col("__copies") > 1).drop("__first", "__copies")


def _with_first(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    firsts = df.groupBy(*keys).agg(F.min(order_by).alias("__first"), F.count(F.lit(1)).alias("__copies"))
    firsts = firsts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__first", "__copies")
    condition = reduce(lambda a, b: a & b, [df[k].eqNullSafe(firsts[f"__k{i}"]) for i, k in enumerate(keys)])
    return df.join(firsts, condition, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def top_k(df: DataFrame, *, by: Sequence[str], order_by: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group. Spark limits each map partition to ``k`` rows per group before shuffling."""
    window = Window.partitionBy(*by).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
