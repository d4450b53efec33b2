"""Classifiers through Spark ML, class metrics by aggregation, minority oversampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from pitwise.operators.ordering import order_statistic
from pitwise.session import materialize

SEED = 42
ROWS_PER_TASK = 20_000
LINEAR = frozenset({"logistic_regression", "linear_svm"})
LINEAR_ROWS_PER_TASK = 200_000      # linear models make hundreds of short passes, which take as long as their tasks take to start
MAX_TREE_DEPTH = 30      # limit of Spark ML trees

# The parameter grid per model family.
GRID = {
    "decision_tree": ({"min_split": 5}, {"min_split": 10}, {"min_split": 15}, {"min_split": 20}),
    "logistic_regression": ({"max_iter": 10}, {"max_iter": 100}, {"max_iter": 1000}),
    "linear_svm": ({"c": 1.0}, {"c": 10.0}, {"c": 50.0}, {"c": 100.0}),
    "random_forest": ({"trees": 5}, {"trees": 10}, {"trees": 15}, {"trees": 20}),
    "gradient_boosting": ({"rounds": 5}, {"rounds": 10}, {"rounds": 20}, {"rounds": 50}),
}


def make_classifier(family: str, label: str, *, depth: int = 10, rows: int = 1, **p):
    """An unfitted Spark ML classifier for one grid entry; trees have the depth that is asked for, or none are built."""
    common = {"featuresCol": "features", "labelCol": label}
    if depth > MAX_TREE_DEPTH:
        raise ValueError(f"trees of depth {depth} are not supported, at most {MAX_TREE_DEPTH}")
    if family == "decision_tree":
        return DecisionTreeClassifier(impurity="entropy", maxDepth=depth, minInstancesPerNode=max(1, p.get("min_split", 2) // 2), seed=SEED, **common)
    if family == "logistic_regression":
        return LogisticRegression(maxIter=p.get("max_iter", 100), regParam=1.0 / (p.get("c", 1.0) * max(rows, 1)), **common)
    if family == "linear_svm":
        return LinearSVC(maxIter=p.get("max_iter", 50), regParam=1.0 / (p.get("c", 1.0) * max(rows, 1)), **common)
    if family == "random_forest":
        return RandomForestClassifier(numTrees=p.get("trees", 20), impurity="entropy", maxDepth=depth, seed=SEED, **common)
    if family == "gradient_boosting":
        return GBTClassifier(maxIter=p.get("rounds", 20), stepSize=p.get("rate", 0.1), maxDepth=depth, seed=SEED, **common)
    raise ValueError(f"unknown model family: {family}")


def majority_baseline(train: DataFrame, df: DataFrame, label: str, name: str = "prediction") -> DataFrame:
    """Predict the most frequent training label everywhere (the smaller one among ties)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    best = counts.agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(label).alias("v")))["v"]).scalar()
    return df.withColumn(name, F.lit(best))


def class_metrics(df: DataFrame, *, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 of class 1; an empty denominator gives 0."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    counts = [F.count_if((y == a) & (p == b)).alias(n) for n, a, b in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))]
    out = df.groupBy(*by).agg(*counts) if by else df.agg(*counts)

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return out.select(
        *by, "tp", "fp", "fn", "tn", F.round(ratio(tp + tn, tp + fp + fn + tn), 4).alias("accuracy"),
        F.round(ratio(tp, tp + fp), 4).alias("precision"), F.round(ratio(tp, tp + fn), 4).alias("recall"),
        F.round(ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1_score"))


def train_grid(train: DataFrame, val: DataFrame, label: str, *, families: Mapping[str, Sequence[Mapping]] = GRID, depth: int = 10) -> tuple[DataFrame, dict]:
    """Fit every configuration and score it on train and validation.

    Returns ``(model, params, split, metrics…)`` and the fitted models by ``(model, params)``. Linear families are fitted on
    fewer and larger tasks than trees.
    """
    rows = train.count()
    parts = rows // ROWS_PER_TASK + 1      # small training sets would spend their time on empty tasks
    train, val = train.coalesce(parts).cache(), val.coalesce(parts).cache()
    results, models = [], {}
    try:
        for family, grid in families.items():
            if family in LINEAR:
                train.count()       # fills the cache on all of its tasks
            fitted_on = train.coalesce(rows // LINEAR_ROWS_PER_TASK + 1) if family in LINEAR else train
            for params in grid:
                label_text = ", ".join(f"{k}={v}" for k, v in params.items())
                model = make_classifier(family, label, depth=depth, rows=rows, **params).fit(fitted_on)
                models[(family, label_text)] = model
                both = reduce(DataFrame.unionByName, [
                    model.transform(part).select(F.lit(name).alias("split"), label, "prediction") for name, part in (("train", train), ("val", val))])
                for r in class_metrics(both, label=label, prediction="prediction", by=["split"]).collect():
                    results.append((family, label_text, r["split"], r["tp"], r["fp"], r["fn"], r["tn"], r["accuracy"], r["precision"], r["recall"], r["f1_score"]))
    finally:
        train.unpersist()
        val.unpersist()
    schema = ("model string, params string, split string, tp long, fp long, fn long, tn long, "
              "accuracy double, precision double, recall double, f1_score double")
    return train.sparkSession.createDataFrame(results, schema), models


def best_configurations(results: DataFrame, metric: str = "f1_score") -> DataFrame:
    """Best validation configuration per model; ties go to the first in parameter order."""
    window = Window.partitionBy("model").orderBy(F.col(metric).desc(), "params")
    return results.where("split = 'val'").withColumn("rank", F.row_number().over(window)).where("rank = 1").drop("rank")


def score_best(results: DataFrame, models: Mapping, test: DataFrame, label: str) -> DataFrame:
    """Test metrics of the chosen configuration of every model."""
    scored = []
    for r in best_configurations(results).select("model", "params").collect():
        predicted = models[(r["model"], r["params"])].transform(test).select(label, "prediction")
        scored.append(class_metrics(predicted, label=label, prediction="prediction").select(
            F.lit(r["model"]).alias("model"), F.lit(r["params"]).alias("params"), F.lit("test").alias("split"), "*"))
    return reduce(DataFrame.unionByName, scored)


# -- minority oversampling ---------------------------------------------------------------------

CELL_ROWS = 4_000        # rows of a cell about, all of which one task holds
SAMPLE_ROWS = 20_000     # rows that the cuts between cells are taken from
SLICE_ROWS = 512         # rows that a cell is held against at once
STRIDE = 4               # levels of the cell tree that one join goes down


def _cuts(sample: np.ndarray, depth: int) -> tuple[list[int], list[float]]:
    """Dimension and median of each inner node of a balanced k-d tree, by levels; the widest dimension is cut."""
    dims, cuts, parts = [], [], [sample]
    for _ in range(depth):
        below = []
        for part in parts:
            dim = int(np.argmax(np.ptp(part, axis=0))) if len(part) else 0
            cut = float(np.median(part[:, dim])) if len(part) else 0.0
            dims.append(dim)
            cuts.append(cut)
            low = part[:, dim] <= cut if len(part) else np.zeros(0, bool)
            below += [part[low], part[~low]]
        parts = below
    return dims, cuts


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _hold(own: np.ndarray, others: np.ndarray, best: tuple[np.ndarray, np.ndarray], start: int, same: bool, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k least squared distances and positions of each own row after ``others``, which have positions from ``start``."""
    for at in range(0, len(others), SLICE_ROWS):
        part = others[at:at + SLICE_ROWS]
        d = np.zeros((len(own), len(part)))
        for j in range(own.shape[1]):
            d += (own[:, j, None] - part[None, :, j]) ** 2
        if same:
            here = np.arange(at, at + len(part))
            d[here, here - at] = np.inf
        d = np.concatenate([best[0], d], axis=1)
        place = np.concatenate([best[1], np.broadcast_to(np.arange(start + at, start + at + len(part)), (len(own), len(part)))], axis=1)
        take = np.argpartition(d, k - 1, axis=1)[:, :k]
        best = np.take_along_axis(d, take, 1), np.take_along_axis(place, take, 1)
    return best


def _nothing(rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full((rows, k), np.inf), np.full((rows, k), -1, np.int64)


def _apart(low: str, high: str, other_low: str, other_high: str) -> Column:
    """Squared distance between two boxes; zero where they touch."""
    gaps = [F.zip_with(u, v, lambda low, high: F.greatest(low - high, F.lit(0.0))) for u, v in ((low, other_high), (other_low, high))]
    return F.aggregate(F.zip_with(*gaps, lambda u, v: (u + v) * (u + v)), F.lit(0.0), lambda s, v: s + v)


def _meeting_cells(boxes: DataFrame, depth: int, size: int) -> DataFrame:
    """``(cell_a, cell_b, apart)``: every cell with itself and all cells whose box is nearer than its ``far``.

    Each cell goes down the tree with the nodes that it still meets: a step takes a node to its descendants ``STRIDE`` levels below, by a join on
    their numbers, and leaves out those whose box is too far. So a cell is held against the tree's upper nodes and what lies below near ones, never
    against all cells. Nodes are numbered from one, node i above 2i and 2i + 1; nodes without rows have no box.
    """
    ends = [F.array(*[f(F.col(c)[j]) for j in range(size)]).alias(c) for c, f in (("low", F.min), ("high", F.max))]
    levels = sorted({depth, *range(0, depth, STRIDE)})
    ups = boxes.select("low", "high", F.explode(F.array(*[F.struct(F.lit(at).alias("level"), F.shiftright(F.col("cell.leaf") + 1, depth - at).alias("node"))
                                                          for at in levels])).alias("up"))
    nodes = materialize(ups.groupBy("up.level", "up.node").agg(*ends))
    met = boxes.select(F.col("cell").alias("cell_a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.col("far").alias("far_a"), F.lit(1).cast("long").alias("node"))
    for above, at in zip(levels, levels[1:]):
        span = 1 << (at - above)
        below = met.withColumn("node", F.explode(F.sequence(F.col("node") * span, F.col("node") * span + (span - 1))))
        own = F.shiftright(F.col("cell_a.leaf") + 1, depth - at) == F.col("node")
        near = _apart("low_a", "high_a", "low", "high") < F.col("far_a")
        met = materialize(below.join(nodes.where(F.col("level") == at).drop("level"), "node").where(own | near).select(*met.columns))
    theirs = boxes.select(F.col("cell").alias("cell_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), (F.col("cell.leaf") + 1).alias("node"))
    apart = F.when(F.col("cell_a") == F.col("cell_b"), -1.0).otherwise(_apart("low_a", "high_a", "low_b", "high_b"))
    return met.join(theirs, "node").withColumn("apart", apart).where("apart < far_a").select("cell_a", "cell_b", "apart")


def near_neighbours(minority: DataFrame, key: str, features: str, *, k: int, seed: int = SEED, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(key, x, neighbours array<array<double>>)``: the ``k`` nearest rows with another key, nearest first, exactly.

    Rows of equal features are one point with a weight: their first neighbours are each other, the next ones are those of the point. So the search
    follows the distinct points, however many rows share them. Points are dealt to cells of a k-d tree whose cuts come from a bounded sample; large cells are dealt on by a hash. A cell
    meets every other cell whose box is nearer than the largest ``k``-th distance within the cell itself, so no nearer row is missed; those are
    found by descent through the tree (``_meeting_cells``). A task
    holds one cell and streams the cells it meets. Few dimensions leave few cells to meet, many leave all: then the work is the square of the points.
    """
    dense = materialize(minority.select(F.col(key).alias("key"), vector_to_array(features).alias("x")).groupBy("key").agg(F.min("x").alias("x")))
    points = materialize(dense.groupBy("x").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("rows")).select("key", F.concat("x", F.array(F.col("rows").cast("double"))).alias("x")))
    first = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("size")).first()
    n, size = first["n"], (first["size"] or 1) - 1       # the weight comes last
    cells = max(1, -(-n // cell_rows))
    share = int(min(1.0, SAMPLE_ROWS / max(n, 1)) * (1 << 30))
    drawn = points.where(F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 30)) < share).select("x").collect() if cells > 1 else []
    depth = (cells - 1).bit_length() if drawn else 0
    dims, cuts = _cuts(np.array([r["x"][:size] for r in drawn]), depth)
    kinds = f"key {dense.schema['key'].dataType.simpleString()}, x array<double>"

    def place(batches):
        for batch in batches:
            x, node = _matrix(batch.column(1)), np.zeros(batch.num_rows, np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), np.array(dims)[node]] > np.array(cuts)[node])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node, pa.int64())], names=["key", "x", "leaf"])
    placed = materialize(points.mapInArrow(place, f"{kinds}, leaf long"))
    salts = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / (2 * cell_rows)).alias("salts"))
    dealt = materialize(placed.join(salts, "leaf").select("key", "x", F.struct("leaf", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), "salts").alias("salt")).alias("cell")))

    def box(table: pa.Table) -> pa.Table:
        x = _matrix(table.column("x").combine_chunks())[:, :size]
        far = _hold(x, x, _nothing(len(x), k), 0, True, k)[0].max()
        return pa.table({"cell": table.column("cell").slice(0, 1), "low": [x.min(axis=0).tolist()], "high": [x.max(axis=0).tolist()], "far": [float(far)]})
    boxes = materialize(dealt.groupBy("cell").applyInArrow(box, "cell struct<leaf: long, salt: long>, low array<double>, high array<double>, far double"))
    pairs = _meeting_cells(boxes, depth, size)
    streams = dealt.join(pairs, F.col("cell") == F.col("cell_b")).select(
        F.concat_ws(",", "cell_a.leaf", "cell_a.salt").alias("a"), "apart", F.concat_ws(",", "cell_b.leaf", "cell_b.salt").alias("b"), "key", "x")
    streams = streams.repartition("a").sortWithinPartitions("a", "apart", "b", "key")

    def nearest(batches):
        def runs():
            """(a, apart, keys, matrix) of every pair of cells, however the batches are cut."""
            held, at = [], None
            for batch in batches:
                a, b = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                edges = [0, *[i for i in range(1, len(a)) if a[i] != a[i - 1] or b[i] != b[i - 1]], len(a)]
                for i, j in zip(edges, edges[1:]):
                    if i == j:
                        continue
                    if held and at[:2] != (a[i], b[i]):
                        yield at[0], at[2], pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held])
                        held = []
                    at = (a[i], b[i], batch.column(1)[i].as_py())
                    part = batch.slice(i, j - i)
                    held.append((part.column(3), _matrix(part.column(4))))
            if held:
                yield at[0], at[2], pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held])

        def done(keys, own, best, rows):
            order = np.lexsort((best[1], best[0]), axis=1)
            places, d = np.take_along_axis(best[1], order, 1), np.take_along_axis(best[0], order, 1)
            out = [[rows[p].tolist() for p, v in zip(ps, vs) if np.isfinite(v)] for ps, vs in zip(places.tolist(), d)]
            return pa.RecordBatch.from_arrays([keys, pa.array(own.tolist(), pa.list_(pa.float64())), pa.array(out, pa.list_(pa.list_(pa.float64())))], names=["key", "x", "neighbours"])
        now = None
        for a, apart, keys, x in runs():
            if a != now:
                if now is not None:
                    yield done(mine_keys, own, best, rows)
                now, mine_keys, own, rows, met = a, keys, x, dict(), 0
                best = _nothing(len(own), k)
            elif apart >= best[0].max():
                continue
            best = _hold(own[:, :size], x[:, :size], best, met, a == now and apart < 0, k)
            rows = {p: (x[p - met] if p >= met else rows[p]) for p in np.unique(best[1]).tolist() if p >= 0}     # only rows that are near to some row stay
            met += len(x)
        if now is not None:
            yield done(mine_keys, own, best, rows)
    found = streams.mapInArrow(nearest, f"{kinds}, neighbours array<array<double>>")
    times = lambda v, rows: F.array_repeat(F.slice(v, 1, size), F.least(rows, F.lit(k)).cast("int"))
    same, others = times(F.col("x"), F.get("x", F.lit(size)) - 1), F.flatten(F.transform("neighbours", lambda v: times(v, F.get(v, F.lit(size)))))
    around = found.select(F.slice("x", 1, size).alias("__x"), F.slice(F.concat(same, others), 1, k).alias("neighbours"))
    return dense.join(around, F.col("x") == F.col("__x")).select("key", "x", "neighbours")


def oversample_minority(df: DataFrame, *, label: str, key: str, features: str = "features", ratio: float = 0.5, k: int = 5, seed: int = SEED) -> DataFrame:
    """Add synthetic minority rows until minority / majority reaches ``ratio``.

    Each synthetic row lies on the segment between a minority row and one of its ``k`` nearest minority
    neighbours (``near_neighbours``); choice and position come from hashes of the row key, so a lost task redraws the same rows.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) != 2:
        raise ValueError("oversampling needs exactly two classes")
    minor = min(counts, key=lambda v: (counts[v], v))
    few, many = counts[minor], max(counts.values())
    wanted = int(many * ratio) - few
    base = df.select(F.col(key), F.col(label), F.col(features), F.lit(False).alias("synthetic"))
    if wanted <= 0:
        return base
    rows = df.where(F.col(label) == minor)
    near = near_neighbours(rows, key, features, k=k, seed=seed)
    near = materialize(near.where(F.size("neighbours") > 0))
    makers = near.count()           # rows of one key are one maker
    if not makers:
        return base
    each, extra = divmod(wanted, makers)
    # the first `extra` rows in hash order make one more; the cut is one number, found without a global sort
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.lit(1 << 40))
    near = near.withColumn("draw", draw)
    cut = _kth(near, extra)
    more = F.when((F.col("draw") < cut[0]) | ((F.col("draw") == cut[0]) & (F.col("key") < cut[1])), 1).otherwise(0) if extra else F.lit(0)
    copies = near.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(each) + more))).where(F.col("copy") <= F.lit(each) + more) if each else (
        near.where(more == 1).withColumn("copy", F.lit(1)))
    pick = F.pmod(F.xxhash64(F.lit(seed + 1), "key", "copy"), F.size("neighbours")).cast("int")
    share = F.pmod(F.xxhash64(F.lit(seed + 2), "key", "copy"), F.lit(1 << 30)) / float(1 << 30)
    target = F.element_at("neighbours", pick + 1)
    moved = copies.withColumn("share", share).withColumn("t", target).select(
        "key", F.zip_with("x", "t", lambda a, b: a + F.col("share") * (b - a)).alias("x"))

    made = moved.select(F.col("key").alias(key), F.lit(minor).cast(df.schema[label].dataType).alias(label),
                        array_to_vector("x").alias(features), F.lit(True).alias("synthetic"))
    return base.unionByName(made)


def _kth(near: DataFrame, position: int) -> tuple[int, int]:
    """Draw and key of the row at ``position`` in (draw, key) order."""
    if not position:
        return (0, 0)
    _, draw, before, _ = order_statistic(near, "draw", [position])[position]
    place = position - int(before)
    return int(draw), int(order_statistic(near.where(F.col("draw") == int(draw)), "key", [place])[place][1])
