"""Regularised second-order boosting over DataFrames, with learned directions for missing values.

Rows are binned once, dealt out evenly and written: an array of bin numbers (-1 is missing), the label, the margin so
far. A pass over them sends each row down the tree as far as it has grown and sums gradients and hessians by (node,
feature, bin) in arrays, whose sums over the tasks are taken node by node. What a task sends and what arrives at the
driver is bounded by nodes, features and bins. From these histograms the driver takes the best split of each node, with L1 and L2
penalties, a least hessian for children, and both directions for the missing values.

Trees grow best first: each pass splits the leaves with the highest gains, ``splits_per_pass`` of them, until
there are ``max_leaves``. So ``max_depth`` is a limit and not an exponent, and a tree costs few passes; with one
split per pass the growth is strictly best first.

Gradients are summed as whole multiples of a power of two, so sums do not depend on the order of tasks, and a
training that stops and goes on gives the same trees. After every ``block_rounds`` rounds the margins are written
as a new table and the trees appended to the table of nodes: a lost executor costs its partitions of one pass, and
a lost driver the rounds since the last block. Each round is computed once.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..workspace import scratch_path
from .training import SPLIT
from .trees import NODES, Node, TreeModel, feature_value, node_rows

_HISTORY = T.StructType(
    [
        T.StructField("rounds", T.IntegerType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("unit", T.DoubleType()),
        T.StructField("errors", T.ArrayType(T.DoubleType())),
        T.StructField("cuts", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("params", T.StringType()),
    ]
)

_PART_ROWS = 1 << 20  # training rows to a task


@dataclass(frozen=True)
class BoostParams:
    """Learning rate, depth limit, penalties, least child weight, rounds and patience are the data model's fixed
    values. ``max_leaves`` bounds a tree, ``splits_per_pass`` its leaves split at a time, and ``max_bins`` the values tried per feature: up to that many distinct
    values are told apart exactly, others by quantiles. Without ``base_score`` training starts at the mean label.
    """

    step_size: float = 0.4
    max_depth: int = 65
    min_child_weight: float = 0.6
    alpha: float = 0.15
    reg_lambda: float = 0.2
    max_iter: int = 1000
    patience: int = 10
    max_leaves: int = 64
    splits_per_pass: int = 32
    max_bins: int = 64
    min_gain: float = 1e-6
    base_score: float | None = None
    block_rounds: int = 8

    def as_text(self) -> dict[str, str]:
        return {k: str(v) for k, v in asdict(self).items()}


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    cut: int  # bins up to this one go left
    missing_left: bool
    left: tuple[float, float]  # gradient and hessian
    right: tuple[float, float]


def _value(name: str) -> Column:
    """A feature as a double; -0.0 becomes 0.0, which the binning would tell apart."""
    return F.expr(feature_value(name)) + F.lit(0.0)


def feature_cuts(rows: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Per feature the thresholds that can be tried: a value goes left of those above it.

    One pass counts distinct values and takes quantiles; a second one lists the values of those features that have
    no more than about ``max_bins``.
    """
    shares = [i / max_bins for i in range(1, max_bins)]
    values = {name: _value(name) for name in features}
    stats = rows.agg(
        *(F.approx_count_distinct(v, 0.01).alias(f"n_{name}") for name, v in values.items()),
        *(F.percentile_approx(v, shares, 10_000).alias(f"q_{name}") for name, v in values.items()),
    ).first()
    few = [name for name in features if stats[f"n_{name}"] <= max_bins]
    listed = rows.agg(*(F.collect_set(values[name]).alias(name) for name in few)).first() if few else {}
    return [
        sorted(listed[name])[1:] if name in few else sorted(set(stats[f"q_{name}"] or [])) for name in features
    ]


def _binned(rows: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]], keep: Sequence[Column]) -> DataFrame:
    """``keep`` and ``bins``, the array of bin numbers, -1 where missing."""
    values = [_value(name).alias(f"_value{i}") for i, name in enumerate(features)]
    rows = rows.select(*keep, *values)
    split = [i for i in range(len(features)) if cuts[i]]
    if split:
        rows = Bucketizer(
            inputCols=[f"_value{i}" for i in split],
            outputCols=[f"_bin{i}" for i in split],
            splitsArray=[[-math.inf, *cuts[i], math.inf] for i in split],
            handleInvalid="keep",
        ).transform(rows)
    numbers = [
        F.when(F.col(f"_value{i}").isNull(), -1).otherwise(F.col(f"_bin{i}") if cuts[i] else 0).cast("short")
        for i in range(len(features))
    ]
    return rows.withColumn("bins", F.array(*numbers))


def _shrunk(gradient, alpha):
    return np.sign(gradient) * np.maximum(np.abs(gradient) - alpha, 0.0)


def best_split(gradients: np.ndarray, hessians: np.ndarray, unit: float, params: BoostParams) -> Split | None:
    """The split of a node with the highest gain, from histograms of shape (features, 1 + bins) whose first column
    is the missing values. Ties: the first feature, the lowest cut, missing values left. Sums are of whole numbers
    of ``unit``, so splits that part the rows alike do tie."""
    total_g, total_h = gradients[0].sum(), hessians[0].sum()

    def score(g, h):
        return _shrunk(g * unit, params.alpha) ** 2 / (h + params.reg_lambda)

    below_g, below_h = gradients[:, 1:].cumsum(1), hessians[:, 1:].cumsum(1)
    left_g = np.stack([below_g + gradients[:, :1], below_g], 2)  # missing values left, right
    left_h = np.stack([below_h + hessians[:, :1], below_h], 2)
    right_g, right_h = total_g - left_g, total_h - left_h
    allowed = np.minimum(left_h, right_h) >= max(params.min_child_weight, np.finfo(float).tiny)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score(left_g, left_h) + score(right_g, right_h) - score(total_g, total_h)
    gain = np.where(allowed, gain, -np.inf)
    feature, cut, side = np.unravel_index(int(gain.argmax()), gain.shape)
    where = feature, cut, side
    if gain[where] <= params.min_gain:
        return None
    return Split(
        float(gain[where]),
        int(feature),
        int(cut),
        bool(side == 0),
        (float(left_g[where] * unit), float(left_h[where])),
        (float(right_g[where] * unit), float(right_h[where])),
    )


class _Tree:
    """A tree that grows from histograms that come in passes."""

    def __init__(self, params: BoostParams, unit: float):
        self.params, self.unit = params, unit
        self.stats = [(0.0, 0.0)]  # gradient and hessian of each node
        self.depth = [0]
        self.split: dict[int, Split] = {}  # of inner nodes
        self.left: dict[int, int] = {}  # the first of an inner node's two children, which are neighbours
        self.waiting = [0]  # nodes whose histogram the next pass has to give
        self.leaves: list[tuple[float, int, Split]] = []  # that can be split, the best one first

    def learn(self, histograms: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        for node in self.waiting:
            gradients, hessians = histograms[node]
            if node == 0:
                self.stats[0] = (float(gradients[0].sum() * self.unit), float(hessians[0].sum()))
            found = best_split(gradients, hessians, self.unit, self.params)
            if found and self.depth[node] < self.params.max_depth:
                heapq.heappush(self.leaves, (-found.gain, node, found))
        self.waiting = []
        while self.leaves and self._room() and not self.waiting:
            for _ in range(min(self._room(), self.params.splits_per_pass, len(self.leaves))):
                self._divide(*heapq.heappop(self.leaves)[1:])
            if not self._room():
                self.waiting = []  # leaves for good

    def _room(self) -> int:
        """Splits that the number of leaves still allows."""
        return self.params.max_leaves - 1 - len(self.split)

    def _divide(self, node: int, split: Split) -> None:
        self.split[node], self.left[node] = split, len(self.stats)
        for gradient, hessian in (split.left, split.right):
            if self.depth[node] + 1 < self.params.max_depth and hessian >= 2 * self.params.min_child_weight:
                self.waiting.append(len(self.stats))
            self.stats.append((gradient, hessian))
            self.depth.append(self.depth[node] + 1)

    def walk(self) -> dict[str, np.ndarray]:
        """What tasks need to send rows down: feature (-1: none), cut, missing values left, left child, weight."""
        splits = [self.split.get(node) for node in range(len(self.stats))]
        return {
            "f": np.array([s.feature if s else -1 for s in splits]),
            "c": np.array([s.cut if s else 0 for s in splits]),
            "m": np.array([bool(s and s.missing_left) for s in splits]),
            "l": np.array([self.left.get(node, -1) for node in range(len(splits))]),
            "w": np.array([self._weight(g, h) for g, h in self.stats]),
        }

    def _weight(self, g: float, h: float) -> float:
        return float(-_shrunk(g, self.params.alpha) / (h + self.params.reg_lambda) * self.params.step_size)

    def nodes(self, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> list[Node]:
        out = []
        for node, (g, h) in enumerate(self.stats):
            inner = {}
            if node in self.split:
                s = self.split[node]
                inner = {
                    "feature": features[s.feature],
                    "threshold": [*cuts[s.feature], math.inf][s.cut],
                    "missing_left": s.missing_left,
                    "left": self.left[node],
                    "right": self.left[node] + 1,
                    "gain": s.gain,
                }
            out.append(Node(weight=self._weight(g, h), cover=h, **inner))
        return out


def _walked(bins: np.ndarray, tree: dict[str, np.ndarray]) -> np.ndarray:
    """The node that each row of ``bins`` comes to."""
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins) if tree["f"][0] >= 0 else 0)
    while len(rows):
        at = node[rows]
        value = bins[rows, tree["f"][at]]
        at = tree["l"][at] + np.where(value < 0, ~tree["m"][at], value > tree["c"][at])
        node[rows] = at
        rows = rows[tree["f"][at] >= 0]
    return node


def _bins_of(batch: pa.RecordBatch) -> np.ndarray:
    """The bin numbers of a batch, a line for each row."""
    return batch.column("bins").flatten().to_numpy().reshape(batch.num_rows, -1)


def _with_margin(rows: DataFrame, tree: dict[str, np.ndarray]) -> DataFrame:
    """Rows with the margin after one more tree."""

    def run(batches):
        for batch in batches:
            margin = batch.column("margin").to_numpy() + tree["w"][_walked(_bins_of(batch), tree)]
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margin))

    return rows.mapInArrow(run, rows.schema)


def _exact_sums(cell: np.ndarray, values: np.ndarray, cells: int) -> np.ndarray:
    """Sums of whole numbers below 2**62 per cell. The halves of a batch's numbers add up exactly as doubles."""
    high = np.bincount(cell, values >> 31, cells).astype(np.int64)
    return (high << 31) + np.bincount(cell, values & ((1 << 31) - 1), cells).astype(np.int64)


def _pass(rows: DataFrame, tree: _Tree, shape: tuple[int, int]):
    """Histograms of the waiting nodes, and the squared error of the watched rows (for a new tree only).

    Each task adds its rows up in arrays of (feature, bin) for each waiting node; what the tasks have of a node meets in
    one partition.
    """
    nodes, waiting, unit = tree.walk(), np.array(tree.waiting), tree.unit
    new = len(nodes["f"]) == 1
    if not new:
        rows = rows.filter("NOT watched")
    slots = np.full(len(nodes["f"]), -1)
    slots[waiting] = np.arange(len(waiting))
    features, width = shape

    def run(batches):
        sums = np.zeros((features, len(waiting) * width), np.int64)
        counts = np.zeros_like(sums)
        error, watched = 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _bins_of(batch)
            gradient = batch.column("margin").to_numpy() - batch.column("label").to_numpy()
            seen = batch.column("watched").to_numpy(zero_copy_only=False)
            error, watched = error + float(np.square(gradient[seen]).sum()), watched + int(seen.sum())
            slot = slots[_walked(bins, nodes)]
            used = np.flatnonzero(~seen & (slot >= 0))
            slot, g = slot[used] * width + 1, np.rint(gradient[used] / unit).astype(np.int64)
            for f in range(features):
                cell = slot + bins[used, f]
                sums[f] += _exact_sums(cell, g, sums.shape[1])
                counts[f] += np.bincount(cell, minlength=sums.shape[1])
        if counts.any() or watched:
            first = waiting == waiting[0]
            yield partials(waiting, by_node(sums), by_node(counts), first * watched, first * error)

    def by_node(cells):
        return [c.tobytes() for c in cells.reshape(features, len(waiting), width).transpose(1, 0, 2)]

    def partials(node, g, h, watched, error):
        columns = [pa.array(node), pa.array(g, pa.binary()), pa.array(h, pa.binary()), pa.array(watched), pa.array(error)]
        return pa.RecordBatch.from_arrays(columns, ["node", "g", "h", "watched", "error"])

    def add(batches):
        added: dict[int, list] = {}
        for batch in batches:
            for node, g, h, watched, error in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = added.setdefault(node, [np.zeros(shape, np.int64), np.zeros(shape, np.int64), 0, 0.0])
                total[0] += np.frombuffer(g, np.int64).reshape(shape)
                total[1] += np.frombuffer(h, np.int64).reshape(shape)
                total[2] += watched
                total[3] += error
        if added:
            g, h, watched, error = zip(*added.values(), strict=True)
            yield partials(list(added), [x.tobytes() for x in g], [x.tobytes() for x in h], watched, error)

    schema = "node long, g binary, h binary, watched long, error double"
    found = rows.mapInArrow(run, schema).repartition("node").mapInArrow(add, schema).toArrow().to_pylist()
    histograms = {n: (np.zeros(shape, np.int64), np.zeros(shape, np.int64)) for n in tree.waiting}
    for r in found:
        histograms[r["node"]] = tuple(np.frombuffer(r[c], np.int64).reshape(shape) for c in ("g", "h"))
    watched = sum(r["watched"] for r in found)
    return histograms, sum(r["error"] for r in found) / watched if watched else None


def fit_boosted(
    df: DataFrame,
    params: BoostParams = BoostParams(),
    *,
    watch: str = "validation",
    features: Sequence[str] = schemas.FEATURES,
    state: str | None = None,
) -> TreeModel:
    """Fit on the ``train`` rows of a frame with a ``split`` column; early stopping follows the squared error on the
    ``watch`` rows. The rounds up to the best one are kept.

    Rows without a label are left out; NULL and NaN features are missing values. ``state`` is a folder for the written
    blocks; if it holds some already, training goes on after the last one (with more rounds or patience, say; data,
    features and the other parameters must be the same).
    """
    spark = df.sparkSession
    state = state or scratch_path(spark, "boosting")
    done = _last_block(spark, state)
    if done is None:
        used = df.filter(F.col(SPLIT).isin("train", watch) & F.col(schemas.LABEL).isNotNull())
        train = used.filter(F.col(SPLIT) == "train")
        cuts = feature_cuts(train, features, params.max_bins)
        label = F.col(schemas.LABEL).cast("double")
        n, low, high = train.agg(F.count("*"), F.min(label), F.max(label)).first()
        if not n:
            raise ValueError("there are no rows to train on")
        # sums of n gradients stay below 2**62 even if they grow to 64 times the largest of the first round
        ends = (low, high, params.base_score or 0.0)
        largest = max(max(ends) - min(ends), abs(low), abs(high), 1e-300)
        unit = 2.0 ** (math.ceil(math.log2(largest)) + math.ceil(math.log2(n + 1)) + 6 - 62)
        base = params.base_score
        if base is None:  # the mean, from an exact sum
            base = int(train.agg(F.sum(F.rint(label / F.lit(unit)).cast("long"))).first()[0]) * unit / n
        keep = [label.alias("label"), (F.col(SPLIT) == watch).alias("watched"), F.lit(float(base)).alias("margin")]
        binned = _binned(used, features, cuts, keep).select("bins", "label", "watched", "margin")
        parts = max(spark.sparkContext.defaultParallelism, n // _PART_ROWS)  # every pass has that many tasks
        binned.repartition(parts).write.mode("overwrite").parquet(f"{state}/margins-0")
        _record(spark, state, 0, base, unit, [], cuts, params, [])
        errors, trees = [], []
    else:
        base, unit, errors, cuts = done["base_score"], done["unit"], list(done["errors"]), done["cuts"]
        if _comparable(done["params"]) != _comparable(json.dumps(asdict(params))):
            raise ValueError(f"{state} was trained with other parameters")
        trees = list(TreeModel.from_table(_nodes(spark, state, done["rounds"])).trees)
    shape = (len(features), 2 + max(map(len, cuts), default=0))

    def stopped() -> bool:
        return len(errors) > params.patience and int(np.argmin(errors)) < len(errors) - params.patience

    while len(trees) < params.max_iter and not stopped():
        start = len(trees)
        schema = T.StructType.fromDDL("bins array<short>, label double, watched boolean, margin double")
        current = spark.read.schema(schema).parquet(f"{state}/margins-{start}").persist(StorageLevel.MEMORY_AND_DISK)
        last = None  # the tree whose weights the margins do not have yet
        try:
            while len(trees) - start < params.block_rounds and len(trees) < params.max_iter:
                before, tree = current, _Tree(params, unit)
                if last is not None:
                    current = _with_margin(before, last).persist(StorageLevel.MEMORY_AND_DISK)
                try:  # the passes of a round share its margins
                    histograms, error = _pass(current, tree, shape)
                finally:
                    if before is not current:
                        before.unpersist()
                if error is not None and len(errors) < len(trees):
                    errors.append(error)  # of the rounds before this one
                    if stopped():
                        last = None
                        break
                tree.learn(histograms)
                while tree.waiting:
                    tree.learn(_pass(current, tree, shape)[0])
                last = tree.walk()
                trees.append(tree.nodes(features, cuts))
            if len(trees) > start:
                after = current if last is None else _with_margin(current, last)
                after.write.mode("overwrite").parquet(f"{state}/margins-{len(trees)}")
        finally:
            current.unpersist()
        if len(trees) > start:
            _record(spark, state, len(trees), base, unit, errors, cuts, params, trees[start:])
    errors = _final_errors(spark, state, errors, len(trees))
    keep = int(np.argmin(errors)) + 1 if errors else len(trees)
    return TreeModel(base, trees[:keep])


def _final_errors(spark: SparkSession, state: str, errors: list[float], rounds: int) -> list[float]:
    """The error after the last round, which no further round has measured."""
    if len(errors) >= rounds:
        return errors
    squared = F.pow(F.col("margin") - F.col("label"), 2)
    last = spark.read.parquet(f"{state}/margins-{rounds}").filter("watched").agg(F.avg(squared)).first()[0]
    return errors if last is None else [*errors, last]


def _comparable(params: str) -> dict:
    """Parameters that decide the trees; rounds, patience and the size of blocks may change on the way."""
    free = ("max_iter", "patience", "block_rounds")
    return {k: v for k, v in json.loads(params).items() if k not in free}


def _record(spark, state, rounds, base, unit, errors, cuts, params, trees) -> None:
    """Append a block's nodes, then note the block: one that is not noted does not count."""
    if trees:
        nodes = spark.createDataFrame(node_rows(trees, rounds - len(trees)), NODES)
        nodes.coalesce(1).write.mode("overwrite").parquet(f"{state}/nodes/upto={rounds}")
    row = (rounds, float(base), unit, [float(e) for e in errors], [list(c) for c in cuts], json.dumps(asdict(params)))
    spark.createDataFrame([row], _HISTORY).coalesce(1).write.mode("append").parquet(f"{state}/blocks")


def _last_block(spark: SparkSession, state: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{state}/blocks")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(_HISTORY).parquet(f"{state}/blocks").orderBy(F.desc("rounds")).first()


def _nodes(spark: SparkSession, state: str, rounds: int) -> DataFrame:
    base = spark.createDataFrame([(-1, 0, None, None, None, None, None, 0.0, None, None)], NODES)
    if not rounds:
        return base
    written = spark.read.option("basePath", f"{state}/nodes").parquet(f"{state}/nodes").filter(F.col("upto") <= rounds)
    return base.unionByName(written.drop("upto"))
