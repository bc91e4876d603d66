"""Boosted trees as a table of nodes, and as one column expression.

A model is a base score and the nodes of its trees. Scoring needs no trained object: the nodes become nested
CASE expressions, which Catalyst compiles with the rest of the projection. A row goes left where the feature
is below the threshold; NULL and NaN go the way the split learned for missing values.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One row per node. The row of round -1 holds the base score; leaves have no feature.
NODES = T.StructType(
    [
        T.StructField("round", T.IntegerType(), False),
        T.StructField("node", T.IntegerType(), False),
        T.StructField("feature", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("missing_left", T.BooleanType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("gain", T.DoubleType()),
        T.StructField("cover", T.DoubleType()),
    ]
)
_BASE = -1


@dataclass(frozen=True)
class Node:
    """A split (with a feature) or a leaf (whose weight includes the learning rate)."""

    weight: float = 0.0
    feature: str | None = None
    threshold: float | None = None
    missing_left: bool | None = None
    left: int | None = None
    right: int | None = None
    gain: float | None = None
    cover: float | None = None


@dataclass(frozen=True)
class TreeModel:
    base_score: float
    trees: Sequence[Sequence[Node]]  # a tree's root is its node 0

    def node_table(self, spark: SparkSession) -> DataFrame:
        base = (_BASE, 0, None, None, None, None, None, self.base_score, None, None)
        return spark.createDataFrame([base, *node_rows(self.trees)], NODES)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeModel:
        return cls.from_table(spark.read.schema(NODES).parquet(path))

    @classmethod
    def from_table(cls, nodes: DataFrame) -> TreeModel:
        """From a table of nodes: rounds times nodes per tree, which the training parameters bound."""
        rows = nodes.orderBy("round", "node").collect()
        trees: dict[int, list[Node]] = {}
        for r in rows:
            if r["round"] != _BASE:
                names = ("weight", "feature", "threshold", "missing_left", "left", "right", "gain", "cover")
                trees.setdefault(r["round"], []).append(Node(**{n: r[n] for n in names}))
        base = next(r["weight"] for r in rows if r["round"] == _BASE)
        return cls(base, [trees[k] for k in sorted(trees)])

    def prediction(self) -> Column:
        """The raw prediction of a row as an expression over the feature columns."""
        return F.expr(_sum([_literal(self.base_score), *(_tree_sql(tree, 0) for tree in self.trees)]))

    def transform(self, df: DataFrame, column: str = "prediction_raw") -> DataFrame:
        return df.withColumn(column, self.prediction())


def node_rows(trees: Iterable[Sequence[Node]], first_round: int = 0) -> list[tuple]:
    return [
        (first_round + i, k, n.feature, n.threshold, n.missing_left, n.left, n.right, n.weight, n.gain, n.cover)
        for i, tree in enumerate(trees)
        for k, n in enumerate(tree)
    ]


def feature_value(name: str) -> str:
    """SQL for a feature as a double, NULL where it is missing."""
    return f"nanvl(CAST(`{name}` AS DOUBLE), NULL)"


def _literal(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _tree_sql(tree: Sequence[Node], at: int) -> str:
    node = tree[at]
    if node.feature is None:
        return _literal(node.weight)
    goes_left = f"coalesce({feature_value(node.feature)} < {_literal(node.threshold)}, {str(node.missing_left).lower()})"
    return f"CASE WHEN {goes_left} THEN {_tree_sql(tree, node.left)} ELSE {_tree_sql(tree, node.right)} END"


def _sum(terms: Sequence[str]) -> str:
    """A balanced sum: a thousand rounds must not make an expression a thousand deep."""
    if len(terms) == 1:
        return terms[0]
    half = len(terms) // 2
    return f"({_sum(terms[:half])} + {_sum(terms[half:])})"
