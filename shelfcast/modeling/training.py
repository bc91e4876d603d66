"""Boosted-tree regression, fitted on the executors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.split import split_label
from ..workspace import ensure_checkpoint_dir
from .features import VECTOR, assembler, feature_inputs
from .trees import TreeModel

SPLIT = "split"
RAW = "prediction_raw"
_HOLDOUT = "__holdout"


@dataclass(frozen=True)
class GBTParams:
    """Learning rate, rounds, patience and seed are the data model's fixed values. Depth is kept small: a
    level-wise distributed tree has up to 2^depth nodes per round, and each round is a pass over the rows.

    ``max_iter`` is the largest number of rounds; training stops once the error on the watched rows
    has not improved for ``patience`` rounds, and the rounds up to the best one are kept. ``max_bins``
    is the number of cuts tried per feature; it must not be below the number of a category's values.
    """

    step_size: float = 0.4
    seed: int = 42
    max_depth: int = 5
    max_iter: int = 1000
    patience: int = 10
    max_bins: int = 32
    min_instances_per_node: int = 1
    min_info_gain: float = 0.0
    subsampling_rate: float = 1.0

    def as_text(self) -> dict[str, str]:
        return {k: str(v) for k, v in asdict(self).items()}


def split_rows(
    df: DataFrame, keys: Sequence[str] = (schemas.ROW_KEY,), *, validate_on_test: bool = False
) -> DataFrame:
    """Adds ``split``: a quarter ``test``, a fifth of the rest ``validation``, else ``train``.

    With ``validate_on_test`` there is no third part, and early stopping watches the test rows (the
    two-way mode; its test metrics are optimistic).
    """
    return df.withColumn(SPLIT, split_label(keys, 4, 0 if validate_on_test else 5, df.schema))


def fit(
    df: DataFrame,
    params: GBTParams = GBTParams(),
    *,
    watch: str = "validation",
    features: Sequence[str] = schemas.FEATURES,
) -> PipelineModel:
    """Fit on the ``train`` rows of a frame with a ``split`` column; early stopping follows the error
    on the ``watch`` rows (``test`` in the two-way mode).

    The learner cannot go on with a fitted model, so rounds are doubled until the best one has
    ``patience`` rounds behind it: at most twice the work of the last fit, whose first rounds up to
    the best one are the model. Without watched rows all ``max_iter`` rounds are kept.

    The vectors are kept in executor memory, spilling to disk, for the passes of the boosting rounds;
    a lost executor's part is rebuilt from ``df``, which should be a written table. The learner cuts
    its own growing lineage every ten rounds in the session's checkpoint folder.
    """
    ensure_checkpoint_dir(df.sparkSession)
    inputs = Pipeline(stages=[feature_inputs(features), assembler(features)])
    rows = df.filter(F.col(SPLIT).isin("train", watch) & F.col(schemas.LABEL).isNotNull())
    prepared = inputs.fit(rows)
    vectors = (
        prepared.transform(rows)
        .select(
            VECTOR,
            F.col(schemas.LABEL).cast("double").alias(schemas.LABEL),
            (F.col(SPLIT) == watch).alias(_HOLDOUT),
        )
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    learner = GBTRegressor(
        featuresCol=VECTOR,
        labelCol=schemas.LABEL,
        predictionCol=RAW,
        lossType="squared",
        stepSize=params.step_size,
        maxDepth=params.max_depth,
        maxBins=params.max_bins,
        minInstancesPerNode=params.min_instances_per_node,
        minInfoGain=params.min_info_gain,
        subsamplingRate=params.subsampling_rate,
        seed=params.seed,
        checkpointInterval=10,
        cacheNodeIds=True,
    )
    try:
        train, watched = vectors.filter(~F.col(_HOLDOUT)), vectors.filter(_HOLDOUT)
        rounds = params.max_iter if watched.isEmpty() else min(params.max_iter, params.patience + 1)
        while True:
            trees = learner.copy({learner.maxIter: rounds}).fit(train)
            if rounds == params.max_iter and watched.isEmpty():
                break
            errors = trees.evaluateEachIteration(watched, "squared")
            best = errors.index(min(errors)) + 1
            if rounds < params.max_iter and best > rounds - params.patience:
                rounds = min(params.max_iter, 2 * rounds)
                continue
            if best < rounds:
                trees = _first_rounds(learner.copy({learner.maxIter: best}), trees, best)
            break
    finally:
        vectors.unpersist()
    return PipelineModel(stages=[*prepared.stages, trees])


def _first_rounds(learner: GBTRegressor, model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of the first rounds: what a fit of so many rounds gives, as rounds don't depend on later ones."""
    gateway, java = SparkSession.getActiveSession().sparkContext._gateway, model._java_obj
    ml = gateway.jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(ml.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(java.trees()[:rounds], model.treeWeights[:rounds], strict=True)):
        trees[i], weights[i] = tree, float(weight)
    kept = GBTRegressionModel(ml.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures()))
    kept._resetUid(java.uid())
    return learner._copyValues(kept)


def load_model(path: str) -> PipelineModel | TreeModel:
    """A saved model, of ``fit`` or of ``fit_boosted``; it scores silver rows without further preparation."""
    spark = SparkSession.getActiveSession()
    stages = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/stages")
    if stages.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(stages):
        return PipelineModel.load(path)
    return TreeModel.load(spark, path)
