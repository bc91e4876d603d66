"""End-to-end flows over one database.

``batch_flow`` ingests files in batch; ``stream_flow`` ingests the transactions as a file stream and
adds the table-history steps. Both end with a model, a scoring table and a gold table.
``forecast_flow`` scores with a stored model and rebuilds gold.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.metrics import regression_metrics
from ..modeling import (
    BoostParams,
    GBTParams,
    RunLog,
    TreeModel,
    fit,
    fit_boosted,
    load_model,
    scoring_table,
    split_rows,
)
from ..modeling.training import RAW, SPLIT
from ..operators.enrich import enrich
from ..operators.gold import gold_by_row, gold_fanout
from ..operators.joins import fanout_rows
from ..operators.quality import approx_grouped_median, null_count, null_profile
from ..operators.versioned import VersionedTable
from ..sinks.tables import replace_table
from ..streaming.ingest import append_to_table, open_file_stream
from ..workspace import scratch_scope

_LOG = logging.getLogger(__name__)

# The cleaning steps and the retention the flows use.
NULL_MONTH = "CompetitionOpenSinceMonth IS NULL"
NULL_WEEK = "Promo2SinceWeek IS NULL"
NULL_DISTANCE = "CompetitionDistance IS NULL"
DEFAULT_WEEK = "0"
DEFAULT_DISTANCE = "1000"
RETAIN_HOURS = 0.01


@dataclass(frozen=True)
class Tables:
    """Table names inside one database."""

    database: str
    bronze_transactions: str = field(init=False)
    bronze_states: str = field(init=False)
    bronze_stores: str = field(init=False)
    silver: str = field(init=False)
    null_counts: str = field(init=False)
    median_sales: str = field(init=False)
    predictions: str = field(init=False)
    scoring: str = field(init=False)
    gold: str = field(init=False)
    runs: str = field(init=False)

    def __post_init__(self) -> None:
        for attribute, table in {
            "bronze_transactions": "bronze_transactions",
            "bronze_states": "bronze_states",
            "bronze_stores": "bronze_stores",
            "silver": "silver_transactions",
            "null_counts": "silver_null_counts",
            "median_sales": "silver_median_sales",
            "predictions": "ml_predictions",
            "scoring": "ml_scoring",
            "gold": "gold_transactions",
            "runs": "model_runs",
        }.items():
            object.__setattr__(self, attribute, f"{self.database}.{table}")


def row_keys(df: DataFrame) -> Sequence[str]:
    """What the split hashes: the row key if there is one, else store and day."""
    return (schemas.ROW_KEY,) if schemas.ROW_KEY in df.columns else (schemas.KEY, "Date")


def build_silver(
    spark: SparkSession, names: Tables, tx: DataFrame, states: DataFrame, stores: DataFrame
) -> VersionedTable:
    """Lookup tables, then silver as version 0. The rows are joined and written once; the steps
    between bronze and silver need no copies."""
    replace_table(states, names.bronze_states)
    replace_table(stores, names.bronze_stores)
    silver = VersionedTable(spark, names.silver)
    silver.drop()
    with scratch_scope(spark):  # the lookup that the join may write is not needed afterwards
        silver.create(
            enrich(tx, spark.table(names.bronze_states), spark.table(names.bronze_stores))
        )
    return silver


def train_and_score(
    spark: SparkSession,
    names: Tables,
    silver: DataFrame,
    model_path: str,
    *,
    params: GBTParams | BoostParams = GBTParams(),
    data_version: int | None = None,
    validate_on_test: bool = False,
) -> dict[str, float]:
    """Fit, save the model, record the run, and write the scoring table of the test rows. The learner is that of
    ``params``: regularised trees with ``BoostParams``, the ML library's with ``GBTParams``."""
    rows = split_rows(silver, row_keys(silver), validate_on_test=validate_on_test)
    watch = "test" if validate_on_test else "validation"
    if isinstance(params, BoostParams):
        with scratch_scope(spark):
            model = fit_boosted(rows, params, watch=watch)
        model.save(model_path)
    else:
        model = fit(rows, params, watch=watch)
        model.write().overwrite().save(model_path)
    raw = predict(model, rows, names.predictions)
    metrics = regression_metrics(raw, schemas.LABEL, RAW).first().asDict()
    RunLog(spark, names.runs).record(params.as_text(), metrics, model_path, data_version)
    write_scoring(names, raw)
    return metrics


def predict(model: PipelineModel | TreeModel, rows: DataFrame, table: str) -> DataFrame:
    """Raw predictions of the test rows, written once: errors and scoring both read them."""
    raw = model.transform(rows.filter(F.col(SPLIT) == "test"))
    keep = [schemas.KEY, schemas.ROW_KEY, schemas.LABEL, RAW]
    replace_table(raw.select(*[c for c in keep if c in raw.columns]), table)
    return rows.sparkSession.table(table)


def write_scoring(names: Tables, raw: DataFrame) -> None:
    keep = [k for k in (schemas.ROW_KEY,) if k in raw.columns]
    replace_table(scoring_table(raw, keep), names.scoring)


def write_gold(
    spark: SparkSession, names: Tables, silver: DataFrame, mode: str | None, row_budget: int | None
) -> None:
    """``row``: one row per transaction, the default where transactions have a row key; ``store``:
    many-to-many on the store, whose rows are counted and logged before they are made."""
    if mode is None:
        mode = "row" if schemas.ROW_KEY in silver.columns else "store"
    scoring = spark.table(names.scoring)
    if mode == "row":
        gold = gold_by_row(silver, scoring)
    elif mode == "store":
        rows = fanout_rows(silver, scoring, schemas.KEY).first()["n_rows"]
        _LOG.info("the store-level gold table will have %s rows", rows)
        gold = gold_fanout(silver, scoring, row_budget=row_budget)
    else:
        raise ValueError(f"gold mode is 'store' or 'row', not {mode!r}")
    spark.sql(f"DROP TABLE IF EXISTS {names.gold}")
    replace_table(gold, names.gold)


def batch_flow(
    spark: SparkSession,
    database: str,
    tx: DataFrame,
    states: DataFrame,
    stores: DataFrame,
    model_path: str,
    *,
    params: GBTParams | BoostParams = GBTParams(),
    gold_mode: str | None = None,
    row_budget: int | None = None,
) -> dict[str, float]:
    """Batch ingest → silver → delete, two updates → expiry → model → scoring → gold.

    Returns the model's test metrics.
    """
    names = Tables(database)
    replace_table(tx, names.bronze_transactions)
    bronze = spark.table(names.bronze_transactions)
    silver = build_silver(spark, names, bronze, states, stores)
    silver.delete(NULL_MONTH)
    silver.update({"Promo2SinceWeek": DEFAULT_WEEK}, NULL_WEEK)
    silver.update({"CompetitionDistance": DEFAULT_DISTANCE}, NULL_DISTANCE)
    silver.expire(RETAIN_HOURS, force=True)
    metrics = train_and_score(
        spark, names, silver.current(), model_path, params=params, data_version=silver.head()
    )
    write_gold(spark, names, silver.current(), gold_mode, row_budget)
    return metrics


@dataclass
class StreamFlowReport:
    null_counts: DataFrame
    median_sales: DataFrame
    history: DataFrame
    nulls_before_delete: int | None
    expired: list[int]
    metrics: dict[str, float]


def stream_flow(
    spark: SparkSession,
    database: str,
    tx_path: str,
    states: DataFrame,
    stores: DataFrame,
    model_path: str,
    checkpoint: str,
    *,
    params: GBTParams | BoostParams = GBTParams(),
    gold_mode: str | None = None,
    row_budget: int | None = None,
    retain_hours: float = RETAIN_HOURS,
    max_files_per_trigger: int = 1,
) -> StreamFlowReport:
    """Stream ingest → snapshot enrichment → profile → delete, update, add column, update → history
    and time travel → expiry → model → scoring → gold.

    The stream is drained before the snapshot join, so the join does not race with it.
    """
    names = Tables(database)
    stream = open_file_stream(spark, tx_path, schemas.TRANSACTIONS, max_files_per_trigger)
    append_to_table(stream, names.bronze_transactions, checkpoint).awaitTermination()
    bronze = spark.table(names.bronze_transactions)
    silver = build_silver(spark, names, bronze, states, stores)
    replace_table(null_profile(silver.current()), names.null_counts)
    medians = approx_grouped_median(silver.current(), "StoreType", schemas.LABEL)
    replace_table(medians, names.median_sales)
    silver.delete(NULL_MONTH)
    silver.update({"Promo2SinceWeek": DEFAULT_WEEK}, NULL_WEEK)
    silver.add_column("SalesPerCustomer", "double")
    silver.update({"SalesPerCustomer": "try_divide(Sales, Customers)"})
    nulls_before = null_count(silver.as_of_version(0), "CompetitionOpenSinceMonth").first()[0]
    report = StreamFlowReport(
        null_counts=spark.table(names.null_counts),
        median_sales=spark.table(names.median_sales),
        history=silver.history(),
        nulls_before_delete=nulls_before,
        expired=silver.expire(retain_hours, force=True),
        metrics={},
    )
    report.metrics = train_and_score(
        spark, names, silver.current(), model_path, params=params, data_version=silver.head()
    )
    write_gold(spark, names, silver.current(), gold_mode, row_budget)
    return report


def forecast_flow(
    spark: SparkSession,
    database: str,
    model_path: str,
    *,
    gold_mode: str | None = None,
    row_budget: int | None = None,
) -> None:
    """Score the test rows of the newest silver version with a stored model; rebuild gold."""
    names = Tables(database)
    silver = VersionedTable(spark, names.silver).current()
    rows = split_rows(silver, row_keys(silver))
    write_scoring(names, predict(load_model(model_path), rows, names.predictions))
    write_gold(spark, names, silver, gold_mode, row_budget)
