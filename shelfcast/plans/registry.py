"""The registered queries: every operator over the whole retail tables of one scale folder.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame. Those that write use a new database
or path in the cluster's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.expressions import fill_constant, ratio
from ..functions.metrics import regression_metrics
from ..modeling import (
    BoostParams,
    GBTParams,
    Node,
    RunLog,
    category_codes,
    feature_frame,
    fit,
    TreeModel,
    fit_boosted,
    load_model,
    predict_store_mean,
    scored_rows,
    scoring_table,
    split_rows,
)
from ..modeling.training import RAW, SPLIT
from ..operators import (
    VersionedTable,
    add_column,
    approx_grouped_median,
    delete_where,
    enrich,
    exact_grouped_median,
    fanout_rows,
    gold_by_row,
    gold_fanout,
    keyed_changes,
    null_count,
    null_profile,
    preview,
    row_count,
    update_where,
    upsert,
    with_states,
)
from ..sinks import append_evolving, create_table, create_table_as, replace_table
from ..sources import read_csv, read_parquet, read_table, retail, rows_per_file
from ..streaming import (
    append_batches,
    append_to_evolving_table,
    append_to_table,
    enrich_stream,
    infer_schema,
    open_file_stream,
    read_batches,
)
from ..workspace import scratch_database, scratch_path, write_and_reopen
from .flows import (
    DEFAULT_DISTANCE,
    DEFAULT_WEEK,
    NULL_DISTANCE,
    NULL_MONTH,
    NULL_WEEK,
    RETAIN_HOURS,
    Tables,
    batch_flow,
    forecast_flow,
    predict,
    stream_flow,
)

_START = datetime(2024, 1, 1, tzinfo=timezone.utc)


# -- scans, projections, filters -----------------------------------------------------------------


def scan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.transactions(spark, sf_dir).select(schemas.ROW_KEY, *schemas.TRANSACTIONS.names)


def source_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [retail.orders, retail.customers, retail.nations]
    counts = None
    for table in tables:
        one = rows_per_file(table(spark, sf_dir)).select("file_name", "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def csv_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "states-csv")
    retail.states(spark, sf_dir).write.option("header", True).csv(path)
    return read_csv(spark, path, schemas.STATES)


def csv_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stores-csv")
    retail.stores(spark, sf_dir).write.option("header", True).csv(path)
    return read_csv(spark, path, schemas.STORES)


# -- joins and profiling -------------------------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(
        retail.transactions(spark, sf_dir),
        retail.states(spark, sf_dir),
        retail.stores(spark, sf_dir),
    )


def enrich_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_states(retail.transactions(spark, sf_dir), retail.states(spark, sf_dir))


def enrich_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


def silver_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(_silver(spark, sf_dir))


def median_sales_by_store_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return approx_grouped_median(_silver(spark, sf_dir), "StoreType", schemas.LABEL)


def median_sales_by_store_type_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_grouped_median(_silver(spark, sf_dir), "StoreType", schemas.LABEL)


def silver_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(_silver(spark, sf_dir), "State IS NOT NULL")


# -- row changes ---------------------------------------------------------------------------------


def delete_null_competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete_where(_silver(spark, sf_dir), NULL_MONTH)


def update_promo2_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return update_where(_silver(spark, sf_dir), {"Promo2SinceWeek": DEFAULT_WEEK}, NULL_WEEK)


def update_competition_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    filled = fill_constant("CompetitionDistance", int(DEFAULT_DISTANCE))
    return silver.select(*[filled if c == "CompetitionDistance" else c for c in silver.columns])


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = delete_where(_silver(spark, sf_dir), NULL_MONTH)
    weeks = update_where(kept, {"Promo2SinceWeek": DEFAULT_WEEK}, NULL_WEEK)
    return update_where(weeks, {"CompetitionDistance": DEFAULT_DISTANCE}, NULL_DISTANCE)


def silver_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir)


def add_sales_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    widened = add_column(_silver(spark, sf_dir), "SalesPerCustomer", "double")
    return update_where(widened, {"SalesPerCustomer": ratio("Sales", "Customers")})


def _store_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New attributes for some stores: one row per supplier, in the layout of the store table."""
    suppliers = read_parquet(spark, f"{sf_dir}/supplier.parquet", schemas.SUPPLIER)
    given = {
        "Store": F.col("s_suppkey"),
        "StoreType": F.lit("e"),
        "Assortment": F.lit("b"),
        "CompetitionDistance": F.floor(F.abs("s_acctbal")),
        "Promo2": F.lit(0),
    }
    return suppliers.select(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.STORES
        ]
    )


def upsert_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(retail.stores(spark, sf_dir), _store_updates(spark, sf_dir), [schemas.KEY])


# -- versions ------------------------------------------------------------------------------------


def _hourly_clock() -> Callable[[], datetime]:
    """A clock that moves one hour per reading, so that commit times are known."""
    hours = iter(range(1_000_000))
    return lambda: _START + timedelta(hours=next(hours))


def _versioned_silver(spark: SparkSession, sf_dir: str, label: str) -> VersionedTable:
    """Silver as version 0; delete, update, add column, update as versions 1 to 4, an hour apart."""
    table = VersionedTable(
        spark, f"{scratch_database(spark, label)}.silver", clock=_hourly_clock()
    )
    table.create(_silver(spark, sf_dir))
    table.delete(NULL_MONTH)
    table.update({"Promo2SinceWeek": DEFAULT_WEEK}, NULL_WEEK)
    table.add_column("SalesPerCustomer", "double")
    table.update({"SalesPerCustomer": "try_divide(Sales, Customers)"})
    return table


def versioned_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned_silver(spark, sf_dir, "head").current()


def nulls_as_of_version_0(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _versioned_silver(spark, sf_dir, "v0")
    return null_count(table.as_of_version(0), "CompetitionOpenSinceMonth")


def read_as_of_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _versioned_silver(spark, sf_dir, "at")
    return table.as_of_timestamp(_START + timedelta(hours=2, minutes=30))


def rollback_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _versioned_silver(spark, sf_dir, "rollback")
    table.rollback(0)
    return table.current()


def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned_silver(spark, sf_dir, "diff").changes(0, 2)


def version_changes_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _versioned_silver(spark, sf_dir, "keyed")
    return keyed_changes(table.as_of_version(0), table.as_of_version(2), [schemas.ROW_KEY])


def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _versioned_silver(spark, sf_dir, "history")
        .history()
        .select("version", "operation", "rows_before", "rows_changed", "rows_after")
    )


def expire_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _versioned_silver(spark, sf_dir, "expire")
    table.expire(RETAIN_HOURS, force=True)
    counts = None
    for version in table.readable_versions():
        one = row_count(table.as_of_version(version)).select(
            F.lit(version).cast("long").alias("version"), "n_rows"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


def merge_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = VersionedTable(spark, f"{scratch_database(spark, 'merge')}.stores")
    table.create(retail.stores(spark, sf_dir))
    table.merge(_store_updates(spark, sf_dir), [schemas.KEY])
    return table.current()


# -- sinks ---------------------------------------------------------------------------------------


def table_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch_database(spark, 'create')}.bronze_states"
    create_table(retail.states(spark, sf_dir), table)
    return read_table(spark, table)


def table_ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two joins as SQL over tables, each made by CREATE TABLE AS SELECT."""
    db = scratch_database(spark, "ctas")
    create_table(retail.transactions(spark, sf_dir), f"{db}.tx")
    create_table(retail.states(spark, sf_dir), f"{db}.states")
    create_table(retail.stores(spark, sf_dir), f"{db}.stores")
    join = "SELECT * EXCEPT (l.Store) FROM {left} l LEFT JOIN {right} r ON l.Store = r.Store"
    for target, left, right in [("located", "tx", "states"), ("silver", "located", "stores")]:
        query = join.format(left=f"{db}.{left}", right=f"{db}.{right}")
        create_table_as(spark, f"{db}.{target}", query, replace=True)
    return read_table(spark, f"{db}.silver")


def table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{scratch_database(spark, 'replace')}.lookup"
    replace_table(retail.states(spark, sf_dir), table)
    replace_table(retail.stores(spark, sf_dir), table)
    return read_table(spark, table)


def append_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions, then the same ones with a further column, in one table."""
    table = f"{scratch_database(spark, 'evolve')}.bronze"
    tx = retail.transactions(spark, sf_dir)
    append_evolving(tx, table)
    append_evolving(tx.withColumn("SalesPerCustomer", ratio("Sales", "Customers")), table)
    return read_table(spark, table)


# -- streaming -----------------------------------------------------------------------------------


def _order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A glob, since a streamed path must be a folder or a pattern, and this may be one file.
    stream = open_file_stream(spark, f"{sf_dir}/orders.parquet*", schemas.ORDERS)
    return retail.as_transactions(stream)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream")
    stream = _order_stream(spark, sf_dir)
    append_batches(stream, f"{base}/bronze", f"{base}/checkpoint").awaitTermination()
    return read_batches(spark, f"{base}/bronze", stream.schema)


def stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream-table")
    table = f"{scratch_database(spark, 'stream')}.bronze"
    stream = _order_stream(spark, sf_dir)
    append_to_table(stream, table, f"{base}/checkpoint").awaitTermination()
    return read_table(spark, table)


def stream_static_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream-static")
    enriched = enrich_stream(
        _order_stream(spark, sf_dir), retail.states(spark, sf_dir), schemas.KEY
    )
    append_batches(enriched, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return read_batches(spark, f"{base}/out", enriched.schema)


def stream_snapshot_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_states(stream_to_table(spark, sf_dir), retail.states(spark, sf_dir))


def _land(rows: DataFrame, folder: str, files: int) -> None:
    """So many more files in a folder that a stream reads."""
    rows.repartition(files).write.mode("append").parquet(folder)


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = retail.orders(spark, sf_dir)
    return orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 <> 0")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several files drained; more files; a second query goes on from the same checkpoint."""
    base = scratch_path(spark, "stream-restart")
    for rows in _halves(spark, sf_dir):
        _land(rows, f"{base}/in", 3)
        stream = retail.as_transactions(open_file_stream(spark, f"{base}/in", schemas.ORDERS))
        append_batches(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return read_batches(spark, f"{base}/out", stream.schema)


def stream_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, but the files that land later carry times of a month before."""
    base = scratch_path(spark, "stream-late")
    for late, rows in enumerate(_halves(spark, sf_dir)):
        folder = f"{base}/in/part={late}"
        _land(rows, folder, 2)
        if late:
            _set_times(spark, folder, datetime.now(timezone.utc) - timedelta(days=30))
        stream = open_file_stream(spark, f"{base}/in/*", schemas.ORDERS)
        stream = retail.as_transactions(stream)
        append_batches(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return read_batches(spark, f"{base}/out", stream.schema)


def _set_times(spark: SparkSession, folder: str, moment: datetime) -> None:
    """Modification time of a folder's files, on any file system Spark can write."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        files.setTimes(status.getPath(), int(moment.timestamp() * 1000), -1)


def stream_inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema comes from the files that are there."""
    base, folder = scratch_path(spark, "stream-inferred"), f"{sf_dir}/orders.parquet*"
    stream = retail.as_transactions(open_file_stream(spark, folder, infer_schema(spark, folder)))
    append_batches(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return read_batches(spark, f"{base}/out", stream.schema)


def stream_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that runs every second until all there is has been taken."""
    base = scratch_path(spark, "stream-timed")
    table = f"{scratch_database(spark, 'stream_timed')}.bronze"
    query = append_to_table(_order_stream(spark, sf_dir), table, f"{base}/checkpoint", every="1 seconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return read_table(spark, table)


def stream_rate_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five files at two per micro-batch: the batches, and the rows they brought."""
    base = scratch_path(spark, "stream-rate")
    _land(retail.orders(spark, sf_dir), f"{base}/in", 5)
    stream = open_file_stream(spark, f"{base}/in", schemas.ORDERS, max_files_per_trigger=2)
    append_batches(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").agg(
        F.count_distinct("_batch").alias("n_batches"), F.count(F.lit(1)).alias("n_rows")
    )


def stream_evolving_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that the later half of the stream gives one more column."""
    base = scratch_path(spark, "stream-evolving")
    table = f"{scratch_database(spark, 'stream_evolving')}.bronze"
    for later, rows in enumerate(_halves(spark, sf_dir)):
        _land(rows, f"{base}/in", 2)
        stream = retail.as_transactions(open_file_stream(spark, f"{base}/in", schemas.ORDERS))
        append_to_evolving_table(
            stream,
            table,
            f"{base}/checkpoint",
            transform=(lambda batch: batch.withColumn("SalesPerCustomer", ratio("Sales", "Customers")))
            if later
            else None,
        ).awaitTermination()
    return read_table(spark, table).drop("_batch")


# -- modelling -----------------------------------------------------------------------------------


def train_test_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        split_rows(_cleaned(spark, sf_dir))
        .groupBy(SPLIT)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(schemas.LABEL).alias("sum_sales"))
    )


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_frame(_cleaned(spark, sf_dir), [schemas.ROW_KEY, schemas.LABEL])


def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    coded = category_codes(silver)
    return coded.select(schemas.ROW_KEY, *[f"{c}Index" for c in schemas.CATEGORIES])


def _baseline(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cleaned silver, and its test rows with the store-mean prediction. Silver is written first:
    training, scoring and gold all read it."""
    cleaned = write_and_reopen(_cleaned(spark, sf_dir), scratch_path(spark, "cleaned"))
    rows = split_rows(cleaned, validate_on_test=True)
    train, test = rows.filter(F.col(SPLIT) == "train"), rows.filter(F.col(SPLIT) == "test")
    return cleaned, predict_store_mean(test, train)


def _baseline_gold_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    cleaned, raw = _baseline(spark, sf_dir)
    table = f"{scratch_database(spark, 'scoring')}.ml_scoring"
    replace_table(scoring_table(raw, [schemas.ROW_KEY]), table)
    return cleaned, read_table(spark, table)


def regression_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, raw = _baseline(spark, sf_dir)
    errors = regression_metrics(raw, schemas.LABEL, RAW)
    return errors.select(
        "n_rows",
        "n_left_out",
        F.round("mae", 4).alias("mae"),
        F.round("mse", 0).alias("mse"),
        F.round("r2", 8).alias("r2"),
    )


def scoring_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring_table(_baseline(spark, sf_dir)[1])


def scored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_rows(_baseline(spark, sf_dir)[1], [schemas.ROW_KEY])


def filter_store_lt_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_features(spark, sf_dir).filter(F.col(schemas.KEY) < 50)


def preview_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring_table(_baseline(spark, sf_dir)[1], [schemas.ROW_KEY])
    return preview(scored, 5, schemas.ROW_KEY)


def gold_store_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_fanout(*_baseline_gold_inputs(spark, sf_dir))


def gold_store_level_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = fanout_rows(*_baseline_gold_inputs(spark, sf_dir), schemas.KEY)
    return counted.select(F.col("n_rows").cast("long").alias("n_rows"))


def gold_row_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_by_row(*_baseline_gold_inputs(spark, sf_dir))


def _trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, GBTParams]:
    cleaned = write_and_reopen(_cleaned(spark, sf_dir), scratch_path(spark, "training"))
    rows = split_rows(cleaned)
    params = GBTParams()
    path = scratch_path(spark, "model")
    fit(rows, params).save(path)
    return rows, path, params


def gbt_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path, _ = _trained(spark, sf_dir)
    raw = load_model(path).transform(rows.filter(F.col(SPLIT) == "test"))
    return scoring_table(raw, [schemas.ROW_KEY])


def gbt_stump_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that SQL can express: one round of depth one over features with few values, saved, loaded, scored."""
    rows = split_rows(write_and_reopen(_cleaned(spark, sf_dir), scratch_path(spark, "stump-training")))
    path = scratch_path(spark, "stump")
    params = GBTParams(max_iter=1, max_depth=1)
    fit(rows, params, features=schemas.FEW_VALUED_FEATURES).save(path)
    raw = load_model(path).transform(rows.filter(F.col(SPLIT) == "test"))
    return scoring_table(raw, [schemas.ROW_KEY])


def boosted_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regularised trees fitted on rows with their missing values, saved as nodes, loaded, scored as an expression."""
    rows = split_rows(write_and_reopen(_silver(spark, sf_dir), scratch_path(spark, "boosted-training")))
    path = scratch_path(spark, "boosted")
    fit_boosted(rows).save(path)
    raw = load_model(path).transform(rows.filter(F.col(SPLIT) == "test"))
    return scoring_table(raw, [schemas.ROW_KEY])


def boosted_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One whole round of the regularised learner, two levels deep, over features with few and with missing values."""
    rows = split_rows(write_and_reopen(_silver(spark, sf_dir), scratch_path(spark, "round-training")))
    params = BoostParams(base_score=0.5, max_iter=1, max_depth=2, max_leaves=4)
    model = fit_boosted(rows, params, features=schemas.FEW_VALUED_FEATURES + schemas.MISSING_FEATURES)
    return model.transform(rows.filter(F.col(SPLIT) == "test")).select(schemas.ROW_KEY, schemas.LABEL, RAW)


#: A fixed model of three trees for the query below.
THREE_TREES = TreeModel(
    250_000.0,
    [
        [
            Node(feature="Promo", threshold=1.0, missing_left=True, left=1, right=2),
            Node(weight=-1500.25),
            Node(feature="Customers", threshold=25.5, missing_left=True, left=3, right=4),
            Node(weight=310.5),
            Node(weight=2200.75),
        ],
        [
            Node(feature="CompetitionOpenSinceMonth", threshold=7.0, missing_left=False, left=1, right=2),
            Node(feature="Promo2SinceWeek", threshold=30.0, missing_left=True, left=3, right=4),
            Node(weight=75.125),
            Node(weight=-640.0),
            Node(weight=12.0),
        ],
        [
            Node(feature="Latitude", threshold=52.0, missing_left=True, left=1, right=2),
            Node(weight=-0.5),
            Node(weight=1000.0),
        ],
    ],
)


def tree_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model written as a table of nodes, read back, and applied to all rows as one expression."""
    table = f"{scratch_database(spark, 'nodes')}.model_nodes"
    replace_table(THREE_TREES.node_table(spark), table)
    model = TreeModel.from_table(read_table(spark, table))
    return model.transform(_silver(spark, sf_dir)).select(schemas.ROW_KEY, RAW)


def gbt_scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of the scored rows: which they are, and that each has a prediction."""
    scored = gbt_scoring(spark, sf_dir)
    return scored.select(
        schemas.ROW_KEY,
        schemas.KEY,
        "Real_Sales",
        F.col("prediction").isNotNull().cast("int").alias("has_prediction"),
    )


def run_log_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The errors of the store-mean model, recorded and read back as the best of two runs."""
    errors = regression_errors(spark, sf_dir).first().asDict()
    log = RunLog(spark, f"{scratch_database(spark, 'baseline_runs')}.model_runs")
    log.record({"model": "none"}, {"r2": float("nan"), "mae": float("nan")})
    log.record({"model": "store mean"}, errors)
    best = log.best("mae").select(F.col("metrics").alias("m"))
    return best.select(
        F.col("m")["n_rows"].cast("long").alias("n_rows"),
        F.col("m")["n_left_out"].cast("long").alias("n_left_out"),
        *[F.col("m")[k].alias(k) for k in ("mae", "mse", "r2")],
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best recorded run, with the sizes of the parts it was trained and measured on."""
    rows, path, params = _trained(spark, sf_dir)
    db = scratch_database(spark, "runs")
    raw = predict(load_model(path), rows, f"{db}.ml_predictions")
    counts = rows.groupBy(SPLIT).agg(F.count(F.lit(1)).alias("n"))
    sizes = {r[SPLIT]: r["n"] for r in counts.collect()}
    log = RunLog(spark, f"{db}.model_runs")
    metrics = regression_metrics(raw, schemas.LABEL, RAW).first().asDict()
    metrics.update({f"n_{part}": n for part, n in sizes.items()})
    log.record(params.as_text(), metrics, path, data_version=0)
    measured = [F.col("metrics")[m].isNotNull() for m in ("mae", "mse", "r2")]
    return log.best("r2").select(
        *[
            F.col("metrics")[f"n_{part}"].cast("long").alias(f"n_{part}")
            for part in ("train", "validation", "test")
        ],
        (measured[0] & measured[1] & measured[2]).cast("int").alias("measured"),
        "data_version",
    )


# -- whole flows ---------------------------------------------------------------------------------


def _table_sizes(spark: SparkSession, names: Tables) -> DataFrame:
    tables = [
        names.bronze_transactions,
        names.bronze_states,
        names.bronze_stores,
        names.silver,
        names.scoring,
        names.gold,
    ]
    sizes = None
    for table in tables:
        one = row_count(spark.table(table)).select(
            F.lit(table.split(".")[-1]).alias("table_name"), "n_rows"
        )
        sizes = one if sizes is None else sizes.unionByName(one)
    return sizes


def batch_flow_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in each table after the batch flow."""
    db = scratch_database(spark, "batch_flow")
    batch_flow(
        spark,
        db,
        retail.transactions(spark, sf_dir),
        retail.states(spark, sf_dir),
        retail.stores(spark, sf_dir),
        scratch_path(spark, "batch-flow-model"),
        gold_mode="store",
    )
    return _table_sizes(spark, Tables(db))


def stream_flow_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in each table after the stream flow, whose transactions have no row key."""
    landing, base = scratch_path(spark, "landing"), scratch_path(spark, "stream-flow")
    tx = retail.transactions(spark, sf_dir).withColumn("Date", F.col("Date").cast("timestamp"))
    tx.select(*schemas.TRANSACTIONS.names).write.parquet(landing)
    db = scratch_database(spark, "stream_flow")
    stream_flow(
        spark,
        db,
        landing,
        retail.states(spark, sf_dir),
        retail.stores(spark, sf_dir),
        f"{base}/model",
        f"{base}/checkpoint",
    )
    return _table_sizes(spark, Tables(db))


def forecast_flow_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in each table after the forecast flow: the newest silver rows scored with a stored model."""
    db = scratch_database(spark, "forecast_flow")
    model = scratch_path(spark, "forecast-model")
    batch_flow(
        spark,
        db,
        retail.transactions(spark, sf_dir),
        retail.states(spark, sf_dir),
        retail.stores(spark, sf_dir),
        model,
    )
    forecast_flow(spark, db, model)
    return _table_sizes(spark, Tables(db))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_transactions": scan_transactions,
    "source_inventory": source_inventory,
    "csv_states": csv_states,
    "csv_stores": csv_stores,
    "enrich_states": enrich_states,
    "enrich_stores": enrich_stores,
    "null_profile": silver_null_profile,
    "median_sales_by_store_type": median_sales_by_store_type,
    "median_sales_by_store_type_exact": median_sales_by_store_type_exact,
    "row_count": silver_row_count,
    "delete_null_competition": delete_null_competition,
    "update_promo2_week": update_promo2_week,
    "update_competition_distance": update_competition_distance,
    "silver_cleaned": silver_cleaned,
    "add_sales_per_customer": add_sales_per_customer,
    "upsert_stores": upsert_stores,
    "merge_version": merge_version,
    "versioned_head": versioned_head,
    "nulls_as_of_version_0": nulls_as_of_version_0,
    "read_as_of_timestamp": read_as_of_timestamp,
    "rollback_head": rollback_head,
    "version_diff": version_diff,
    "version_changes_by_row": version_changes_by_row,
    "table_history": table_history,
    "expire_versions": expire_versions,
    "table_create": table_create,
    "table_ctas": table_ctas,
    "table_replace": table_replace,
    "append_evolved": append_evolved,
    "stream_ingest": stream_ingest,
    "stream_to_table": stream_to_table,
    "stream_static_enrich": stream_static_enrich,
    "stream_snapshot_enrich": stream_snapshot_enrich,
    "stream_restart": stream_restart,
    "stream_late_file": stream_late_file,
    "stream_inferred_schema": stream_inferred_schema,
    "stream_processing_time": stream_processing_time,
    "stream_rate_limited": stream_rate_limited,
    "stream_evolving_table": stream_evolving_table,
    "train_test_split_counts": train_test_split_counts,
    "feature_matrix": feature_matrix,
    "category_index": category_index,
    "regression_metrics": regression_errors,
    "scoring_baseline": scoring_baseline,
    "scored_features": scored_features,
    "filter_store_lt_50": filter_store_lt_50,
    "preview_5": preview_5,
    "gold_fanout": gold_store_level,
    "gold_fanout_rows": gold_store_level_rows,
    "gold_by_row": gold_row_level,
    "gbt_scoring": gbt_scoring,
    "gbt_stump_scoring": gbt_stump_scoring,
    "gbt_scored_rows": gbt_scored_rows,
    "boosted_scoring": boosted_scoring,
    "boosted_round": boosted_round,
    "tree_expression": tree_expression,
    "run_log": run_log,
    "run_log_baseline": run_log_baseline,
    "batch_flow_tables": batch_flow_tables,
    "stream_flow_tables": stream_flow_tables,
    "forecast_flow_tables": forecast_flow_tables,
}
