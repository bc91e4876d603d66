"""DuckDB SQL for the registered queries, written independently of the Spark plans: the two joins in
sequence where Spark joins once, set operators where Spark aggregates, and so on."""

from __future__ import annotations

_TX = """
SELECT o_orderkey AS RowId, o_custkey AS Store, CAST(isodow(o_orderdate) AS BIGINT) AS DayOfWeek,
       o_orderdate AS Date, CAST(floor(o_totalprice) AS BIGINT) AS Sales,
       CAST(o_orderkey % 50 AS BIGINT) AS Customers,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS BIGINT) AS Open,
       CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS BIGINT) AS Promo,
       CASE WHEN o_orderkey % 97 = 0 THEN 'a' ELSE '0' END AS StateHoliday,
       CAST(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS SchoolHoliday
FROM orders"""

_ST = """
SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS Store, n_name AS State,
       CAST(n_nationkey + 40.5 AS FLOAT) AS Latitude, CAST(n_regionkey + 5.25 AS FLOAT) AS Longitude
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

_SO = """
SELECT CASE WHEN c_custkey % 25 = 0 THEN NULL ELSE c_custkey END AS Store,
       CASE c_custkey % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' ELSE 'd' END AS StoreType,
       CASE c_custkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS Assortment,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(floor(abs(c_acctbal)) AS BIGINT) END
           AS CompetitionDistance,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 12 + 1 END
           AS CompetitionOpenSinceMonth,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 20 + 1995 END
           AS CompetitionOpenSinceYear,
       CAST(c_custkey % 2 AS BIGINT) AS Promo2,
       CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_custkey % 52 + 1 END AS Promo2SinceWeek,
       CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_custkey % 6 + 2009 END AS Promo2SinceYear,
       CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'Jan,Apr,Jul,Oct' END AS PromoInterval
FROM customer"""

_CTES = {
    "tx": _TX,
    "st": _ST,
    "so": _SO,
    "located": "SELECT a.* EXCLUDE (Store), b.* FROM tx a LEFT JOIN st b ON a.Store = b.Store",
    "silver": "SELECT a.* EXCLUDE (Store), b.* FROM located a LEFT JOIN so b ON a.Store = b.Store",
    "kept": "SELECT * FROM silver WHERE CompetitionOpenSinceMonth IS NOT NULL",
    "v2": "SELECT * REPLACE (coalesce(Promo2SinceWeek, 0) AS Promo2SinceWeek) FROM kept",
    "v4": "SELECT *, CAST(Sales AS DOUBLE) / nullif(Customers, 0) AS SalesPerCustomer FROM v2",
    "cleaned": "SELECT * REPLACE (coalesce(CompetitionDistance, 1000) AS CompetitionDistance) FROM v2",
    "hashed": """
SELECT *, CAST('0x' || substr(md5(CAST(RowId AS VARCHAR)), 1, 8) AS BIGINT) % 4 AS b1,
       CAST('0x' || substr(md5(CAST(RowId AS VARCHAR)), 9, 8) AS BIGINT) % 5 AS b2
FROM cleaned""",
    "hashed_silver": """
SELECT *, CAST('0x' || substr(md5(CAST(RowId AS VARCHAR)), 1, 8) AS BIGINT) % 4 AS b1,
       CAST('0x' || substr(md5(CAST(RowId AS VARCHAR)), 9, 8) AS BIGINT) % 5 AS b2
FROM silver""",
    "train": "SELECT * FROM hashed WHERE b1 <> 0",
    "test": "SELECT * FROM hashed WHERE b1 = 0",
    "means": "SELECT Store AS mean_store, CAST(sum(Sales) AS DOUBLE) / count(*) AS mean_sales "
    "FROM train GROUP BY Store",
    "raw": """
SELECT t.*, coalesce(m.mean_sales, (SELECT CAST(sum(Sales) AS DOUBLE) / count(*) FROM train))
       AS prediction_raw
FROM test t LEFT JOIN means m ON t.Store = m.mean_store""",
    "scoring": "SELECT Store, CAST(floor(prediction_raw) AS BIGINT) AS prediction, "
    "Sales AS Real_Sales, RowId FROM raw",
    "hashed_by_day": """
SELECT *, CAST('0x' || substr(md5(concat_ws(chr(31), CAST(Store AS VARCHAR),
       CAST(epoch_us(Date) AS VARCHAR))), 1, 8) AS BIGINT) % 4 AS b1
FROM v4""",
    "updates": """
SELECT s_suppkey AS Store, 'e' AS StoreType, 'b' AS Assortment,
       CAST(floor(abs(s_acctbal)) AS BIGINT) AS CompetitionDistance,
       CAST(NULL AS BIGINT) AS CompetitionOpenSinceMonth,
       CAST(NULL AS BIGINT) AS CompetitionOpenSinceYear, CAST(0 AS BIGINT) AS Promo2,
       CAST(NULL AS BIGINT) AS Promo2SinceWeek, CAST(NULL AS BIGINT) AS Promo2SinceYear,
       CAST(NULL AS VARCHAR) AS PromoInterval
FROM supplier""",
}

# What each common table reads, so that a query carries only the ones it needs.
_NEEDS = {
    "located": ["tx", "st"],
    "silver": ["located", "so"],
    "kept": ["silver"],
    "v2": ["kept"],
    "v4": ["v2"],
    "cleaned": ["v2"],
    "hashed": ["cleaned"],
    "hashed_by_day": ["v4"],
    "hashed_silver": ["silver"],
    "train": ["hashed"],
    "test": ["hashed"],
    "means": ["train"],
    "raw": ["test", "means", "train"],
    "scoring": ["raw"],
}

_SILVER_COLUMNS = [
    "RowId",
    "DayOfWeek",
    "Date",
    "Sales",
    "Customers",
    "Open",
    "Promo",
    "StateHoliday",
    "SchoolHoliday",
    "State",
    "Latitude",
    "Longitude",
    "Store",
    "StoreType",
    "Assortment",
    "CompetitionDistance",
    "CompetitionOpenSinceMonth",
    "CompetitionOpenSinceYear",
    "Promo2",
    "Promo2SinceWeek",
    "Promo2SinceYear",
    "PromoInterval",
]

_STORE_COLUMNS = _SILVER_COLUMNS[_SILVER_COLUMNS.index("Store") :]

_FEATURES = [
    "Store",
    "DayOfWeek",
    "Customers",
    "Open",
    "Promo",
    "SchoolHoliday",
    "Latitude",
    "Longitude",
    "CompetitionDistance",
    "CompetitionOpenSinceMonth",
    "CompetitionOpenSinceYear",
    "Promo2",
    "Promo2SinceWeek",
    "Promo2SinceYear",
]


def _with(names: list[str], query: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    tables = ",\n".join(f"{n} AS ({_CTES[n].strip()})" for n in order)
    return f"WITH {tables}\n{query}"


def _null_profile() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_nulls FROM silver"
        for c in _SILVER_COLUMNS
    ]
    return " UNION ALL ".join(parts)


def _upsert() -> str:
    updated = ", ".join(
        f"CASE WHEN u.Store IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}"
        for c in _STORE_COLUMNS
    )
    inserted = ", ".join(f"u.{c}" for c in _STORE_COLUMNS)
    return (
        f"SELECT {updated} FROM so t LEFT JOIN updates u ON t.Store = u.Store UNION ALL "
        f"SELECT {inserted} FROM updates u "
        "WHERE NOT EXISTS (SELECT 1 FROM so t WHERE t.Store = u.Store)"
    )


def _diff() -> str:
    columns = ", ".join(_SILVER_COLUMNS)
    return (
        f"SELECT {columns}, 'removed' AS change_type, count(*) AS n_copies FROM "
        "(SELECT * FROM silver EXCEPT ALL SELECT * FROM v2) GROUP BY ALL "
        f"UNION ALL SELECT {columns}, 'added' AS change_type, count(*) AS n_copies FROM "
        "(SELECT * FROM v2 EXCEPT ALL SELECT * FROM silver) GROUP BY ALL"
    )


def _row_changes() -> str:
    return """
SELECT coalesce(o.RowId, n.RowId) AS RowId,
       CASE WHEN o.RowId IS NULL THEN 'insert' WHEN n.RowId IS NULL THEN 'delete' ELSE 'update' END
           AS change_type
FROM silver o FULL JOIN v2 n ON o.RowId = n.RowId
WHERE o.RowId IS NULL OR n.RowId IS NULL
   OR o.Promo2SinceWeek IS DISTINCT FROM n.Promo2SinceWeek"""


def _history() -> str:
    return """
SELECT CAST(version AS BIGINT) AS version, operation, CAST(rows_before AS BIGINT) AS rows_before,
       CAST(rows_changed AS BIGINT) AS rows_changed, CAST(rows_after AS BIGINT) AS rows_after
FROM (
  SELECT 0 AS version, 'CREATE TABLE AS SELECT' AS operation, NULL AS rows_before,
         NULL AS rows_changed, (SELECT count(*) FROM silver) AS rows_after
  UNION ALL SELECT 1, 'DELETE', (SELECT count(*) FROM silver),
         (SELECT count(*) FROM silver WHERE CompetitionOpenSinceMonth IS NULL),
         (SELECT count(*) FROM kept)
  UNION ALL SELECT 2, 'UPDATE', (SELECT count(*) FROM kept),
         (SELECT count(*) FROM kept WHERE Promo2SinceWeek IS NULL), (SELECT count(*) FROM kept)
  UNION ALL SELECT 3, 'ADD COLUMNS', (SELECT count(*) FROM kept), 0, (SELECT count(*) FROM kept)
  UNION ALL SELECT 4, 'UPDATE', (SELECT count(*) FROM kept), (SELECT count(*) FROM kept),
         (SELECT count(*) FROM kept)
)"""


def _features() -> str:
    inputs = ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), -1.0) AS x_{c}, "
        f"CAST(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS x_{c}_missing"
        for c in _FEATURES
    )
    return f"SELECT RowId, Sales, {inputs} FROM cleaned"


def _category_codes() -> str:
    def codes(column: str) -> str:
        return (
            f"(SELECT {column} AS label, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 "
            f"AS code FROM silver WHERE {column} IS NOT NULL GROUP BY {column})"
        )

    columns = ["StoreType", "Assortment", "StateHoliday"]
    picked = ", ".join(
        f"CAST(coalesce(c{i}.code, (SELECT count(DISTINCT {c}) FROM silver)) AS DOUBLE) AS {c}Index"
        for i, c in enumerate(columns)
    )
    joins = " ".join(
        f"LEFT JOIN {codes(c)} c{i} ON s.{c} = c{i}.label" for i, c in enumerate(columns)
    )
    return f"SELECT s.RowId, {picked} FROM silver s {joins}"


_SPLIT_COUNTS = """
SELECT CASE WHEN b1 = 0 THEN 'test' WHEN b2 = 0 THEN 'validation' ELSE 'train' END AS split,
       count(*) AS n_rows, CAST(sum(Sales) AS BIGINT) AS sum_sales
FROM hashed GROUP BY 1"""

_METRICS = """
SELECT count(*) FILTER (prediction_raw IS NOT NULL AND Sales IS NOT NULL) AS n_rows,
       count(*) FILTER (prediction_raw IS NULL OR Sales IS NULL) AS n_left_out,
       round(avg(abs(prediction_raw - Sales)), 4) AS mae,
       round(avg((prediction_raw - Sales) * (prediction_raw - Sales)), 0) AS mse,
       round(1 - avg((prediction_raw - Sales) * (prediction_raw - Sales)) / var_pop(Sales), 8) AS r2
FROM raw"""

_SCORED = ", ".join(
    ["RowId", *_FEATURES, "CAST(floor(prediction_raw) AS BIGINT) AS prediction", "Sales AS Real_Sales"]
)

_GOLD = "FROM cleaned a LEFT JOIN scoring b ON a.Store = b.Store"

_FEW = ["DayOfWeek", "Open", "Promo", "SchoolHoliday", "Promo2"]


def _stump() -> str:
    """The split with the largest gain in squared error over all features, and the means of its sides."""
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS f, CAST({c} AS DOUBLE) AS v, CAST(Sales AS DOUBLE) AS y FROM hashed "
        "WHERE b1 <> 0 AND b2 <> 0"
        for c in _FEW
    )
    chosen = " ".join(f"WHEN '{c}' THEN {c}" for c in _FEW)
    return f"""
SELECT Store, CAST(trunc(CASE WHEN CASE f {chosen} END <= cut THEN low ELSE high END) AS BIGINT)
       AS prediction, Sales AS Real_Sales, RowId
FROM hashed, (
  SELECT f, (v + next) / 2 AS cut, sl / nl AS low, (s - sl) / (n - nl) AS high
  FROM (
    SELECT f, v, sum(n) OVER up AS nl, sum(s) OVER up AS sl, sum(n) OVER (PARTITION BY f) AS n,
           sum(s) OVER (PARTITION BY f) AS s, lead(v) OVER up AS next
    FROM (SELECT f, v, count(*) AS n, sum(y) AS s FROM ({values}) GROUP BY f, v)
    WINDOW up AS (PARTITION BY f ORDER BY v))
  WHERE next IS NOT NULL
  ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)
WHERE b1 = 0"""


_ROUND_FEATURES = [*_FEW, "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2SinceWeek"]


def _boosted_round() -> str:
    """Two levels of splits by gain with penalties 0.15 and 0.2, a least child weight of 0.6 and a direction for
    missing values; leaves at a learning rate of 0.4 on a base score of 0.5."""

    def shrunk(g: str) -> str:
        return f"(sign({g}) * greatest(abs({g}) - 0.15::DOUBLE, 0))"

    def score(g: str, h: str) -> str:
        return f"({shrunk(g)} * {shrunk(g)} / ({h} + 0.2::DOUBLE))"

    def level(rows: str, n: int) -> str:
        entries = " UNION ALL ".join(
            f"SELECT node, {i} AS f, CAST({c} AS DOUBLE) AS v, 0.5::DOUBLE - Sales AS g FROM {rows} WHERE trained"
            for i, c in enumerate(_ROUND_FEATURES)
        )
        value = "CASE f " + " ".join(f"WHEN {i} THEN CAST({c} AS DOUBLE)" for i, c in enumerate(_ROUND_FEATURES)) + " END"
        return f"""
entries{n} AS ({entries}),
cells{n} AS (SELECT node, f, v, sum(g) AS g, count(*)::DOUBLE AS h FROM entries{n} GROUP BY ALL),
cuts{n} AS (
  SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS next
  FROM (SELECT DISTINCT f, v FROM entries{n} WHERE v IS NOT NULL)),
sums{n} AS (
  SELECT t.node, c.f, c.v, c.next, t.g, t.h, coalesce(m.g, 0) AS mg, coalesce(m.h, 0) AS mh,
    sum(coalesce(x.g, 0)) OVER w AS pg, sum(coalesce(x.h, 0)) OVER w AS ph
  FROM (SELECT node, sum(g) AS g, sum(h) AS h FROM cells{n} WHERE f = 0 GROUP BY node) t
  CROSS JOIN cuts{n} c
  LEFT JOIN cells{n} x ON x.node = t.node AND x.f = c.f AND x.v = c.v
  LEFT JOIN cells{n} m ON m.node = t.node AND m.f = c.f AND m.v IS NULL
  WINDOW w AS (PARTITION BY t.node, c.f ORDER BY c.v)),
sides{n} AS (
  SELECT *, true AS missing_left, pg + mg AS lg, ph + mh AS lh FROM sums{n}
  UNION ALL SELECT *, false, pg, ph FROM sums{n}),
gains{n} AS (
  SELECT *, {score("lg", "lh")} + {score("(g - lg)", "(h - lh)")} - {score("g", "h")} AS gain
  FROM sides{n} WHERE lh >= 0.6 AND h - lh >= 0.6),
best{n} AS (
  SELECT * FROM gains{n} WHERE gain > 1e-6
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v, missing_left DESC) = 1),
level{n} AS (
  SELECT r.* REPLACE (CASE WHEN b.node IS NULL THEN r.node
      WHEN {value} IS NULL THEN 2 * r.node + (NOT b.missing_left)::INT
      ELSE 2 * r.node + (NOT ({value} < coalesce(b.next, 'inf'::DOUBLE)))::INT END AS node)
  FROM {rows} r LEFT JOIN best{n} b ON r.node = b.node)"""

    return f"""
, level0 AS (SELECT *, b1 <> 0 AND b2 <> 0 AS trained, 1 AS node FROM hashed_silver),
{level("level0", 1)},{level("level1", 2)},
leaves AS (
  SELECT node, -{shrunk("g")} / (h + 0.2::DOUBLE) * 0.4::DOUBLE AS weight
  FROM (SELECT node, sum(0.5::DOUBLE - Sales) AS g, count(*) AS h FROM level2 WHERE trained GROUP BY node))
SELECT RowId, Sales, 0.5::DOUBLE + weight AS prediction_raw FROM level2 JOIN leaves USING (node) WHERE b1 = 0"""


_THREE_TREES = """
SELECT RowId, (250000 +
    CASE WHEN Promo < 1 OR Promo IS NULL THEN -1500.25
         WHEN Customers < 25.5 OR Customers IS NULL THEN 310.5 ELSE 2200.75 END +
    CASE WHEN CompetitionOpenSinceMonth < 7 THEN
           CASE WHEN Promo2SinceWeek >= 30 THEN 12.0 ELSE -640.0 END
         ELSE 75.125 END +
    CASE WHEN Latitude >= 52 THEN 1000.0 ELSE -0.5 END)::DOUBLE AS prediction_raw
FROM silver"""

_RUN = """
SELECT count(*) FILTER (b1 <> 0 AND b2 <> 0) AS n_train,
       count(*) FILTER (b1 <> 0 AND b2 = 0) AS n_validation,
       count(*) FILTER (b1 = 0) AS n_test, 1 AS measured, CAST(0 AS BIGINT) AS data_version
FROM hashed"""

def _flow_sizes(rows: str, by_row: bool = False) -> str:
    """Rows per table after a flow; ``rows`` names the common table of silver rows with their split."""
    gold = "" if by_row else f" a LEFT JOIN (SELECT Store FROM {rows} WHERE b1 = 0) b ON a.Store = b.Store"
    return f"""
SELECT 'bronze_transactions' AS table_name, count(*) AS n_rows FROM tx
UNION ALL SELECT 'bronze_states', count(*) FROM st
UNION ALL SELECT 'bronze_stores', count(*) FROM so
UNION ALL SELECT 'silver_transactions', count(*) FROM {rows}
UNION ALL SELECT 'ml_scoring', count(*) FROM {rows} WHERE b1 = 0
UNION ALL SELECT 'gold_transactions', count(*) FROM {rows}{gold}"""


ORACLES: dict[str, str] = {
    "scan_transactions": _with(["tx"], "SELECT * FROM tx"),
    "source_inventory": "SELECT 'orders.parquet' AS file_name, count(*) AS n_rows FROM orders "
    "UNION ALL SELECT 'customer.parquet', count(*) FROM customer "
    "UNION ALL SELECT 'nation.parquet', count(*) FROM nation",
    "csv_states": _with(["st"], "SELECT * FROM st"),
    "csv_stores": _with(["so"], "SELECT * FROM so"),
    "enrich_states": _with(["located"], "SELECT * FROM located"),
    "enrich_stores": _with(["silver"], "SELECT * FROM silver"),
    "null_profile": _with(["silver"], _null_profile()),
    "median_sales_by_store_type": _with(
        ["silver"],
        "SELECT StoreType, quantile_disc(Sales, 0.5) AS median FROM silver "
        "WHERE StoreType IS NOT NULL GROUP BY StoreType",
    ),
    "median_sales_by_store_type_exact": _with(
        ["silver"],
        "SELECT StoreType, CAST(median(Sales) AS DOUBLE) AS median FROM silver "
        "WHERE StoreType IS NOT NULL GROUP BY StoreType",
    ),
    "row_count": _with(["silver"], "SELECT count(*) AS n_rows FROM silver WHERE State IS NOT NULL"),
    "delete_null_competition": _with(["kept"], "SELECT * FROM kept"),
    "update_promo2_week": _with(
        ["silver"],
        "SELECT * REPLACE (CASE WHEN Promo2SinceWeek IS NULL THEN 0 ELSE Promo2SinceWeek END "
        "AS Promo2SinceWeek) FROM silver",
    ),
    "update_competition_distance": _with(
        ["silver"],
        "SELECT * REPLACE (CASE WHEN CompetitionDistance IS NULL THEN 1000 "
        "ELSE CompetitionDistance END AS CompetitionDistance) FROM silver",
    ),
    "silver_cleaned": _with(["cleaned"], "SELECT * FROM cleaned"),
    "add_sales_per_customer": _with(
        ["silver"],
        "SELECT *, CAST(Sales AS DOUBLE) / nullif(Customers, 0) AS SalesPerCustomer FROM silver",
    ),
    "upsert_stores": _with(["so", "updates"], _upsert()),
    "merge_version": _with(["so", "updates"], _upsert()),
    "versioned_head": _with(["v4"], "SELECT * FROM v4"),
    "nulls_as_of_version_0": _with(
        ["silver"],
        "SELECT CAST(sum(CASE WHEN CompetitionOpenSinceMonth IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
        "AS CompetitionOpenSinceMonth_NULL FROM silver",
    ),
    "read_as_of_timestamp": _with(["v2"], "SELECT * FROM v2"),
    "rollback_head": _with(["silver"], "SELECT * FROM silver"),
    "version_diff": _with(["silver", "v2"], _diff()),
    "version_changes_by_row": _with(["silver", "v2"], _row_changes()),
    "table_history": _with(["silver", "kept"], _history()),
    "expire_versions": _with(
        ["v4"], "SELECT CAST(4 AS BIGINT) AS version, count(*) AS n_rows FROM v4"
    ),
    "table_create": _with(["st"], "SELECT * FROM st"),
    "table_ctas": _with(["silver"], "SELECT * FROM silver"),
    "table_replace": _with(["so"], "SELECT * FROM so"),
    "append_evolved": _with(
        ["tx"],
        "SELECT *, CAST(NULL AS DOUBLE) AS SalesPerCustomer FROM tx UNION ALL "
        "SELECT *, CAST(Sales AS DOUBLE) / nullif(Customers, 0) AS SalesPerCustomer FROM tx",
    ),
    "stream_ingest": _with(["tx"], "SELECT * FROM tx"),
    "stream_to_table": _with(["tx"], "SELECT * FROM tx"),
    "stream_static_enrich": _with(["located"], "SELECT * FROM located"),
    "stream_restart": _with(["tx"], "SELECT * FROM tx"),
    "stream_late_file": _with(["tx"], "SELECT * FROM tx"),
    "stream_inferred_schema": _with(["tx"], "SELECT * FROM tx"),
    "stream_processing_time": _with(["tx"], "SELECT * FROM tx"),
    "stream_rate_limited": _with(
        ["tx"], "SELECT CAST(3 AS BIGINT) AS n_batches, count(*) AS n_rows FROM tx"
    ),
    "stream_evolving_table": _with(
        ["tx"],
        "SELECT *, CASE WHEN RowId % 2 <> 0 AND Customers <> 0 THEN Sales / Customers END "
        "AS SalesPerCustomer FROM tx",
    ),
    "stream_snapshot_enrich": _with(["located"], "SELECT * FROM located"),
    "train_test_split_counts": _with(["hashed"], _SPLIT_COUNTS),
    "feature_matrix": _with(["cleaned"], _features()),
    "category_index": _with(["silver"], _category_codes()),
    "regression_metrics": _with(["raw"], _METRICS),
    "scoring_baseline": _with(["scoring"], "SELECT Store, prediction, Real_Sales FROM scoring"),
    "scored_features": _with(["raw"], f"SELECT {_SCORED} FROM raw"),
    "filter_store_lt_50": _with(["raw"], f"SELECT {_SCORED} FROM raw WHERE Store < 50"),
    "preview_5": _with(["scoring"], "SELECT * FROM scoring ORDER BY RowId LIMIT 5"),
    "gold_fanout": _with(
        ["cleaned", "scoring"],
        f"SELECT a.* EXCLUDE (Store), b.Store, b.prediction, b.Real_Sales {_GOLD}",
    ),
    "gold_fanout_rows": _with(["cleaned", "scoring"], f"SELECT count(*) AS n_rows {_GOLD}"),
    "gold_by_row": _with(
        ["cleaned", "scoring"],
        "SELECT a.*, b.prediction, b.Real_Sales FROM cleaned a "
        "LEFT JOIN scoring b ON a.RowId = b.RowId",
    ),
    "gbt_stump_scoring": _with(["hashed"], _stump()),
    "gbt_scored_rows": _with(
        ["test"], "SELECT RowId, Store, Sales AS Real_Sales, 1 AS has_prediction FROM test"
    ),
    "boosted_round": _with(["hashed_silver"], _boosted_round()),
    "tree_expression": _with(["silver"], _THREE_TREES),
    "run_log_baseline": _with(["raw"], _METRICS),
    "run_log": _with(["hashed"], _RUN),
    "batch_flow_tables": _with(["hashed"], _flow_sizes("hashed")),
    "forecast_flow_tables": _with(["hashed"], _flow_sizes("hashed", by_row=True)),
    "stream_flow_tables": _with(["hashed_by_day"], _flow_sizes("hashed_by_day")),
}
