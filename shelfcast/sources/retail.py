"""The retail data model derived from the order tables.

A store is a customer account, a transaction is an order. Every source row is kept. Some lookup
rows carry no store number and some attributes are NULL, so that left joins meet unmatched keys
and the cleaning steps have something to clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .files import read_parquet


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/orders.parquet", schemas.ORDERS)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/customer.parquet", schemas.CUSTOMER)


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/nation.parquet", schemas.NATION)


def as_transactions(order_rows: DataFrame) -> DataFrame:
    """Stateless, so it serves a batch frame and a stream alike."""
    return order_rows.selectExpr(
        "o_orderkey AS RowId",
        "o_custkey AS Store",
        "CAST(weekday(o_orderdate) + 1 AS BIGINT) AS DayOfWeek",
        "o_orderdate AS Date",
        "CAST(floor(o_totalprice) AS BIGINT) AS Sales",
        "o_orderkey % 50 AS Customers",
        "if(o_orderstatus = 'P', 0L, 1L) AS Open",
        "if(o_orderpriority IN ('1-URGENT', '2-HIGH'), 1L, 0L) AS Promo",
        "if(o_orderkey % 97 = 0, 'a', '0') AS StateHoliday",
        "if(o_orderkey % 7 = 0, 1L, 0L) AS SchoolHoliday",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(orders(spark, sf_dir))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store locations. Every tenth account has no store number."""
    located = customers(spark, sf_dir).join(
        nations(spark, sf_dir), F.expr("c_nationkey = n_nationkey")
    )
    return located.selectExpr(
        "if(c_custkey % 10 <> 0, c_custkey, NULL) AS Store",
        "n_name AS State",
        "CAST(n_nationkey + 40.5 AS FLOAT) AS Latitude",
        "CAST(n_regionkey + 5.25 AS FLOAT) AS Longitude",
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store attributes. Every 25th account has no store number."""
    return customers(spark, sf_dir).selectExpr(
        "if(c_custkey % 25 <> 0, c_custkey, NULL) AS Store",
        "element_at(array('a', 'b', 'c', 'd'), CAST(c_custkey % 4 AS INT) + 1) AS StoreType",
        "element_at(array('a', 'b', 'c'), CAST(c_custkey % 3 AS INT) + 1) AS Assortment",
        "if(c_custkey % 11 <> 0, CAST(floor(abs(c_acctbal)) AS BIGINT), NULL) AS CompetitionDistance",
        "if(c_custkey % 3 <> 0, c_custkey % 12 + 1, NULL) AS CompetitionOpenSinceMonth",
        "if(c_custkey % 5 <> 0, c_custkey % 20 + 1995, NULL) AS CompetitionOpenSinceYear",
        "c_custkey % 2 AS Promo2",
        "if(c_custkey % 2 <> 0, c_custkey % 52 + 1, NULL) AS Promo2SinceWeek",
        "if(c_custkey % 2 <> 0, c_custkey % 6 + 2009, NULL) AS Promo2SinceYear",
        "if(c_custkey % 2 <> 0, 'Jan,Apr,Jul,Oct', NULL) AS PromoInterval",
    )
