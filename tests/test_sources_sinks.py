from __future__ import annotations

import pytest
from helpers import bag, plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schemas
from shelfcast.sinks import append_evolving, create_table, create_table_as, replace_table
from shelfcast.sources import file_inventory, read_csv, read_parquet, read_table, rows_per_file


def test_parquet_under_a_declared_schema_widens_and_fills(spark, path):
    spark.sql("SELECT CAST(1 AS INT) AS Store, CAST(5 AS INT) AS Sales, 'z' AS Extra").write.parquet(path)
    df = read_parquet(spark, path, schemas.TRANSACTIONS)
    assert df.schema == schemas.TRANSACTIONS
    row = df.first()
    assert (row["Store"], row["Sales"], row["Customers"]) == (1, 5, None)


def test_csv_cells(spark, path):
    lines = [
        ",".join(schemas.STORES.names),
        '1,a,c,100,x,2008,1,,2010,"Jan,Apr"',
        "2,b,,,,,0,,,",
    ]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    first, second = read_csv(spark, path, schemas.STORES).orderBy("Store").collect()
    assert first["CompetitionOpenSinceMonth"] is None  # not a number
    assert first["Promo2SinceWeek"] is None  # blank
    assert first["PromoInterval"] == "Jan,Apr"  # quoted comma
    assert first["CompetitionOpenSinceYear"] == 2008
    assert second["Assortment"] is None and second["PromoInterval"] is None


def test_csv_header_in_another_order_is_an_error(spark, path):
    text = "State,Store,Latitude,Longitude\nBY,1,48.1,11.5"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, path, schemas.STATES).collect()


def test_csv_round_trip(spark, path):
    df = spark.createDataFrame([(1, "BY", 48.5, 11.25), (2, None, None, None)], schemas.STATES)
    df.write.option("header", True).csv(path)
    assert bag(read_csv(spark, path, schemas.STATES)) == bag(df)


def test_inventory_reads_no_content(spark, path):
    spark.range(100).repartition(3).write.parquet(path)
    listing = file_inventory(spark, path, "*.parquet")
    rows = listing.collect()
    assert len(rows) == 3 and all(r["file_size"] > 0 for r in rows)
    assert "content" not in plan_of(listing)
    counted = rows_per_file(spark.read.parquet(path))
    assert {(r["file_name"], r["file_size"]) for r in rows} == {
        (r["file_name"], r["file_size"]) for r in counted.collect()
    }
    assert counted.agg(F.sum("n_rows")).first()[0] == 100
    assert "ReadSchema: struct<>" in plan_of(counted)


def test_create_fails_if_the_table_exists(spark, database):
    create_table(spark.range(3), f"{database}.t")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        create_table(spark.range(5), f"{database}.t")
    assert read_table(spark, f"{database}.t").count() == 3


def test_create_table_as_select_and_replace(spark, database):
    query = "SELECT id, id * 2 AS twice FROM range(4)"
    create_table_as(spark, f"{database}.t", query)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_table_as(spark, f"{database}.t", query)
    create_table_as(spark, f"{database}.t", "SELECT 1 AS one", replace=True)
    assert bag(spark.table(f"{database}.t")) == {(1,): 1}


def test_replace_changes_rows_and_schema(spark, database):
    replace_table(spark.range(3), f"{database}.t")
    replace_table(spark.sql("SELECT 'x' AS s"), f"{database}.t")
    assert bag(spark.table(f"{database}.t")) == {("x",): 1}


def test_table_scan_is_pruned(spark, database):
    create_table(spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c"), f"{database}.t")
    assert "ReadSchema: struct<b:int>" in plan_of(read_table(spark, f"{database}.t", ["b"]))


def test_append_adds_columns_and_fills_absent_ones(spark, database):
    table = f"{database}.t"
    append_evolving(spark.createDataFrame([(1, "a")], "k long, s string"), table)
    append_evolving(spark.createDataFrame([("b", 2, 0.5)], "s string, k long, d double"), table)
    append_evolving(spark.createDataFrame([(3,)], "k long"), table)
    assert bag(spark.table(table)) == {(1, "a", None): 1, (2, "b", 0.5): 1, (3, None, None): 1}
    with pytest.raises(ValueError, match="k is string"):
        append_evolving(spark.createDataFrame([("x",)], "k string"), table)


def test_declared_schemas():
    assert schemas.TRANSACTIONS["Date"].dataType == T.TimestampType()
    assert schemas.STATES["Latitude"].dataType == T.FloatType()
    assert all(f.nullable for f in schemas.STORES)
