from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from helpers import bag, plan_of

from shelfcast.operators import VersionedTable
from shelfcast.operators.versioned import VersionNotFound

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


class Clock:
    def __init__(self):
        self.now = START

    def __call__(self):
        moment, self.now = self.now, self.now + timedelta(hours=1)
        return moment


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, None, 10, 2), (2, 5, 20, 0), (3, 7, 30, None)],
        "k long, m long, Sales long, Customers long",
    )


@pytest.fixture
def table(spark, database, rows):
    t = VersionedTable(spark, f"{database}.silver", clock=Clock())
    t.create(rows)
    t.delete("m IS NULL OR m IS NULL")
    t.update({"m": "0"}, "m = 7")
    t.add_column("spc", "double")
    t.update({"spc": "try_divide(Sales, Customers)"})
    return t


def test_chain_of_versions(table, rows):
    assert [table.as_of_version(v).count() for v in range(5)] == [3, 2, 2, 2, 2]
    assert bag(table.as_of_version(0)) == bag(rows)
    assert table.as_of_version(2).columns == ["k", "m", "Sales", "Customers"]
    assert table.current().columns[-1] == "spc"
    assert bag(table.as_of_version(2)) == {(2, 5, 20, 0): 1, (3, 0, 30, None): 1}
    assert bag(table.as_of_version(3)) == {(2, 5, 20, 0, None): 1, (3, 0, 30, None, None): 1}


def test_head_is_a_table_name_for_sql(spark, table):
    assert bag(spark.sql(f"SELECT * FROM {table.name}")) == bag(table.current())


def test_history_is_newest_first_and_counts_rows(table):
    log = table.history().collect()
    assert [r["version"] for r in log] == [4, 3, 2, 1, 0]
    assert [r["operation"] for r in log] == [
        "UPDATE", "ADD COLUMNS", "UPDATE", "DELETE", "CREATE TABLE AS SELECT",
    ]
    assert [(r["rows_before"], r["rows_changed"], r["rows_after"]) for r in log] == [
        (2, 2, 2), (2, 0, 2), (2, 1, 2), (3, 1, 2), (None, None, 3),
    ]
    assert log[2]["parameters"] == {"set m": "0", "where": "m = 7"}
    assert [r["written"] for r in log] == [False, False, False, False, True]


def test_changes_are_folded_into_one_scan(table):
    plan = plan_of(table.current().select("k"))
    assert plan.count("Scan parquet") == 2  # once in the tree, once in its details
    assert "IsNotNull(m)" in plan
    assert "Exchange" not in plan


def test_earlier_versions_do_not_change_with_later_commits(spark, table):
    before = bag(table.as_of_version(1))
    table.update({"Sales": "Sales + 1"})
    table.replace(table.current().limit(0))
    assert bag(table.as_of_version(1)) == before
    assert table.current().isEmpty()


def test_time_travel_by_timestamp(table):
    assert table.version_at(START) == 0
    assert table.version_at(START + timedelta(hours=2, minutes=59)) == 2
    assert table.version_at(datetime(2030, 1, 1)) == 4
    assert table.as_of_timestamp(START + timedelta(minutes=5)).count() == 3
    with pytest.raises(VersionNotFound):
        table.version_at(START - timedelta(seconds=1))


def test_unknown_version(table):
    with pytest.raises(VersionNotFound):
        table.as_of_version(9)


def test_rollback_restores_rows_and_keeps_what_came_after(table, rows):
    head = table.rollback(0)
    assert head == 5
    assert bag(table.current()) == bag(rows)
    assert table.as_of_version(4).count() == 2
    table.delete("k = 1")
    assert table.current().count() == 2
    assert table.history().first()["rows_before"] == 3


def test_audit_between_versions(table):
    assert bag(table.changes(1, 2)) == {
        (3, 7, 30, None, "removed", 1): 1, (3, 0, 30, None, "added", 1): 1,
    }
    assert table.changes(2, 2).isEmpty()


def test_merge(spark, table):
    source = spark.createDataFrame(
        [(3, 9, 1, 1, 1.0), (8, 8, 8, 8, 8.0)],
        "k long, m long, Sales long, Customers long, spc double",
    )
    table.merge(source, ["k"])
    assert bag(table.current()) == {
        (2, 5, 20, 0, None): 1, (3, 9, 1, 1, 1.0): 1, (8, 8, 8, 8, 8.0): 1,
    }


def test_expiry_needs_force_below_a_week(table):
    with pytest.raises(ValueError, match="forced"):
        table.expire(0.01)
    assert table.readable_versions() == [0, 1, 2, 3, 4]
    assert table.expire() == []


def test_expired_versions_are_gone_and_the_head_is_unchanged(spark, table, database):
    head = bag(table.current())
    assert table.expire(0.01, force=True) == [0, 1, 2, 3]
    assert table.readable_versions() == [4]
    assert bag(table.current()) == head == bag(spark.table(table.name))
    for version in range(4):
        with pytest.raises(VersionNotFound, match="expired"):
            table.as_of_version(version)
    names = {t.name for t in spark.catalog.listTables(database)}
    assert names == {"silver", "silver__history", "silver__v4", "silver__v4_data"}
    assert table.expire(0.01, force=True) == []
    table.delete("k = 2")
    assert table.current().count() == 1


def test_expiry_keeps_recent_versions_readable(table):
    wanted = {v: bag(table.as_of_version(v)) for v in (2, 3, 4)}
    table._clock.now = START + timedelta(hours=5)
    assert table.expire(2.5, force=True) == [0, 1]
    assert table.readable_versions() == [2, 3, 4]
    assert {v: bag(table.as_of_version(v)) for v in (2, 3, 4)} == wanted


def test_deleted_rows_leave_storage_on_expiry(spark, table):
    table.expire(0.0, force=True)
    stored = spark.table(f"{table.name}__v4_data")
    assert stored.filter("k = 1").isEmpty()


def test_long_chains_are_written_out(spark, database, rows):
    t = VersionedTable(spark, f"{database}.deep", max_stacked=3)
    t.create(rows)
    for _ in range(8):
        t.update({"Sales": "Sales + 1"})
    assert [r["written"] for r in t.history().orderBy("version").collect()] == [
        True, False, False, False, True, False, False, False, True,
    ]
    assert sorted(r["Sales"] for r in t.current().collect()) == [18, 28, 38]


def test_stacked_views_are_counted_from_what_expiry_wrote(spark, database, rows):
    t = VersionedTable(spark, f"{database}.counted", max_stacked=3)
    t.create(rows)
    for _ in range(3):
        t.update({"Sales": "Sales + 1"})
    t.expire(0.0, force=True)
    t.update({"Sales": "Sales + 1"})
    assert not t.history().first()["written"]


def test_names_that_look_like_functions_are_no_reason_to_rewrite():
    from shelfcast.operators.versioned import is_unstable

    assert not is_unstable("user = 'b'", ["User"])
    assert not is_unstable("note = 'please select rand()'", ["note"])
    assert not is_unstable("`current_date` > 3 AND random_number > 1", ["current_date", "random_number"])
    for text in ("user = 'b'", "x > uniform(1, 2, 3)", "x IN (SELECT y FROM t)", "d < current_date", "d < now()"):
        assert is_unstable(text, ["x", "d"])


def test_column_names_of_an_update_ignore_case(spark, database, rows):
    t = VersionedTable(spark, f"{database}.cased")
    t.create(rows)
    t.update({"SALES": "0"})
    assert {r["Sales"] for r in t.current().collect()} == {0}


def test_moments_in_quotes_are_written_out(spark, database, rows):
    from shelfcast.operators.versioned import is_unstable

    for text in ["timestamp'now'", "CAST('today' AS DATE)", "date\" Tomorrow\"", "reflect('java.lang.Math', 'random')"]:
        assert is_unstable(text)
    assert not is_unstable("note = 'nobody knows'", ["note"])
    t = VersionedTable(spark, f"{database}.moments")
    t.create(rows.selectExpr("*", "CAST(NULL AS TIMESTAMP) AS seen"))
    t.update({"seen": "timestamp'now'"})
    first = bag(t.as_of_version(1))
    assert bag(t.as_of_version(1)) == first and t.history().first()["written"]


def test_unstable_expressions_are_written_out(spark, database, rows):
    t = VersionedTable(spark, f"{database}.unstable")
    t.create(rows)
    t.update({"Sales": "CAST(rand() * 1000000 AS BIGINT)"})
    assert t.history().first()["written"]
    assert bag(t.current()) == bag(t.current())


def test_failing_update_leaves_the_table_alone(spark, database, rows):
    t = VersionedTable(spark, f"{database}.failing")
    t.create(rows.withColumn("spc", rows.Sales.cast("double")))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        t.update({"spc": "Sales / Customers"})
    assert t.head() == 0
    assert bag(t.current().select("k")) == bag(rows.select("k"))


def test_left_over_rows_of_a_failed_commit_are_replaced(spark, database, rows):
    t = VersionedTable(spark, f"{database}.retry")
    t.create(rows)
    rows.limit(1).write.saveAsTable(f"{database}.retry__v1_data")  # no history row: not a version
    with pytest.raises(VersionNotFound):
        t.as_of_version(1)
    t.delete("k = 1")
    t.expire(0.0, force=True)
    assert bag(t.current().select("k")) == {(2,): 1, (3,): 1}


def test_create_twice_fails_and_drop_removes_everything(spark, table, database, rows):
    with pytest.raises(ValueError, match="exists"):
        table.create(rows)
    table.drop()
    assert spark.catalog.listTables(database) == []
    table.create(rows)
    assert table.head() == 0


def test_name_must_be_plain(spark):
    with pytest.raises(ValueError):
        VersionedTable(spark, "db.t; DROP TABLE x")


def test_unstable_delete_counts_what_it_wrote(spark, database, rows):
    t = VersionedTable(spark, f"{database}.unstable_delete")
    t.create(rows)
    t.delete("rand() >= 0")
    assert t.current().isEmpty()
    assert t.history().first()["rows_after"] == 0


def test_delete_with_a_subquery_does_not_follow_the_other_table(spark, database, rows):
    other = f"{database}.closed"
    spark.sql("SELECT 1L AS k").write.saveAsTable(other)
    t = VersionedTable(spark, f"{database}.subquery")
    t.create(rows)
    t.delete(f"k IN (SELECT k FROM {other})")
    spark.sql("SELECT 2L AS k").write.mode("overwrite").saveAsTable(other)
    assert bag(t.current().select("k")) == {(2,): 1, (3,): 1}
    assert t.history().first()["rows_after"] == 2
