from __future__ import annotations

import os
import time

import pytest
from helpers import bag
from pyspark.sql import functions as F

from shelfcast.operators import lookup_left_join, with_states
from shelfcast.streaming import (
    append_batches,
    append_to_evolving_table,
    append_to_table,
    enrich_stream,
    infer_schema,
    open_file_stream,
    read_batches,
)

SCHEMA = "Store long, Sales long"


def land(spark, folder, rows, schema=SCHEMA):
    """One more file in the folder."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def forget_commit(checkpoint, batch_id):
    for name in (str(batch_id), f".{batch_id}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


def test_drained_stream_equals_batch_and_a_restart_adds_only_new_files(spark, path, database):
    table, checkpoint = f"{database}.bronze", f"{path}/checkpoint"
    for i in range(3):
        land(spark, f"{path}/in", [(i, 10 * i), (i, None)])
    schema = infer_schema(spark, f"{path}/in")
    stream = lambda: open_file_stream(spark, f"{path}/in", schema)
    append_to_table(stream(), table, checkpoint).awaitTermination()
    assert bag(spark.table(table)) == bag(spark.read.parquet(f"{path}/in"))
    append_to_table(stream(), table, checkpoint).awaitTermination()
    assert spark.table(table).count() == 6
    land(spark, f"{path}/in", [(9, 9)])
    append_to_table(stream(), table, checkpoint).awaitTermination()
    assert bag(spark.table(table)) == bag(spark.read.parquet(f"{path}/in"))


def test_a_new_checkpoint_on_a_filled_table_is_refused(spark, path, database):
    table = f"{database}.bronze"
    land(spark, f"{path}/in", [(1, 1)])
    schema = infer_schema(spark, f"{path}/in")
    stream = open_file_stream(spark, f"{path}/in", schema)
    append_to_table(stream, table, f"{path}/c1").awaitTermination()
    with pytest.raises(ValueError, match="do not belong together"):
        append_to_table(stream, table, f"{path}/c2")
    assert spark.table(table).count() == 1


def test_one_file_per_batch(spark, path):
    for i in range(4):
        land(spark, f"{path}/in", [(i, i)])
    stream = open_file_stream(spark, f"{path}/in", infer_schema(spark, f"{path}/in"))
    query = append_batches(stream, f"{path}/out", f"{path}/checkpoint")
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1, 1]
    folders = spark.read.parquet(f"{path}/out").select("_batch").distinct().count()
    assert folders == 4


def test_replayed_batch_is_written_once(spark, path):
    """A batch replayed after a lost commit lands in the same folder again."""
    land(spark, f"{path}/in", [(1, 1), (2, 2)])
    schema = infer_schema(spark, f"{path}/in")
    stream = open_file_stream(spark, f"{path}/in", schema)
    for _ in range(2):
        append_batches(stream, f"{path}/out", f"{path}/c1").awaitTermination()
        forget_commit(f"{path}/c1", 0)  # as if the query had died before it
    append_batches(stream, f"{path}/out", f"{path}/c1").awaitTermination()
    assert bag(read_batches(spark, f"{path}/out", schema)) == {(1, 1): 1, (2, 2): 1}


def test_two_checkpoints_on_one_path_keep_all_rows(spark, path):
    land(spark, f"{path}/a", [(i, i) for i in range(10)])
    land(spark, f"{path}/b", [(100 + i, i) for i in range(3)])
    schema = infer_schema(spark, f"{path}/a")
    for name in ("a", "b"):
        stream = open_file_stream(spark, f"{path}/{name}", schema)
        append_batches(stream, f"{path}/out", f"{path}/checkpoint-{name}").awaitTermination()
    assert read_batches(spark, f"{path}/out", schema).count() == 13


def test_a_file_that_lands_late_with_an_old_time_is_read(spark, path):
    land(spark, f"{path}/in", [(1, 1)])
    schema = infer_schema(spark, f"{path}/in")

    def drain():
        stream = open_file_stream(spark, f"{path}/in", schema)
        append_batches(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()

    drain()
    before = set(os.listdir(f"{path}/in"))
    land(spark, f"{path}/in", [(2, 2), (3, 3)])
    for name in set(os.listdir(f"{path}/in")) - before:
        os.utime(f"{path}/in/{name}", (time.time() - 30 * 86400,) * 2)
    drain()
    assert read_batches(spark, f"{path}/out", schema).count() == 3


def test_evolving_table_sink_adds_columns_and_replays_once(spark, path, database):
    table, wide = f"{database}.bronze", SCHEMA + ", spc double"

    def drain(schema):
        declared = spark.createDataFrame([], schema).schema
        stream = open_file_stream(spark, f"{path}/in", declared)
        append_to_evolving_table(stream, table, f"{path}/checkpoint").awaitTermination()

    land(spark, f"{path}/in", [(1, 1)])
    drain(SCHEMA)
    land(spark, f"{path}/in", [(2, 2, 0.5)], wide)
    drain(wide)
    forget_commit(f"{path}/checkpoint", 1)
    drain(wide)
    rows = bag(spark.table(table).select("Store", "Sales", "spc"))
    assert rows == {(1, 1, None): 1, (2, 2, 0.5): 1}


def test_later_batches_with_more_columns(spark, path):
    wide = SCHEMA + ", spc double"
    land(spark, f"{path}/in", [(1, 1)])
    for schema, rows in ((SCHEMA, []), (wide, [(2, 2, 0.5)])):
        if rows:
            land(spark, f"{path}/in", rows, wide)
        declared = spark.createDataFrame([], schema).schema
        stream = open_file_stream(spark, f"{path}/in", declared)
        append_batches(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    wanted = {(1, 1, None): 1, (2, 2, 0.5): 1}
    assert bag(read_batches(spark, f"{path}/out", declared)) == wanted
    assert bag(read_batches(spark, f"{path}/out").select("Store", "Sales", "spc")) == wanted


def test_stream_static_join_equals_batch_join(spark, path):
    land(spark, f"{path}/in", [(1, 10), (3, 30), (None, 5)])
    land(spark, f"{path}/in", [(2, 20)])
    states = spark.createDataFrame([(1, "BY"), (2, "HE")], "Store long, State string")
    schema = infer_schema(spark, f"{path}/in")
    wanted = bag(with_states(spark.read.parquet(f"{path}/in"), states))
    for limit in (0, 1 << 20):
        stream = open_file_stream(spark, f"{path}/in", schema)
        enriched = enrich_stream(stream, states, "Store", broadcast_limit=limit)
        out = f"{path}/out{limit}"
        append_batches(enriched, out, f"{path}/c{limit}").awaitTermination()
        assert bag(read_batches(spark, out, enriched.schema)) == wanted
        # The same inside the sink, where a batch join may spread hot keys.
        append_batches(
            open_file_stream(spark, f"{path}/in", schema),
            f"{path}/batch{limit}",
            f"{path}/cb{limit}",
            transform=lambda batch: lookup_left_join(batch, states, "Store", broadcast_limit=limit),
        ).awaitTermination()
        assert bag(read_batches(spark, f"{path}/batch{limit}", enriched.schema)) == wanted


def test_processing_time_trigger_keeps_running(spark, path, database):
    table = f"{database}.bronze"
    land(spark, f"{path}/in", [(1, 1)])
    schema = infer_schema(spark, f"{path}/in")
    stream = open_file_stream(spark, f"{path}/in", schema)
    query = append_to_table(stream, table, f"{path}/c", every="1 seconds")
    try:
        land(spark, f"{path}/in", [(2, 2)])
        deadline = time.time() + 60
        while time.time() < deadline and spark.table(table).count() < 2:
            time.sleep(0.5)
            spark.catalog.refreshTable(table)
        assert query.isActive
    finally:
        query.stop()
    assert spark.table(table).agg(F.sum("Sales")).first()[0] == 3
