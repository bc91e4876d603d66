from __future__ import annotations

import os
from types import SimpleNamespace

import pyarrow as pa
import pytest

from shelfcast import workspace
from shelfcast.workspace import scratch_path, write_and_reopen


def session(**settings):
    names = {k.replace("_", "."): v for k, v in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: names.get(k, default)))


def test_the_folder_named_by_the_session_is_used():
    spark = session(spark_checkpoint_dir="hdfs://shared/dir/", spark_master="yarn")
    assert workspace.shared_dir(spark) == "hdfs://shared/dir"
    first, second = (workspace.scratch_path(spark, "x") for _ in range(2))
    assert first.startswith("hdfs://shared/dir/shelfcast/x-") and first != second


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_dir(session(spark_master="yarn"))


def test_a_local_session_without_the_setting_gets_one_temporary_folder():
    spark = session(spark_master="local[2]")
    assert workspace.shared_dir(spark) == workspace.shared_dir(spark)


def test_written_frames_keep_schema_and_rows(spark, path):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS FLOAT) AS f, TIMESTAMP_NTZ '2024-01-01' AS t")
    again = workspace.write_and_reopen(df, path)
    assert again.dtypes == df.dtypes and again.collect() == df.collect()


def test_drop_database_stops_streams_and_removes_tables(spark, database, path):
    from shelfcast.streaming import append_to_table, open_file_stream

    spark.range(3).write.parquet(f"{path}/in")
    stream = open_file_stream(spark, f"{path}/in", spark.range(1).schema)
    append_to_table(stream, f"{database}.t", f"{path}/checkpoint", every="1 seconds")
    workspace.drop_database(spark, database)
    assert not spark.streams.active
    assert not spark.catalog.databaseExists(database)
    workspace.drop_database(spark, database)


def test_a_scope_removes_what_was_written_in_it(spark):
    from shelfcast.workspace import scratch_scope

    kept = scratch_path(spark, "kept")
    with scratch_scope(spark) as made:
        inner = write_and_reopen(spark.range(3), scratch_path(spark, "inner"))
        inner.write.parquet(kept)
    assert len(made) == 1 and not os.path.exists(made[0].removeprefix("file:"))
    assert spark.read.parquet(kept).count() == 3


def test_python_tasks_get_batches_of_bounded_rows_inside_the_block(spark):
    from shelfcast.workspace import arrow_rows

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    def largest():
        return max(r.n for r in spark.range(0, 5000, 1, 1).mapInArrow(run, "n long").collect())

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with arrow_rows(spark, 700):
        assert largest() == 700
        with arrow_rows(spark, 900):  # a smaller bound stays
            assert largest() == 700
    assert spark.conf.get(name) == before and largest() == 5000
