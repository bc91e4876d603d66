"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.workspace import scratch_path, write_and_reopen


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node each node of the edges ``(a, b)`` is connected with.

    Each round takes the smallest label around a node and then that label's own label; the state is
    written, so a round is never computed twice. Labels are combined before they are shuffled.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = write_and_reopen(both.filter("a <> b").distinct(), scratch_path(spark, f"{label}-edges"))
    state = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    state = write_and_reopen(state, scratch_path(spark, f"{label}-0"))
    step = 0
    while True:
        step += 1
        around = (
            both.join(state, both["b"] == state["node"])
            .groupBy("a")
            .agg(F.min("component").alias("nearby"))
            .join(state, F.col("a") == F.col("node"))
            .select("node", F.col("component").alias("old"), F.least("component", "nearby").alias("label"))
        )
        jump = state.select(F.col("node").alias("label"), F.col("component").alias("further"))
        moved = around.join(jump, "label").select("node", "old", F.least("label", "further").alias("component"))
        moved = write_and_reopen(moved, scratch_path(spark, f"{label}-{step}"))
        state = moved.select("node", "component")
        if moved.filter("old <> component").isEmpty():
            return state


def labelled(rows: DataFrame, found: DataFrame, column: str, label: str) -> DataFrame:
    """Adds the component of a column's node: its own name where it has no link."""
    labels = found.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    joined = rows.join(labels, rows[column] == F.col("_node"), "left")
    return joined.withColumn(label, F.coalesce("_component", column)).drop("_node", "_component")


def joined_components(found: DataFrame, edges: DataFrame, label: str) -> DataFrame:
    """(node, component) after more edges ``(a, b)``: only the components that these join are looked at again."""
    spark = found.sparkSession
    ends = labelled(labelled(edges.select("a", "b"), found, "a", "p"), found, "b", "q")
    ends = ends.filter("p <> q").select(F.col("p").alias("a"), F.col("q").alias("b")).distinct()
    ends = write_and_reopen(ends, scratch_path(spark, f"{label}-between"))
    if ends.isEmpty():
        return found
    top = components(ends, label)  # a component is named by its smallest node, so the names' smallest is the new name
    moved = top.select(F.col("node").alias("component"), F.col("component").alias("_new"))
    old = found.join(moved, "component", "left").select("node", F.coalesce("_new", "component").alias("component"))
    new = top.join(found.select("node"), "node", "left_anti").select("node", "component")
    return write_and_reopen(old.unionByName(new), scratch_path(spark, f"{label}-joined"))
