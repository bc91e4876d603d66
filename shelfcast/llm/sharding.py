"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every (record key, shard) pair has a pseudo-random number of its own; a record belongs to the shard
with the highest score ``-weight / ln(u)``. A shard gets records in proportion to its weight, and a
shard that is added takes over only the records it wins: no record moves between older shards.
Assignment is one projection without shuffle; only the numbering inside the shards shuffles, and it
carries no text.

Defined results: a NULL key is a key of its own (all such records share a shard); NULL or empty texts
are ordinary records; repeated rows share a shard and get slots of their own; an empty table gives an
empty result; columns other than the key, also those named like the result's, pass or are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard that one task numbers; larger shards are split into ranges of the key's hash.
SLOT_ROWS = 100_000

_DIGITS = 13  # hexadecimal digits of the digest that are used: 52 bits, exact in a double


def _unit(text: Column) -> Column:
    """A number in (0, 1) from a digest of the text."""
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, _DIGITS), 16, 10).cast("double")
    return (digits + F.lit(0.5)) / F.lit(float(16**_DIGITS))


def record_key(*columns: Column) -> Column:
    """One text for the key columns; NULL differs from every value."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.concat_ws("\x1f", *parts)


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The number of the shard that wins the key; shards with weight 0 win none."""
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    scores = [
        F.struct((F.lit(-float(w)) / F.ln(_unit(F.concat(key, F.lit(f"#{i}"))))).alias("s"), F.lit(-i).alias("i"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    best = scores[0] if len(scores) == 1 else F.array_max(F.array(*scores))
    return (-best["i"]).cast("int")


def shard_records(
    docs: DataFrame, weights: Sequence[float], keys: Sequence[str] = ("doc_id",), column: str = "shard"
) -> DataFrame:
    """``docs`` with the shard of each record; no shuffle. An existing ``column`` is replaced."""
    return docs.withColumn(column, rendezvous_shard(record_key(*(docs[k] for k in keys)), weights))


def number_slots(
    rows: DataFrame, keys: Sequence[str], shard: str = "shard", slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard, by a digest of all ``keys`` and then their values.

    A shard is numbered in as many ranges of the digest as its size asks for, each by a task of its own, and the
    counts of the ranges before are added. The order does not depend on the number of ranges. Rows with equal keys may
    take each other's slots. Pass narrow rows: they are shuffled.
    """
    largest = rows.groupBy(shard).count().agg(F.max("count")).first()[0] or 0
    ranges = max(1, -(-largest // slot_rows))
    at = _unit(record_key(*(rows[k] for k in keys)))
    ranged = rows.withColumn("_at", at).withColumn("_range", F.floor(F.col("_at") * ranges).cast("int"))
    groups = [shard, "_range"]
    before = (
        ranged.groupBy(*groups)
        .count()
        .select(
            *groups,
            (F.sum("count").over(Window.partitionBy(shard).orderBy("_range")) - F.col("count")).alias("_before"),
        )
    )
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy("_at", *keys))
    return (
        ranged.withColumn("_rank", rank)
        .join(before, groups)
        .withColumn("slot", F.col("_before") + F.col("_rank") - 1)
        .drop("_at", "_range", "_rank", "_before")
    )


def write_shards(docs: DataFrame, path: str, column: str = "shard") -> None:
    """One folder per shard, written without a shuffle: each task adds a file to every shard it has rows of."""
    docs.write.mode("errorifexists").partitionBy(column).parquet(path)
