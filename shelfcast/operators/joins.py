"""Left joins that stay right and even at scale.

The retail joins drop the LEFT key and keep the RIGHT one, so a row without a partner loses its
key: that is part of the result. Three strategies give it, chosen by measurement:

* the lookup side is measured and broadcast when it fits: the fact is not shuffled at all;
* beyond that both sides are shuffled on the key, and adaptive execution may split what it finds;
* keys that hold a large share of either side are first spread over a grid of salts, so that no
  single task gets a hot key's rows, on whichever side they are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sizing import BROADCAST_LIMIT, fits_broadcast
from ..workspace import scratch_path, write_and_reopen

#: A key is hot when it holds this part of a task's mean share of the rows: the threshold falls with
#: the number of shuffle partitions.
HOT_PART = 0.5

#: Counters of a sketch per hot key that there can be, groups of partitions whose sketches are merged first, and
#: the largest sketch Spark makes.
_COUNTERS, _GROUPS, _MOST_COUNTERS = 4, 64, 1_000_000

#: Splits per partition's share of rows. Salts fall into partitions by hash; more and smaller pieces
#: fill them more evenly.
PIECES = 4

_LEFT_KEY, _ROW, _CELL = "__left_key", "__salt_row", "__salt_cell"


def keep_right_key_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` without its key, then all of ``right``; unmatched rows get a NULL key.

    The left key is renamed before the join, so frames with a common ancestor do not clash.
    """
    _reject_shared_columns(left, right, key)
    keyed = left.withColumnRenamed(key, _LEFT_KEY)
    return keyed.join(right, F.col(_LEFT_KEY) == F.col(key), "left").drop(_LEFT_KEY)


def lookup_left_join(
    fact: DataFrame,
    lookup: DataFrame,
    key: str,
    *,
    broadcast_limit: int = BROADCAST_LIMIT,
    hot_share: float | None = None,
) -> DataFrame:
    """Key-dropping left join of a fact with a lookup of unknown size. A lookup too large to broadcast
    is written first: it is read for its hot keys and for the join."""
    if fits_broadcast(lookup, broadcast_limit):
        return keep_right_key_left_join(fact, F.broadcast(lookup), key)
    lookup = write_and_reopen(lookup, scratch_path(fact.sparkSession, "lookup"))
    return spread_left_join(fact, lookup, key, hot_share=hot_share)


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> list[tuple[object, float]]:
    """Keys holding at least ``share`` of the rows, each with its share, largest first.

    By default a key is hot from ``HOT_PART`` of a shuffle partition's mean share. One pass over the key
    column with sketches, merged per group of partitions and then once more, so that no task gets all
    of them; never more than ``1/share`` results. Used only to place rows: a miss costs balance, not
    correctness.
    """
    share = _hot_share(df) if share is None else share
    wanted = math.ceil(1 / share)
    tracked = min(_MOST_COUNTERS, 1 << max(8192, _COUNTERS * wanted).bit_length())
    wanted = min(wanted, tracked // _COUNTERS)
    group = F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).alias("__group")
    part = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("__k"), group)
    if part.isEmpty():
        return []
    sketches = part.groupBy("__group").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(__k, {tracked})").alias("s")
    )
    row = (
        sketches.coalesce(1)  # Spark can't combine in a task without sketches
        .agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
        .selectExpr("n", f"approx_top_k_estimate(s, {wanted}) AS top")
        .first()
    )
    shares = [(item["item"], item["count"] / row["n"]) for item in row["top"]]
    return [(value, part) for value, part in shares if part >= share]


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    hot_share: float | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Key-dropping left join by shuffle, with hot keys laid out on a salt grid.

    A hot left key's rows are split over the grid's rows and the partners repeated there; a hot
    right key's rows are split over its columns and the left rows repeated. Each pair meets in
    exactly one cell, so the result is that of the plain join. Each hot key has a grid of its own size,
    by its share (to a power of two), so no piece is larger than a part of a task's mean share. A left
    row repeated over columns finds no partner in some of them; these copies are dropped, which is safe because a hot right
    key has a partner in at least one.

    Salts hash the row (``spread_by``, default: all left columns), so a retried task places its
    rows as before. Identical rows share a salt; adaptive skew splitting deals with those.
    """
    _reject_shared_columns(left, right, key)
    splits = PIECES * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot_left, hot_right = hot_keys(left, key, hot_share), hot_keys(right, key, hot_share)
    rows = lambda c: _grid_size(c, hot_left, splits)
    cells = lambda c: _grid_size(c, hot_right, splits)

    left_key, right_key = F.col(_LEFT_KEY), F.col(key)
    is_hot_right = lambda c: cells(c) > 1

    placed_left = left.withColumnRenamed(key, _LEFT_KEY)
    names = [_LEFT_KEY if n == key else n for n in spread_by or left.columns]
    # NULL keys never match; spreading them keeps them out of one partition.
    placed_left = placed_left.withColumn(
        _ROW,
        F.when(left_key.isNull(), _salt(names, F.lit(splits))).otherwise(_salt(names, rows(left_key))),
    )
    placed_right = right.withColumn(_CELL, _salt(right.columns, cells(right_key)))
    if hot_right:
        placed_left = placed_left.withColumn(_CELL, _repeat(cells(left_key)))
    else:
        placed_left = placed_left.withColumn(_CELL, F.lit(0))
    if hot_left:
        placed_right = placed_right.withColumn(_ROW, _repeat(rows(right_key)))
    else:
        placed_right = placed_right.withColumn(_ROW, F.lit(0))

    a, b = placed_left.alias("a"), placed_right.alias("b")
    on = (
        (F.col(f"a.{_LEFT_KEY}") == F.col(f"b.{key}"))
        & (F.col(f"a.{_ROW}") == F.col(f"b.{_ROW}"))
        & (F.col(f"a.{_CELL}") == F.col(f"b.{_CELL}"))
    )
    joined = a.join(b, on, "left")
    if hot_right:
        joined = joined.filter(~is_hot_right(F.col(f"a.{_LEFT_KEY}")) | F.col(f"b.{key}").isNotNull())
    return joined.selectExpr(
        *[f"a.`{n}`" for n in left.columns if n != key], *[f"b.`{n}`" for n in right.columns]
    )


def fanout_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Row count of the left join without making its rows: each side is counted per key first.

    One row, ``n_rows`` as decimal(38,0): per key it is n_left * max(1, n_right).
    """
    per_left = left.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    per_right = (
        right.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("rk"))
        .agg(F.count(F.lit(1)).alias("m"))
    )
    wide = "decimal(19,0)"
    produced = F.col("n").cast(wide) * F.coalesce(F.col("m"), F.lit(1)).cast(wide)
    total = F.coalesce(F.sum(produced.cast("decimal(38,0)")), F.lit(0))
    return per_left.join(per_right, F.col("k") == F.col("rk"), "left").agg(
        total.cast("decimal(38,0)").alias("n_rows")
    )


def _reject_shared_columns(left: DataFrame, right: DataFrame, key: str) -> None:
    lower = key.lower()
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {lower}
    if shared:
        raise ValueError(f"both sides have column(s) {sorted(shared)}; rename one side first")


def _hot_share(df: DataFrame) -> float:
    return min(0.5, HOT_PART / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _grid_size(column: Column, hot: list[tuple[object, float]], splits: int) -> Column:
    """Pieces of a key's rows, by its share of a side that is cut into ``splits`` pieces; 1 for keys that
    are not hot. Sizes are powers of two, so there are few classes of keys to tell apart."""
    classes: dict[int, list[object]] = {}
    for value, share in hot:
        pieces = 1 << max(1, math.ceil(share * splits) - 1).bit_length()
        classes.setdefault(max(pieces, 2 * PIECES), []).append(value)
    size = F.lit(None).cast("int")
    for pieces, values in classes.items():
        size = F.when(column.isin(values), F.lit(pieces)).otherwise(size)
    return F.coalesce(size, F.lit(1))


def _salt(columns: Sequence[str], splits: Column) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), splits).cast("int")


def _repeat(splits: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), splits - 1))
