"""Gold: predictions joined back to the cleaned transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..sizing import BROADCAST_LIMIT, fits_broadcast
from .joins import fanout_rows, lookup_left_join


class FanoutTooLarge(ValueError):
    """The store-level gold table would have more rows than the caller allows."""


def gold_fanout(
    silver: DataFrame,
    scoring: DataFrame,
    *,
    row_budget: int | None = None,
    **options,
) -> DataFrame:
    """Silver ⟕ scoring on Store: many-to-many, the Store kept is the scoring side's.

    Scoring has a row per test transaction, so a store with n transactions and m scored ones gets
    n * max(1, m) rows; nothing can make that smaller. Beyond a broadcast, hot stores are spread over
    a salt grid (``options`` go to ``lookup_left_join``). With ``row_budget`` the exact size is
    computed first, from per-store counts, and a result beyond it is refused whole; ``gold_by_row``
    is the mode that grows with the data. ``scoring`` should be a written table.
    """
    if row_budget is not None:
        expected = int(fanout_rows(silver, scoring, schemas.KEY).first()["n_rows"])
        if expected > row_budget:
            raise FanoutTooLarge(f"{expected} rows expected, {row_budget} allowed")
    return lookup_left_join(silver, scoring.select(*schemas.SCORING_COLUMNS), schemas.KEY, **options)


def gold_by_row(
    silver: DataFrame,
    scored: DataFrame,
    row_key: str = schemas.ROW_KEY,
    *,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """One row per transaction: its own prediction where it was scored, else NULL.

    The row key is unique, so the join is even by nature.
    """
    right = scored.select(
        F.col(row_key).alias("__scored_row"),
        "prediction",
        F.col("Real_Sales"),
    )
    if fits_broadcast(right, broadcast_limit):
        right = F.broadcast(right)
    return silver.join(right, F.col(row_key) == F.col("__scored_row"), "left").drop("__scored_row")
