"""Store and location data added to transactions.

The two left joins chain: the second one uses the Store that survived the first, so a store without
a state also gets no store attributes. Since that condition rejects NULLs of the middle table,
``(tx ⟕ states) ⟕ stores`` equals ``tx ⟕ (states ⟕ stores)``. ``enrich`` uses the second form: the
two small tables are joined once, and the transactions take part in one join instead of two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..sizing import BROADCAST_LIMIT, fits_broadcast
from ..workspace import scratch_path, write_and_reopen
from .joins import keep_right_key_left_join, lookup_left_join, spread_left_join

_LOOKUP_KEY = "__lookup_store"


def with_states(tx: DataFrame, states: DataFrame, **options) -> DataFrame:
    """First join alone: transactions and locations."""
    return lookup_left_join(tx, states, schemas.KEY, **options)


def with_stores(located: DataFrame, stores: DataFrame, **options) -> DataFrame:
    """Second join alone: on the Store column the first join left."""
    return lookup_left_join(located, stores, schemas.KEY, **options)


def store_lookup(states: DataFrame, stores: DataFrame) -> DataFrame:
    """``states ⟕ stores``: one row set per located store, under the key ``__lookup_store``."""
    key = schemas.KEY
    # A location without a store number matches no transaction: none of its rows is in the result.
    located = states.filter(F.col(key).isNotNull()).withColumnRenamed(key, _LOOKUP_KEY)
    return located.join(stores, located[_LOOKUP_KEY] == stores[key], "left")


def enrich(
    tx: DataFrame, states: DataFrame, stores: DataFrame, *, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Both joins at once; the columns are those of ``SILVER_COLUMNS`` plus any extra ones of tx.

    A lookup too large to broadcast is written first: looking for its hot keys and joining then read
    it, and the two tables behind it are joined no second time.
    """
    key = schemas.KEY
    # The outer join is on the location's Store; the output keeps the store table's.
    lookup = store_lookup(states, stores).withColumnsRenamed({key: "__store", _LOOKUP_KEY: key})
    if fits_broadcast(lookup, broadcast_limit):
        joined = keep_right_key_left_join(tx, F.broadcast(lookup), key)
    else:
        written = write_and_reopen(lookup, scratch_path(tx.sparkSession, "store-lookup"))
        joined = spread_left_join(tx, written, key)
    return joined.drop(key).withColumnRenamed("__store", key)
