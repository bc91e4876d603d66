"""Declared schemas and column lists of the retail data model.

Every file read states its schema: nothing is inferred, so a reader never opens footers or
scans text only to learn types, and a stream and a batch over the same folder agree.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(fields: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields.items()])


# The data model's column names, order and types.
TRANSACTIONS = _struct(
    {
        "Store": "long",
        "DayOfWeek": "long",
        "Date": "timestamp",
        "Sales": "long",
        "Customers": "long",
        "Open": "long",
        "Promo": "long",
        "StateHoliday": "string",
        "SchoolHoliday": "long",
    }
)

STATES = _struct({"Store": "long", "State": "string", "Latitude": "float", "Longitude": "float"})

STORES = _struct(
    {
        "Store": "long",
        "StoreType": "string",
        "Assortment": "string",
        "CompetitionDistance": "long",
        "CompetitionOpenSinceMonth": "long",
        "CompetitionOpenSinceYear": "long",
        "Promo2": "long",
        "Promo2SinceWeek": "long",
        "Promo2SinceYear": "long",
        "PromoInterval": "string",
    }
)

# The numeric model inputs, in order, and the label.
FEATURES = [
    "Store",
    "DayOfWeek",
    "Customers",
    "Open",
    "Promo",
    "SchoolHoliday",
    "Latitude",
    "Longitude",
    "CompetitionDistance",
    "CompetitionOpenSinceMonth",
    "CompetitionOpenSinceYear",
    "Promo2",
    "Promo2SinceWeek",
    "Promo2SinceYear",
]
LABEL = "Sales"
CATEGORIES = ["StoreType", "Assortment", "StateHoliday"]
SCORING_COLUMNS = ["Store", "prediction", "Real_Sales"]

KEY = "Store"
ROW_KEY = "RowId"

# Column order after each left join: the fact without its key, then all of the lookup side.
TRANSACTIONS_AND_STATES_COLUMNS = [c for c in TRANSACTIONS.names if c != KEY] + STATES.names
SILVER_COLUMNS = [c for c in TRANSACTIONS_AND_STATES_COLUMNS if c != KEY] + STORES.names
GOLD_COLUMNS = [c for c in SILVER_COLUMNS if c != KEY] + SCORING_COLUMNS

# The driver tables that the test mapping reads (sources/retail.py).
ORDERS = _struct(
    {
        "o_orderkey": "long",
        "o_custkey": "long",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    }
)
CUSTOMER = _struct(
    {
        "c_custkey": "long",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    }
)
NATION = _struct({"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"})
SUPPLIER = _struct(
    {"s_suppkey": "long", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"}
)

#: Features with few values each.
FEW_VALUED_FEATURES = ["DayOfWeek", "Open", "Promo", "SchoolHoliday", "Promo2"]
#: Features with few values each and many missing ones.
MISSING_FEATURES = ["CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2SinceWeek"]
