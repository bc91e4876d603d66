from .diff import changed_rows, keyed_changes
from .enrich import enrich, with_states, with_stores
from .gold import gold_by_row, gold_fanout
from .joins import fanout_rows, keep_right_key_left_join, lookup_left_join, spread_left_join
from .mutations import add_column, delete_where, fill_nulls, update_where, upsert
from .quality import (
    approx_grouped_median,
    exact_grouped_median,
    null_count,
    null_profile,
    preview,
    row_count,
)
from .versioned import VersionedTable

__all__ = [
    "VersionedTable",
    "add_column",
    "approx_grouped_median",
    "changed_rows",
    "delete_where",
    "enrich",
    "exact_grouped_median",
    "fanout_rows",
    "fill_nulls",
    "gold_by_row",
    "gold_fanout",
    "keep_right_key_left_join",
    "keyed_changes",
    "lookup_left_join",
    "null_count",
    "null_profile",
    "preview",
    "row_count",
    "spread_left_join",
    "update_where",
    "upsert",
    "with_states",
    "with_stores",
]
