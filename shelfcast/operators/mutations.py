"""Row changes as pure transforms of a frame.

DELETE, UPDATE and ADD COLUMN are a filter and projections: no shuffle, and Catalyst folds a chain
of them into the scan. ``versioned.VersionedTable`` records them as versions of a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import as_column, fill_constant, holds, typed_null
from ..sizing import BROADCAST_LIMIT, fits_broadcast
from ..workspace import scratch_path, write_and_reopen
from .joins import spread_left_join

_SOURCE = "__src_"


def delete_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Drop the rows where the predicate is TRUE; rows where it is UNKNOWN stay.

    Written so that comparisons reach the scan. The predicate stands there twice, so it must be
    deterministic.
    """
    condition = as_column(predicate)
    return df.filter(~condition | condition.isNull())


def update_where(
    df: DataFrame, assignments: Mapping[str, Column | str], predicate: Column | str | None = None
) -> DataFrame:
    """Set columns where the predicate is TRUE (everywhere if there is none).

    Every right-hand side sees the old row; results are cast to the column's type, and column order
    and types stay as they were.
    """
    assignments = own_names(df, assignments)
    hit = None if predicate is None else holds(predicate)
    changed = {}
    for name, value in assignments.items():
        new = as_column(value)
        if hit is not None:
            new = F.when(hit, new).otherwise(F.col(f"`{name}`"))
        changed[name] = new.cast(df.schema[name].dataType)
    return df.withColumns(changed)


def own_names(df: DataFrame, given: Mapping[str, object]) -> dict:
    """The mapping under the frame's own column names; case does not matter, as in SQL."""
    names = {c.lower(): c for c in df.columns}
    unknown = sorted(k for k in given if k.lower() not in names)
    if unknown:
        raise ValueError(f"no such column(s): {unknown}")
    return {names[k.lower()]: v for k, v in given.items()}


def fill_nulls(df: DataFrame, constants: Mapping[str, float | int | str]) -> DataFrame:
    """Constant fill of NULLs; the same as an update of each column where it is NULL. NaN is a value
    and stays (``fillna`` would replace it)."""
    constants = own_names(df, constants)
    kinds = dict(df.dtypes)
    return df.withColumns({c: fill_constant(c, v).cast(kinds[c]) for c, v in constants.items()})


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Append a column of NULLs of the given type."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {name} exists")
    return df.withColumn(name, typed_null(kind))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Rows of ``target`` updated from the matching source row, plus the source rows without one.

    ``source`` has the columns of ``target``. A key that occurs twice in the source is an error; a
    NULL key matches nothing, so such source rows are inserted. Written as a left join and an anti
    join, not as a full outer join: adaptive execution cannot split a hot key of the latter. This way
    a small source is broadcast and the target is not shuffled; for a large one, hot target keys are
    spread, and the inserts need only the target's distinct keys.
    """
    keys = list(keys)
    if set(target.columns) != set(source.columns):
        raise ValueError("source and target must have the same columns")
    keyed_source = source.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    repeated = keyed_source.groupBy(*keys).count().filter("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"the source has more than one row for some {keys}")

    small = fits_broadcast(keyed_source, broadcast_limit)
    if not small:  # it is read several times below
        source = write_and_reopen(source, scratch_path(source.sparkSession, "upsert-source"))
        keyed_source = source.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    renamed = keyed_source.selectExpr(
        *[f"`{c}` AS `{_SOURCE}{c}`" for c in target.columns], f"true AS `{_SOURCE}`"
    )
    existing = target.select(*keys)
    if small:
        source_keys = F.broadcast(keyed_source.select(*keys))
        existing = existing.join(source_keys, keys, "left_semi")
    existing = existing.distinct()
    if small or len(keys) > 1:
        matched = F.expr(" AND ".join(f"`{k}` = `{_SOURCE}{k}`" for k in keys))
        joined = target.join(F.broadcast(renamed) if small else renamed, matched, "left")
    else:
        # The spread join drops its left key, so it gets a copy.
        copied = target.withColumn(_SOURCE + keys[0], F.col(keys[0]))
        joined = spread_left_join(copied, renamed, _SOURCE + keys[0])
    updated = joined.selectExpr(
        *[
            f"`{c}`" if c in keys else f"if(`{_SOURCE}`, `{_SOURCE}{c}`, `{c}`) AS `{c}`"
            for c in target.columns
        ]
    )
    inserted = source.join(existing, keys, "left_anti").select(*target.columns)
    return updated.unionByName(inserted)
