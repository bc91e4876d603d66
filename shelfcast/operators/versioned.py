"""A table with versions, history, time travel, rollback and expiry, made of Spark views.

Every version of ``db.t`` is the view ``db.t__v<n>``; ``db.t`` itself is a view of the newest one,
and ``db.t__history`` has a row per commit. A version that brings rows in (create, replace, upsert)
is a written table behind its view. A delete, update or added column is only a view over the version
before it: nothing is rewritten, and at read time Catalyst folds the chain into one scan. Expiry
writes out what must stay and drops the rest, files included.

One writer per table; concurrent commits are not coordinated. The history row is written last: a
version without one does not exist, and a retry overwrites what a failed commit left behind.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .diff import changed_rows
from .mutations import own_names, upsert

#: Retention below which expiry must be forced.
SAFE_RETENTION_HOURS = 168.0
#: Views stacked on a written version before a commit writes the rows out again.
MAX_STACKED_VIEWS = 16

# Functions of the moment, of chance or of the placement of rows. An expression that calls one, or
# holds a subquery (whose tables can change), may give another value at a later read and is written out at commit.
_UNSTABLE_CALLS = frozenset(
    """rand randn random uniform randstr uuid shuffle now current_date current_timestamp current_time current_timezone
    current_user current_catalog current_database current_schema localtimestamp curdate user session_user
    monotonically_increasing_id spark_partition_id input_file_name input_file_block_start input_file_block_length
    unix_timestamp reflect try_reflect java_method""".split()
)
# Those of them that may stand without parentheses.
_UNSTABLE_NAMES = frozenset("current_date current_timestamp current_time current_user localtimestamp user session_user".split())
# Texts that a date or timestamp literal, or a cast, takes for a moment of today.
_MOMENTS = ("now", "today", "tomorrow", "yesterday")
_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`")
_NAME = re.compile(r"([A-Za-z_]\w*)\s*(\()?")


def is_unstable(expression: str, columns: Sequence[str] = ()) -> bool:
    """Whether an SQL expression may change its value. Column names don't count, and text literals only if they could
    be read as a moment: such a version is written out, which costs more and is never wrong."""
    own = {c.lower() for c in columns}
    if any(q[0] != "`" and q[1:-1].strip().lower().startswith(_MOMENTS) for q in _QUOTED.findall(expression)):
        return True
    for name, call in _NAME.findall(_QUOTED.sub(" ", expression)):
        name = name.lower()
        if name == "select" or (name in _UNSTABLE_CALLS if call else name in _UNSTABLE_NAMES - own):
            return True
    return False


_HISTORY = (
    "version BIGINT, committed_at TIMESTAMP, operation STRING, parameters MAP<STRING, STRING>, "
    "parent BIGINT, written BOOLEAN, rows_before BIGINT, rows_changed BIGINT, rows_after BIGINT"
)


class VersionNotFound(LookupError):
    """No such version, or it has expired."""


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


class VersionedTable:
    def __init__(
        self,
        spark: SparkSession,
        name: str,
        clock: Callable[[], datetime] = _utc_now,
        max_stacked: int = MAX_STACKED_VIEWS,
    ) -> None:
        """``max_stacked``: views over written rows before a commit writes them again, which is a pass
        over the whole table; more views make plans longer, fewer make commits dearer."""
        if not re.fullmatch(r"\w+(\.\w+){0,2}", name):
            raise ValueError(f"not a table name: {name!r}")
        self.spark, self.name, self._clock, self.max_stacked = spark, name, clock, max_stacked
        self._history_table = f"{name}__history"

    # -- commits ---------------------------------------------------------------------------------

    def create(self, df: DataFrame) -> int:
        """Version 0."""
        history = self._history_table
        if self._exists(history) and not self.spark.table(history).isEmpty():
            raise ValueError(f"{self.name} exists")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {history} ({_HISTORY}) USING parquet"
        )
        return self._commit(
            0,
            "CREATE TABLE AS SELECT",
            {},
            parent=None,
            written=True,
            rows_before=None,
            rows_changed=None,
            rows_after=self._write(0, df),
        )

    def drop(self) -> None:
        """Remove the table with all its versions."""
        if self._exists(self._history_table):
            for row in self.spark.table(self._history_table).select("version").collect():
                self._drop_version(row["version"])
            self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
            self.spark.sql(f"DROP TABLE {self._history_table}")

    def delete(self, where: str) -> int:
        """Remove the rows where the SQL predicate is TRUE."""
        log = self._log()
        parent, before = log[-1]["version"], log[-1]["rows_after"]
        hits = after = None
        source = self.spark.table(self._view(parent))
        unstable = is_unstable(where, source.columns)
        if not unstable:
            hits = source.agg(F.count_if(F.expr(where))).first()[0]
            after = before - hits
        # The second form reaches the scan, but evaluates the predicate twice.
        kept = f"NOT coalesce(({where}), false)" if unstable else f"NOT ({where}) OR ({where}) IS NULL"
        query = f"SELECT * FROM {self._view(parent)} WHERE {kept}"
        return self._derive(log, "DELETE", {"where": where}, query, hits, after, where)

    def update(self, assignments: Mapping[str, str], where: str | None = None) -> int:
        """Set columns to SQL expressions over the old row, where the predicate is TRUE.

        The expressions are evaluated once over the affected rows before the commit, so one that
        fails is reported here and not by later readers.
        """
        log = self._log()
        source = self._view(log[-1]["version"])
        current = self.spark.table(source)
        assignments = own_names(current, assignments)
        hit = "true" if where is None else f"coalesce(({where}), false)"
        items, new_values = [], []
        for field in current.schema:
            column, item = f"`{field.name}`", f"`{field.name}`"
            if field.name in assignments:
                choice = f"CASE WHEN {hit} THEN ({assignments[field.name]}) ELSE {column} END"
                value = f"CAST({choice} AS {field.dataType.simpleString()})"
                new_values.append(F.expr(value))
                item = f"{value} AS {column}"
            items.append(item)
        expressions = " ".join([*assignments.values(), where or ""])
        hits = None
        if not is_unstable(expressions, current.columns):
            check = current.agg(F.count_if(F.expr(hit)), F.max(F.xxhash64(*new_values)))
            hits = check.first()[0]
        parameters = {f"set {c}": e for c, e in assignments.items()}
        if where is not None:
            parameters["where"] = where
        query = f"SELECT {', '.join(items)} FROM {source}"
        rows = log[-1]["rows_after"]
        return self._derive(log, "UPDATE", parameters, query, hits, rows, expressions)

    def add_column(self, name: str, kind: str) -> int:
        log = self._log()
        source = self._view(log[-1]["version"])
        if name.lower() in {c.lower() for c in self.spark.table(source).columns}:
            raise ValueError(f"column {name} exists")
        query = f"SELECT *, CAST(NULL AS {kind}) AS `{name}` FROM {source}"
        parameters = {"column": name, "type": kind}
        return self._derive(log, "ADD COLUMNS", parameters, query, 0, log[-1]["rows_after"])

    def rollback(self, version: int) -> int:
        """Make an earlier version's rows the newest version; the versions between stay readable."""
        log = self._log()
        found = self._find(log, version)
        query = f"SELECT * FROM {self._view(version)}"
        parameters = {"version": str(version)}
        return self._derive(
            log, "RESTORE", parameters, query, None, found["rows_after"], parent=version
        )

    def merge(self, source: DataFrame, keys: Sequence[str]) -> int:
        """Upsert: update the rows the source matches, insert the others. Written out."""
        log = self._log()
        merged = upsert(self.spark.table(self._view(log[-1]["version"])), source, keys)
        return self._store(log, "MERGE", {"keys": ", ".join(keys)}, merged)

    def replace(self, df: DataFrame) -> int:
        """New contents and schema; ``df`` may read this table."""
        return self._store(self._log(), "OVERWRITE", {}, df)

    # -- reads -----------------------------------------------------------------------------------

    def history(self) -> DataFrame:
        """One row per commit, newest first."""
        return self.spark.table(self._history_table).orderBy(F.desc("version"))

    def head(self) -> int:
        return self._log()[-1]["version"]

    def current(self) -> DataFrame:
        return self.spark.table(self._view(self.head()))

    def as_of_version(self, version: int) -> DataFrame:
        self._find(self._log(), version)
        return self.spark.table(self._view(version))

    def version_at(self, moment: datetime) -> int:
        """The newest version committed at or before ``moment``."""
        found = [r["version"] for r in self._log() if r["at"] <= _micros(moment)]
        if not found:
            raise VersionNotFound(f"{self.name} had no version at {moment}")
        return found[-1]

    def as_of_timestamp(self, moment: datetime) -> DataFrame:
        return self.as_of_version(self.version_at(moment))

    def changes(self, from_version: int, to_version: int) -> DataFrame:
        """Rows added and removed between two versions, with their number of copies."""
        return changed_rows(self.as_of_version(from_version), self.as_of_version(to_version))

    def readable_versions(self) -> list[int]:
        return [r["version"] for r in self._log() if self._exists(self._view(r["version"]))]

    # -- expiry ----------------------------------------------------------------------------------

    def expire(self, retain_hours: float = SAFE_RETENTION_HOURS, force: bool = False) -> list[int]:
        """Drop the versions superseded more than ``retain_hours`` ago; returns their numbers.

        The newest version always stays. A kept version that is a view over a dropped one is written
        out first, so rows deleted since are then gone from storage too.
        """
        if retain_hours < SAFE_RETENTION_HOURS and not force:
            raise ValueError(f"retention under {SAFE_RETENTION_HOURS:g} hours must be forced")
        limit = _micros(self._clock() - timedelta(hours=retain_hours))
        log = self._log()
        readable = {r["version"] for r in log if self._exists(self._view(r["version"]))}
        expired = [
            r["version"]
            for r, following in zip(log, log[1:])
            if following["at"] < limit and r["version"] in readable
        ]
        for row in log:
            version = row["version"]
            stays = version in readable and version not in expired
            if stays and row["parent"] in expired and not self._exists(self._data(version)):
                self._write(version, self.spark.table(self._view(version)))
        for version in reversed(expired):
            self._drop_version(version)
        return expired

    # -- parts -----------------------------------------------------------------------------------

    def _view(self, version: int) -> str:
        return f"{self.name}__v{version}"

    def _data(self, version: int) -> str:
        return f"{self.name}__v{version}_data"

    def _exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def _log(self) -> list[Row]:
        """The commits, oldest first: a few fields each, and only as many rows as commits."""
        rows = (
            self.spark.table(self._history_table)
            .select(
                "version",
                F.unix_micros("committed_at").alias("at"),
                "parent",
                "written",
                "rows_after",
            )
            .collect()
        )
        if not rows:
            raise VersionNotFound(f"{self.name} has no version")
        return sorted(rows, key=lambda r: r["version"])

    def _find(self, log: list[Row], version: int) -> Row:
        """The commit of a readable version. The history row is what makes a version exist."""
        for row in log:
            if row["version"] == version:
                if not self._exists(self._view(version)):
                    raise VersionNotFound(f"version {version} of {self.name} has expired")
                return row
        raise VersionNotFound(f"{self.name} has no version {version}")

    def _write(self, version: int, df: DataFrame) -> int:
        """Write the rows of a version, point its view at them, and return their number."""
        data = self._data(version)
        df.write.format("parquet").mode("overwrite").saveAsTable(data)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self._view(version)} AS SELECT * FROM {data}")
        return self.spark.table(data).count()  # from file footers; no column is read

    def _store(
        self, log: list[Row], operation: str, parameters: dict[str, str], df: DataFrame
    ) -> int:
        """Commit a written version."""
        head = log[-1]
        rows = self._write(head["version"] + 1, df)
        return self._commit(
            head["version"] + 1,
            operation,
            parameters,
            parent=head["version"],
            written=True,
            rows_before=head["rows_after"],
            rows_changed=None,
            rows_after=rows,
        )

    def _derive(
        self,
        log: list[Row],
        operation: str,
        parameters: dict[str, str],
        query: str,
        rows_changed: int | None,
        rows_after: int | None,
        expressions: str = "",
        parent: int | None = None,
    ) -> int:
        """Commit a version given by a query over an earlier one, as a view where that is stable."""
        head = log[-1]
        version = head["version"] + 1
        parent = head["version"] if parent is None else parent
        columns = self.spark.table(self._view(parent)).columns
        written = is_unstable(expressions, columns) or self._stacked(log, parent) >= self.max_stacked
        if written:
            rows_after = self._write(version, self.spark.sql(query))
        else:
            # A failed commit may have left rows here; this version is not them.
            self.spark.sql(f"DROP TABLE IF EXISTS {self._data(version)}")
            self.spark.sql(f"CREATE OR REPLACE VIEW {self._view(version)} AS {query}")
        return self._commit(
            version,
            operation,
            parameters,
            parent=parent,
            written=written,
            rows_before=head["rows_after"],
            rows_changed=rows_changed,
            rows_after=rows_after,
        )

    def _commit(
        self,
        version: int,
        operation: str,
        parameters: dict[str, str],
        *,
        parent: int | None,
        written: bool,
        rows_before: int | None,
        rows_changed: int | None,
        rows_after: int,
    ) -> int:
        self.spark.sql(
            f"INSERT INTO {self._history_table} SELECT CAST(:version AS BIGINT), "
            "timestamp_micros(:at), :operation, map_from_arrays("
            "CAST(:names AS ARRAY<STRING>), CAST(:texts AS ARRAY<STRING>)), "
            "CAST(:parent AS BIGINT), :written, CAST(:before AS BIGINT), CAST(:changed AS BIGINT), "
            "CAST(:after AS BIGINT)",
            args={
                "version": version,
                "at": _micros(self._clock()),
                "operation": operation,
                "names": F.array(*[F.lit(k) for k in parameters]),
                "texts": F.array(*[F.lit(v) for v in parameters.values()]),
                "parent": F.lit(parent),
                "written": written,
                "before": F.lit(rows_before),
                "changed": F.lit(rows_changed),
                "after": rows_after,
            },
        )
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {self._view(version)}")
        return version

    def _stacked(self, log: list[Row], version: int) -> int:
        """Views between a version and the rows it reads; expiry may have written rows since the commit."""
        parents = {r["version"]: r["parent"] for r in log}
        depth = 0
        while not self._exists(self._data(version)):
            version, depth = parents[version], depth + 1
        return depth

    def _drop_version(self, version: int) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self._view(version)}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._data(version)}")


def _micros(moment: datetime) -> int:
    """Microseconds since the epoch; a moment without a zone is taken as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
