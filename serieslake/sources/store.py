"""Append-only versioned Parquet tables with snapshot reads.

Layout of one table below the lake's root folder::

    <schema>/<table>/_commits/        one row per commit, written last
    <schema>/<table>/data/_commit=ID/ the rows of a commit (plus partition folders)
    <schema>/<table>/gone/_commit=ID/ keys a commit replaces

A commit is visible once its row in ``_commits`` exists, so a job that dies half-way leaves
nothing a reader can see. One writer per table at a time is assumed.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serieslake.operators.joins import small_side
from serieslake.schema import (
    SEQ,
    VERSION,
    InvalidFilterFieldError,
    InvalidQueryError,
    SnapshotConflictError,
    SnapshotNotFoundError,
)

COMMIT = "_commit"
COMMITS_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("commit_ts", T.TimestampNTZType()),
        T.StructField("commit_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("table_schema", T.StringType()),
    ]
)

APPEND = "append"
REPLACE = "replace"
DELETE = "delete"


@dataclass(frozen=True)
class Commit:
    version: int
    commit_ts: datetime
    commit_id: str
    kind: str
    detail: str | None
    table_schema: str


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class VersionedTable:
    """One table: append, replace by key, delete by value, read at a snapshot."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        partition_by: Sequence[str] = (),
        write_options: Mapping[str, str] | None = None,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)
        self.write_options = dict(write_options or {})

    # -- commits ---------------------------------------------------------------------------

    def snapshots(self) -> DataFrame:
        """All commits, oldest first; empty when the table does not exist."""
        try:
            frame = self.spark.read.schema(COMMITS_SCHEMA).parquet(f"{self.path}/_commits")
        except AnalysisException:
            frame = self.spark.createDataFrame([], COMMITS_SCHEMA)
        return frame.orderBy("version")

    def _commits(self, version: int | None = None, as_of: datetime | str | None = None):
        """Commits visible at a snapshot. The list is table metadata: one row per write."""
        if version is not None and as_of is not None:
            raise SnapshotConflictError("give only one of version and as_of")
        commits = [Commit(**row.asDict()) for row in self.snapshots().collect()]
        if version is None and as_of is None:
            return commits
        if version is not None:
            visible = [commit for commit in commits if commit.version <= version]
        else:
            moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
            visible = [commit for commit in commits if commit.commit_ts <= moment]
        if not visible:
            raise SnapshotNotFoundError(
                f"{self.path} has no commit at version={version} as_of={as_of}"
            )
        return visible

    def exists(self) -> bool:
        return bool(self._commits())

    def schema(self) -> T.StructType | None:
        """Columns after the newest commit; None when the table does not exist."""
        commits = self._commits()
        return T.StructType.fromJson(json.loads(commits[-1].table_schema)) if commits else None

    def columns(self) -> list[str]:
        schema = self.schema()
        return schema.names if schema else []

    def latest_version(self) -> int | None:
        commits = self._commits()
        return commits[-1].version if commits else None

    def committed_at(self, version: int) -> datetime:
        """When the newest commit of a snapshot was made."""
        return self._commits(version)[-1].commit_ts

    def _record(
        self,
        kind: str,
        schema: T.StructType,
        *,
        commit_id: str | None = None,
        detail: str | None = None,
        commit_ts: datetime | None = None,
        version: int | None = None,
    ) -> int:
        if version is None:
            version = (self.latest_version() or 0) + 1
        row = (
            version,
            commit_ts or utc_now(),
            commit_id or uuid.uuid4().hex,
            kind,
            detail,
            json.dumps(schema.jsonValue()),
        )
        marker = self.spark.createDataFrame([row], COMMITS_SCHEMA)
        marker.coalesce(1).write.mode("append").parquet(f"{self.path}/_commits")
        return version

    # -- writes ----------------------------------------------------------------------------

    def create(self, schema: T.StructType) -> None:
        """Create the table empty; nothing happens when it already exists."""
        if not self.exists():
            self._record(APPEND, schema, detail="create")

    def _conform(
        self, frame: DataFrame, recorded: T.StructType | None
    ) -> tuple[DataFrame, T.StructType]:
        """Cast to the recorded types and widen the schema by the frame's new columns.

        Column names match without regard to case, as in SQL. A column that tells the order of
        saves passes through and is no part of the schema.
        """
        known = recorded or T.StructType([])
        by_name = {field.name.lower(): field for field in known}
        incoming = {field.name.lower(): field for field in frame.schema if field.name != SEQ}
        added = [field for name, field in incoming.items() if name not in by_name]
        target = T.StructType([*known, *added])
        columns = []
        for field in target:
            source = incoming.get(field.name.lower())
            value = F.lit(None) if source is None else F.col(f"`{source.name}`")
            columns.append(value.cast(field.dataType).alias(field.name))
        if SEQ in frame.columns:
            columns.append(F.col(SEQ).cast("long").alias(SEQ))
        return frame.select(*columns), target

    def _write_rows(self, frame: DataFrame, commit_id: str, version: int) -> None:
        stamped = frame.withColumn(VERSION, F.lit(version).cast("long"))
        if SEQ not in frame.columns:
            stamped = stamped.withColumn(SEQ, F.monotonically_increasing_id())
        writer = stamped
        if self.partition_by:
            # Rebalance keeps files well-sized and still splits a hot partition over tasks.
            writer = stamped.hint("rebalance", *self.partition_by)
        (
            writer.write.options(**self.write_options)
            .partitionBy(*self.partition_by)
            .parquet(f"{self.path}/data/{COMMIT}={commit_id}")
        )

    def append(self, frame: DataFrame, *, commit_ts: datetime | None = None) -> int | None:
        """Append rows as one commit. An empty frame commits nothing."""
        return self._save(frame, APPEND, None, commit_ts)

    def replace(
        self, frame: DataFrame, *keys: str, commit_ts: datetime | None = None
    ) -> int | None:
        """Append rows and hide every older row that shares all keys with one of them, in one
        commit. A repeated run of a job thus leaves the rows of one run."""
        if not keys:
            raise ValueError("name at least one key column")
        return self._save(frame, REPLACE, ",".join(keys), commit_ts)

    def _save(self, frame, kind, key, commit_ts):
        commits = self._commits()  # the one look at the commits of this write
        recorded = T.StructType.fromJson(json.loads(commits[-1].table_schema)) if commits else None
        version = commits[-1].version + 1 if commits else 1
        rows, schema = self._conform(frame, recorded)
        commit_id = uuid.uuid4().hex
        self._write_rows(rows, commit_id, version)
        written = self.spark.read.schema(T.StructType([*schema, T.StructField(VERSION, T.LongType())]))
        written = written.parquet(f"{self.path}/data/{COMMIT}={commit_id}")
        if written.isEmpty():
            return None
        if kind == REPLACE:
            keys = written.select(*key.split(",")).dropna().distinct()
            keys.withColumn(VERSION, F.lit(version).cast("long")).write.parquet(
                f"{self.path}/gone/{COMMIT}={commit_id}"
            )
        return self._record(
            kind, schema, commit_id=commit_id, detail=key, commit_ts=commit_ts, version=version
        )

    def delete(self, filters: Mapping[str, object] | None = None) -> int | None:
        """Hide every current row that equals all given values (all rows when none are given).

        Values are compared in the type of their column, so 3 finds 3.0 and a date its midnight.
        """
        schema = self.schema()
        if schema is None:
            return None
        known = {field.name.lower(): field for field in schema}
        wanted = {name: value for name, value in (filters or {}).items() if value is not None}
        for name in filters or {}:
            if name.lower() not in known:
                raise InvalidFilterFieldError(f"cannot delete by {name!r}: no such column")
        typed = [
            F.lit(json.loads(json.dumps(value, default=str))).try_cast(known[name.lower()].dataType)
            for name, value in wanted.items()
        ]
        found = self.spark.range(1).select(*typed).first() if typed else []
        for (name, value), cell in zip(wanted.items(), found):
            if cell is None:
                kind = known[name.lower()].dataType.simpleString()
                raise InvalidQueryError(f"{value!r} is no {kind} for column {name!r}")
        return self._record(DELETE, schema, detail=json.dumps(filters or {}, default=str))

    # -- reads -----------------------------------------------------------------------------

    def read(
        self,
        *,
        version: int | None = None,
        as_of: datetime | str | None = None,
        bookkeeping: bool = False,
    ) -> DataFrame:
        """Rows visible at a snapshot (the newest one by default).

        The schema comes from the commit row, so no file footers are merged; a file written
        before a column existed reads it as NULL. Only folders of visible commits are listed.
        """
        commits = self._commits(version, as_of)
        if not commits:
            return self.spark.createDataFrame([], T.StructType([]))
        schema = T.StructType.fromJson(json.loads(commits[-1].table_schema))
        stored = T.StructType(
            [*schema, T.StructField(VERSION, T.LongType()), T.StructField(SEQ, T.LongType())]
        )
        data = [c for c in commits if c.kind in (APPEND, REPLACE) and c.detail != "create"]
        if data:
            frame = (
                self.spark.read.schema(stored)
                .option("basePath", f"{self.path}/data")
                .parquet(*[f"{self.path}/data/{COMMIT}={c.commit_id}" for c in data])
            ).select(*stored.names)
        else:
            frame = self.spark.createDataFrame([], stored)
        for commit in commits:
            if commit.kind == DELETE:
                frame = frame.filter(self._survives(commit, schema))
        frame = self._drop_replaced(frame, [c for c in commits if c.kind == REPLACE])
        return frame if bookkeeping else frame.drop(VERSION, SEQ)

    @staticmethod
    def _survives(commit: Commit, schema: T.StructType):
        kinds = {field.name.lower(): field.dataType for field in schema}
        matches = F.lit(True)
        for column, value in json.loads(commit.detail or "{}").items():
            typed = F.lit(value).try_cast(kinds[column.lower()])
            matches = matches & F.coalesce(F.col(f"`{column}`") == typed, F.lit(False))
        return ~matches | (F.col(VERSION) >= commit.version)

    def _drop_replaced(self, frame: DataFrame, commits: list[Commit]) -> DataFrame:
        for detail in sorted({commit.detail for commit in commits}):
            ids, keys = [c.commit_id for c in commits if c.detail == detail], detail.split(",")
            kinds = [T.StructField(key, frame.schema[key].dataType) for key in keys]
            gone = (
                self.spark.read.schema(T.StructType([*kinds, T.StructField(VERSION, T.LongType())]))
                .parquet(*[f"{self.path}/gone/{COMMIT}={i}" for i in ids])
                .groupBy(*keys)
                .agg(F.max(VERSION).alias("_replaced_at"))
            )
            gone = small_side(gone.select(*[F.col(k).alias(f"_gone_{k}") for k in keys], "_replaced_at"))
            superseded = F.col(VERSION) < F.col("_replaced_at")
            for key in keys:
                superseded = superseded & (F.col(key) == F.col(f"_gone_{key}"))
            frame = frame.join(gone, superseded, "left_anti")
        return frame

    # -- reports ---------------------------------------------------------------------------

    def storage_path(self) -> str | None:
        """Longest common folder of the live data files; None when nothing was written."""
        if not self.exists():
            return None
        return common_folder(self.read().inputFiles())

    def is_stale(self, max_age_seconds: float, *, now: datetime | None = None) -> bool:
        """True when the last commit is older than allowed, or there is none."""
        commits = self._commits()
        if not commits:
            return True
        return ((now or utc_now()) - commits[-1].commit_ts).total_seconds() > max_age_seconds


def common_folder(files: Sequence[str]) -> str | None:
    """Longest common folder of some file addresses."""
    if not files:
        return None
    folders = [os.path.dirname(name) for name in files]
    first, last = min(folders), max(folders)
    parts = []
    for left, right in zip(first.split("/"), last.split("/")):
        if left != right:
            break
        parts.append(left)
    return "/".join(parts)


class Lake:
    """Tables below one root folder, addressed by schema and name."""

    def __init__(
        self, spark: SparkSession, root: str, *, write_options: Mapping[str, str] | None = None
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.write_options = write_options

    def table(
        self, schema: str, name: str, *, partition_by: Sequence[str] = ()
    ) -> VersionedTable:
        return VersionedTable(
            self.spark,
            f"{self.root}/{schema}/{name}",
            partition_by=partition_by,
            write_options=self.write_options,
        )
