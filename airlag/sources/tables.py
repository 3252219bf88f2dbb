"""Versioned tables as plain Parquet folders plus a small version log.

An :class:`AppendTable` adds one ``batch_id=N`` folder per batch; version N is
every batch up to N. A :class:`SnapshotTable` writes a ``commit=N`` folder per
change and logs which folders make up the version, so a change that touches a
few partitions rewrites only those. The log row is written after the data, and
readers see logged versions only. One writer at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlag.functions.columns import decoded_path
from airlag.operators.layout import rebalance, zorder_layout
from airlag.operators.merge import merge_upsert, never_null
from airlag.session import materialize, path_exists

TARGET_BYTES = 256 * 1024 * 1024
#: Stored bytes that one task of a clustering arranges; shuffled, they are several
#: times as many.
TASK_BYTES = 32 * 1024 * 1024
LOG_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("operation", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("schema", T.StringType()),
        T.StructField("folders", T.ArrayType(T.StringType())),
        T.StructField("token", T.StringType()),
    ]
)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def wider(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type that holds the values of both."""
    if left == right:
        return left
    pair = {type(left), type(right)}
    if T.NullType in pair:
        return right if isinstance(left, T.NullType) else left
    if pair == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    if pair == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def merged_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """Columns of all schemas in order of first sight, each as wide as needed."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            known = types.get(field.name)
            types[field.name] = (
                field.dataType if known is None else wider(known, field.dataType)
            )
    return T.StructType([T.StructField(name, kind, True) for name, kind in types.items()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``; absent ones are null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def append_merged(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames under the merged schema."""
    schema = merged_schema(df.schema for df in frames)
    result = conform(frames[0], schema)
    for df in frames[1:]:
        result = result.unionByName(conform(df, schema))
    return result


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str

    def log(self) -> DataFrame | None:
        """The version log, or None when nothing was committed."""
        path = f"{self.path}/log"
        if not path_exists(self.spark, path):
            return None
        return self.spark.read.schema(LOG_SCHEMA).parquet(path)

    def exists(self) -> bool:
        return self.log() is not None

    def version(self) -> int | None:
        log = self.log()
        return None if log is None else log.agg(F.max("version")).first()[0]

    def _record(self, entries: list[tuple]) -> None:
        self.spark.createDataFrame(entries, LOG_SCHEMA).coalesce(1).write.mode(
            "append"
        ).parquet(f"{self.path}/log")


class AppendTable(VersionedTable):
    """Append-only table whose schema grows with its batches."""

    def append(
        self,
        df: DataFrame,
        batch_ids: Sequence[int] | None = None,
        operation: str = "append",
        tokens: Sequence[str] | None = None,
    ) -> list[int]:
        """Write one batch, or several batches told apart by ``batch_id``.

        Rewriting a batch that was never logged replaces its files; a logged
        version is left alone. A batch whose token is logged already is left out
        under any number, so a retried one adds nothing twice. A batch without
        rows is logged with none.
        """
        if batch_ids is None:
            batch_ids = [self.next_version()]
            df = df.withColumn("batch_id", F.lit(batch_ids[0]))
        named = dict(zip(batch_ids, tokens)) if tokens else {}
        log = self.log()
        if log is not None:
            ids, marks = F.col("version").isin(list(batch_ids)), F.col("token").isin(list(named.values()))
            known = log.where(ids | F.coalesce(marks, F.lit(False))).select("version", "token").collect()
            versions, done = {r.version for r in known}, {r.token for r in known}
            batch_ids = [b for b in batch_ids if b not in versions and not (named and named[b] in done)]
            if not batch_ids:
                return []
            df = df.where(F.col("batch_id").isin(batch_ids))
        stored = T.StructType([f for f in df.schema if f.name != "batch_id"])
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(f"{self.path}/data")
        )
        data = f"{self.path}/data/batch_id="
        filled = [b for b in batch_ids if path_exists(self.spark, f"{data}{b}")]
        counts = {}
        if filled:
            written = self._batches(stored, filled).groupBy("batch_id").count()
            counts = {row.batch_id: row["count"] for row in written.collect()}
        now = utc_now()
        self._record(
            [
                (b, operation, counts.get(b, 0), now, stored.json(), [f"batch_id={b}"], named.get(b))
                for b in batch_ids
            ]
        )
        return list(batch_ids)

    def next_version(self) -> int:
        current = self.version()
        return 0 if current is None else current + 1

    def _batches(self, stored: T.StructType, batch_ids: Sequence[int]) -> DataFrame:
        folders = [f"{self.path}/data/batch_id={b}" for b in batch_ids]
        return (
            self.spark.read.option("basePath", f"{self.path}/data")
            .schema(stored.add("batch_id", T.LongType()))
            .parquet(*folders)
        )

    def read(self, version: int | None = None, after: int | None = None) -> DataFrame:
        """Batches up to ``version``, or those ``after`` one, with ``batch_id``
        as last column.

        The schemas come from the log, so no file footers are merged.
        """
        log = self.log()
        if log is None:
            raise FileNotFoundError(f"no table at {self.path}")
        if after is not None:
            log = log.where(F.col("version") > after)
        if version is not None:
            log = log.where(F.col("version") <= version)
        groups: dict[str, list[int]] = {}
        for row in log.where("rows > 0").orderBy("version").select("version", "schema").collect():
            groups.setdefault(row.schema, []).append(row.version)
        if not groups:
            schemas = [T.StructType.fromJson(json.loads(r.schema)) for r in log.select("schema").collect()]
            empty = merged_schema(schemas).add("batch_id", T.LongType())
            return self.spark.createDataFrame([], empty)
        frames = [
            self._batches(T.StructType.fromJson(json.loads(text)), ids)
            for text, ids in groups.items()
        ]
        merged = append_merged(frames)
        return merged.select(*[c for c in merged.columns if c != "batch_id"], "batch_id")


class SnapshotTable(VersionedTable):
    """Table whose every version is a complete set of rows."""

    def _entry(self, version: int | None) -> T.Row:
        log = self.log()
        if log is None:
            raise FileNotFoundError(f"no table at {self.path}")
        if version is None:
            row = log.orderBy(F.desc("version")).first()
        else:
            row = log.where(F.col("version") == version).first()
        if row is None:
            raise FileNotFoundError(f"no version {version} at {self.path}")
        return row

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or the given one."""
        entry = self._entry(version)
        return self._read(T.StructType.fromJson(json.loads(entry.schema)), entry.folders)

    def previous(self) -> DataFrame | None:
        """The version before the newest; None when there is none."""
        current = self.version()
        return None if not current else self.read(current - 1)

    def _read(self, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return (
            self.spark.read.option("basePath", f"{self.path}/data")
            .schema(schema)
            .parquet(*[f"{self.path}/data/{f}" for f in folders])
            .select(*schema.names)
        )

    def files(self, version: int | None = None) -> DataFrame:
        """Folder, path and size of the data files of a version; lists only."""
        live = self._entry(version).folders
        listed = (
            self.spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True)
            .load([f"{self.path}/data/{f}" for f in live])
        )
        return listed.select(self._folder_of(F.col("path")).alias("folder"), "path", "length")

    def _folder_of(self, path: Column) -> Column:
        """The part of a file path between ``data/`` and the file name."""
        tail = F.substring_index(path, "/data/commit=", -1)
        folder = F.regexp_replace(tail, "/[^/]*$", "")
        return F.concat(F.lit("commit="), folder)

    def write(
        self,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        operation: str = "overwrite",
        keep: Sequence[str] = (),
        arranged: bool = False,
        token: str | None = None,
    ) -> int:
        """Commit ``df`` plus the ``keep`` folders of the newest version, with a
        ``token`` that names what the version was made from.

        Partitioned rows are rebalanced by partition first: a small partition
        becomes one file, and a hot one is split over several tasks. Rows that
        are ``arranged`` already keep their order.
        """
        current = self.version()
        version = 0 if current is None else current + 1
        schema = df.schema
        if partition_by and not arranged:
            df = rebalance(df, partition_by)
        folder = f"{self.path}/data/commit={version}"
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
        new = [f"commit={version}"]
        if partition_by:
            listed = (
                self.spark.read.format("binaryFile")
                .option("pathGlobFilter", "*.parquet")
                .option("recursiveFileLookup", True)
                .load(folder)
                .select(self._folder_of(F.col("path")).alias("folder"))
                .distinct()
            )
            # An empty partitioned write leaves one file outside any partition.
            new = [r.folder for r in listed.collect() if r.folder != f"commit={version}"]
        rows = self._read(schema, new).count()  # from file footers
        self._record(
            [(version, operation, rows, utc_now(), schema.json(), sorted([*keep, *new]), token)]
        )
        return version

    def folders(self) -> list[str]:
        """The folders of the newest version."""
        return list(self._entry(None).folders)

    def merge(
        self,
        source: DataFrame,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
        token: str | None = None,
    ) -> int:
        """Upsert ``source``, which must be stored and unique on ``keys``.

        Only partition folders that hold a matched row are rewritten; the
        others pass into the new version by name.
        """
        entry = self._entry(None)
        schema = T.StructType.fromJson(json.loads(entry.schema))
        target = self._read(schema, entry.folders)
        folder = self._folder_of(decoded_path(F.col("_metadata.file_path")))
        matched = (
            target.select(*keys, folder.alias("folder"))
            .where(never_null(keys))
            .join(source.select(*keys).where(never_null(keys)), list(keys), "left_semi")
            .select("folder")
            .distinct()
        )
        touched = {row.folder for row in matched.collect()}
        unknown = touched - set(entry.folders)
        if unknown:
            raise ValueError(f"folders {sorted(unknown)} are not part of the table")
        result = merge_upsert(self._read(schema, sorted(touched)), source, keys)
        keep = [f for f in entry.folders if f not in touched]
        return self.write(result, partition_by, operation="merge", keep=keep, token=token)

    def insert(
        self,
        source: DataFrame,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
        token: str | None = None,
    ) -> DataFrame:
        """Add the rows of ``source``, which must be stored, whose key the table
        does not have; a null key part matches nothing. No folder is rewritten:
        new rows go beside the old ones. Returns what was added, stored; without
        such rows there is no new version."""
        full = never_null(keys)
        known = self.read().select(*keys).where(full)
        fresh = source.where(full).join(known, list(keys), "left_anti").select(*source.columns)
        fresh = materialize(fresh.unionByName(source.where(~full)))
        if not fresh.isEmpty():
            self.write(fresh, partition_by, operation="merge", keep=self.folders(), token=token)
        return fresh

    def replace_partitions(
        self, rows: DataFrame, partition_by: Sequence[str], parts: Sequence[tuple]
    ) -> int:
        """A version in which the partitions ``parts`` hold ``rows``; the folders
        of all others pass into it by name. A table that has no partitions yet
        must get all its rows."""
        gone = {_part_folder(partition_by, part) for part in parts}
        keep = [f for f in self.folders() if _partition(f) and _partition(f) not in gone] if self.exists() else []
        return self.write(rows, partition_by, operation="overwrite", keep=keep)

    def partitioned(self) -> bool:
        return self.exists() and all(_partition(f) for f in self.folders())

    def compact(self, partition_by: Sequence[str], target_bytes: int = TARGET_BYTES) -> int:
        """Rewrite partitions that hold two or more files below the target size.

        Returns the new version, or the current one if nothing is small.
        """
        entry = self._entry(None)
        files = self.files().withColumn("part", self._partition_of(F.col("folder")))
        small = (
            files.groupBy("part")
            .agg(F.count_if(F.col("length") < target_bytes).alias("small"))
            .where("small >= 2")
        )
        folders = files.join(small, "part", "left_semi").select("folder").distinct()
        touched = {row.folder for row in folders.collect()}
        if not touched:
            return entry.version
        schema = T.StructType.fromJson(json.loads(entry.schema))
        rows = self._read(schema, sorted(touched))
        keep = [f for f in entry.folders if f not in touched]
        return self.write(rows, partition_by, operation="compact", keep=keep)

    def _partition_of(self, folder: Column) -> Column:
        return F.regexp_replace(folder, "^commit=[0-9]+", "")

    def cluster(
        self,
        cluster_by: Sequence[str],
        partition_by: Sequence[str],
        spread_by: Sequence[str],
        target_bytes: int = TARGET_BYTES,
        bits: int = 8,
    ) -> int:
        """Rewrite partitions in the order of an interleaved key: those with a
        folder that came after the last clustering. Returns the new version, or
        the current one if nothing came."""
        entry = self._entry(None)
        clustered = self.log().where("operation = 'zorder'").orderBy(F.desc("version")).first()
        settled = set(clustered.folders) if clustered else set()
        changed = {_partition(f) for f in entry.folders if f not in settled}
        if not changed:
            return entry.version
        touched = [f for f in entry.folders if _partition(f) in changed]
        sizes = self.files().where(F.col("folder").isin(touched))
        total = sizes.agg(F.sum("length")).first()[0] or 0
        files = max(1, -(-total // min(target_bytes, TASK_BYTES)))
        schema = T.StructType.fromJson(json.loads(entry.schema))
        arranged = zorder_layout(
            self._read(schema, touched), cluster_by, partition_by, spread_by, files, bits
        )
        keep = [f for f in entry.folders if _partition(f) not in changed]
        return self.write(arranged, partition_by, operation="zorder", keep=keep, arranged=True)


def _part_folder(names: Sequence[str], values: tuple) -> str:
    spelled = ("__HIVE_DEFAULT_PARTITION__" if v is None else v for v in values)
    return "".join(f"/{n}={v}" for n, v in zip(names, spelled))


def _partition(folder: str) -> str:
    """The partition part of a folder name."""
    return re.sub("^commit=[0-9]+", "", folder)


def table_summary(spark: SparkSession, tables: dict[str, VersionedTable]) -> DataFrame:
    """Name, existence, row count and newest version of each table."""
    parts = []
    for name, table in tables.items():
        version = table.version()
        if version is None:
            rows = spark.range(1).select(F.lit(0).cast("bigint").alias("rows"))
        else:
            rows = table.read().agg(F.count(F.lit(1)).alias("rows"))
        parts.append(
            rows.select(
                F.lit(name).alias("table"),
                F.lit(version is not None).alias("exists"),
                "rows",
                F.lit(version).cast("bigint").alias("version"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def expired_versions(log: DataFrame, now: Column, hours: int) -> DataFrame:
    """Logged versions past the retention, except the newest of each table.

    ``log`` has columns ``table``, ``version`` and ``committed_at``.
    """
    newest = log.groupBy("table").agg(F.max("version").alias("version"))
    old = log.where(F.col("committed_at") < now - F.make_interval(hours=F.lit(hours)))
    return old.join(newest, ["table", "version"], "left_anti")
