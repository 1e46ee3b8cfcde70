"""Tables of the warehouse as Parquet snapshots.

A table is a list of folders that an entry of the snapshot log names. Every write, an append
too, goes to a new folder; nothing that a reader may see is changed. One append to the log
publishes all tables written in a transaction, so that a step that fails leaves every table
as it was. One process may write at a time: if the log has grown since it was read, a write is
refused.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silostar.model import EVENT_SCHEMA
from silostar.operators.keys import assign_keys
from silostar.session import batch_timestamp

_FOLDER = T.StructType(
    [T.StructField("part", T.StringType()), T.StructField("path", T.StringType())]
)
_LOG_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("folders", T.ArrayType(_FOLDER)),
        T.StructField("schema", T.StringType()),
        T.StructField("highest", T.LongType()),
        T.StructField("written", T.TimestampNTZType()),
    ]
)
# Each folder is a partition of the table's own folder, so that folders with partitions of
# their own are read in one scan.
_LOAD = "load_id"


class Warehouse:
    """A folder of snapshot tables on shared storage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._latest: dict[str, Row] | None = None
        self._log_files: set[str] = set()  # of the log as it was read
        self._staged: dict[str, Row] | None = None  # written in the open transaction
        self._made: list[str] = []  # folders of the open transaction
        self._scratch: list[str] = []  # intermediate tables of the open transaction
        self._lock = threading.RLock()

    # Reading ----------------------------------------------------------------
    def reload(self) -> None:
        """Look at the log again, to see what another writer has done."""
        self._latest = None

    def _snapshots(self) -> dict[str, Row]:
        """The last log entry of every table (as many rows as there are tables)."""
        if self._latest is None:
            self._log_files = self._names("_snapshots")
            if not self._log_files:
                return {}  # nothing written yet
            log = self.spark.read.schema(_LOG_SCHEMA).parquet(f"{self.root}/_snapshots")
            entry = F.struct("version", *[c for c in log.columns if c != "version"])
            last = log.groupBy("table").agg(F.max_by(entry, "version").alias("entry"))
            self._latest = {row.table: row for row in last.select("entry.*").collect()}
        return self._latest

    def _current(self, table: str) -> Row | None:
        if self._staged and table in self._staged:
            return self._staged[table]
        return self._snapshots().get(table)

    def exists(self, table: str) -> bool:
        current = self._current(table)
        return current is not None and bool(current.folders)

    def version(self, table: str) -> int:
        """Counts the writes of a table; 0 if there was none."""
        current = self._current(table)
        return current.version if current else 0

    def highest(self, table: str) -> int:
        """The highest key that was ever given out in a table written with its ``key``."""
        current = self._current(table)
        return (current.highest or 0) if current else 0

    def folders(self, table: str, part: str | None = None) -> list[str]:
        current = self._current(table)
        found = current.folders if current else []
        return [f.path for f in found if part is None or f.part == part]

    def read(
        self, table: str, schema: T.StructType | None = None, part: str | None = None,
        only: Sequence[str] | None = None,
    ) -> DataFrame:
        """The current content, one part of it, or that of ``only`` some of its folders. A
        table not yet written is empty if its schema is given."""
        if not self.exists(table):
            if schema is None:
                raise LookupError(f"no such table: {table}")
            return self.spark.createDataFrame([], schema)
        kept = T.StructType.fromJson(json.loads(self._current(table).schema))
        paths = self.folders(table, part) if only is None else list(only)
        if not paths:
            return self.spark.createDataFrame([], kept)
        reader = self.spark.read.schema(T.StructType([*kept, T.StructField(_LOAD, T.StringType())]))
        rows = reader.option("basePath", f"{self.root}/{table}").parquet(*paths)
        return rows.select(*[F.col(f"`{f.name}`") for f in kept])

    # Writing ----------------------------------------------------------------
    @contextmanager
    def transaction(self) -> Iterator[None]:
        """All tables written inside change together, or none of them. Reads inside see what
        was written. Intermediate tables are deleted at the end, and after a failure the
        folders that were written, too. Inside another transaction it is a part of it."""
        if self._staged is not None:
            yield
            return
        self._staged, self._made, self._scratch = {}, [], []
        try:
            yield
            self._publish(list(self._staged.values()))
        except BaseException:
            for path in self._made:
                self._delete(path)
            raise
        finally:
            for path in self._scratch:
                self._delete(path)
            self._staged, self._made, self._scratch = None, [], []

    def _publish(self, entries: list[Row]) -> None:
        if entries:
            known = self._snapshots()
            if self._names("_snapshots") != self._log_files:
                raise RuntimeError("the snapshot log has changed: another process writes here")
            log = self.spark.createDataFrame(entries, _LOG_SCHEMA).coalesce(1)
            log.write.mode("append").parquet(f"{self.root}/_snapshots")
            self._log_files = self._names("_snapshots")
            self._latest = known | {entry.table: entry for entry in entries}

    def _enter(self, table: str, folders: list, schema: str | None, highest: int | None) -> None:
        """A new log entry of a table, published now or at the end of the transaction."""
        with self._lock:  # tables may be written from several threads
            entry = Row(
                table=table, version=self.version(table) + 1, folders=folders, schema=schema,
                highest=highest, written=batch_timestamp(),
            )
            if self._staged is not None:
                self._staged[table] = entry
            else:
                self._publish([entry])

    def _names(self, path: str) -> set[str]:
        """What a folder below the warehouse holds, without hidden files; none if it is not there."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = system.listStatus(folder) if system.exists(folder) else []
        names = {status.getPath().getName() for status in found}
        return {n for n in names if not n.startswith(("_", "."))}

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _write(
        self, df: DataFrame, table: str, partition_by: Sequence[str], key: str | None
    ) -> tuple[str, int, int | None]:
        """Write to a new folder; count the rows and find the highest key in the same pass."""
        path = f"{self.root}/{table}/{_LOAD}={uuid.uuid4().hex}"
        with self._lock:
            self._made.append(path)
        counted = Observation()
        top = F.max(F.col(key) if key else F.lit(None)).cast("bigint")
        writer = df.observe(counted, F.count(F.lit(1)).alias("n"), top.alias("top")).write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return path, int(counted.get["n"]), counted.get["top"]

    def _store(
        self, df: DataFrame, table: str, partition_by: Sequence[str], part: str, key: str | None,
        keep,
    ) -> int:
        path, rows, top = self._write(df, table, partition_by, key)
        with self._lock:
            current = self._current(table)
            folders = [f for f in (current.folders if current else []) if keep(f)]
            self._list(df, table, folders, [Row(part=part, path=path)], top)
        return rows

    def _list(self, df: DataFrame, table: str, kept: list, fresh: list, top: int | None) -> None:
        """Enter a table that consists of the kept folders and those written from ``df``."""
        with self._lock:
            current = self._current(table)
            fields = {f.name: f for f in df.schema}
            if kept:  # a column that an older folder lacks is null there
                old = T.StructType.fromJson(json.loads(current.schema))
                fields = {f.name: f for f in old} | {n: f for n, f in fields.items() if n not in old.names}
            highest = max((x for x in (top, current.highest if current else None) if x is not None), default=None)
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()]).json()
            self._enter(table, [*kept, *fresh], schema, highest)

    def overwrite(
        self, df: DataFrame, table: str, partition_by: Sequence[str] = (), part: str | None = None,
        key: str | None = None,
    ) -> int:
        """Replace the whole content (drop and recreate, full refresh, merge result), or that
        of one part. ``key`` names a surrogate key whose highest value is kept in the log."""
        return self._store(
            df, table, partition_by, part or "", key, lambda f: part is not None and f.part != part
        )

    def append(
        self, df: DataFrame, table: str, partition_by: Sequence[str] = (), part: str = "",
        key: str | None = None,
    ) -> int:
        return self._store(df, table, partition_by, part, key, lambda f: True)

    def drop(self, table: str) -> None:
        """The table is gone, and may be loaded anew; versions and keys go on counting."""
        current = self._current(table)
        if current is not None:
            self._enter(table, [], None, current.highest)

    def replace_where(self, df: DataFrame, table: str, key: str, whole: bool = False) -> int:
        """Replace the rows of the key values that occur in ``df`` and keep the others (with
        ``whole``: drop them).

        Each key value is a part in a folder of its own, so only the values that come in are
        written, in one job; the folders of others are neither read nor written. There should
        be moderately many values, as with steps or months. A table that was written in
        another way is brought into this form once.
        """
        with self.transaction():
            current = self._current(table)
            known = [] if whole or current is None else current.folders
            if not all(f.part.startswith(f"{key}=") for f in known):
                df = self.intermediate(df)
                others = self.read(table).join(df.select(key).distinct(), key, "left_anti")
                rows = df.count()
                self._replace(others.unionByName(df, allowMissingColumns=True), table, key, [])
                return rows
            return self._replace(df, table, key, known)

    def _replace(self, df: DataFrame, table: str, key: str, known: list[Row]) -> int:
        path, rows, _ = self._write(df.hint("rebalance", key), table, [key], None)
        found = self._names(path.removeprefix(f"{self.root}/"))
        kept = [f for f in known if f.part not in found]
        fresh = [Row(part=part, path=f"{path}/{part}") for part in sorted(found)]
        self._list(df, table, kept, fresh, None)
        return rows

    def intermediate(self, df: DataFrame) -> DataFrame:
        """``df`` as a table below the warehouse that lasts until the transaction ends. The
        rows are worked out once, survive the loss of executors, and their size is known to
        the planner: joins with a small batch are planned as broadcasts of the batch."""
        if self._staged is None:
            raise RuntimeError("intermediate tables need a transaction")
        path = f"{self.root}/_intermediate/{uuid.uuid4().hex}"
        with self._lock:
            self._scratch.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def expire(self) -> int:
        """Delete the folders that no current table lists: old snapshots, and what a lost
        job left. Readers that still work on an old snapshot lose it, and no transaction may
        be open, here or in another process. Returns the number of folders."""
        if self._staged is not None:
            raise RuntimeError("a transaction is open")
        self.reload()
        gone = 0
        for table in self._snapshots():
            top = f"{self.root}/{table}"
            listed = {path.removeprefix(f"{top}/") for path in self.folders(table)}
            loads = {name.split("/")[0] for name in listed}
            for load in self._names(table):
                # a load is a folder, or has a folder for each of the parts it wrote
                parts = [load] if load not in loads else [f"{load}/{p}" for p in self._names(f"{table}/{load}")]
                for name in parts:
                    if name.startswith(f"{_LOAD}=") and name not in listed and load not in listed:
                        self._delete(f"{top}/{name}")
                        gone += 1
        self._delete(f"{self.root}/_intermediate")
        return gone


def append_numbered(
    warehouse: Warehouse, df: DataFrame, table: str, schema: T.StructType,
    order: Sequence[str],
) -> int:
    """Append rows to a log table with increasing ids (a batch of log rows is small: one
    per declared check, column or write)."""
    numbered = assign_keys(df, order, "id", warehouse.highest(table), bucket_digits=1)
    columns = [F.col(f.name).cast(f.dataType) for f in schema]
    return warehouse.append(numbered.select(*columns).coalesce(1), table, key="id")


def event(
    table: str, kind: str, step: str, start: datetime, end: datetime, rows: int,
    state: str = "OK", note: str | None = None,
) -> tuple:
    return (0, table, kind, step, start, end, rows, state, note)


def log_events(warehouse: Warehouse, events: Iterable[tuple], table: str = "dqm_eventos") -> int:
    """Append one row per write or process to the event log."""
    rows = warehouse.spark.createDataFrame(list(events), EVENT_SCHEMA).drop("id")
    order = ["fecha_inicio", "tabla", "tipo_evento"]
    return append_numbered(warehouse, rows, table, EVENT_SCHEMA, order)
