"""Target tables as Parquet folders, or in an external database over JDBC.

Every write goes to a new folder.  What the tables consist of is said by numbered markers, small
JSON files in one folder, each of which is made by a rename: the newest one counts.  All writes
inside one ``publication`` become valid by one marker, so a load that fails leaves every table
as it was, and readers never see half of it.  One load writes at a time; a second one that would
publish the same number fails.

A table that is replaced by waves is partitioned by the wave column, and one that is upserted by
a hash bucket of its first key column; a write replaces the parts that it touches and leaves the
files of the others.  Buckets grow in number with the bytes of the table, and a large bucket is
written by several tasks.  A batch too large to be broadcast is written as it comes, without the
shuffle into buckets, and the next small one puts its rows into theirs.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import (
    as_collapsed,
    collapse_batch,
    collapsed,
    collapsed_apart,
    fresh_rows,
    held_keys,
    lost_keys,
    merged,
    repeated_hashes,
    replaced,
    single_rows,
    updated,
    upsert_table,
)
from ..schemas import TABLES, Table
from .scratch import stored

_BUCKET, _VERSION = "key_bucket", "load_version"
_NODE = T.VariantType()
_BUCKET_BYTES = 256 << 20  # a table has a bucket for each of these, about
_MOST_FOLDERS = 64  # a table that is only appended to is written anew beyond so many

State = dict[str, dict]  # table: {"buckets": n or None, "parts": [[version, partition folder or "", bytes], ...]}


class TableStore:
    """Tables below one root folder that all executors can reach.

    ``buckets`` is the least number of buckets of an upserted table.  ``keep`` is the number of
    published states whose files stay: with 2, what was read before the last load can still be read.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, keep: int = 1):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.keep = keep
        self._lock = threading.RLock()
        self._pending: State | None = None
        self._folders = 0

    # --- files and markers

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _names(self, path: str) -> list[str]:
        fs, hadoop_path = self._fs(path)
        return [status.getPath().getName() for status in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []

    def _bytes(self, path: str) -> int:
        fs, hadoop_path = self._fs(path)
        return fs.getContentSummary(hadoop_path).getLength()

    def _delete(self, path: str) -> None:
        fs, hadoop_path = self._fs(path)
        fs.delete(hadoop_path, True)

    def _markers(self) -> list[int]:
        return sorted(int(n) for n in self._names(f"{self.root}/_published") if n.isdigit())

    def _state_of(self, number: int) -> State:
        fs, hadoop_path = self._fs(f"{self.root}/_published/{number:010d}")
        stream = fs.open(hadoop_path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _state(self) -> State:
        with self._lock:
            if self._pending is not None:
                return self._pending
            numbers = self._markers()
            return self._state_of(numbers[-1]) if numbers else {}

    @contextmanager
    def publication(self) -> Iterator[None]:
        """Everything written inside becomes valid at its end, or nothing if it fails."""
        with self._lock:
            outer = self._pending is not None
            if not outer:
                self._number = (self._markers() or [0])[-1] + 1
                self._pending = json.loads(json.dumps(self._state()))
                self._folders = 0
        if outer:
            yield
            return
        try:
            yield
            self._publish()
        finally:
            self._pending = None

    def _publish(self) -> None:
        fs, made = self._fs(f"{self.root}/_published/.new-{uuid.uuid4().hex}")
        out = fs.create(made)
        out.write(bytearray(json.dumps(self._pending).encode()))
        out.close()
        _, marker = self._fs(f"{self.root}/_published/{self._number:010d}")
        if fs.exists(marker) or not fs.rename(made, marker):
            raise RuntimeError(f"another load has published number {self._number}")
        numbers = self._markers()
        kept = {part for n in numbers[-self.keep :] for part in self._paths(self._state_of(n))}
        for number in numbers[: -self.keep]:
            for path in set(self._paths(self._state_of(number))) - kept:
                self._delete(path)
            self._delete(f"{self.root}/_published/{number:010d}")

    def _paths(self, state: State) -> list[str]:
        return [self._path(name, part) for name, table in state.items() for part in table["parts"]]

    def _path(self, name: str, part: Sequence) -> str:
        return f"{self.root}/{name}/{_VERSION}={part[0]}" + (f"/{part[1]}" if part[1] else "")

    # --- reading

    def read(self, name: str, nested: str = "text") -> DataFrame:
        """The table as it is now; an empty frame where it was never written.

        Its ``json`` columns are JSON text, or VARIANT with ``nested="node"``.
        """
        frame, table = self._read(name, self._state().get(name)), TABLES.get(name)
        if nested == "node" or table is None:
            return frame
        return frame.select(*[F.to_json(c).alias(c) if table.schema[c].dataType == _NODE else c for c in table.columns])

    def _read(self, name: str, known: dict | None, more: Sequence[T.StructField] = ()) -> DataFrame:
        """The table's columns, and ``more`` that its files hold."""
        table = TABLES.get(name)
        if known is None and table is None:
            raise ValueError(f"table {name} was never written")
        if known is None or not known["parts"]:
            return self.spark.createDataFrame([], table.schema)
        reader = self.spark.read.schema(T.StructType([*table.schema, *more])) if table else self.spark.read
        frame = reader.option("basePath", f"{self.root}/{name}").parquet(*[self._path(name, p) for p in known["parts"]])
        return frame.select(*table.columns, *[f.name for f in more]) if table else frame.drop(_VERSION)

    # --- writing

    @staticmethod
    def _typed(table: Table, rows: DataFrame) -> list[Column]:
        """The table's columns with its types; JSON text is parsed for a node, a node is text for a text column."""

        def typed(field: T.StructField) -> Column:
            value, given = F.col(field.name), rows.schema[field.name].dataType
            if field.dataType == _NODE:
                value = value if given == _NODE else F.try_parse_json(value)
            elif given == _NODE:
                value = F.to_json(value)
            else:
                value = value.cast(field.dataType)
            return value.alias(field.name)

        return [typed(f) for f in table.schema]

    def _typed_batch(self, table: Table, updates: DataFrame) -> DataFrame:
        """Updates with the table's types, and the columns that tell their order."""
        return updates.select(*self._typed(table, updates), *[c for c in updates.columns if c not in table.columns])

    def _write(
        self, name: str, rows: DataFrame, buckets: int | None = None, more: Sequence[str] = ()
    ) -> tuple[list[list], int]:
        """Writes rows to a new folder, with the columns ``more``; gives its parts and the number of rows."""
        table = TABLES.get(name)
        rows = rows.select(*self._typed(table, rows), *more) if table else rows
        with self._lock:
            self._folders += 1
            version = f"v{self._number}-{self._folders}"
        by = table.slice_by if table else None
        if buckets:
            rows, by = rows.withColumn(_BUCKET, self._bucket(table, buckets)), _BUCKET
            # a bucket goes to as many tasks as its bytes ask for, small ones share a task
            rows = rows.hint("rebalance", F.col(_BUCKET))
        writer = rows.write.mode("overwrite")
        if not buckets:  # buckets are small files, compressed as the session says
            writer = writer.option("compression", "zstd")
        path = f"{self.root}/{name}/{_VERSION}={version}"
        (writer.partitionBy(by) if by else writer).parquet(path)
        names = [n for n in self._names(path) if "=" in n] if by else [""]
        parts = [[version, n, self._bytes(f"{path}/{n}" if n else path)] for n in names]
        return parts, self._read(name, {"parts": parts}).count() if parts else 0  # from the footers

    def _write_single(self, name: str, rows: DataFrame, order_cols: Sequence[str]) -> tuple[list[list], int]:
        """Writes one row per key: insert-only columns of the first row, the others of the last.

        The rows are written as they come and their keys looked at; only where keys repeat are
        their rows reduced, and the others copied.
        """
        table = TABLES[name]
        more = [f for f in rows.schema if f.name in order_cols and f.name not in table.columns]
        parts, n = self._write(name, rows, None, [f.name for f in more])
        if not parts or not table.keys:
            return parts, n
        rows = self._read(name, {"parts": parts}, more)
        repeated = self._repeated(rows, table)
        if repeated is None:
            return parts, n
        if self._scanned_bytes(repeated) > self._broadcast_limit():
            single = collapse_batch(rows, table.keys, table.insert_only, order_cols, table.columns)
        else:
            single = single_rows(rows, repeated, table, order_cols)
        single = self._write(name, single)
        self._delete(f"{self.root}/{name}/{_VERSION}={parts[0][0]}")
        return single

    @staticmethod
    def _repeated(rows: DataFrame, table: Table) -> DataFrame | None:
        """The key hashes that repeat, stored so that their size is known; None where no key does."""
        repeated = stored(repeated_hashes(rows, table), "repeated")
        return None if repeated.isEmpty() else repeated

    def _put(self, name: str, parts: list[list], buckets: int | None = None) -> None:
        with self._lock:
            self._pending[name] = {"buckets": buckets, "parts": parts}

    def overwrite(self, name: str, rows: DataFrame) -> int:
        """Full reload; gives the number of rows written."""
        with self.publication():
            table, known = TABLES.get(name), self._state().get(name)
            buckets = self._buckets(known) if table and table.bucketed else None
            parts, n = self._write(name, rows, buckets)
            self._put(name, parts, buckets)
            return n

    def _buckets(self, known: dict | None) -> int:
        """Buckets for the bytes that a table has now: a power of two times the least number."""
        found, wanted = self.buckets, sum(p[2] for p in known["parts"]) / _BUCKET_BYTES if known else 0
        while found < wanted:
            found *= 2
        return max(found, (known or {}).get("buckets") or 0)

    def append(self, name: str, rows: DataFrame) -> int:
        """Adds rows to the table; gives their number."""
        with self.publication():
            known = self._state().get(name) or {"parts": []}
            parts, n = self._write(name, rows)
            if len(known["parts"]) >= _MOST_FOLDERS:
                whole = self._read(name, {"parts": known["parts"] + parts})
                known, parts = {"parts": []}, self._write(name, whole)[0]
            self._put(name, known["parts"] + parts)
            return n

    def insert_new(self, name: str, updates: DataFrame, order_cols: Sequence[str] | None) -> int:
        """Appends the rows whose key is new; the table itself is not rewritten."""
        table = TABLES[name]
        return self.append(name, fresh_rows(self.read(name, "node"), updates, table.keys, order_cols))

    def upsert(self, name: str, updates: DataFrame, order_cols: Sequence[str]) -> int:
        """Keyed upsert by the table's keys; gives the rows of the buckets it rewrote."""
        table = TABLES[name]
        if not table.bucketed:
            return self.overwrite(name, upsert_table(self.read(name, "node"), self._typed_batch(table, updates), table, order_cols))
        with self.publication():
            known, batch = self._state().get(name), self._typed_batch(table, updates)
            if not known or not known["parts"]:
                parts, n = self._write_single(name, batch, order_cols)
                buckets = self._buckets(known)
                if parts and parts[0][2] <= self._broadcast_limit():
                    made, (parts, n) = parts, self._write(name, self._read(name, {"parts": parts}), buckets)
                    self._delete(self._path(name, made[0]))
                self._put(name, parts, buckets)
                return n
            # one row per key, read for its buckets and for its rows
            batch = self._single(stored(batch, "batch"), table, order_cols)
            if self._scanned_bytes(batch) > self._broadcast_limit():
                parts, n = self._write(name, self._merged(self._read(name, known), batch, table))
                self._put(name, parts, self._buckets(known))
                return n
            keys = batch.select(F.col("_key")[table.keys[0]].alias(table.keys[0]))
            return self.rewrite(name, keys, lambda old: self._merged(old, batch, table))

    def _single(self, batch: DataFrame, table: Table, order_cols: Sequence[str]) -> DataFrame:
        """A stored batch as one row per key; what is reduced is stored."""
        if self._scanned_bytes(batch) <= self._broadcast_limit():
            return stored(collapsed(batch, table, order_cols), "single")
        repeated = self._repeated(batch, table)
        if repeated is None:
            return as_collapsed(batch, table)
        if self._scanned_bytes(repeated) > self._broadcast_limit():
            return stored(collapsed(batch, table, order_cols), "single")
        return collapsed_apart(batch, repeated, table, order_cols)

    def _merged(self, old: DataFrame, batch: DataFrame, table: Table) -> DataFrame:
        """A batch that Spark broadcasts is merged without a shuffle of the table.

        A larger one that leaves few keys of the table alone is shuffled itself, against the table's
        keys and insert-only columns; else both are, by one full join.
        """
        limit = self._broadcast_limit()
        if self._scanned_bytes(batch) > limit:
            lost = stored(lost_keys(old, batch, table), "lost")
            few = self._scanned_bytes(lost) <= limit or lost.isEmpty()
            return replaced(old, batch, lost, table) if few else merged(old, batch, table)
        # the batch's keys that the table holds are as few as the batch; stored, so that their size is known
        held = stored(held_keys(old, batch, table), "held")
        return updated(old, batch, held, table)

    def _broadcast_limit(self) -> int:
        return self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()

    @staticmethod
    def _scanned_bytes(frame: DataFrame) -> int:
        return int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

    def rewrite(self, name: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        """Puts ``change`` of them in place of the buckets that hold keys of ``touched``.

        ``touched`` has the first key column of the table.
        """
        with self.publication():
            table, known = TABLES[name], self._state().get(name)
            if known is None or self._buckets(known) > known["buckets"]:
                return self.overwrite(name, change(self._read(name, known)))
            buckets = known["buckets"]
            numbers = touched.select(self._bucket(table, buckets)).distinct().collect()  # at most ``buckets``
            names = {f"{_BUCKET}={r[0]}" for r in numbers} | {""}  # rows not in buckets yet are touched by any
            old = [p for p in known["parts"] if p[1] in names]
            parts, n = self._write(name, change(self._read(name, {"parts": old})), buckets)
            self._put(name, [p for p in known["parts"] if p[1] not in names] + parts, buckets)
            return n

    @staticmethod
    def _bucket(table: Table, buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.col(table.keys[0]).cast("string")), F.lit(buckets)).cast("int")

    def replace_slices(
        self, name: str, rows: DataFrame, values: Sequence[str], order_cols: Sequence[str] | None = None
    ) -> int:
        """Replaces whole slices of a sliced table; a slice without rows is removed.

        With ``order_cols``, the order of arrival, a key that comes again is one row.
        """
        column = TABLES[name].slice_by
        with self.publication():
            known = self._state().get(name) or {"parts": []}
            rows = rows.filter(F.col(column).isin(list(values)))
            parts, n = self._write(name, rows) if order_cols is None else self._write_single(name, rows, order_cols)
            kept = [p for p in known["parts"] if unquote(p[1].partition("=")[2]) not in set(values)]
            self._put(name, kept + parts)
            return n


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; filters and column lists are pushed down by Spark.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to read
    a large table in parallel.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def write_jdbc(rows: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Writes to a database table in batches of 500 rows; ``overwrite`` truncates it first."""
    settings = {"url": url, "dbtable": table, "batchsize": "500", "truncate": "true", **options}
    rows.write.format("jdbc").options(**settings).mode(mode).save()
