"""Batched insert into a database table, all or nothing.

Spark's JDBC writer commits per partition, so a load that fails halfway leaves
half of its rows. This data source (``batched_insert``) loads as one:

* each task inserts its rows in batches of 10,000 and a remainder into a load
  table beside the target, marked with the task's attempt, and commits them there
  a few batches at a time. Rows are fetched and converted between these commits,
  so a database that lets one task write at a time is held for the inserts alone;
* when all tasks have reported, the driver moves the rows of exactly the
  reported attempts into the target, in one transaction: rows of lost or
  repeated attempts stay behind. With ``overwrite`` the same transaction empties the target
  before. It rolls back where the number of rows is not the one that the tasks
  reported, or not the given control total;
* when a task fails for good, the load table is dropped; the target was never
  touched.

The database is reached through a Python DB-API module that the executors
have (``connect="psycopg:connect"`` and the like). The rows go from executor
to database; only counts pass through the driver. Reading back takes ranges of
a whole-number key, one connection a range.

This module imports nothing of the library, and is sent to the workers as it is.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from itertools import chain, islice, repeat

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, InputPartition,
                                    WriterCommitMessage)

FORMAT = "batched_insert"
#: Rows of a batch unless the caller says otherwise.
BATCH_ROWS = 10_000
#: Batches that a task gathers and commits together.
COMMIT_BATCHES = 10
#: Types whose values are the same Python objects from an Arrow column as from a row.
PLAIN = (T.IntegralType, T.DoubleType, T.BooleanType, T.StringType, T.DecimalType, T.DateType)


class LoadError(RuntimeError):
    pass


def _open(options):
    module, function = options["connect"].split(":")
    return getattr(importlib.import_module(module), function)(options["target"], **json.loads(options.get("connect_args", "{}")))


def _as_text(value):
    """Decimals, dates and timestamps for a database without types for them."""
    if isinstance(value, Decimal):
        return format(value, "f")
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else value


def _texts(column: pa.Array) -> list:
    """``_as_text`` of a column's values."""
    if pa.types.is_decimal(column.type):
        # small numbers come with an exponent
        return [format(Decimal(x), "f") if x and "E" in x else x for x in column.cast(pa.string()).to_pylist()]
    return [*map(_as_text, column.to_pylist())] if pa.types.is_date(column.type) else column.to_pylist()


def _from_text(value, kind: T.DataType):
    if value is None:
        return None
    if isinstance(kind, T.DecimalType):
        return value if isinstance(value, Decimal) else Decimal(str(value))
    if isinstance(value, str) and isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return dt.datetime.fromisoformat(value)
    if isinstance(value, str) and isinstance(kind, T.DateType):
        return dt.date.fromisoformat(value)
    return value


@dataclass
class Loaded(WriterCommitMessage):
    """What one task has put into the load table."""

    attempt: int
    rows: int
    batches: int


class BatchedWriter(DataSourceWriter):
    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        self.options, self.overwrite = options, overwrite
        self.columns = schema.names
        self.table = options["table"]
        self.load = f"{self.table}_load_{uuid.uuid4().hex[:12]}"
        self.mark = options.get("placeholder", "?")
        con = _open(options)
        try:
            if options.get("create"):
                con.cursor().execute(options["create"])
            con.cursor().execute(
                f"CREATE TABLE {self.load} AS SELECT {self._names()}, 0 AS load_attempt FROM {self.table} WHERE 1 = 0")
            con.cursor().execute(f"CREATE TABLE {self.load}_done (load_attempt BIGINT)")
            con.commit()
        finally:
            con.close()

    def _names(self) -> str:
        return ", ".join(self.columns)

    def _rows(self, iterator: Iterator, attempt: int) -> Iterator[tuple]:
        """What is inserted of each row: its values, and the attempt."""
        convert = _as_text if self.options.get("types") == "text" else lambda v: v
        return ((*map(convert, row), attempt) for row in iterator)

    def write(self, iterator: Iterator) -> Loaded:
        size = int(self.options.get("batch_rows", BATCH_ROWS))
        attempt = TaskContext.get().taskAttemptId()
        marks = ", ".join([self.mark] * (len(self.columns) + 1))
        insert = f"INSERT INTO {self.load} ({self._names()}, load_attempt) VALUES ({marks})"
        con, batches, done = _open(self.options), [], Loaded(attempt, 0, 0)

        def send() -> None:
            # no transaction is open before this, and none after
            for batch in batches:
                con.cursor().executemany(insert, batch)
                done.rows += len(batch)
                done.batches += 1
            con.commit()
            batches.clear()

        try:
            rows = self._rows(iterator, attempt)
            while batch := list(islice(rows, size)):
                batches.append(batch)
                if len(batches) == COMMIT_BATCHES:
                    send()
            send()
        except BaseException:
            con.rollback()
            raise
        finally:
            con.close()
        return done

    def commit(self, messages: list) -> None:
        reported = sum(m.rows for m in messages)
        total = self.options.get("control_total")
        con = _open(self.options)
        try:
            cursor = con.cursor()
            cursor.executemany(f"INSERT INTO {self.load}_done VALUES ({self.mark})", [(m.attempt,) for m in messages])
            if self.overwrite:
                cursor.execute(f"DELETE FROM {self.table}")
            cursor.execute(f"INSERT INTO {self.table} ({self._names()}) SELECT {self._names()} FROM {self.load} "
                           f"WHERE load_attempt IN (SELECT load_attempt FROM {self.load}_done)")
            if cursor.rowcount != reported:
                raise LoadError(f"{cursor.rowcount} rows moved, {reported} reported; nothing was loaded")
            if total is not None and int(total) != reported:
                raise LoadError(f"control total {total} != rows loaded {reported}; nothing was loaded")
            con.commit()
        except BaseException:
            con.rollback()
            raise
        finally:
            con.close()
        self._drop()

    def abort(self, messages: list) -> None:
        self._drop()

    def _drop(self) -> None:
        con = _open(self.options)
        try:
            for table in (self.load, f"{self.load}_done"):
                con.cursor().execute(f"DROP TABLE IF EXISTS {table}")
            con.commit()
        finally:
            con.close()


class ArrowBatchedWriter(BatchedWriter, DataSourceArrowWriter):
    """The same for columns of ``PLAIN`` types: their values are taken from whole Arrow columns."""

    def _rows(self, iterator: Iterator[pa.RecordBatch], attempt: int) -> Iterator[tuple]:
        values = _texts if self.options.get("types") == "text" else pa.Array.to_pylist
        return chain.from_iterable(zip(*map(values, batch.columns), repeat(attempt)) for batch in iterator)


@dataclass
class KeyRange(InputPartition):
    low: int
    high: int


class RangeReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, options

    def partitions(self) -> list:
        key, n = self.options["key"], int(self.options.get("ranges", 8))
        con = _open(self.options)
        try:
            cursor = con.cursor()
            cursor.execute(f"SELECT MIN({key}), MAX({key}) FROM {self.options['table']}")
            low, high = cursor.fetchone()
        finally:
            con.close()
        if low is None:
            return [KeyRange(0, 0)]
        step = -(-(high - low + 1) // n)
        return [KeyRange(a, a + step) for a in range(low, high + 1, step)]

    def read(self, partition: KeyRange) -> Iterator[tuple]:
        mark, key = self.options.get("placeholder", "?"), self.options["key"]
        kinds = [f.dataType for f in self.schema.fields]
        con = _open(self.options)
        try:
            cursor = con.cursor()
            cursor.execute(f"SELECT {', '.join(self.schema.names)} FROM {self.options['table']} "
                           f"WHERE {key} >= {mark} AND {key} < {mark}", (partition.low, partition.high))
            while rows := cursor.fetchmany(BATCH_ROWS):
                for row in rows:
                    yield tuple(map(_from_text, row, kinds))
        finally:
            con.close()


class BatchedInsert(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> BatchedWriter:
        plain = all(isinstance(f.dataType, PLAIN) for f in schema.fields)
        return (ArrowBatchedWriter if plain else BatchedWriter)(schema, dict(self.options), overwrite)

    def reader(self, schema: T.StructType) -> RangeReader:
        return RangeReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the data source known to the session."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(BatchedInsert)


def _options(connect: str, target: str, table: str, connect_args: dict | None, more: dict) -> dict[str, str]:
    given = {"connect": connect, "target": target, "table": table, "connect_args": json.dumps(connect_args or {}), **more}
    return {k: str(v) for k, v in given.items() if v is not None}


def batched_insert(df: DataFrame, connect: str, target: str, table: str, *, mode: str = "append", create: str | None = None,
                   batch_rows: int = BATCH_ROWS, control_total: int | None = None, connect_args: dict | None = None,
                   placeholder: str = "?", types: str = "native") -> None:
    """Load ``df`` into a database table in batches, all or nothing.

    ``connect`` names a DB-API ``module:function`` that is called with ``target`` and
    ``connect_args``; ``create`` is a statement that makes the table if it is missing;
    ``mode="overwrite"`` replaces the rows. ``types="text"`` sends decimals,
    dates and timestamps as text.
    """
    register(df.sparkSession)
    options = _options(connect, target, table, connect_args, {
        "create": create, "batch_rows": batch_rows, "control_total": control_total, "placeholder": placeholder, "types": types})
    df.write.format(FORMAT).mode(mode).options(**options).save()


def read_table(spark: SparkSession, connect: str, target: str, table: str, schema: T.StructType, key: str, *,
               ranges: int = 8, connect_args: dict | None = None, placeholder: str = "?") -> DataFrame:
    """A database table, read in ``ranges`` of its whole-number ``key``."""
    register(spark)
    options = _options(connect, target, table, connect_args, {"key": key, "ranges": ranges, "placeholder": placeholder})
    return spark.read.format(FORMAT).schema(schema).options(**options).load()
