"""Batched insert, all or nothing, into a database file (no server)."""

import datetime as dt
import sqlite3
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.sources import batched_insert, read_table

CREATE = "CREATE TABLE IF NOT EXISTS orders (id INTEGER, amount TEXT, day TEXT, note TEXT)"
SCHEMA = "id bigint, amount decimal(12,4), day date, note string"
WAIT = {"timeout": 120}


def frame(spark, n, parts=4, note="x"):
    return spark.range(n).repartition(parts).select(
        "id", (F.col("id") / 8).cast("decimal(12,4)").alias("amount"),
        F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") % 9).cast("int")).alias("day"),
        F.when(F.col("id") % 3 > 0, F.lit(note)).alias("note"))


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "orders.db")


def load(df, path, **more):
    batched_insert(df, "sqlite3:connect", path, "orders", create=CREATE, connect_args=WAIT, types="text", **more)


def tables(path):
    con = sqlite3.connect(path)
    try:
        return sorted(r[0] for r in con.execute("SELECT name FROM sqlite_master"))
    finally:
        con.close()


def back(spark, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return read_table(spark, "sqlite3:connect", path, "orders", schema, "id", ranges=3, connect_args=WAIT)


def test_round_trip_append_and_replace(spark, path):  # S7, S8
    load(frame(spark, 2500), path, batch_rows=1000, control_total=2500)
    assert back(spark, path).schema == frame(spark, 1).schema or back(spark, path).dtypes == frame(spark, 1).dtypes
    assert sorted(map(tuple, back(spark, path).collect())) == sorted(map(tuple, frame(spark, 2500).collect()))
    load(frame(spark, 10), path)
    assert back(spark, path).count() == 2510
    load(frame(spark, 7, note="new"), path, mode="overwrite")
    assert back(spark, path).count() == 7 and back(spark, path).filter("note = 'new'").count() == 4
    load(frame(spark, 0), path, mode="overwrite")
    assert back(spark, path).count() == 0
    assert tables(path) == ["orders"]


def test_batches_and_remainder():
    """10,000 rows a statement, whatever the task holds."""
    from salesmart.sources import batched

    sent = []

    class Connection:
        def cursor(self):
            return self

        def executemany(self, statement, rows):
            sent.append(len(rows))

        def execute(self, statement):
            pass

        commit = rollback = close = lambda self: None

    class Context:
        taskAttemptId = staticmethod(lambda: 5)

    from pyspark.sql import types as T

    plain, context = batched._open, batched.TaskContext
    batched._open, batched.TaskContext = lambda options: Connection(), type("C", (), {"get": staticmethod(lambda: Context)})
    try:
        writer = batched.BatchedWriter(T.StructType([T.StructField("id", T.LongType())]), {"table": "t"}, False)
        done = writer.write((i,) for i in range(25_000))
    finally:
        batched._open, batched.TaskContext = plain, context
    assert sent == [10_000, 10_000, 5_000] and (done.rows, done.batches, done.attempt) == (25_000, 3, 5)


def test_a_failing_task_leaves_the_target_as_it_was(spark, path):  # S8, S12
    load(frame(spark, 100), path)
    broken = frame(spark, 4000).withColumn(
        "note", F.when(F.col("id") == 3999, F.raise_error(F.lit("lost"))).otherwise(F.col("note")))
    with pytest.raises(Exception, match="lost"):
        load(broken, path, mode="overwrite", batch_rows=100)
    assert back(spark, path).count() == 100 and tables(path) == ["orders"]


def test_a_wrong_total_rolls_back(spark, path):  # S3, T21
    load(frame(spark, 100), path)
    with pytest.raises(Exception, match="control total 41"):
        load(frame(spark, 40), path, mode="overwrite", control_total=41)
    assert back(spark, path).count() == 100 and tables(path) == ["orders"]


def test_rows_of_attempts_that_were_not_reported_stay_behind(spark, path):
    """An attempt that committed its rows and was lost before it reported is not loaded twice."""
    from pyspark.sql import types as T

    from salesmart.sources import batched

    load(frame(spark, 1), path)
    options = {"connect": "sqlite3:connect", "target": path, "table": "orders"}
    writer = batched.BatchedWriter(T.StructType([T.StructField("id", T.LongType())]), options, False)
    con = sqlite3.connect(path)
    con.executemany(f"INSERT INTO {writer.load} VALUES (?, ?)", [(10, 1), (11, 1), (10, 2), (11, 2)])
    con.commit()
    con.close()
    writer.commit([batched.Loaded(2, 2, 1)])
    assert sorted(r.id for r in back(spark, path).collect()) == [0, 10, 11] and tables(path) == ["orders"]
    # and where a report does not match the rows, nothing is loaded
    writer = batched.BatchedWriter(T.StructType([T.StructField("id", T.LongType())]), options, True)
    with pytest.raises(batched.LoadError, match="0 rows moved, 2 reported"):
        writer.commit([batched.Loaded(7, 2, 1)])
    writer.abort([])
    assert back(spark, path).count() == 3 and tables(path) == ["orders"]


def test_values(spark, path):
    load(frame(spark, 9), path)
    row = back(spark, path).filter("id = 7").first()
    assert tuple(row) == (7, Decimal("0.8750"), dt.date(2026, 1, 8), "x")


def test_the_database_is_held_for_the_inserts_alone():
    """Rows are fetched while no transaction is open: tasks of a database with one writer don't wait for each other's."""
    from pyspark.sql import types as T

    from salesmart.sources import batched

    log = []

    class Connection:
        def cursor(self):
            return self

        def executemany(self, statement, rows):
            log.append("insert")

        def execute(self, statement):
            pass

        def commit(self):
            log.append("commit")

        rollback = close = lambda self: None

    def source():
        for i in range(30):
            log.append("fetch")
            yield (i,)

    context = type("C", (), {"get": staticmethod(lambda: type("T", (), {"taskAttemptId": staticmethod(lambda: 5)}))})
    plain, was = batched._open, batched.TaskContext
    batched._open, batched.TaskContext = lambda options: Connection(), context
    try:
        writer = batched.BatchedWriter(T.StructType([T.StructField("id", T.LongType())]), {"table": "t", "batch_rows": "2"}, False)
        done = writer.write(source())
    finally:
        batched._open, batched.TaskContext = plain, was
    assert (done.rows, done.batches) == (30, 15) and log.count("insert") == 15
    opened = [b for a, b in zip(log, log[1:]) if a == "insert"]
    assert "fetch" not in opened and log[-1] == "commit"


def test_values_of_columns_are_those_of_rows():
    import pyarrow as pa

    from salesmart.sources import batched

    values = [Decimal("0.0000000012"), Decimal("0E-10"), Decimal("-12.5000000000"), None]
    assert batched._texts(pa.array(values, pa.decimal128(20, 10))) == [
        None if v is None else format(v.quantize(Decimal("1E-10")), "f") for v in values]
    for column in ([dt.date(2026, 1, 2), None], [1, None], ["E", None], [True, None], [0.5, None]):
        assert batched._texts(pa.array(column)) == [batched._as_text(v) for v in column]
