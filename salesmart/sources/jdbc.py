"""JDBC source and sink options.

The source job pulls every table through one cursor in one process. Here a
large table is read by ``numPartitions`` parallel range queries on a numeric
column, and filters/projections are pushed into the database by Spark's
JDBC source. Equal-width ranges serve evenly spread ids; where ids have gaps or
clusters, split points come from the database's own quantiles. One cursor sees
one state of the database and many connections do not, so all queries of a load
can be tied to one named state (:class:`Snapshot`). Writes go through Spark's JDBC writer, which inserts each
partition in batches (``batchsize``) inside its own connection.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from .tables import ErpTables


@dataclass(frozen=True)
class Snapshot:
    """How a database reads a table in one past state.

    ``clause`` follows the table's name and has ``{at}`` for the state; ``ask``
    is a query for the present state (one row, one column).
    """

    clause: str
    ask: str

    def table(self, name: str, at) -> str:
        """The table in that state, as a source for :func:`read_jdbc`."""
        text = str(at)
        if not text or not all(c.isalnum() or c in "-:. " for c in text):
            raise ValueError(f"not the name of a database state: {text!r}")
        return f"(SELECT * FROM {name} {self.clause.format(at=text)}) s"


# --- FIXED VALUES: flashback query of the source database (system change numbers)
ORACLE_SNAPSHOT = Snapshot("AS OF SCN {at}", "SELECT current_scn AS at_scn FROM v$database")


def current_state(spark: SparkSession, url: str, snapshot: Snapshot, *, properties: Mapping[str, str] | None = None) -> str:
    """The database's present state by ``snapshot.ask``, as text (a number without a fraction)."""
    row = read_jdbc(spark, url, f"({snapshot.ask}) q", properties=properties).first()
    if row is None or row[0] is None:
        raise ValueError("the database names no present state")
    value = row[0]
    return str(int(value)) if hasattr(value, "as_tuple") and value == int(value) else str(value)


def read_jdbc(spark: SparkSession, url: str, table: str, *, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              predicates: list[str] | None = None,
              fetchsize: int = 10_000, custom_schema: str | None = None) -> DataFrame:
    """Partitioned JDBC read (``spark.read.jdbc``) of one table or ``(subquery) t``.

    With ``partition_column`` the read becomes ``num_partitions`` range
    queries; bounds only decide the stride, no row is filtered by them. With
    ``predicates`` it becomes one query for each of them.
    """
    if predicates:
        options = {"fetchsize": str(fetchsize), **(properties or {})}
        if custom_schema:
            options["customSchema"] = custom_schema
        return spark.read.jdbc(url, table, predicates=predicates, properties=options)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", str(fetchsize))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if custom_schema:
        reader = reader.option("customSchema", custom_schema)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def partition_bounds(spark: SparkSession, url: str, table: str, column: str, *,
                     properties: Mapping[str, str] | None = None,
                     quote: bool = False) -> tuple[int, int] | None:
    """``(MIN(column), MAX(column))`` computed by the database: one row comes back.

    ``quote`` wraps the column in double quotes (for case-sensitive names).
    """
    col = f'"{column}"' if quote else column
    probe = read_jdbc(spark, url, f"(SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {table}) b",
                      properties=properties).first()
    if probe is None or probe[0] is None:
        return None
    return int(probe[0]), int(probe[1])


# --- FIXED VALUES: queries that cut a table into n parts of equally many rows by a column, and name each part's
# --- lowest value; the second is for databases without NTILE
TILES = ("SELECT MIN(v) AS lo FROM (SELECT {column} AS v, NTILE({n}) OVER (ORDER BY {column}) AS part FROM {table} "
         "WHERE {column} IS NOT NULL) p GROUP BY part")
TILES_BY_ROW = ("SELECT MIN(v) AS lo FROM (SELECT o.v AS v, (o.r - 1) * {n} / c.total AS part "
                "FROM (SELECT v, ROW_NUMBER() OVER () AS r FROM (SELECT {column} AS v FROM {table} WHERE {column} IS NOT NULL "
                "ORDER BY {column}) s) o, (SELECT COUNT({column}) AS total FROM {table}) c) p GROUP BY part")


def split_points(spark: SparkSession, url: str, table: str, column: str, n: int, *,
                 properties: Mapping[str, str] | None = None, quote: bool = False, tiles: str = TILES) -> list:
    """The lowest values of ``n`` parts with equally many rows, found by the database: at most ``n`` come back."""
    if n < 1:
        raise ValueError("a table has at least one part")
    col = f'"{column}"' if quote else column
    query = tiles.format(column=col, table=table, n=n)
    rows = read_jdbc(spark, url, f"({query}) q", properties=properties).collect()
    return sorted({int(r[0]) for r in rows})


def range_predicates(column: str, points: list) -> list[str]:
    """Conditions that deal every row to exactly one part: those below the second point (and nulls), and so on.

    A value that fills several parts starts one of its own, so parts never overlap.
    """
    cuts = points[1:]
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *between, f"{column} >= {cuts[-1]}"]


def jdbc_tables(spark: SparkSession, url: str, *, schema: str | None = None,
                properties: Mapping[str, str] | None = None,
                partitioning: Mapping[str, tuple] | None = None,
                quote_identifiers: bool = False, snapshot: Snapshot | None = None, at=None,
                tiles: str = TILES) -> ErpTables:
    """ERP tables read over JDBC.

    ``partitioning[table] = (column, lo, hi, n)`` splits a table into ``n``
    range queries; ``(column, n)`` asks the database for the bounds first and
    ``(column, "quantiles", n)`` for split points with equally many rows between.
    A table that is not named is read through one connection, by one task.

    With ``snapshot`` every query, bounds included, reads the state ``at``; where
    it is not given, the database is asked for its present state once, before
    the first table, and the mapping keeps it as ``state``.
    """
    partitioning = partitioning or {}

    def load(name: str) -> DataFrame:
        table = f"{schema}.{name}" if schema else name
        if snapshot is not None:
            if tables.state is None:
                tables.state = current_state(spark, url, snapshot, properties=properties)
            table = snapshot.table(table, tables.state)
        return read_partitioned(spark, url, table, partitioning.get(name), properties=properties,
                                quote=quote_identifiers, tiles=tiles)

    tables = ErpTables(load)
    tables.state = at
    return tables


def read_partitioned(spark: SparkSession, url: str, table: str, how: tuple | None, *,
                     properties: Mapping[str, str] | None = None, quote: bool = False,
                     tiles: str = TILES) -> DataFrame:
    """One table or ``(subquery) t``, split as ``partitioning`` of :func:`jdbc_tables` says (None: one query)."""
    if not how:
        return read_jdbc(spark, url, table, properties=properties)
    column, n = how[0], how[-1]
    if len(how) == 3:
        if how[1] != "quantiles":
            raise ValueError(f"unknown way to split {table}: {how[1]!r}")
        points = split_points(spark, url, table, column, n, properties=properties, quote=quote, tiles=tiles)
        named = f'"{column}"' if quote else column
        return read_jdbc(spark, url, table, properties=properties, predicates=range_predicates(named, points))
    bounds = how[1:3] if len(how) == 4 else partition_bounds(spark, url, table, column, properties=properties, quote=quote)
    if bounds is None:
        return read_jdbc(spark, url, table, properties=properties)
    return read_jdbc(spark, url, table, properties=properties, partition_column=column, lower_bound=bounds[0],
                     upper_bound=bounds[1], num_partitions=n)


def read_with_total(spark: SparkSession, url: str, table: str, how: tuple | None = None, *,
                    properties: Mapping[str, str] | None = None, snapshot: Snapshot | None = None, at=None,
                    quote: bool = False, tiles: str = TILES) -> tuple[DataFrame, int]:
    """A table and its control total ``COUNT(*)``, counted by the database, both of one state where one is named."""
    if snapshot is not None:
        table = snapshot.table(table, current_state(spark, url, snapshot, properties=properties) if at is None else at)
    total = read_jdbc(spark, url, table, properties=properties).agg(F.count(F.lit(1))).first()[0]
    return read_partitioned(spark, url, table, how, properties=properties, quote=quote, tiles=tiles), total


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append",
               properties: Mapping[str, str] | None = None, batchsize: int = R.INSERT_BATCH_ROWS,
               truncate: bool = False, column_types: str | None = None,
               num_partitions: int | None = None) -> None:
    """Write ``df`` to a JDBC table.

    ``mode='overwrite', truncate=True`` is the full replace (TRUNCATE then
    load, keeping the table definition); ``column_types`` sets the DDL
    types Spark uses when it has to create the table (``CREATE TABLE IF
    NOT EXISTS``). ``num_partitions`` caps concurrent connections.
    """
    writer = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("batchsize", str(batchsize)))
    if truncate:
        writer = writer.option("truncate", "true")
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()

