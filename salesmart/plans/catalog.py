"""Typed tables in a named schema of the catalog.

The source jobs set a default schema, create their table there if it is missing,
and empty it before they load.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .contract import apply_contract, create_table_ddl


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@contextmanager
def default_schema(spark: SparkSession, schema: str, location: str | None = None) -> Iterator[str]:
    """Names without a schema mean ``schema`` inside the block; the one before is in force again after it.

    The schema is created if it is missing (under ``location``, if given).
    """
    before = spark.catalog.currentDatabase()
    where = " LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)}{where}")
    spark.catalog.setCurrentDatabase(schema)
    try:
        yield schema
    finally:
        spark.catalog.setCurrentDatabase(before)


def replace_table(df: DataFrame, table: str, ddl: Iterable[tuple[str, str]], schema: str | None = None) -> None:
    """Create the typed table if it is missing, and replace its rows by ``df``.

    ``schema`` qualifies the name; without it the default schema holds. The rows are
    cast by the contract; a table that is there keeps its definition.
    Readers of a plain catalog table can meet it half replaced; where that matters, publish by ``History``.
    """
    spark = df.sparkSession
    ddl = list(ddl)
    name = f"{_quoted(schema)}.{_quoted(table)}" if schema else _quoted(table)
    spark.sql(create_table_ddl(name, ddl))
    apply_contract(df, ddl).write.mode("overwrite").insertInto(name)
