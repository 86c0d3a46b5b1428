"""Column contract of the published tables.

The source job renames the query's display names through a map, lower-cases
every name, compares them with the expected list (warning only), converts
the two date columns and fills missing values with ``''``. Here a missing
column is an error, an extra column is reported, and the empty-string fill
touches string columns only (numbers and dates stay null, which is what the
target's typed columns can hold).
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules as R
from ..functions import exact_cast, keeps_digits_sql

log = logging.getLogger(__name__)


class ContractError(ValueError):
    pass


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename through a map; names not in the frame are ignored (as pandas does)."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def column_report(df: DataFrame, expected: Iterable[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) column names, each in a stable order."""
    exp = list(expected)
    have = df.columns
    return [c for c in exp if c not in have], [c for c in have if c not in exp]


def check_columns(df: DataFrame, expected: Iterable[str]) -> list[str]:
    """Fail on missing columns, report extra ones (returned and logged)."""
    missing, extra = column_report(df, expected)
    if missing:
        raise ContractError(f"missing columns: {missing}")
    if extra:
        log.warning("extra columns: %s", extra)
    return extra


def to_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Convert the named columns to timestamps where present.

    Text is cast to ``timestamp_ntz`` directly: no time zone takes part, and
    text that is no timestamp raises, as in the source job.
    """
    out = df
    for c in columns:
        if c not in out.columns:
            continue
        dtype = out.schema[c].dataType
        if not isinstance(dtype, T.TimestampNTZType):
            out = out.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return out


def fill_strings(df: DataFrame, value: str = "") -> DataFrame:
    """Missing string values → ``value``; other types keep their nulls."""
    return df.na.fill(value)


def normalise_mart(df: DataFrame, mapping: Mapping[str, str] = R.DISPLAY_TO_CONTRACT,
                   expected: Iterable[str] = R.MART_COLUMNS,
                   date_columns: Iterable[str] = R.MART_DATE_COLUMNS) -> DataFrame:
    """Display names → contract: rename, lower-case, check, dates, fill, contract order."""
    expected = list(expected)
    out = lower_columns(rename_columns(df, mapping))
    check_columns(out, expected)
    out = fill_strings(to_timestamps(out, date_columns))
    return out.select(*expected)


# --- typed targets -------------------------------------------------------

def spark_type(sql_type: str) -> str:
    """Target SQL type → Spark type used for the cast (VARCHAR length is checked separately)."""
    t = sql_type.strip().upper()
    if t.startswith("VARCHAR") or t.startswith("CHAR") or t == "TEXT":
        return "string"
    if t == "NUMERIC":
        return "decimal(38,10)"
    if t.startswith("NUMERIC(") or t.startswith("DECIMAL("):
        return "decimal" + t[t.index("("):]
    if t == "DATE":
        return "date"
    if t.startswith("TIMESTAMP"):
        return "timestamp_ntz"
    if t in ("BIGINT", "INT", "INTEGER", "SMALLINT", "DOUBLE", "BOOLEAN"):
        return t.lower()
    raise ContractError(f"unsupported target type {sql_type}")


def varchar_length(sql_type: str) -> int | None:
    t = sql_type.strip().upper()
    if t.startswith("VARCHAR(") or t.startswith("CHAR("):
        return int(t[t.index("(") + 1:t.index(")")])
    return None


def apply_contract(df: DataFrame, ddl: Iterable[tuple[str, str]]) -> DataFrame:
    """Select and cast to a typed target; an overlong string fails the job.

    A value that does not fit its type raises (too large, or with digits that
    the target's scale would cut), and a string longer than its ``VARCHAR(n)`` raises, as the
    target database would on insert.
    """
    ddl = list(ddl)
    check_columns(df, [c for c, _ in ddl])
    cols = []
    for name, sql_type in ddl:
        c = exact_cast(name, df.schema[name].dataType, spark_type(sql_type))
        n = varchar_length(sql_type)
        if n is not None:
            c = F.when(F.length(c) > n, F.raise_error(
                F.concat(F.lit(f"value too long for {name} {sql_type}: "), c))).otherwise(c)
        cols.append(c.alias(name))
    return df.select(*cols)


def contract_violations(df: DataFrame, ddl: Iterable[tuple[str, str]], key: str | None = None) -> DataFrame:
    """Every breach of a typed target, counted in one pass instead of failing at the first value.

    (column_name, rule, n_rows, sample_key, sample_value) for each column and
    rule that is broken: ``missing`` (the column is not there; all rows),
    ``type`` (no value of the type, or too large for it), ``digits`` (decimals that the
    type cannot hold), ``length`` (longer than its ``VARCHAR(n)``). The
    sample is the offending value of the row with the smallest ``key``, or the smallest value.
    """
    checks = []  # (column, rule, condition, value)
    for name, sql_type in ddl:
        if name not in df.columns:
            checks.append((name, "missing", "true", "CAST(NULL AS STRING)"))
            continue
        have, want, value = df.schema[name].dataType, spark_type(sql_type), f"`{name}`"
        cast, text = f"TRY_CAST({value} AS {want})", f"CAST({value} AS STRING)"
        kept = keeps_digits_sql(value, have, want, cast)
        n = varchar_length(sql_type)
        if want != "string":
            checks.append((name, "type", f"{value} IS NOT NULL AND {cast} IS NULL", text))
        if kept is not None:
            checks.append((name, "digits", f"{cast} IS NOT NULL AND NOT {kept}", text))
        if n is not None:
            checks.append((name, "length", f"length({text}) > {n}", text))
    by = f"`{key}`" if key else "CAST(NULL AS STRING)"
    sums = []
    for i, (_, _, broken, text) in enumerate(checks):
        sums.append(F.expr(f"count_if({broken})").alias(f"n{i}"))
        sums.append(F.expr(f"min(CASE WHEN {broken} THEN struct({by} AS k, {text} AS v) END)").alias(f"s{i}"))
    if not sums:
        return df.sparkSession.createDataFrame([], VIOLATION_COLUMNS)
    rows = [F.struct(F.lit(column).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"n{i}").alias("n_rows"),
                     F.col(f"s{i}.k").cast("string").alias("sample_key"), F.col(f"s{i}.v").alias("sample_value"))
            for i, (column, rule, _, _) in enumerate(checks)]
    return df.agg(*sums).select(F.inline(F.array(*rows))).filter("n_rows > 0")


VIOLATION_COLUMNS = "column_name string, rule string, n_rows bigint, sample_key string, sample_value string"


def check_contract(df: DataFrame, ddl: Iterable[tuple[str, str]], key: str | None = None) -> None:
    """Fail with all breaches of a typed target at once."""
    found = contract_violations(df, ddl, key).collect()  # at most a row for each column and rule
    if found:
        raise ContractError("; ".join(
            f"{r.column_name}: {r.rule} in {r.n_rows} rows" + (f" (row {r.sample_key}: {r.sample_value!r})" if r.sample_key else
                                                               f" ({r.sample_value!r})" if r.sample_value else "")
            for r in found))


def column_relation(df: DataFrame, ddl: Iterable[tuple[str, str]]) -> DataFrame:
    """The columns of a frame against a typed target, as rows.

    (position, column_name, expected_type, found_type, status, n_rows, n_null):
    the expected columns in their order, then extra ones; status is ``ok``,
    ``type differs``, ``missing`` or ``extra``. The nulls of all columns are counted in one pass.
    """
    expected = {name: spark_type(t) for name, t in ddl}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [*expected, *(c for c in found if c not in expected)]
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names) if c in found])

    def text(value: str | None):
        return F.lit(value).cast("string")

    rows = []
    for i, c in enumerate(names):
        want, have = expected.get(c), found.get(c)
        status = "missing" if have is None else "extra" if want is None else "ok" if want == have else "type differs"
        rows.append(F.struct(
            F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), text(want).alias("expected_type"),
            text(have).alias("found_type"), F.lit(status).alias("status"), F.col("n").alias("n_rows"),
            (F.col("n") - F.col(f"c{i}") if have is not None else F.lit(None).cast("long")).alias("n_null")))
    return counts.select(F.inline(F.array(*rows)))


def create_table_ddl(table: str, ddl: Iterable[tuple[str, str]]) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a typed target (Spark SQL)."""
    body = ", ".join(f"`{c}` {spark_type(t) if varchar_length(t) is None else t}" for c, t in ddl)
    return f"CREATE TABLE IF NOT EXISTS {table} ({body}) USING parquet"


def jdbc_column_types(ddl: Iterable[tuple[str, str]]) -> str:
    """``createTableColumnTypes`` option for the JDBC writer."""
    return ", ".join(f"{c} {t}" for c, t in ddl)
