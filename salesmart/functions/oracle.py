"""Column expressions with the source database's semantics.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a UDF.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nvl(value: ColumnOrName, default) -> Column:
    """``NVL(a, b)``: ``b`` where ``a`` is null."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(_c(value), d)


def trunc_day(ts: ColumnOrName) -> Column:
    """``TRUNC(date)``: the calendar day of a timestamp.

    A plain cast keeps a range filter on the raw column pushable to the
    scan; ``date_trunc``/``trunc(…,'DD')`` are not (and ``trunc`` with 'DD'
    returns null in Spark).
    """
    return _c(ts).cast("date")


def add_months_oracle(d: ColumnOrName, months: int | Column) -> Column:
    """``ADD_MONTHS``: like Spark's, except that a month end maps to a month end.

    Spark gives ``add_months('2025-02-28', -12) = 2024-02-28``; the source
    database gives 2024-02-29.
    """
    day = _c(d).cast("date")
    shifted = F.add_months(day, months)
    return F.when(day == F.last_day(day), F.last_day(shifted)).otherwise(shifted)


def add_months_date(d: _dt.date, months: int) -> _dt.date:
    """``ADD_MONTHS`` on a Python date, with the month-end rule (for arguments and literals)."""
    y, m = divmod(d.month - 1 + months, 12)
    y, m = d.year + y, m + 1

    def last_day(yy: int, mm: int) -> int:
        nxt = _dt.date(yy + (mm == 12), mm % 12 + 1, 1)
        return (nxt - _dt.timedelta(days=1)).day

    if d.day == last_day(d.year, d.month):
        return _dt.date(y, m, last_day(y, m))
    return _dt.date(y, m, min(d.day, last_day(y, m)))


def window_start(as_of, months: int) -> _dt.datetime:
    """First instant of the trailing window: midnight of ``ADD_MONTHS(TRUNC(as_of), -months)``."""
    return _dt.datetime.combine(add_months_date(_as_date(as_of), -months), _dt.time())


def trailing_window_bounds(as_of: _dt.date | str, months: int) -> tuple[Column, Column]:
    """``[TRUNC(ADD_MONTHS(as_of, -months)), TRUNC(as_of)]`` as date literals.

    Computed as literals so Catalyst folds them and the range reaches the
    parquet scan as a pushed filter.
    """
    hi = F.lit(_as_date(as_of))
    return add_months_oracle(hi, -months), hi


def in_trailing_window(ts: ColumnOrName, as_of, months: int) -> Column:
    lo, hi = trailing_window_bounds(as_of, months)
    return trunc_day(ts).between(lo, hi)


def _as_date(v) -> _dt.date:
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v)[:10])


def substr_from(s: ColumnOrName, start: int, length: int | None = None) -> Column:
    """``SUBSTR(s, start[, length])``; start 0 counts as 1, as in the source."""
    start = max(start, 1)
    if length is None:
        return F.substr(_c(s), F.lit(start))
    return F.substr(_c(s), F.lit(start), F.lit(length))


def first_token(s: ColumnOrName, sep: str = "-") -> Column:
    """``REGEXP_SUBSTR(s, '[^sep]+')``: first non-empty token or null."""
    return F.regexp_substr(_c(s), F.lit(f"[^{sep}]+"))


def empty_as_null(s: ColumnOrName) -> Column:
    """The source treats ``''`` as null."""
    return F.nullif(_c(s), F.lit(""))


def clean_org_name(name: ColumnOrName, start: int, suffix: str) -> Column:
    """``TRIM(REPLACE(SUBSTR(name, start), suffix, ''))``, empty → null."""
    return empty_as_null(F.trim(F.replace(substr_from(name, start), F.lit(suffix), F.lit(""))))


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def like_any(c: ColumnOrName, patterns) -> Column:
    """``c LIKE p1 OR c LIKE p2 …``; null when ``c`` is null.

    For a column name the whole disjunction is one SQL expression (one
    round trip to the JVM instead of two per pattern).
    """
    if isinstance(c, str):
        return F.expr("(" + " OR ".join(f"`{c}` LIKE {sql_string(p)}" for p in patterns) + ")")
    col = _c(c)
    return reduce(lambda a, b: a | b, [col.like(p) for p in patterns])


def not_like_all(c: ColumnOrName, patterns) -> Column:
    """``c NOT LIKE p1 AND c NOT LIKE p2 …``; null when ``c`` is null."""
    if isinstance(c, str):
        return F.expr("(" + " AND ".join(f"`{c}` NOT LIKE {sql_string(p)}" for p in patterns) + ")")
    col = _c(c)
    return reduce(lambda a, b: a & b, [~col.like(p) for p in patterns])


def upper_like(c: ColumnOrName, pattern: str) -> Column:
    return F.upper(_c(c)).like(pattern)


def is_true(pred: Column) -> Column:
    """Null-safe truth: null counts as false (SQL WHERE semantics, made explicit)."""
    return F.coalesce(pred, F.lit(False))


# The digits before and after the point, and the exponent, at the end of a text that is a number.
_NUMBER = "'([0-9]*)[.]?([0-9]*)(?:[eE]([+-]?[0-9]+))?[^0-9]*$'"


def _decimals_sql(text: str) -> str:
    """SQL for the decimals that a number given as text needs (less than 1 for whole ones, null for zero)."""
    whole, cut, power = (f"regexp_extract({text}, {_NUMBER}, {i})" for i in (1, 2, 3))
    digits = f"concat({whole}, {cut})"
    needed = f"rtrim('0', {digits})"
    return (f"CASE WHEN {needed} <> '' THEN length({cut}) - (length({digits}) - length({needed})) "
            f"- coalesce(cast(nullif({power}, '') AS int), 0) END")


def keeps_digits_sql(value: str, have: T.DataType, want: str, cast: str) -> str | None:
    """SQL that is true where ``cast``, the value as ``want``, has all digits of ``value``; None where no cast can lose any.

    Decimals are compared with the result in their own type. So are floats and doubles:
    the result must be the number that the source has (0.1 is 0.1000, 0.123456 is not 0.1235).
    Of text the decimals are counted.
    """
    scale = int(want.rstrip(")").split(",")[1]) if want.startswith("decimal(") else 0
    decimal = want.startswith("decimal")
    if not (decimal or want in ("bigint", "int", "smallint", "tinyint")):
        return None
    if isinstance(have, T.DecimalType) and have.scale > scale or isinstance(have, (T.FloatType, T.DoubleType)):
        # compared in the source's type: a common type of both would round the source as well
        return f"CAST({cast} AS {have.simpleString()}) = {value}"
    if isinstance(have, T.StringType) and decimal:
        return f"coalesce({_decimals_sql(value)} <= {scale}, true)"
    return None


def exact_cast_sql(value: str, have: T.DataType, want: str, name: str) -> str:
    """SQL that casts ``value`` to ``want`` and raises where digits would be lost.

    Casts that cannot lose digits are plain; a value that does not fit raises under ANSI mode.
    """
    cast = f"CAST({value} AS {want})"
    kept = keeps_digits_sql(value, have, want, cast)
    if kept is None:
        return cast
    return (f"CASE WHEN {value} IS NULL OR {kept} THEN {cast} "
            f"ELSE raise_error('{name}: a value has more decimals than {want} can hold') END")


def exact_cast(column: str, have: T.DataType, want: str) -> Column:
    """:func:`exact_cast_sql` as a column."""
    return F.expr(exact_cast_sql(f"`{column}`", have, want, column))


def order_reference(text: ColumnOrName) -> Column:
    """``TO_NUMBER(reference)`` as an order number: ``12``, ``12.0`` and ``1E1`` are numbers.

    Null for text that is no number or no whole one; such rows cannot match.
    """
    number = _c(text).try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))
