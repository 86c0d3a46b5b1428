"""Correlated scalar subqueries, re-expressed as aggregate + left join.

A correlated subquery ``(SELECT agg(x) FROM t WHERE t.k = outer.k)`` becomes
``t.groupBy(k).agg(...)`` joined back with a LEFT join. The aggregate runs
with map-side partial aggregation, so a hot key is collapsed before the
shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup(df: DataFrame, key: str | list[str], **aggs: Column) -> DataFrame:
    """``df.groupBy(key).agg(name=expr, ...)``: one row per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])


def attach(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
           defaults: dict | None = None) -> DataFrame:
    """LEFT JOIN a one-row-per-key frame; ``defaults`` fills misses (``NVL(sub, 0)``).

    ``right`` must be unique on its key (it comes from :func:`rollup` or
    :func:`guarded_lookup`), so the join never multiplies rows.
    """
    right_key = right_key or left_key
    r = right.withColumnRenamed(right_key, "__rk") if right_key != "__rk" else right
    out = left.join(r, left[left_key] == r["__rk"], "left").drop("__rk")
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value).cast(out.schema[name].dataType)))
    return out


def guarded_lookup(df: DataFrame, key: str, value: str, name: str, *, distinct: bool) -> DataFrame:
    """Per key: the value a scalar subquery returns, plus how many rows it would see.

    Returns (key, ``name``, ``name__n``). ``distinct=True`` models
    ``SELECT DISTINCT v``: several equal values count once, a null counts as
    a value. Use :func:`enforce_single` after the join so only keys that are
    actually looked up can fail, as in the source database.
    """
    v = F.col(value)
    if distinct:
        n = F.count_distinct(v) + F.max(F.when(v.isNull(), 1).otherwise(0))
    else:
        n = F.count(F.lit(1))
    return df.groupBy(key).agg(F.min(v).alias(name), n.alias(f"{name}__n"))


def enforce_single(df: DataFrame, name: str) -> DataFrame:
    """Fail like ``SCALAR_SUBQUERY_TOO_MANY_ROWS`` where a looked-up key had >1 rows."""
    n = F.col(f"{name}__n")
    checked = F.when(n > 1, F.raise_error(F.concat(
        F.lit(f"scalar lookup '{name}' returned more than one row"))).cast(df.schema[name].dataType)
    ).otherwise(F.col(name))
    return df.withColumn(name, checked).drop(f"{name}__n")
