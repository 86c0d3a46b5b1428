"""Join helpers: role-playing dimensions and existence tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def role(df: DataFrame, prefix: str, columns: list[str] | None = None) -> DataFrame:
    """The same table in another role: every column renamed ``<prefix>_<col>``.

    Using prefixed names instead of ``df.alias`` keeps several copies of one
    table (party x3, account x3, …) unambiguous after the joins.
    """
    cols = columns or df.columns
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def exists_any(df: DataFrame, key: str, **flags: Column) -> DataFrame:
    """Per key, whether any row satisfies each flag predicate (null counts as false).

    An inner join whose columns are never selected, collapsed by DISTINCT, is
    an existence test. Reducing the inner side to one row of flags per key
    (partial aggregation, skew-safe) turns the fan-out join into a
    many-to-one join and lets predicates that mix both sides be evaluated
    after it.
    """
    return df.groupBy(key).agg(*[
        F.max(F.coalesce(pred, F.lit(False)).cast("int")).cast("boolean").alias(name)
        for name, pred in flags.items()])


def semi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``EXISTS (SELECT 1 FROM right WHERE right_key = left_key)`` as a left-semi join."""
    r = right.select(F.col(right_key).alias("__sk"))
    return left.join(r, left[left_key] == r["__sk"], "left_semi")
