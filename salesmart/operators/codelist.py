"""Inline code relations: a comma list split into rows (ordinal, token)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import category_case


def split_list(text: Column, sep: str = ",") -> Column:
    """Non-empty tokens of ``text`` as an array (``REGEXP_SUBSTR(text, '[^,]+', 1, n)`` for all n)."""
    return F.regexp_extract_all(text, F.lit(f"([^{sep}]+)"), 1)


def explode_list(df: DataFrame, text_col: str, sep: str = ",", *, ordinal: str = "ordinal",
                 token: str = "token") -> DataFrame:
    """One row per token of ``text_col`` with its 1-based position; blank tokens dropped.

    Row-wise (``posexplode``), so it runs on every partition with no shuffle.
    """
    exploded = df.select("*", F.posexplode(split_list(F.col(text_col), sep)).alias("_pos", "_tok"))
    return (exploded
            .withColumn(token, F.trim(F.col("_tok")))
            .withColumn(ordinal, (F.col("_pos") + 1).cast("int"))
            .filter(F.col(token) != "")
            .drop("_pos", "_tok"))


def code_list(spark: SparkSession, rules: R.MartRules = R.DEFAULT_RULES) -> DataFrame:
    """``data_item``: (ordinal, item_code, sp_type) for the configured code list.

    The list is a fixed constant (70 entries), so its size is bounded and
    broadcasting it is always safe.
    """
    base = spark.range(1).select(F.lit(rules.code_list).alias("_codes"))
    codes = explode_list(base, "_codes", ordinal="ordinal", token="item_code").drop("_codes")
    return F.broadcast(codes.withColumn("sp_type", category_case("item_code", rules.category_rules)))
