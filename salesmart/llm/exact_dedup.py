"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after deleting ASCII white space; a
null text counts as empty.  Of equal texts the row with the most code points
stays, then the one with the smallest id (a null id comes last).

1. A Misra-Gries summary (``freqItems``) over the digests gives at most
   ``1 / support`` candidates, among them every digest with more than
   ``support`` of the rows.
2. The candidates are verified by an exact aggregate, which also finds each
   one's winner.  At most ``1 / support`` rows are broadcast.
3. Rows with such a digest are settled on the map side, without a shuffle.
   The rest, where no group holds more than ``support`` of the rows, takes one
   ordinary shuffle by digest.

Defined cases: null, empty and blank texts form one group; repeated rows (same
id and text) are members of their group like any other and one of them stays;
an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, staged

#: Share of the rows from which on a digest is surely treated as frequent.
SUPPORT = 0.001
#: The characters that do not count.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def points(text: Column) -> Column:
    return F.char_length(F.coalesce(text, F.lit(""))).cast("long")


def frequent(keys: DataFrame, column: str, support: float = SUPPORT) -> DataFrame:
    """At most 1/support values, every one above the support among them."""
    found = keys.stat.freqItems([column], support)
    return found.select(F.explode(found.columns[0]).alias(column))


def verified_winners(keys: DataFrame, support: float) -> DataFrame:
    """Winner and size of the candidate groups that have more than one row.

    ``keys`` has key, points, id and row; at most 1/support rows come back.
    """
    order = F.struct((-F.col("points")).alias("fewer"), F.col("id").isNull().alias("no_id"), "id", "row")
    sizes = (
        keys.join(F.broadcast(frequent(keys, "key", support)), "key")
        .groupBy("key")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
    )
    return staged(sizes, "winners")


def _first(*by: str) -> Window:
    return Window.partitionBy(*by).orderBy(
        F.col("points").desc(), F.col("id").asc_nulls_last(), F.col("row")
    )


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    keys = staged(
        docs.select(
            F.col(id).alias("id"),
            digest(F.col(text)).alias("key"),
            points(F.col(text)).alias("points"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    hot = verified_winners(keys, support)
    by_map = keys.join(F.broadcast(hot), "key").select(
        "id",
        F.col("first.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        "key",
    )
    by_shuffle = keys.join(F.broadcast(hot), "key", "left_anti").select(
        "id",
        F.first("id").over(_first("key")).alias("keep_id"),
        F.count(F.lit(1)).over(Window.partitionBy("key")).alias("group_size"),
        (F.row_number().over(_first("key")) == 1).alias("kept"),
        "key",
    )
    return by_map.unionByName(by_shuffle).select(
        F.col("id").alias(id), "keep_id", "group_size", "kept", F.col("key").alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Texts of frequent groups never shuffle; the others shuffle once.
    """
    names = key, pts, row = fresh(docs, "key", "points", "row")
    tagged = docs.withColumns(
        {key: digest(F.col(text)), pts: points(F.col(text)), row: F.lit(0)}
    )
    keys = staged(
        tagged.select(F.col(id).alias("id"), F.col(key).alias("key"), F.col(pts).alias("points"), F.col(row).alias("row")),
        "digests",
    )
    hot = verified_winners(keys, support)
    (win,) = fresh(tagged, "win")
    winners = hot.select(F.col("key").alias(key), F.col("first").alias(win))
    is_winner = (F.col(pts) == -F.col(f"{win}.fewer")) & F.col(id).eqNullSafe(F.col(f"{win}.id"))
    by_map = tagged.join(F.broadcast(winners), key).where(is_winner).drop(win).dropDuplicates([key])
    place = Window.partitionBy(key).orderBy(F.col(pts).desc(), F.col(id).asc_nulls_last())
    by_shuffle = (
        tagged.join(F.broadcast(winners.select(key)), key, "left_anti")
        .withColumn(row, F.row_number().over(place))
        .where(F.col(row) == 1)
    )
    columns = docs.columns
    return by_map.select(columns).unionByName(by_shuffle.select(columns)).drop(*names)
