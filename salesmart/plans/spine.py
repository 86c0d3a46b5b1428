"""The spine of a mart run: the window's invoices, their lines, and the return lines.

The invoice total, the fact rows, and the returns all start from the same invoices
and lines. Here both are read once and written under the shared folder. The
line table is the largest there is and has no date of its own:

* as it comes, it is scanned once. Of other lines than those with an id between
  the window's first and last invoice only return lines pass the scan (both
  conditions are pushed down). The lines of the window are marked by a bit for
  each invoice id (:func:`id_bits`), a table small enough to be broadcast where the
  ids are not, so the lines need not travel; return lines of other invoices
  pass unmarked;
* landed by invoice month (:func:`salesmart.sources.land_lines_by_month`), the
  months outside the window are never listed: the scan of the lines is pruned
  by the months that the window's headers have (dynamic partition pruning),
  and the return lines are partitions of their own.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import in_trailing_window
from ..session import discard, stored
from ..sources.tables import LINE_MONTH, line_month


@dataclass
class Spine:
    """``headers``: the window's sale invoices; ``lines``: all their lines; ``returns``: lines that return others."""

    headers: DataFrame
    lines: DataFrame
    returns: DataFrame
    parts: tuple[DataFrame, ...] = ()

    def discard(self) -> None:
        """Delete the stored tables; frames built on the spine cannot be read any more."""
        discard(*self.parts)


def window_invoices(erp: Mapping[str, DataFrame], as_of, rules: R.MartRules) -> DataFrame:
    """Invoice headers dated inside the trailing window whose type counts as a sale."""
    types = (erp["ra_cust_trx_types_all"]
             .filter(F.col("name").isin(list(rules.invoice_types)))
             .select("cust_trx_type_id", F.col("name").alias("trx_source")))
    return (erp["ra_customer_trx_all"]
            .filter(in_trailing_window("trx_date", as_of, rules.window_months))
            .join(types, "cust_trx_type_id")
            .drop("cust_trx_type_id", "previous_customer_trx_id"))


def lines_of_months(monthly: DataFrame, headers: DataFrame) -> DataFrame:
    """The lines of the given invoices out of lines landed by month.

    The months of the headers (13 at most in a window of 12) are broadcast, and
    Spark prunes the partitions of the line scan by them.
    """
    months = headers.select(line_month(F.col("trx_date")).alias(LINE_MONTH)).distinct()
    pruned = monthly.join(F.broadcast(months), LINE_MONTH, "left_semi")
    return pruned.join(headers.select("customer_trx_id"), "customer_trx_id", "left_semi").drop(LINE_MONTH, "is_return")


def id_bits(ids: DataFrame, id: str) -> DataFrame:
    """Which ids there are: for each block of 4,096 ids its number and 64 words of 64 bits."""
    of_words = (ids.filter(F.col(id).isNotNull())
                .groupBy(F.shiftright(id, 6).alias("word"))
                .agg(F.expr(f"bit_or(shiftleft(1L, CAST({id} & 63 AS INT)))").alias("bits")))
    return (of_words.groupBy(F.shiftright("word", 6).alias("block"))
            .agg(F.expr("map_from_entries(collect_list(struct(CAST(word & 63 AS INT) AS at, bits)))").alias("found"))
            .select("block", F.expr("transform(sequence(0, 63), k -> coalesce(found[k], 0L))").alias("words")))


def marked_by(df: DataFrame, bits: DataFrame, id: str, name: str) -> DataFrame:
    """All rows, with ``name`` telling whether the id is one of those in ``bits`` (:func:`id_bits`)."""
    bit = F.expr(f"getbit(words[CAST(shiftright({id}, 6) & 63 AS INT)], CAST({id} & 63 AS INT)) = 1")
    return (df.join(bits, F.shiftright(id, 12) == F.col("block"), "left")
            .withColumn(name, F.coalesce(bit, F.lit(False))).drop("block", "words"))


def window_spine(erp: Mapping[str, DataFrame], as_of, rules: R.MartRules = R.DEFAULT_RULES) -> Spine:
    """The spine of one run, written under the shared folder."""
    ends = Observation("window_ends")
    found = window_invoices(erp, as_of, rules)
    headers = stored(found.observe(ends, F.min("customer_trx_id").alias("first"), F.max("customer_trx_id").alias("last")),
                     "window_headers")
    previous = F.col("previous_customer_trx_line_id")
    monthly = getattr(erp, "monthly_lines", None)
    if monthly is not None:
        # the months come from the date filter itself, so that the pruning has a selective side
        dated = erp["ra_customer_trx_all"].filter(in_trailing_window("trx_date", as_of, rules.window_months))
        lines = stored(lines_of_months(monthly, dated).join(headers.select("customer_trx_id"), "customer_trx_id", "left_semi"),
                       "window_lines")
        returns = monthly.filter(F.col("is_return")).drop(LINE_MONTH, "is_return")
        return Spine(headers, lines, returns, (headers, lines))
    near = F.col("customer_trx_id").between(ends.get.get("first"), ends.get.get("last")) | previous.isNotNull()
    invoices = headers.select("customer_trx_id")
    bits = stored(id_bits(invoices, "customer_trx_id"), "window_ids")  # of known size, so that Spark may broadcast it
    # a line comes once for each invoice with its id; ids that repeat are few or none
    repeated = stored(invoices.groupBy("customer_trx_id").count().filter("count > 1")
                      .select("customer_trx_id", F.explode(F.expr("array_repeat(true, CAST(count AS INT))")).alias("again")),
                      "window_repeats")
    both = stored(marked_by(erp["ra_customer_trx_lines_all"].filter(near), bits, "customer_trx_id", "in_window")
                  .filter(F.col("in_window") | previous.isNotNull())
                  .join(repeated, "customer_trx_id", "left").drop("again"), "window_lines")
    return Spine(headers, both.filter("in_window").drop("in_window"), both.filter(previous.isNotNull()).drop("in_window"),
                 (headers, bits, repeated, both))
