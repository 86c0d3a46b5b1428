"""Returned quantity and return-invoice list per original invoice line.

Both correlated subqueries (sum of credited quantity; string list of the
return invoices) scan the same return lines, so they share one pass:
return lines LEFT JOIN their headers, grouped by the line they return.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def returns_rollup(lines: DataFrame, headers: DataFrame, *, of: DataFrame | None = None,
                   line_type: str = "LINE", sep: str = ",") -> DataFrame:
    """(returned_line_id, qty_retur_sum, invoice_retur) for lines that have returns.

    Lines without a previous line id are filtered first: they are almost all
    lines and, as one null key, would be the hottest group of the shuffle.
    ``of`` (with ``customer_trx_line_id``) bounds the work to the returns of
    those lines, whenever they were returned: a left-semi join on the line id
    comes before the grouping, so its cost follows the window, not history.
    ``invoice_retur`` is ordered by invoice number so it is deterministic;
    it skips return lines whose header is missing, while the quantity sum
    still counts them (as the two subqueries do).
    """
    ret = (lines
           .filter(F.col("previous_customer_trx_line_id").isNotNull()
                   & (F.col("line_type") == line_type))
           .select(F.col("previous_customer_trx_line_id").alias("returned_line_id"),
                   "customer_trx_id", "quantity_credited"))
    if of is not None:
        wanted = of.select(F.col("customer_trx_line_id").alias("returned_line_id"))
        ret = ret.join(wanted, "returned_line_id", "left_semi")
    hdr = headers.select("customer_trx_id", F.col("trx_number").alias("return_trx_number"))
    # headers RIGHT JOIN returns == returns LEFT JOIN headers, but lets Spark build (broadcast)
    # the small return side and stream all headers without shuffling them
    joined = hdr.join(ret, "customer_trx_id", "right")
    return joined.groupBy("returned_line_id").agg(
        F.sum("quantity_credited").alias("qty_retur_sum"),
        F.expr(f"listagg(return_trx_number, '{sep}') WITHIN GROUP (ORDER BY return_trx_number)")
        .alias("invoice_retur"),
    )
