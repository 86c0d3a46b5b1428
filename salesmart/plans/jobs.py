"""The two daily jobs, end to end.

* :func:`refresh_sales_mart` -- extract the trailing twelve months into the
  27-column mart and replace that window of the history, keeping older and
  protected rows, in one atomic publish.
* :func:`copy_transactions` -- copy a whole source view into a typed
  32-column target (full replace), reconciled against a control count.

Neither collects data to the driver; only counts and the version pointer
pass through it.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import window_start
from .contract import apply_contract, jdbc_column_types
from .mart import rejected_rows, sales_mart
from .refresh import History, PublishError, RefreshReport
from .spine import window_spine

log = logging.getLogger(__name__)


def refresh_sales_mart(spark: SparkSession, erp: Mapping[str, DataFrame], history_root: str,
                       as_of: dt.date | str, *, rules: R.MartRules = R.DEFAULT_RULES,
                       cutoff: dt.datetime | None = None,
                       protect: tuple[str, int] | None = ("tahun_invoice", R.PROTECTED_YEAR),
                       create: bool = True) -> RefreshReport:
    """Job A. ``as_of`` replaces the database clock; ``cutoff`` defaults to the
    first instant of the extracted window, so delete and extract cover the
    same days (the source deletes from "now minus 12 months", an instant,
    which reloads the boundary day's early rows a second time). Order
    references that are no numbers join nothing; they are counted in the report,
    and the rows are published beside the mart (``History.read_rejected``)."""
    spine = window_spine(erp, as_of, rules)
    fresh = sales_mart(erp, as_of, rules, spark, spine)
    if cutoff is None:
        cutoff = window_start(as_of, rules.window_months)
    try:
        report = History(spark, history_root, date_col="tgl_invoice").window_replace(
            fresh, cutoff, protect=protect, create=create, rejected=rejected_rows(spine.headers))
    finally:
        spine.discard()
    if report.rejected_references:
        log.warning("%d order references of the window are no order numbers", report.rejected_references)
    log.info("sales mart v%d: extracted %d, deleted %d, kept %d in rewritten months, total written %d",
             report.version, report.rows_fresh, report.rows_deleted,
             report.rows_written - report.rows_fresh, report.rows_written)
    return report


def copy_transactions(source: DataFrame, history_root: str, *,
                      ddl=R.TRANSACTIONS_DDL, control_total: int | None = None, rebalance: bool = True) -> RefreshReport:
    """Job B into a published table: typed, all-or-nothing, reconciled.

    ``rebalance=False`` is for a source that ends in a join or a scan of many
    splits, whose tasks follow its size already (:meth:`History.full_replace`).

    ``control_total`` is the source's ``COUNT(*)`` taken as its own
    statement (over JDBC Spark pushes the count into the database); when it
    is not given it is computed here with a count over the source.
    """
    spark = source.sparkSession
    typed = apply_contract(source, ddl)
    expected = control_total if control_total is not None else source.agg(F.count(F.lit(1))).first()[0]
    report = History(spark, history_root, date_col=None).full_replace(
        typed, expected_rows=expected, rebalance=rebalance)
    log.info("transactions v%d: %d rows copied (control total %d)", report.version,
             report.rows_written, expected)
    return report


def copy_transactions_jdbc(source: DataFrame, url: str, table: str, *, properties=None,
                           ddl=R.TRANSACTIONS_DDL, control_total: int | None = None,
                           batchsize: int = R.INSERT_BATCH_ROWS, num_partitions: int | None = None) -> int:
    """Job B into a database table: truncate-and-load, then reconcile the count.

    Spark's JDBC writer commits per partition, so the load is not one
    transaction, and a wrong total is seen only afterwards: give a staging
    table, and let the target database swap it in (``ALTER TABLE … RENAME``)
    once this function has returned. The same steps serve a window replace in
    a database: load the window into a staging table, then delete the window
    and insert from staging in one transaction there.
    """
    from ..sources.jdbc import read_jdbc, write_jdbc

    typed = apply_contract(source, ddl)
    expected = control_total if control_total is not None else source.agg(F.count(F.lit(1))).first()[0]
    write_jdbc(typed, url, table, mode="overwrite", truncate=True, properties=properties,
               batchsize=batchsize, column_types=jdbc_column_types(
                   [(c, t) for c, t in ddl if t.upper().startswith("VARCHAR")]),
               num_partitions=num_partitions)
    loaded = read_jdbc(source.sparkSession, url, table, properties=properties).agg(
        F.count(F.lit(1))).first()[0]
    if loaded != expected:
        raise PublishError(f"control total {expected} != rows loaded {loaded}")
    log.info("%s: %d rows loaded (control total %d)", table, loaded, expected)
    return loaded
