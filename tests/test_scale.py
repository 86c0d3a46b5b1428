"""Scale behaviour: a hot key holding a third of the lines, pushdown, property checks."""

import datetime as dt
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.functions import add_months_date, add_months_oracle
from salesmart.plans import mart_rows
from salesmart.plans.refresh import deleted_count_expr, survivors
from salesmart.queries import edge
from salesmart.sources import DRIVER_AS_OF, driver_erp, frames
from salesmart.sources.tables import ERP_SCHEMAS

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


class conf:
    """Temporarily set session confs."""

    def __init__(self, spark, **kv):
        self.spark, self.kv, self.old = spark, kv, {}

    def __enter__(self):
        for k, v in self.kv.items():
            key = k.replace("__", ".")
            self.old[key] = self.spark.conf.get(key, None)
            self.spark.conf.set(key, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def _skewed_erp(spark):
    """Driver ERP where one item and one warehouse carry a third of all invoice lines."""
    base = driver_erp(spark, SF)
    tabs = {n: base[n] for n in ERP_SCHEMAS}
    lines = tabs["ra_customer_trx_lines_all"]
    hot = (F.col("customer_trx_line_id") % 3) == 0
    tabs["ra_customer_trx_lines_all"] = (lines
                                         .withColumn("inventory_item_id", F.when(hot, F.lit(5)).otherwise(F.col("inventory_item_id")))
                                         .withColumn("warehouse_id", F.when(hot, F.lit(7)).otherwise(F.col("warehouse_id"))))
    return frames(tabs)


@needs_data
def test_hot_key_is_split_and_result_unchanged(spark):
    erp = _skewed_erp(spark)
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__skewJoin__enabled="false"):
        plain = edge(mart_rows(erp, DRIVER_AS_OF))
        expected = sorted(map(tuple, plain.collect()), key=str)
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__skewJoin__enabled="true",
              spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
              spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
              spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
              spark__sql__adaptive__coalescePartitions__enabled="false"):
        df = edge(mart_rows(erp, DRIVER_AS_OF))
        got = sorted(map(tuple, df.collect()), key=str)
        final = df._jdf.queryExecution().executedPlan().toString()
    assert got == expected
    assert "isSkewJoin=true" in final or "skew=true" in final


@needs_data
def test_window_filter_is_pushed_to_header_scan(spark):
    from salesmart import rules as R
    from salesmart.plans import window_invoices

    erp = driver_erp(spark, SF)
    plan = window_invoices(erp, DRIVER_AS_OF, R.DEFAULT_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,2000-08-01T00:00)" in plan
    assert "LessThan(o_orderdate," in plan  # the plan text truncates the literal


@needs_data
def test_no_udf_and_no_cartesian_in_mart(spark):
    plan = mart_rows(driver_erp(spark, SF), DRIVER_AS_OF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "Window ["):
        assert bad not in plan, bad


dates = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(dates, st.integers(-36, 36)), min_size=50, max_size=120))
def test_add_months_matches_model(spark, cases):  # T3, X17
    df = spark.createDataFrame(cases, "d date, n int")
    got = [(r.d, r.n, r.r) for r in df.select("d", "n", add_months_oracle("d", F.col("n")).alias("r")).collect()]
    for d, n, r in got:
        assert r == add_months_date(d, n), (d, n, r)


rows = st.lists(st.tuples(
    st.one_of(st.none(), st.datetimes(min_value=dt.datetime(1999, 1, 1), max_value=dt.datetime(2003, 1, 1))),
    st.one_of(st.none(), st.sampled_from([2000, 2001, 9999]))), min_size=1, max_size=60)


@settings(max_examples=5, deadline=None)
@given(rows)
def test_delete_semantics_match_sql_model(spark, data):  # T9, T12, F15
    cut = dt.datetime(2000, 8, 1)
    df = spark.createDataFrame([(i, ts, y) for i, (ts, y) in enumerate(data)],
                               "k int, tgl_invoice timestamp_ntz, tahun_invoice int")
    kept = {r.k for r in survivors(df, "tgl_invoice", cut, ("tahun_invoice", 9999)).collect()}
    deleted = df.agg(deleted_count_expr("tgl_invoice", cut, ("tahun_invoice", 9999))).first()[0] or 0

    def pred(ts, y):  # SQL three-valued logic of "ts >= cut AND y <> 9999"
        a = None if ts is None else ts >= cut
        b = None if y is None else y != 9999
        if a is False or b is False:
            return False
        if a is None or b is None:
            return None
        return True

    model_kept = {i for i, (ts, y) in enumerate(data) if pred(ts, y) is not True}
    assert kept == model_kept
    assert deleted == len(data) - len(model_kept)


@needs_data
def test_bucketed_landing_makes_line_join_shuffle_free(spark, tmp_path):
    """Headers and lines bucketed by customer_trx_id: their join reads both sides without an Exchange."""
    import re

    from salesmart.plans.mart import invoice_lines, window_invoices
    from salesmart.sources import catalog_tables, land_bucketed

    from salesmart import rules as R

    db = "erp_bucketed"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path}/{db}'")
    erp = driver_erp(spark, SF)
    for name in ("ra_customer_trx_all", "ra_customer_trx_lines_all"):
        land_bucketed(erp[name], f"{db}.{name}", "customer_trx_id", 8)
    for name in ("ra_cust_trx_types_all",):
        erp[name].write.mode("overwrite").saveAsTable(f"{db}.{name}")
    cat = catalog_tables(spark, db)
    # only the 4-row invoice-type table may be broadcast, never headers or lines
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="32k",
              spark__sql__adaptive__autoBroadcastJoinThreshold="32k"):
        headers = window_invoices(cat, DRIVER_AS_OF, R.DEFAULT_RULES)
        joined = invoice_lines(cat["ra_customer_trx_lines_all"], headers)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        n = joined.count()
    assert "SortMergeJoin" in plan  # neither side was broadcast
    assert not re.search(r"Exchange hashpartitioning\(customer_trx_id", plan), plan
    assert n == invoice_lines(erp["ra_customer_trx_lines_all"], window_invoices(erp, DRIVER_AS_OF, R.DEFAULT_RULES)).count()


def test_cutoff_and_window_do_not_depend_on_time_zone(spark):  # literals are zone-free
    from salesmart.functions import in_trailing_window

    data = [(1, dt.datetime(2000, 7, 31, 23, 30), 2000), (2, dt.datetime(2000, 8, 1, 0, 0), 2000),
            (3, dt.datetime(2000, 8, 1, 0, 30), 2000), (4, dt.datetime(2001, 8, 1, 23, 59), 2001),
            (5, dt.datetime(2001, 8, 2, 0, 0), 2001)]
    df = spark.createDataFrame(data, "k int, tgl_invoice timestamp_ntz, tahun_invoice int")
    cut = dt.datetime(2000, 8, 1)

    def result():
        kept = sorted(r.k for r in survivors(df, "tgl_invoice", cut, ("tahun_invoice", 9999)).collect())
        window = sorted(r.k for r in df.filter(in_trailing_window("tgl_invoice", "2001-08-01", 12)).collect())
        return kept, window

    expected = ([1], [2, 3, 4])
    for zone in ("UTC", "America/New_York", "Asia/Jakarta", "Pacific/Kiritimati"):
        with conf(spark, spark__sql__session__timeZone=zone):
            assert result() == expected, zone


def test_transactions_send_the_lines_twice_at_most(spark, monkeypatch):
    """Above the lines stand two joins (parts, orders with their buyers), and the 32 columns are written without a further shuffle."""
    import json

    from salesmart import queries

    schemas = queries.driver_frames.__globals__["DRIVER_SCHEMAS"]
    monkeypatch.setattr(queries, "driver_frames", lambda s, d: {t: s.createDataFrame([], c) for t, c in schemas.items()})
    seen = {}

    def copy(view, root, **more):
        seen.update(more, view=view)
        raise InterruptedError

    monkeypatch.setattr(queries, "copy_transactions", copy)
    with pytest.raises(InterruptedError):
        queries.q_transactions_copy(spark, "")
    nodes = iter(json.loads(seen["view"]._jdf.queryExecution().analyzed().toJSON()))

    def above_lines(joins=0):
        node = next(nodes)
        joins += node["class"].endswith(".Join")
        found = [above_lines(joins) for _ in range(node["num-children"])]
        if not found:
            return joins if "l_orderkey" in json.dumps(node) else None
        return next((f for f in found if f is not None), None)

    assert above_lines() == 2 and seen["rebalance"] is False


def test_a_replace_without_rebalance_writes_what_its_tasks_hold(spark, tmp_path):
    from salesmart.plans import History

    df = spark.range(300).repartition(3)
    for rebalance, files in ((True, 1), (False, 3)):
        hist = History(spark, str(tmp_path / str(rebalance)), date_col=None)
        assert hist.full_replace(df, expected_rows=300, rebalance=rebalance).rows_written == 300
        assert len(hist.read().inputFiles()) == files and sorted(r.id for r in hist.read().collect()) == [*range(300)]
