"""The window's invoices and lines are read once, and only the window's months where lines are landed by month."""

import pytest

from salesmart.functions import in_trailing_window
from salesmart.plans import mart_rows, sales_mart, spine as S
from salesmart.queries import edge
from salesmart.sources import frames, land_lines_by_month, parquet_tables, with_monthly_lines
from tests import erp_fixture as FX

LINES = "ra_customer_trx_lines_all"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_paths(spark):
    """Plans show the paths of their scans uncut."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture
def landed(spark, tmp_path):
    """The ERP fixture landed as parquet, as it comes."""
    for name, df in FX.erp_frames(spark).items():
        df.write.parquet(f"{tmp_path}/{name}")
    return str(tmp_path)


def rows_of(df):
    return sorted(map(tuple, edge(df).collect()), key=str)


def test_the_line_table_is_scanned_once(spark, landed, monkeypatch):  # J1, C1, C7
    erp, plans = parquet_tables(spark, landed), []
    assert erp.monthly_lines is None
    write = S.stored

    def noted(df, name):
        plans.append(plan_of(df))
        return write(df, name)

    monkeypatch.setattr(S, "stored", noted)
    spine = S.window_spine(erp, FX.AS_OF)
    plans.append(plan_of(mart_rows(erp, FX.AS_OF, spine=spine)))
    scans = [line for plan in plans for line in plan.splitlines() if "FileScan" in line and f"/{LINES}" in line]
    assert len(scans) == 1
    # other invoices' lines are sorted out by the scan, but for those that return a line
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(customer_trx_id" in scans[0] and "IsNotNull(previous_customer_trx_line_id)" in scans[0]
    assert rows_of(sales_mart(erp, FX.AS_OF, spine=spine)) == rows_of(sales_mart(frames(FX.erp_frames(spark)), FX.AS_OF))


def test_spine_holds_the_window_and_the_returns(spark, landed):
    erp = parquet_tables(spark, landed)
    spine = S.window_spine(erp, FX.AS_OF)
    ids = {r[0] for r in spine.headers.select("customer_trx_id").collect()}
    want = [r for r in erp[LINES].collect()]
    assert sorted(r.customer_trx_line_id for r in spine.lines.collect()) == sorted(
        r.customer_trx_line_id for r in want if r.customer_trx_id in ids)
    assert {r.customer_trx_line_id for r in spine.returns.collect()} == {
        r.customer_trx_line_id for r in want if r.previous_customer_trx_line_id is not None}
    paths = [part._stored for part in spine.parts]
    spine.discard()
    import os
    assert not any(os.path.exists(path.removeprefix("file:").replace("//", "/")) for path in paths)


def test_a_window_without_invoices(spark, landed):
    assert sales_mart(parquet_tables(spark, landed), "1970-01-01").collect() == []


def test_lines_landed_by_month_are_pruned_by_the_headers(spark, landed, tmp_path_factory):  # F10, S1
    erp = parquet_tables(spark, landed)
    path = str(tmp_path_factory.mktemp("monthly") / LINES)
    land_lines_by_month(erp[LINES], erp["ra_customer_trx_all"], path)
    monthly = with_monthly_lines(erp, path)
    assert sorted(map(str, monthly[LINES].collect())) == sorted(map(str, erp[LINES].collect()))
    window = erp["ra_customer_trx_all"].filter(in_trailing_window("trx_date", FX.AS_OF, 12))
    df = S.lines_of_months(monthly.monthly_lines, window)
    plan = plan_of(df)
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line and f"/{LINES}" in line]
    assert "PartitionFilters: [isnotnull(invoice_month" in scan and "dynamicpruningexpression(invoice_month" in scan
    ids = {r[0] for r in window.select("customer_trx_id").collect()}
    assert sorted(r.customer_trx_line_id for r in df.collect()) == sorted(
        r.customer_trx_line_id for r in erp[LINES].collect() if r.customer_trx_id in ids)
    assert rows_of(sales_mart(monthly, FX.AS_OF)) == rows_of(sales_mart(erp, FX.AS_OF))


def test_months_outside_the_window_are_not_read(spark, landed, tmp_path_factory):
    """A month that the window does not need may even be unreadable."""
    import glob
    erp = parquet_tables(spark, landed)
    path = str(tmp_path_factory.mktemp("monthly") / LINES)
    land_lines_by_month(erp[LINES], erp["ra_customer_trx_all"], path)
    window = erp["ra_customer_trx_all"].filter(in_trailing_window("trx_date", FX.AS_OF, 12))
    months = {str(r[0])[:7] for r in window.select("trx_date").collect()}
    others = [f for f in glob.glob(f"{path}/*/invoice_month=*/*.parquet") if f.split("invoice_month=")[1][:7] not in months]
    for f in others:
        with open(f, "wb") as broken:
            broken.write(b"no parquet")
    df = S.lines_of_months(with_monthly_lines(erp, path).monthly_lines, window)
    assert others and df.count() > 0


def test_marks_of_ids(spark):
    ids = [0, 1, 63, 64, 4095, 4096, -1, -4096, -4097, 10**15, None, 64]
    has = spark.createDataFrame([(i,) for i in ids], "i bigint")
    asked = sorted({n for i in ids if i is not None for n in (i - 1, i, i + 1)}) + [None]
    rows = S.marked_by(spark.createDataFrame([(i,) for i in asked], "i bigint"), S.id_bits(has, "i"), "i", "known").collect()
    assert {(r.i, r.known) for r in rows} == {(i, i is not None and i in ids) for i in asked} and len(rows) == len(asked)


def test_lines_do_not_travel_for_the_window(spark, landed, monkeypatch):
    """The ids of the window are too large to be broadcast, their marks are not; invoices that come twice keep their lines twice."""
    erp, plans, write = dict(parquet_tables(spark, landed)), [], S.stored

    def noted(df, name):
        if name == "window_lines":
            plans.append(plan_of(df))
        return write(df, name)

    monkeypatch.setattr(S, "stored", noted)
    first = S.window_spine(frames(erp), FX.AS_OF)
    assert "customer_trx_id" in plans[0] and "BroadcastHashJoin [shiftright(customer_trx_id" in plans[0]
    once = sorted(r[0] for r in first.lines.select("customer_trx_line_id").collect())
    erp["ra_customer_trx_all"] = erp["ra_customer_trx_all"].unionByName(erp["ra_customer_trx_all"])
    twice = S.window_spine(frames(erp), FX.AS_OF)
    assert sorted(r[0] for r in twice.lines.select("customer_trx_line_id").collect()) == sorted(once * 2) and once
