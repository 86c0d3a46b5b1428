"""The whole mart on the hand-built ERP fixture: golden rows, oracle, join equivalence."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from salesmart import rules as R
from salesmart.plans import mart_rows, ordered_report, sales_mart, sales_mart_display
from salesmart.queries import MART_ON_ERP_SQL, edge
from salesmart.sources import frames, parquet_tables
from salesmart.sources.tables import ERP_SCHEMAS
from tests import erp_fixture as FX


@pytest.fixture(scope="module")
def erp_root(spark, tmp_path_factory):
    return FX.write_parquet(spark, str(tmp_path_factory.mktemp("erp")))


@pytest.fixture(scope="module")
def mart(spark, erp_root):
    return sales_mart(parquet_tables(spark, erp_root), FX.AS_OF)


def _norm(v):
    if isinstance(v, Decimal):
        return v.normalize() if v != 0 else Decimal(0)
    return v


def test_contract_schema(mart):
    assert tuple(mart.columns) == R.MART_COLUMNS
    types = dict(mart.dtypes)
    assert types["tgl_invoice"] == "timestamp_ntz" and types["tgl_so"] == "timestamp_ntz"
    assert types["tahun_invoice"] == "int" and types["no_do"] == "bigint"
    assert types["total_harga"].startswith("decimal")


def test_golden_rows(mart):
    got = sorted((tuple(_norm(r[c]) for c in FX.EXPECTED_COLUMNS) for r in mart.collect()),
                 key=lambda t: (t[0], t[1]))
    exp = sorted((tuple(_norm(v) for v in row) for row in FX.EXPECTED), key=lambda t: (t[0], t[1]))
    assert got == exp


def test_dates_and_parts(mart):
    r = mart.filter(F.col("no_invoice") == "INV-2").collect()[0]
    assert r.tgl_invoice == dt.datetime(2000, 8, 1)       # first day of the window, midnight
    assert (r.tahun_invoice, r.bulan_invoice, r.tanggal_hari_invoice) == (2000, 8, 1)
    assert r.tgl_so == dt.datetime(2000, 7, 20)
    assert r.no_so == "5002"
    five = mart.filter(F.col("no_invoice") == "INV-5").collect()[0]
    assert five.tgl_invoice == dt.datetime(2001, 8, 1, 18)  # today, later in the day


def test_duplicate_lines_collapse_once(mart):  # A6, T16
    assert mart.filter(F.col("kode_barang") == "IAU-9").filter(F.col("no_invoice") == "INV-1").count() == 1


def test_oracle_on_fixture(spark, erp_root):
    """The reference-shaped SQL (outer joins + WHERE, correlated subqueries, DISTINCT) on DuckDB."""
    con = duckdb.connect()
    for name in ERP_SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{erp_root}/{name}/*.parquet')")
    rel = con.execute(MART_ON_ERP_SQL)
    cols = [d[0] for d in rel.description]
    oracle = sorted(tuple(_n(v) for v in row) for row in rel.fetchall())
    df = edge(sales_mart(parquet_tables(spark, erp_root), FX.AS_OF)).select(*cols)
    mine = sorted(tuple(_n(v) for v in r) for r in df.collect())
    assert mine == oracle
    assert len(mine) == len(FX.EXPECTED)


def _n(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def test_mart_from_frames_equals_parquet(spark, erp_root):
    a = edge(sales_mart(frames(FX.erp_frames(spark)), FX.AS_OF))
    b = edge(sales_mart(parquet_tables(spark, erp_root), FX.AS_OF))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_plan_uses_semi_join_and_no_territory(spark, erp_root):  # J6, J8, T17
    erp = parquet_tables(spark, erp_root)
    df = mart_rows(erp, FX.AS_OF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    assert "territory_code" not in plan


def test_display_names_before_contract(spark, erp_root):  # P1
    df = sales_mart_display(parquet_tables(spark, erp_root), FX.AS_OF)
    assert df.columns[:3] == ["Cabang", "Organization ID", "Tgl Invoice"]
    assert "PRICELIST" in df.columns and "QTY_RETUR" in df.columns


def test_ordered_report_nulls_last(spark, mart):  # O1, T15
    nulled = mart.withColumn("warehouse", F.when(F.col("no_invoice") == "INV-9", None)
                             .otherwise(F.col("warehouse")))
    got = [(r.warehouse, r.order_type) for r in ordered_report(nulled).collect()]
    assert got[-1][0] is None
    assert got[:-1] == sorted(got[:-1])


def test_duplicate_price_list_fails_like_a_scalar_subquery(spark, erp_root):  # T4
    tabs = FX.erp_frames(spark)
    tabs["qp_list_headers_tl"] = tabs["qp_list_headers_tl"].union(
        spark.createDataFrame([(1, "SP Reguler ENG")], tabs["qp_list_headers_tl"].schema))
    with pytest.raises(Exception, match="more than one row"):
        sales_mart(frames(tabs), FX.AS_OF).collect()


def test_job_a_on_fixture_is_idempotent(spark, erp_root, tmp_path):  # job A end to end
    from salesmart.plans import History, refresh_sales_mart
    erp = parquet_tables(spark, erp_root)
    root = str(tmp_path / "mart")
    r1 = refresh_sales_mart(spark, erp, root, FX.AS_OF)
    assert r1.rows_written == len(FX.EXPECTED)
    first = sorted(map(tuple, edge(History(spark, root).read()).collect()), key=str)
    r2 = refresh_sales_mart(spark, erp, root, FX.AS_OF)
    assert r2.rows_deleted == len(FX.EXPECTED) and r2.rows_fresh == len(FX.EXPECTED)
    assert sorted(map(tuple, edge(History(spark, root).read()).collect()), key=str) == first


def test_command_line_mart_refresh(spark, erp_root, tmp_path, capsys):  # the scheduler's entry point
    import json

    from salesmart.__main__ import main
    from salesmart.plans import History

    root = str(tmp_path / "cli")
    assert main(["mart-refresh", "--erp-parquet", erp_root, "--history", root, "--as-of", FX.AS_OF]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["rows_fresh"] == len(FX.EXPECTED) and report["version"] == 1
    assert History(spark, root).read().count() == len(FX.EXPECTED)
