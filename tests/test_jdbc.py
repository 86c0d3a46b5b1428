"""JDBC source and sink on Derby's in-memory, in-process database (no server, no port)."""

import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart import rules as R
from salesmart.plans import apply_contract
from salesmart.plans.contract import jdbc_column_types
from salesmart.sources import jdbc_tables, read_jdbc, write_jdbc

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture
def url():
    return f"jdbc:derby:memory:sm{uuid.uuid4().hex[:8]};create=true"


def test_partitioned_read_pushdown_and_truncate(spark, url):  # S1, S2, S7, S8
    df = spark.range(1, 1001).select(F.col("id").alias("ID"), (F.col("id") * 2).alias("V"))
    write_jdbc(df, url, "T1", mode="overwrite", properties=DRIVER, batchsize=100)
    back = read_jdbc(spark, url, "T1", properties=DRIVER, partition_column="ID", lower_bound=1,
                     upper_bound=1000, num_partitions=2)
    assert back.rdd.getNumPartitions() == 2
    assert back.count() == 1000
    filtered = back.filter(F.col("ID") > 990).select("V")
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(ID), *GreaterThan(ID,990)]" in plan
    assert sorted(r.V for r in filtered.collect()) == list(range(1982, 2001, 2))
    # full replace: truncate keeps the table, rows are replaced
    write_jdbc(df.filter("ID <= 10"), url, "T1", mode="overwrite", truncate=True, properties=DRIVER)
    assert read_jdbc(spark, url, "T1", properties=DRIVER).count() == 10


def test_typed_target_created_with_contract_types(spark, url):  # S6, B job
    ddl = [c for c in R.TRANSACTIONS_DDL if c[0] in ("REQUEST_ID", "INVOICE_NUMBER", "REQUEST_DATE")]
    src = spark.createDataFrame([(1, "INV-1", None)], "REQUEST_ID long, INVOICE_NUMBER string, REQUEST_DATE date")
    out = apply_contract(src, ddl)
    write_jdbc(out, url, "TX_COPY", mode="overwrite", properties=DRIVER,
               column_types="INVOICE_NUMBER VARCHAR(20)")
    back = read_jdbc(spark, url, "TX_COPY", properties=DRIVER)
    r = back.collect()[0]
    assert r.INVOICE_NUMBER == "INV-1" and r.REQUEST_ID == Decimal("1")
    assert jdbc_column_types(ddl).startswith("REQUEST_ID NUMERIC")


def test_erp_tables_over_jdbc_are_narrowed(spark, url):  # S1, type narrowing
    src = spark.createDataFrame([(Decimal(1), "X"), (Decimal(2), "Y")], "LIST_HEADER_ID decimal(38,10), NAME string")
    write_jdbc(src, url, "QP_LIST_HEADERS_TL", mode="overwrite", properties=DRIVER)
    tabs = jdbc_tables(spark, url, properties=DRIVER,
                       partitioning={"qp_list_headers_tl": ("LIST_HEADER_ID", 1, 2, 2)})
    df = tabs["qp_list_headers_tl"]
    assert df.dtypes == [("list_header_id", "bigint"), ("name", "string")]
    assert sorted(r.list_header_id for r in df.collect()) == [1, 2]


def test_whole_mart_from_jdbc_sources(spark, url, tmp_path):  # S1 over JDBC, end to end
    from salesmart.plans import sales_mart
    from salesmart.queries import edge
    from salesmart.sources import frames
    from tests import erp_fixture as FX

    for name, df in FX.erp_frames(spark).items():
        write_jdbc(df, url, name.upper(), mode="overwrite", properties=DRIVER)
    # Spark's Derby dialect stores strings as CLOB, which Derby cannot compare in a pushed
    # filter; pushdown itself is covered by test_partitioned_read_pushdown_and_truncate.
    props = dict(DRIVER, pushDownPredicate="false")
    erp = jdbc_tables(spark, url, properties=props, partitioning={
        "ra_customer_trx_lines_all": ("customer_trx_line_id", 100, 2200, 3),
        "ra_customer_trx_all": ("customer_trx_id", 2)},  # bounds asked from the database
        quote_identifiers=True)  # Spark created lower-case quoted column names in Derby
    assert erp["ra_customer_trx_lines_all"].rdd.getNumPartitions() == 3
    assert erp["ra_customer_trx_all"].rdd.getNumPartitions() == 2
    from salesmart.sources import partition_bounds
    assert partition_bounds(spark, url, "RA_CUSTOMER_TRX_ALL", "customer_trx_id", properties=props,
                            quote=True) == (1, 21)
    got = edge(sales_mart(erp, FX.AS_OF))
    want = edge(sales_mart(frames(FX.erp_frames(spark)), FX.AS_OF))
    assert got.count() == len(FX.EXPECTED)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_copy_transactions_jdbc_reconciles(spark, url):  # job B into a database table
    from salesmart.plans import PublishError, copy_transactions_jdbc
    from tests.test_refresh import _transactions

    src = _transactions(spark, 2500)
    assert copy_transactions_jdbc(src, url, "CUSTOMER_TRANSACTIONS", properties=DRIVER, batchsize=1000) == 2500
    back = read_jdbc(spark, url, "CUSTOMER_TRANSACTIONS", properties=DRIVER)
    assert len(back.columns) == 32 and back.count() == 2500
    # a second run truncates and reloads; a wrong control total fails after the load
    with pytest.raises(PublishError):
        copy_transactions_jdbc(src.limit(10), url, "CUSTOMER_TRANSACTIONS", properties=DRIVER, control_total=11)


def test_window_filter_reaches_the_database(spark, url):  # F10 over JDBC: no full-table pull
    from salesmart import rules as R
    from salesmart.plans.mart import window_invoices
    from tests import erp_fixture as FX

    tabs = FX.erp_frames(spark)
    write_jdbc(tabs["ra_customer_trx_all"], url, "RA_CUSTOMER_TRX_ALL", mode="overwrite", properties=DRIVER)
    # VARCHAR, not Spark's Derby default CLOB, so the IN filter on the name can be pushed too
    write_jdbc(tabs["ra_cust_trx_types_all"], url, "RA_CUST_TRX_TYPES_ALL", mode="overwrite",
               properties=DRIVER, column_types="name VARCHAR(100)")
    erp = jdbc_tables(spark, url, properties=DRIVER)
    df = window_invoices(erp, FX.AS_OF, R.DEFAULT_RULES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "*GreaterThanOrEqual(trx_date," in plan and "*LessThan(trx_date," in plan
    assert sorted(r.customer_trx_id for r in df.collect()) == [1, 2, 3, 5, 7, 8, 9, 10, 11, 12, 13, 20, 21]


def test_snapshot_texts():  # S1, S2: every query of a load names the same state
    from salesmart.sources import ORACLE_SNAPSHOT

    assert ORACLE_SNAPSHOT.table("APPS.T", 4711) == "(SELECT * FROM APPS.T AS OF SCN 4711) s"
    for bad in ("", "1; DROP TABLE t", "1) x"):
        with pytest.raises(ValueError):
            ORACLE_SNAPSHOT.table("T", bad)


def _log(spark, url, lo, hi, mode="append"):
    """Rows numbered by the transaction that brought them."""
    df = spark.range(lo, hi).select(F.col("id").alias("CUSTOMER_TRX_ID"), F.col("id").alias("TXN"))
    write_jdbc(df, url, "HEADERS", mode=mode, properties=DRIVER)


def test_all_queries_of_a_load_read_one_state(spark, url, monkeypatch):  # S1, S2, S3
    from salesmart.sources import Snapshot, jdbc, read_with_total

    # a stand-in for flashback: a state is the highest transaction seen
    by_txn = Snapshot("WHERE TXN <= {at}", "SELECT MAX(TXN) AS AT_TXN FROM HEADERS")
    _log(spark, url, 0, 100, "overwrite")
    texts = []
    plain = jdbc.read_jdbc

    def noted(spark, url, table, **options):
        texts.append(table)
        return plain(spark, url, table, **options)

    monkeypatch.setattr(jdbc, "read_jdbc", noted)
    df, total = read_with_total(spark, url, "HEADERS", ("TXN", 4), properties=DRIVER, snapshot=by_txn)
    asked, *queries = texts
    assert asked == f"({by_txn.ask}) q"
    # the control total, the bounds and the rows come from the same state
    assert len(queries) == 3 and all("(SELECT * FROM HEADERS WHERE TXN <= 99) s" in q for q in queries)
    _log(spark, url, 100, 150)  # arrives while the load runs
    assert df.rdd.getNumPartitions() == 4 and df.count() == total == 100
    later, total = read_with_total(spark, url, "HEADERS", properties=DRIVER, snapshot=by_txn, at=119)
    assert later.count() == total == 120
    assert read_with_total(spark, url, "HEADERS", properties=DRIVER)[1] == 150


def test_erp_tables_ask_for_the_state_once(spark, url, monkeypatch):  # S1
    from salesmart.sources import Snapshot, jdbc

    texts = []
    monkeypatch.setattr(jdbc, "read_jdbc", lambda spark, url, table, **o: texts.append(table) or spark.createDataFrame(
        [(5,)], "n int") if table.startswith("(ASK)") else texts.append(table) or spark.createDataFrame(
        [(1, "x")], "cust_trx_type_id long, name string").withColumns(
        {"transaction_type_id": F.lit(1), "list_header_id": F.lit(1)}))
    tables = jdbc_tables(spark, "jdbc:none", schema="APPS", snapshot=Snapshot("AS OF SCN {at}", "ASK"))
    for name in ("ra_cust_trx_types_all", "oe_transaction_types_tl", "qp_list_headers_tl"):
        tables[name]
    assert texts == ["(ASK) q"] + [f"(SELECT * FROM APPS.{t} AS OF SCN 5) s" for t in (
        "ra_cust_trx_types_all", "oe_transaction_types_tl", "qp_list_headers_tl")]
    assert tables.state == "5"


def test_quantile_split_of_a_skewed_key(spark, url):  # S1: equal widths would put nearly all rows in one part
    import statistics

    from salesmart.sources import jdbc, read_partitioned

    # 1,000 ids close together, 1,000 far apart and 40 nulls
    ids = [*range(1000), *(10**6 * i for i in range(1, 1001))]
    df = spark.createDataFrame([(i, i) for i in ids] + [(None, -1)] * 40, "ID long, V long")
    write_jdbc(df, url, "SKEWED", mode="overwrite", properties=DRIVER)

    def sizes(how):
        back = read_partitioned(spark, url, "SKEWED", how, properties=DRIVER, tiles=jdbc.TILES_BY_ROW)
        found = [r.n for r in back.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(found) == 2040 and back.select("ID").distinct().count() == 2001
        return found

    even = sizes(("ID", "quantiles", 8))
    assert len(even) == 8 and max(even) <= 2 * statistics.median(even)
    assert max(sizes(("ID", 8))) > 1000


def test_tiles_by_a_database_with_ntile_and_values_that_fill_parts():  # S1
    import duckdb

    from salesmart.sources import jdbc, range_predicates

    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i < 500 THEN 7 ELSE i END AS id FROM range(1000) r(i) UNION ALL SELECT NULL")
    for tiles in (jdbc.TILES, jdbc.TILES_BY_ROW.replace(" / ", " // ")):
        points = sorted({r[0] for r in con.execute(tiles.format(column="id", table="t", n=10)).fetchall()})
        assert points[0] == 7 and len(points) == 6  # five parts hold nothing but 7
        parts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in range_predicates("id", points)]
        assert sum(parts) == 1001 and max(parts) <= 601
    assert range_predicates("id", []) == range_predicates("id", [3]) == ["1 = 1"]
