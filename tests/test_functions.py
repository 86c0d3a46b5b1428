"""Scalar expressions and the semantic traps (T1-T22) they guard against."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart import rules as R
from salesmart import functions as SF
from salesmart.functions import labels


def one(spark, expr, ddl="x string", value=None):
    df = spark.createDataFrame([(value,)], ddl)
    return df.select(expr.alias("r")).collect()[0]["r"]


def test_substr_start_zero_is_one_and_rl_code(spark):  # T1
    df = spark.createDataFrame([("RL",), ("RL1",), ("RLX9",), ("AAA-1",)], "s string")
    got = [r.p for r in df.select(SF.substr_from("s", 0, 3).alias("p")).collect()]
    assert got == ["RL", "RL1", "RLX", "AAA"]
    # only an item code that is exactly RL has the prefix RL
    assert [p for p in got if p == "RL"] == ["RL"]


@pytest.mark.parametrize("value,expected", [("-A-B", "A"), ("--", None), ("SBY-Retur DN", "SBY"),
                                            ("ABC", "ABC"), (None, None)])
def test_first_token(spark, value, expected):  # T2
    assert one(spark, SF.first_token(F.col("x"), "-"), value=value) == expected


@pytest.mark.parametrize("d,n,expected", [
    ("2025-02-28", -12, "2024-02-29"),   # month end maps to month end
    ("2024-02-29", -12, "2023-02-28"),
    ("2001-01-31", 1, "2001-02-28"),
    ("2001-02-28", 1, "2001-03-31"),
    ("2001-08-01", -12, "2000-08-01"),
    ("2000-03-30", -1, "2000-02-29"),    # clamp, not a month end
])
def test_add_months_oracle(spark, d, n, expected):  # T3
    got = one(spark, SF.add_months_oracle(F.col("x"), n), "x date", dt.date.fromisoformat(d))
    assert got == dt.date.fromisoformat(expected)


def test_trunc_day_is_not_null(spark):  # T3: trunc(ts,'DD') is null in Spark; the cast is not
    ts = dt.datetime(2001, 2, 28, 13, 0)
    assert one(spark, SF.trunc_day(F.col("x")), "x timestamp_ntz", ts) == dt.date(2001, 2, 28)


def test_trailing_window_boundaries(spark):  # F10 / X16-X18
    as_of = "2001-08-01"
    cases = {
        dt.datetime(2000, 8, 1, 0, 0): True,     # first day of the window, midnight
        dt.datetime(2000, 8, 1, 13, 0): True,    # first day, afternoon
        dt.datetime(2000, 7, 31, 23, 59): False,  # the day before
        dt.datetime(2001, 8, 1, 23, 0): True,    # today, later in the day
        dt.datetime(2001, 8, 2, 0, 0): False,    # tomorrow
    }
    df = spark.createDataFrame([(k,) for k in cases], "ts timestamp_ntz")
    got = {r.ts: r.ok for r in df.select("ts", SF.in_trailing_window("ts", as_of, 12).alias("ok")).collect()}
    assert got == cases


def test_window_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(dt.datetime(2001, 1, 1),)], "ts timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path).filter(SF.in_trailing_window("ts", "2001-08-01", 12))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_try_cast_bad_reference_is_null(spark):  # T5
    df = spark.createDataFrame([("123",), (" 45 ",), ("SO/12",), (None,)], "r string")
    got = [r.n for r in df.select(F.col("r").try_cast("bigint").alias("n")).collect()]
    assert got == [123, 45, None, None]


def test_line_amounts_are_exact(spark):  # T7
    df = spark.createDataFrame(
        [(Decimal("3.00"), None, Decimal("0.333333"), Decimal("15000.123456"))],
        "qi decimal(18,2), qc decimal(18,2), usp decimal(18,6), rate decimal(18,6)")
    r = df.select(SF.line_qty("qi", "qc").alias("q"),
                  SF.unit_price("usp", "rate").alias("p"),
                  SF.line_amount(SF.line_qty("qi", "qc"), SF.unit_price("usp", "rate")).alias("a")).collect()[0]
    assert r.p == Decimal("0.333333") * Decimal("15000.123456")
    assert r.a == Decimal("3.00") * Decimal("0.333333") * Decimal("15000.123456")


def test_nvl_quantity_and_rate(spark):  # X1
    df = spark.createDataFrame([(None, Decimal("-2.00"), Decimal("10"), None), (None, None, Decimal("1"), None)],
                               "qi decimal(18,2), qc decimal(18,2), usp decimal(18,6), rate decimal(18,6)")
    got = df.select(SF.line_qty("qi", "qc").alias("q"), SF.unit_price("usp", "rate").alias("p")).collect()
    assert got[0].q == Decimal("-2.00") and got[0].p == Decimal("10")
    assert got[1].q is None


@pytest.mark.parametrize("code,factor", [("PPN-10", "1.10"), ("PPN-11", "1.11"), ("PPN-10-11", "1.10"),
                                         ("PPN-7", "1.10"), (None, "1.10"), ("1011", "1.10"),
                                         ("X11", "1.11")])
def test_tax_factor_first_match_wins(spark, code, factor):  # X4, T20
    assert one(spark, SF.tax_factor(F.col("x")), value=code) == Decimal(factor)


def test_gross_up_exact(spark):  # T7
    df = spark.createDataFrame([(Decimal("100.01"), "PPN-11")], "a decimal(32,14), c string")
    assert df.select(SF.gross_up("a", "c").alias("g")).collect()[0].g == Decimal("111.0111")


@pytest.mark.parametrize("ot,pl,expected", [
    ("Penjualan TOKOQUICK", "QT Truck", "TOKOQUICK"),   # order type wins
    ("Penjualan tokoquick", None, "TOKOQUICK"),         # upper()
    ("JKT-SAP DN", "qt harga", "QUICK TRUCK"),
    ("JKT-SAP DN", None, "UMUM"),
    (None, None, "UMUM"),
])
def test_sales_channel(spark, ot, pl, expected):  # X5, X7
    df = spark.createDataFrame([(ot, pl)], "ot string, pl string")
    assert df.select(SF.sales_channel("ot", "pl").alias("c")).collect()[0].c == expected


@pytest.mark.parametrize("name,expected", [("Toko Eceran", "KOTA ORDER"), ("Toko eceran", "LOC"),
                                           ("Eceran Toko", "LOC"), (None, "LOC")])
def test_city_override(spark, name, expected):  # X6
    df = spark.createDataFrame([(name, "KOTA ORDER", "LOC")], "n string, k string, c string")
    assert df.select(SF.ship_to_city("n", "k", "c").alias("x")).collect()[0].x == expected


@pytest.mark.parametrize("ot,expected", [("SBY-Retur DN", "SBY"), ("TRAKTOR LN", "HO"),
                                         ("X DN LN", "HO"), ("Penjualan", None), ("-DN", "DN"),
                                         (None, None)])
def test_branch_code(spark, ot, expected):  # X3, X12
    assert one(spark, SF.branch_code(F.col("x")), value=ot) == expected


@pytest.mark.parametrize("name,expected", [("PTX Jakarta (OU)", "Jakarta"), ("HO (OU)", None),
                                           ("AB", None), ("PTX  Medan  ", "Medan")])
def test_org_label_empty_is_null(spark, name, expected):  # X8-X10, T14
    assert one(spark, SF.org_label(F.col("x")), value=name) == expected


def test_branch_label_variants(spark):  # C5 / C9
    df = spark.createDataFrame([("A LN", "PTX Jkt (OU)"), ("A DN", "PTX Jkt (OU)"), ("A XX", "PTX Jkt (OU)")],
                               "ot string, org string")
    got = df.select(SF.branch_label("ot", "org", domestic_only=False).alias("a"),
                    SF.branch_label("ot", "org", domestic_only=True).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("Ekspor", "Ekspor"), ("Jkt", "Jkt"), ("Jkt", None)]


@pytest.mark.parametrize("ot,pl,keep", [
    ("SBY-Retur Bando DN", "SP Reguler", True),
    ("SBY-Retur Bando DN", "RH Roll Khusus", True),
    ("SBY-Retur Bando DN", "sparepart", True),          # %SPARE%PART% on upper
    ("SBY-Retur Bando DN", "Harga Umum", False),
    ("SBY-Retur Bando DN", None, False),
    ("JKT-SAP DN", None, True),
    (None, "SP", False),                                 # null order type fails
])
def test_returns_gate(spark, ot, pl, keep):  # F8, F9, X23
    df = spark.createDataFrame([(ot, pl)], "ot string, pl string")
    assert df.filter(SF.returns_gate("ot", "pl")).count() == (1 if keep else 0)


def test_like_case_sensitivity(spark):  # T18: %Retur% is case-sensitive, the gate's %RETUR% is on upper
    df = spark.createDataFrame([("X RETUR DN",), ("X Retur DN",)], "ot string")
    got = [r.ot for r in df.filter(SF.like_any("ot", ["%Retur%"])).collect()]
    assert got == ["X Retur DN"]


def test_like_inner_wildcards(spark):  # F6
    df = spark.createDataFrame([("Bearing Quick All",), ("Bearing-Quick-All DN",), ("Quick Bearing All",)], "n string")
    assert df.filter(SF.like_any("n", ["%Bearing%Quick%All%"])).count() == 2


def test_not_like_rejects_null(spark):  # F7
    df = spark.createDataFrame([("JAD1",), ("QA21",), ("QA3",), (None,)], "s string")
    got = [r.s for r in df.filter(SF.not_like_all("s", ["JAD%", "QA2%"])).collect()]
    assert got == ["QA3"]


def test_not_in_rejects_null(spark):  # F3
    df = spark.createDataFrame([(R.EXCLUDED_CUSTOMERS[1],), ("Toko A",), (None,)], "n string")
    got = [r.n for r in df.filter(~F.col("n").isin([R.EXCLUDED_CUSTOMERS[1]])).collect()]
    assert got == ["Toko A"]


def test_category_case_matches_rules(spark):  # X2
    df = spark.createDataFrame([("AAA",), ("IAA",), ("IAK",), ("ZZZ",), ("RL",)], "c string")
    got = [r.k for r in df.select(labels.category_case("c").alias("k")).collect()]
    assert got == ["SAP", "SHDE", "SGE", None, "SAP"]
