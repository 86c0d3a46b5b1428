"""Code list, guarded lookups (T4), existence tests, returns rollup (C7/C8)."""

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart import rules as R
from salesmart.operators import (attach, code_list, enforce_single, exists_any, explode_list,
                                 guarded_lookup, returns_rollup, role, rollup, semi_join)
from tests.conftest import rows


def test_code_list_shape(spark):  # S5, O2, X2
    codes = code_list(spark).collect()
    assert len(codes) == 70
    assert [c.ordinal for c in codes] == list(range(1, 71))
    assert len({c.item_code for c in codes}) == 70
    assert all(c.sp_type is not None for c in codes)
    assert Counter(c.sp_type for c in codes) == Counter(
        {"SAP": 57, "BRG": 3, "SHDE": 2, "TR4": 2, "SVDE": 1, "MBI": 1, "BND": 1, "ROLL": 1,
         "GASKET": 1, "SGE": 1})
    assert codes[0].item_code == "AAA" and codes[54].item_code == "RL"
    assert [c.item_code for c in codes] == R.item_codes()


def test_code_list_is_broadcast(spark):
    items = spark.range(100).select(F.when(F.col("id") < 50, "AAA").otherwise("ZZZ").alias("p"))
    df = items.join(code_list(spark), items.p == F.col("item_code"))
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_explode_list_skips_blank_tokens(spark):  # F13
    df = spark.createDataFrame([(1, "A, B,,C ,"), (2, None)], "k int, s string")
    got = rows(explode_list(df, "s"), "k", "ordinal", "token")
    assert got == [(1, 1, "A"), (1, 2, "B"), (1, 3, "C")]


def test_guarded_lookup_single_value(spark):  # C4
    lut = spark.createDataFrame([(1, "SP"), (2, "QT")], "id long, name string")
    left = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "k long, ref long")
    out = enforce_single(attach(left, guarded_lookup(lut, "id", "name", "v", distinct=False), "ref", "id"), "v")
    assert rows(out, "k", "v") == [(10, "SP"), (11, None), (12, None)]
    assert out.columns == ["k", "ref", "v"]


def test_guarded_lookup_fails_only_when_looked_up(spark):  # T4
    lut = spark.createDataFrame([(1, "SP"), (2, "A"), (2, "B")], "id long, name string")
    look = guarded_lookup(lut, "id", "name", "v", distinct=False)
    ok = spark.createDataFrame([(10, 1)], "k long, ref long")
    assert rows(enforce_single(attach(ok, look, "ref", "id"), "v"), "k", "v") == [(10, "SP")]
    bad = spark.createDataFrame([(10, 2)], "k long, ref long")
    with pytest.raises(Exception, match="more than one row"):
        enforce_single(attach(bad, look, "ref", "id"), "v").collect()


def test_guarded_lookup_distinct_semantics(spark):  # A7: DISTINCT collapses equal values
    lut = spark.createDataFrame([(1, "X"), (1, "X"), (2, "X"), (2, None)], "id long, name string")
    look = guarded_lookup(lut, "id", "name", "v", distinct=True)
    ok = spark.createDataFrame([(10, 1)], "k long, ref long")
    assert rows(enforce_single(attach(ok, look, "ref", "id"), "v"), "k", "v") == [(10, "X")]
    bad = spark.createDataFrame([(10, 2)], "k long, ref long")  # {X, NULL}: two distinct rows
    with pytest.raises(Exception, match="more than one row"):
        enforce_single(attach(bad, look, "ref", "id"), "v").collect()


def test_attach_defaults(spark):  # A8
    left = spark.createDataFrame([(1,), (2,)], "k long")
    right = spark.createDataFrame([(1, Decimal("5.00"))], "k long, s decimal(28,2)")
    out = attach(left, rollup(right, "k", total=F.sum("s")), "k", defaults={"total": 0})
    assert rows(out, "k", "total") == [(1, Decimal("5.00")), (2, Decimal("0.00"))]


def test_exists_any_is_semi_join_with_theta(spark):  # J6, F4, T17
    orders = spark.createDataFrame([(1, "SAP DN"), (2, "TRAKTOR DN"), (3, "TRAKTOR DN"), (4, "SAP DN"),
                                    (5, "SAP DN")], "h long, ot string")
    lines = spark.createDataFrame([(1, "EXTERNAL"), (1, "EXTERNAL"), (2, "EXTERNAL"), (3, "INTERNAL"),
                                   (3, "EXTERNAL"), (4, None), (5, "OTHER")], "h long, src string")
    src = F.col("src")
    flags = exists_any(lines, "h", i=(src == "INTERNAL") | src.isNull(), e=(src == "EXTERNAL"))
    out = orders.join(flags, "h").filter(F.col("i") | (F.col("e") & ~F.upper("ot").like("%TRAKTOR%")))
    assert rows(out, "h") == [(1,), (3,), (4,)]  # one row per order: no fan-out


def test_semi_join_and_role(spark):  # J4
    users = spark.createDataFrame([(7,)], "user_id long")
    orders = spark.createDataFrame([(1, 7), (2, 8)], "h long, created_by long")
    assert rows(semi_join(orders, users, "created_by", "user_id"), "h") == [(1,)]
    r = role(users, "sold")
    assert r.columns == ["sold_user_id"]


def test_returns_rollup(spark):  # C7, C8, T22
    lines = spark.createDataFrame([
        (100, 1, None, "LINE", None),                 # original line, no returns
        (101, 1, None, "LINE", None),                 # original line with two returns
        (201, 2, 101, "LINE", Decimal("-1.00")),
        (301, 3, 101, "LINE", Decimal("-2.00")),
        (302, 3, 101, "TAX", Decimal("-9.00")),       # other line type: ignored
        (401, 4, 100, "LINE", None),                  # return with null credited qty
        (501, 9, 101, "LINE", Decimal("-4.00")),      # header 9 missing: counted in qty, not in list
    ], "customer_trx_line_id long, customer_trx_id long, previous_customer_trx_line_id long, "
       "line_type string, quantity_credited decimal(18,2)")
    headers = spark.createDataFrame([(1, "INV-1"), (2, "CM-B"), (3, "CM-A"), (4, "CM-C")],
                                    "customer_trx_id long, trx_number string")
    out = returns_rollup(lines, headers)
    assert rows(out, "returned_line_id", "qty_retur_sum", "invoice_retur") == [
        (100, None, "CM-C"), (101, Decimal("-7.00"), "CM-A,CM-B")]
