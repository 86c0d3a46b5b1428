"""Nothing is rounded or lost between a source table and the mart's arithmetic."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from salesmart.functions import line_amount, line_qty, order_reference, unit_price
from salesmart.plans.mart import rejected_references
from salesmart.sources import narrow

LINE = ("customer_trx_line_id decimal(38,10), customer_trx_id decimal(38,10), previous_customer_trx_line_id decimal(38,10), "
        "line_number int, line_type string, inventory_item_id decimal(38,10), description string, "
        "quantity_invoiced decimal(38,10), quantity_credited decimal(38,10), unit_selling_price decimal(38,10), "
        "tax_classification_code string, warehouse_id decimal(38,10)")


def lines(spark, qty, price, line_id="1"):
    row = (D(line_id), D(1), None, 1, "LINE", D(1), None, D(qty), None, D(price), None, D(1))
    return narrow(spark.createDataFrame([row], LINE), "ra_customer_trx_lines_all")


def test_decimals_come_through(spark):  # S1, X20
    df = lines(spark, "0.125", "0.1234567891")
    qty = line_qty("quantity_invoiced", "quantity_credited")
    r = df.select(qty.alias("q"), F.col("unit_selling_price").alias("p"),
                  line_amount(qty, unit_price("unit_selling_price", F.lit("1.5"))).alias("a")).collect()[0]
    assert (r.q, r.p) == (D("0.125"), D("0.1234567891"))
    assert r.a == D("0.125") * D("0.1234567891") * D("1.5")


@pytest.mark.parametrize("qty,line_id", [("0.12345", "1"), ("1", "1.5")])
def test_a_value_that_would_be_rounded_raises(spark, qty, line_id):
    with pytest.raises(Exception, match="more decimals"):
        lines(spark, qty, "1", line_id).collect()


@pytest.mark.parametrize("text,number", [("12", 12), ("12.0", 12), ("1E1", 10), (" 7 ", 7), ("12.5", None), ("SO/12", None),
                                         ("", None), (None, None), ("1e40", None)])
def test_order_reference(spark, text, number):  # J5, X21
    df = spark.createDataFrame([(text,)], "r string")
    assert df.select(order_reference("r").alias("n")).collect()[0].n == number


def test_rejected_references_are_counted(spark):  # T5
    df = spark.createDataFrame([("12",), ("12.0",), ("SO/1",), (None,), ("1.5",)], "ct_reference string")
    assert rejected_references(df).first()[0] == 2


def test_command_line_wants_every_jdbc_table_named(capsys):  # S1, S2
    from salesmart.__main__ import _splits, main

    assert _splits(["t:id:8", "s.u:K:2"]) == {"t": ("id", 8), "s.u": ("K", 2)}
    with pytest.raises(SystemExit):
        main(["mart-refresh", "--jdbc-url", "jdbc:x", "--history", "/tmp/none", "--jdbc-single", "hz_parties"])
    assert "ra_customer_trx_all" in capsys.readouterr().err


@pytest.mark.parametrize("kind, good, bad", [
    ("double", [0.1, 1234.5678, -3.0, 1e-4, None], [0.123456, 1e-5, 2.00001]),
    ("float", [0.1, 3.0625, -7.0, None], [0.123456, 1e-6]),
    ("string", ["0.1", " 12.3400000 ", "1E3", "12345E-4", "-.5", "7.", "0.0000000", "0E-50", "+1.2345", None],
     ["0.123456", "1E-5", "123456E-5", "0.00001", "1.00000000000000000000000000001"]),
])
def test_no_kind_of_source_is_rounded(spark, kind, good, bad):
    from decimal import Decimal

    from salesmart.functions import exact_cast

    def cast(values):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        return [r.v for r in df.select(exact_cast("v", df.schema["v"].dataType, "decimal(12,4)").alias("v")).collect()]

    assert cast(good) == [None if v is None else Decimal(str(v).strip()).quantize(Decimal("0.0001")) for v in good]
    for v in bad:
        with pytest.raises(Exception, match="more decimals"):
            cast([v])


def test_binary_numbers_with_a_fraction_are_no_ids(spark):
    from salesmart.functions import exact_cast

    df = spark.createDataFrame([(3.0, 1)], "v double, i int")
    assert df.select(exact_cast("v", df.schema["v"].dataType, "bigint")).first()[0] == 3
    with pytest.raises(Exception, match="more decimals"):
        df.select((F.col("v") + 0.5).alias("v")).select(exact_cast("v", df.schema["v"].dataType, "bigint")).collect()
    text = spark.createDataFrame([("no number",)], "v string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        text.select(exact_cast("v", text.schema["v"].dataType, "decimal(12,4)")).collect()
