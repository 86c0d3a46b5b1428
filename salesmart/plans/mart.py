"""The spare-part sales mart: invoice lines → 27-column fact rows.

The source query is one 28-relation Oracle statement with nine correlated
subqueries, a 38-column DISTINCT and a final classification block. Here it
is a DataFrame plan with the same result, reshaped for a distributed engine:

* joins that are written as outer joins but are turned into inner joins by
  a later null-rejecting predicate are written as inner joins;
* the two joins whose columns are never selected (order lines, creating
  user) are existence tests under the DISTINCT and become a per-order flag
  aggregate and a left-semi join -- no fan-out;
* the two territory joins, which select nothing and cannot change a
  DISTINCT result, are left out;
* every correlated subquery is an aggregate grouped by its correlation key
  and LEFT-joined back (the returned quantity and the return-invoice list
  share one pass);
* dimension chains (site use → account site → party site → location,
  account → party, warehouse → organisation → operating unit) are joined
  among themselves first, so the large invoice-line side is joined once
  per chain instead of once per table;
* the window's invoices and lines are read once and stored for all uses
  (:mod:`salesmart.plans.spine`);
* everything that hangs off the invoice header (orders, customers, sites,
  operating unit, adjustments, invoice total) is joined to the 12-month
  window of headers first (:func:`enriched_headers`); the invoice lines
  are then joined to the enriched headers once, and to the line-level
  dimensions (item, warehouse, returns);
* filters on DISTINCT key columns (item category exists, returns gate) are
  applied before the DISTINCT; the DISTINCT keeps the source's 36 live key
  columns (the two subquery results that are functions of other key
  columns are not computed), and the projection comes after it.

Broadcasts are left to Spark's size check (``autoBroadcastJoinThreshold``
and AQE's runtime statistics) except for the fixed 70-row code list.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import (gross_up, is_true, like_any, line_amount, line_qty,
                         not_like_all, order_reference, returns_gate, sales_channel, ship_to_city,
                         substr_from, unit_price, upper_like)
from ..operators import (attach, code_list, enforce_single, exists_any, guarded_lookup,
                         returns_rollup, semi_join)
from .spine import Spine, window_invoices, window_spine

# The 36 live DISTINCT key columns, in the source's select order.
DISTINCT_KEY = (
    "nama", "alamat1", "alamat2", "kota", "no_telp", "line_number", "trx_date", "trx_number",
    "ct_reference", "ordered_date", "trx_source", "order_type", "segment1", "description", "qty",
    "price_dpp", "price", "dpp", "adjusting", "organization_code", "sold_to_customer",
    "account_number", "bill_to_customer", "bill_city", "ship_to_customer", "ship_to_city",
    "shipping_instructions", "no_do", "pricelist", "org_id", "invoice_retur", "qty_retur",
    "tax_classification_code", "cabang_dari_gudang", "cabang_dari_invoice",
    "organization_id_invoice",
)


def invoice_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines of the given invoices with quantity, unit price and amount (exact decimals)."""
    return (lines
            .drop("previous_customer_trx_line_id")
            .join(headers, "customer_trx_id")
            .withColumn("qty", line_qty("quantity_invoiced", "quantity_credited"))
            .withColumn("price_dpp", unit_price("unit_selling_price", "exchange_rate"))
            .withColumn("price", line_amount("qty", "price_dpp")))


def sales_items(erp: Mapping[str, DataFrame], codes: DataFrame, rules: R.MartRules) -> DataFrame:
    """Items of the item-master organisation that are not excluded and have a listed prefix."""
    items = (erp["mtl_system_items_b"]
             .filter((F.col("organization_id") == rules.item_master_org)
                     & is_true(not_like_all("segment1", rules.excluded_item_patterns))))
    listed = codes.select(F.col("item_code").alias("_prefix"))
    return (items.join(listed, substr_from(items["segment1"], 1, 3) == listed["_prefix"], "left_semi")
            .select("inventory_item_id", "segment1"))


def orders_in_scope(erp: Mapping[str, DataFrame], headers: DataFrame, rules: R.MartRules, *,
                    guard: bool = True) -> DataFrame:
    """Sales orders referenced by the window's invoices, with everything the mart reads from them.

    An ambiguous price list fails the job; with ``guard=False`` the number of
    its names comes along (``pricelist__n``) for a caller that filters further
    and enforces it on what is left.

    Restricting to referenced order numbers first keeps the order-line and
    delivery scans proportional to the window rather than to all history.
    """
    refs = (headers.select(order_reference("ct_reference").alias("order_number"))
            .filter(F.col("order_number").isNotNull()).distinct())
    ooha = erp["oe_order_headers_all"].join(refs, "order_number", "left_semi")

    # order type (written as an outer join; the LIKE filters reject null)
    ottt = erp["oe_transaction_types_tl"].select(
        F.col("transaction_type_id").alias("order_type_id"), F.col("name").alias("order_type"))
    orders = (ooha.join(ottt, "order_type_id")
              .filter(like_any("order_type", rules.branch_patterns)
                      & like_any("order_type", rules.product_patterns)))

    # creating user exists (inner join, no column selected)
    orders = semi_join(orders, erp["fnd_user"], "created_by", "user_id")

    # order lines exist with an allowed source type (inner join, no column selected)
    src = F.col("source_type_code")
    lines = erp["oe_order_lines_all"]
    flags = exists_any(lines.join(orders.select("header_id"), "header_id", "left_semi"), "header_id",
                       _int_or_null=(src == rules.internal_source) | src.isNull(),
                       _external=(src == rules.external_source))
    orders = (orders.join(flags, "header_id")
              .filter(F.col("_int_or_null")
                      | (F.col("_external") & is_true(~upper_like("order_type", rules.tractor_pattern))))
              .drop("_int_or_null", "_external"))

    # price list name: scalar subquery, at most one row per list
    plist = guarded_lookup(erp["qp_list_headers_tl"], "list_header_id", "name", "pricelist",
                           distinct=False)
    orders = attach(orders, plist, "price_list_id", "list_header_id")
    if guard:
        orders = enforce_single(orders, "pricelist")

    # lowest delivery batch over all orders with the same order number
    scope_headers = erp["oe_order_headers_all"].join(refs, "order_number", "left_semi").select(
        "header_id", "order_number")
    no_do = (lines.select("line_id", "header_id")
             .join(scope_headers, "header_id")
             .join(erp["wsh_delivery_details"].select("source_line_id", "batch_id"),
                   F.col("line_id") == F.col("source_line_id"))
             .groupBy("order_number").agg(F.min("batch_id").alias("no_do")))
    orders = attach(orders, no_do, "order_number")

    return orders.select(
        *([] if guard else ["pricelist__n"]),
        "order_number", "ordered_date", "order_type", "pricelist", "no_do", "shipping_instructions",
        F.col("attribute1").alias("nama"), F.col("attribute2").alias("alamat1"),
        F.col("attribute3").alias("alamat2"), F.col("attribute4").alias("kota"),
        F.col("attribute5").alias("no_telp"))


def warehouses(erp: Mapping[str, DataFrame]) -> DataFrame:
    """Warehouse → code and the name of its operating unit."""
    hou = erp["hr_organization_units"].select(
        F.col("organization_id").alias("operating_unit"), F.col("name").alias("cabang_dari_gudang"))
    return (erp["mtl_parameters"]
            .join(erp["org_organization_definitions"], "organization_id")
            .join(hou, "operating_unit")
            .select(F.col("organization_id").alias("warehouse_id"), "organization_code",
                    "cabang_dari_gudang"))


def account_parties(erp: Mapping[str, DataFrame], how: str) -> DataFrame:
    """Customer account → account number and party name."""
    return (erp["hz_cust_accounts_all"]
            .join(erp["hz_parties"], "party_id", how)
            .select("cust_account_id", "account_number", "party_name"))


def site_cities(erp: Mapping[str, DataFrame], how: str) -> DataFrame:
    """Site use → city, through account site, party site and location."""
    return (erp["hz_cust_site_uses_all"]
            .join(erp["hz_cust_acct_sites_all"], "cust_acct_site_id", how)
            .join(erp["hz_party_sites"], "party_site_id", how)
            .join(erp["hz_locations"], "location_id", how)
            .select("site_use_id", "city"))


def _unreadable(headers: DataFrame) -> DataFrame:
    return headers.filter(F.col("ct_reference").isNotNull() & order_reference("ct_reference").isNull())


def rejected_rows(headers: DataFrame) -> DataFrame:
    """The given invoices whose order reference stands for no order number, each with the reason.

    A reference joins nothing where it is no number, no whole one, or too large for an order number.
    """
    number = F.col("ct_reference").try_cast("decimal(38,10)")
    size = F.abs(F.col("ct_reference").try_cast("double"))  # of numbers beyond the decimal's digits
    huge = number.isNull() & (size > 1) & (size < float("inf"))
    reason = (F.when(huge, "too large").when(number.isNull(), "no number").when(number != F.floor(number), "no whole number")
              .otherwise("too large"))
    return (_unreadable(headers)
            .select("customer_trx_id", "trx_number", "trx_date", "ct_reference", reason.alias("reason")))


def rejected_references(headers: DataFrame) -> DataFrame:
    """One row: how many order references of the given invoices are no order numbers."""
    return _unreadable(headers).agg(F.count(F.lit(1)).alias("rejected_references"))


def adjustments(erp: Mapping[str, DataFrame], rules: R.MartRules, invoices: DataFrame) -> DataFrame:
    """Per given invoice: sum of adjustments except the excluded receivables type.

    The left-semi join on the invoice comes before the grouping, so the cost
    follows the window, not all adjustments ever made.
    """
    kinds = (erp["ar_receivables_trx_all"]
             .filter(F.col("name") != rules.excluded_adjustment_type)
             .select("receivables_trx_id"))
    return (erp["ar_adjustments_all"]
            .join(invoices.select("customer_trx_id"), "customer_trx_id", "left_semi")
            .join(kinds, "receivables_trx_id")
            .groupBy("customer_trx_id")
            .agg(F.sum(F.coalesce(F.col("line_adjusted"), F.lit(0).cast("decimal(28,10)")))
                 .alias("adjusting")))


def enriched_headers(erp: Mapping[str, DataFrame], spine: Spine, rules: R.MartRules) -> DataFrame:
    """Window invoices with every header-level attribute and filter applied.

    Orders, operating unit, sold/bill/ship customer and sites, adjustments
    and the invoice total all hang off the invoice header, so they are
    joined here, where there is one row per invoice, and the (much larger)
    line side is joined only once afterwards.
    """
    headers = spine.headers
    orders = orders_in_scope(erp, headers, rules, guard=False)
    # returns gate: both inputs are header-level DISTINCT key columns, so filtering first is exact
    # (an ambiguous price list passes, to fail at the guard if a line reaches it)
    orders = orders.filter(returns_gate("order_type", "pricelist",
                                        rules.return_order_pattern, rules.return_pricelist_patterns)
                           | (F.col("pricelist__n") > 1))
    h = (headers.withColumn("_order_number", order_reference("ct_reference"))
         .join(orders, F.col("_order_number") == orders["order_number"])
         .drop("_order_number", "order_number"))

    houinv = erp["hr_organization_units"].select(
        F.col("organization_id").alias("org_id"), F.col("name").alias("cabang_dari_invoice"))
    h = h.join(houinv, "org_id").withColumn("organization_id_invoice", F.col("org_id"))

    sold = account_parties(erp, "inner").select(
        F.col("cust_account_id").alias("sold_to_customer_id"), "account_number",
        F.col("party_name").alias("sold_to_customer"))
    h = (h.join(sold, "sold_to_customer_id")
         .filter(~F.col("sold_to_customer").isin(list(rules.excluded_customers))))

    bill = account_parties(erp, "inner").select(
        F.col("cust_account_id").alias("bill_to_customer_id"),
        F.col("party_name").alias("bill_to_customer"))
    bill_site = site_cities(erp, "inner").select(
        F.col("site_use_id").alias("bill_to_site_use_id"), F.col("city").alias("bill_city"))
    h = h.join(bill, "bill_to_customer_id").join(bill_site, "bill_to_site_use_id")

    ship = account_parties(erp, "left").select(
        F.col("cust_account_id").alias("ship_to_customer_id"),
        F.col("party_name").alias("ship_to_customer"))
    ship_site = site_cities(erp, "left").select(
        F.col("site_use_id").alias("ship_to_site_use_id"), F.col("city").alias("ship_city"))
    h = (h.join(ship, "ship_to_customer_id", "left").join(ship_site, "ship_to_site_use_id", "left")
         .withColumn("ship_to_city", ship_to_city("sold_to_customer", "kota", "ship_city",
                                                  rules.retail_pattern))
         .drop("ship_city"))

    h = attach(h, adjustments(erp, rules, headers), "customer_trx_id", defaults={"adjusting": 0})

    # dpp: invoice total over all its lines, every line type (narrow columns only). Keyed on
    # the plain window headers, not on ``h``, so the enrichment above is not planned twice.
    rate = headers.select("customer_trx_id", "exchange_rate")
    dpp = (spine.lines
           .select("customer_trx_id", "quantity_invoiced", "quantity_credited", "unit_selling_price")
           .join(rate, "customer_trx_id")
           .groupBy("customer_trx_id")
           .agg(F.sum(line_amount(line_qty("quantity_invoiced", "quantity_credited"),
                                  unit_price("unit_selling_price", "exchange_rate"))).alias("dpp")))
    return attach(h, dpp, "customer_trx_id")


def mart_rows(erp: Mapping[str, DataFrame], as_of, rules: R.MartRules = R.DEFAULT_RULES,
              spark: SparkSession | None = None, codes: DataFrame | None = None,
              spine: Spine | None = None) -> DataFrame:
    """The DISTINCT block: one row per distinct invoice-line fact.

    Columns: the 36 DISTINCT key columns (see :data:`DISTINCT_KEY`). The window's
    invoices and lines are read and written first, unless ``spine`` has them.
    """
    spark = spark or erp["ra_customer_trx_all"].sparkSession
    codes = codes if codes is not None else code_list(spark, rules)

    spine = spine if spine is not None else window_spine(erp, as_of, rules)
    h = enriched_headers(erp, spine, rules)
    window_lines = spine.lines.filter(F.col("line_type") == "LINE")
    rows = (invoice_lines(window_lines, h)
            .join(sales_items(erp, codes, rules), "inventory_item_id")
            .join(warehouses(erp), "warehouse_id"))
    ret = returns_rollup(spine.returns, erp["ra_customer_trx_all"], of=window_lines)
    rows = (attach(rows, ret, "customer_trx_line_id", "returned_line_id")
            .withColumn("qty_retur", F.coalesce(F.col("qty_retur_sum"),
                                                F.lit(0).cast("decimal(22,4)"))))
    return enforce_single(rows, "pricelist").select(*DISTINCT_KEY).distinct()


def sales_mart_display(erp: Mapping[str, DataFrame], as_of, rules: R.MartRules = R.DEFAULT_RULES,
                       spark: SparkSession | None = None, spine: Spine | None = None) -> DataFrame:
    """The 27 output columns under their display names (before the contract rename)."""
    spark = spark or erp["ra_customer_trx_all"].sparkSession
    all_codes = code_list(spark, rules)
    rows = mart_rows(erp, as_of, rules, spark, all_codes, spine)
    codes = all_codes.select(F.col("item_code").alias("_prefix"), "sp_type")
    rows = rows.join(codes, substr_from(rows["segment1"], 1, 3) == codes["_prefix"])
    tax = F.col("tax_classification_code")
    return rows.select(
        F.col("cabang_dari_invoice").alias("Cabang"),
        F.col("organization_id_invoice").alias("Organization ID"),
        F.col("trx_date").alias("Tgl Invoice"),
        F.year("trx_date").alias("Tahun Invoice"),
        F.month("trx_date").alias("Bulan Invoice"),
        F.dayofmonth("trx_date").alias("Tanggal Hari Invoice"),
        F.col("trx_number").alias("No. Invoice"),
        F.col("ct_reference").alias("No. SO"),
        F.col("ordered_date").alias("Tgl SO"),
        F.col("trx_source").alias("Tipe Invoice"),
        F.col("order_type").alias("Order Type"),
        F.col("segment1").alias("Kode Barang"),
        F.col("description").alias("Nama Barang"),
        F.col("price").alias("Total Harga"),
        gross_up("price", tax, rules.tax_rules, rules.tax_default).alias("Total Harga PPN"),
        F.col("pricelist").alias("PRICELIST"),
        F.col("invoice_retur").alias("INVOICE_RETUR"),
        F.col("no_do").alias("NO_DO"),
        F.col("qty").alias("Qty"),
        F.col("qty_retur").alias("QTY_RETUR"),
        F.col("price_dpp").alias("Harga DPP/unit"),
        gross_up("price_dpp", tax, rules.tax_rules, rules.tax_default).alias("Harga PPN/unit"),
        F.col("organization_code").alias("Warehouse"),
        F.col("sold_to_customer").alias("Nama Customer"),
        F.col("ship_to_city").alias("Kota Ship To"),
        F.col("sp_type").alias("Tipe Sparepart"),
        sales_channel("order_type", "pricelist", rules.channel_rules,
                      rules.channel_default).alias("Tipe Penjualan"),
    )


def sales_mart(erp: Mapping[str, DataFrame], as_of: dt.date | str,
               rules: R.MartRules = R.DEFAULT_RULES, spark: SparkSession | None = None,
               spine: Spine | None = None) -> DataFrame:
    """The mart under its contract: 27 lower-case columns, dates as timestamps, strings filled."""
    from .contract import normalise_mart

    return normalise_mart(sales_mart_display(erp, as_of, rules, spark, spine))


def ordered_report(df: DataFrame, warehouse: str = "warehouse", order_type: str = "order_type") -> DataFrame:
    """``ORDER BY warehouse, order_type`` with the source's nulls-last order (presentation only).

    Further keys break ties, so that the rows of one large warehouse and type
    can be dealt over several tasks; the required order is kept.
    """
    ties = [c for c in ("no_invoice", "kode_barang", "nama_barang", "total_harga") if c in df.columns]
    return df.orderBy(F.asc_nulls_last(warehouse), F.asc_nulls_last(order_type), *ties)
