"""ERP-shaped tables derived from the driver's TPC-H-like tables.

The reference reads 23 ERP tables; the test and benchmark data is a star
schema (region, nation, customer, supplier, part, orders, lineitem). Each
ERP table below is a projection of one driver table (or of a DISTINCT
column of another derived table), so every query that reads them scales
with the driver data. The expressions are applied with ``selectExpr`` on
the already-resolved source DataFrame for Spark (no SQL text re-analysis,
no temp views), and rendered as CTEs for the DuckDB oracle.

Role mapping:

* invoice header / sales order  <- orders (one invoice per order)
* invoice line / order line / delivery detail <- lineitem
  (line id = orderkey*100 + linenumber; R-flag lines are returns of the
  lines with the same order and line number; every fourth invoice refers back
  to the one two keys before it)
* item <- part, warehouse <- supplier, operating unit <- nation,
  customer / party / site / location / user <- customer
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import EXCLUDED_CUSTOMERS
from .tables import ErpTables, frames


@dataclass(frozen=True)
class View:
    """``SELECT <select> FROM (SELECT DISTINCT <distinct> FROM <source> WHERE <where>)``."""

    source: str
    select: tuple[str, ...]
    where: str | None = None
    distinct: str | None = None

    def to_spark(self, src: DataFrame) -> DataFrame:
        df = src.filter(F.expr(self.where)) if self.where else src
        if self.distinct:
            df = df.select(self.distinct).distinct()
        return df.selectExpr(*self.select)

    def to_sql(self) -> str:
        inner = self.source
        if self.distinct or self.where:
            cols = self.distinct or "*"
            where = f" WHERE {self.where}" if self.where else ""
            inner = f"(SELECT {'DISTINCT ' if self.distinct else ''}{cols} FROM {self.source}{where}) t"
        return f"SELECT {', '.join(self.select)} FROM {inner}"

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Latest order date in the driver data: the "today" of every mart query.
DRIVER_AS_OF = "2001-08-01"

# Each entry: ERP table -> View(source, select expressions, where, distinct column).
# The expressions are written in the common subset of Spark SQL and DuckDB SQL.
ERP_VIEWS: dict[str, View] = {
    "ra_customer_trx_all": View(
        "orders",
        (
            'o_orderkey AS customer_trx_id',
            "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 4 WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 3 END AS cust_trx_type_id",
            'o_orderdate AS trx_date',
            "'INV-' || CAST(o_orderkey AS STRING) AS trx_number",
            "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'SO/' || CAST(o_orderkey AS STRING) WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_orderkey % 10 = 0 THEN CAST(CAST(o_orderkey / 10 AS BIGINT) AS STRING) || 'E1' WHEN o_orderkey % 11 = 4 THEN CAST(o_orderkey AS STRING) || '.0' ELSE CAST(o_orderkey AS STRING) END AS ct_reference",
            "CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'F' THEN CAST(1 AS DECIMAL(15,6)) ELSE CAST(1.5 AS DECIMAL(15,6)) END AS exchange_rate",
            'CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS org_id',
            'o_custkey AS sold_to_customer_id',
            'o_custkey AS bill_to_customer_id',
            "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS ship_to_customer_id",
            "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS ship_to_site_use_id",
            'o_custkey AS bill_to_site_use_id',
            'CASE WHEN o_orderkey % 4 = 3 THEN o_orderkey - 2 END AS previous_customer_trx_id',
        ),
    ),
    "ra_customer_trx_lines_all": View(
        "lineitem",
        (
            "CASE WHEN l_returnflag = 'R' THEN l_orderkey * 100 + l_linenumber + 50 ELSE l_orderkey * 100 + l_linenumber END AS customer_trx_line_id",
            'l_orderkey AS customer_trx_id',
            "CASE WHEN l_returnflag = 'R' THEN l_orderkey * 100 + l_linenumber END AS previous_customer_trx_line_id",
            'l_linenumber AS line_number',
            "CASE WHEN l_discount = 0.0 THEN 'FREIGHT' ELSE 'LINE' END AS line_type",
            'l_partkey AS inventory_item_id',
            "'PART-' || CAST(l_partkey AS STRING) AS description",
            "CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS DECIMAL(12,4)) END AS quantity_invoiced",
            "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN CAST(0.0 - l_quantity AS DECIMAL(12,4)) END AS quantity_credited",
            'CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(20,10)) AS unit_selling_price',
            "CASE WHEN l_tax = 0.0 THEN NULL WHEN l_tax = 0.08 THEN 'PPN-10-11' ELSE 'PPN-' || CAST(CAST(round(l_tax * 100) AS INT) + 6 AS STRING) END AS tax_classification_code",
            'l_suppkey AS warehouse_id',
        ),
    ),
    "ra_cust_trx_types_all": View(
        "ra_customer_trx_all",
        (
            'cust_trx_type_id',
            "CASE cust_trx_type_id WHEN 1 THEN 'Inv. Penj. Lokal' WHEN 2 THEN 'CM Inv. Penj. Export' WHEN 3 THEN 'Inv. Penj. Export' ELSE 'Inv. Non Penjualan' END AS name",
        ),
        distinct='cust_trx_type_id',
    ),
    "mtl_system_items_b": View(
        "part",
        (
            'p_partkey AS inventory_item_id',
            'CASE WHEN p_size > 45 THEN 82 ELSE 81 END AS organization_id',
            "CASE WHEN p_size = 1 THEN 'RL' WHEN p_size = 2 THEN 'JAD' || CAST(p_partkey AS STRING) WHEN p_size = 3 THEN 'QA2' || CAST(p_partkey AS STRING) WHEN p_size = 4 THEN 'RL' || CAST(p_partkey AS STRING) ELSE CASE p_type WHEN 'ECONOMY' THEN 'AAA' WHEN 'LARGE' THEN 'IAG' WHEN 'MEDIUM' THEN 'IAT' WHEN 'PROMO' THEN 'IBB' WHEN 'SMALL' THEN 'EAS' ELSE 'ZZZ' END || '-' || CAST(p_partkey AS STRING) END AS segment1",
        ),
    ),
    "oe_order_headers_all": View(
        "orders",
        (
            'o_orderkey AS header_id',
            'o_orderkey AS order_number',
            'CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS order_type_id',
            'o_orderdate AS ordered_date',
            'CASE WHEN o_totalprice >= 400000 THEN NULL ELSE CAST(floor(o_totalprice / 100000) AS BIGINT) END AS price_list_id',
            'o_custkey AS created_by',
            'CAST(NULL AS STRING) AS shipping_instructions',
            "'Cust ' || CAST(o_custkey AS STRING) AS attribute1",
            'o_orderstatus AS attribute2',
            'CAST(NULL AS STRING) AS attribute3',
            "'Kota ' || substr(o_orderpriority, 3) AS attribute4",
            'CAST(NULL AS STRING) AS attribute5',
        ),
    ),
    "oe_order_lines_all": View(
        "lineitem",
        (
            'l_orderkey AS header_id',
            'l_orderkey * 100 + l_linenumber AS line_id',
            "CASE l_returnflag WHEN 'A' THEN 'INTERNAL' WHEN 'N' THEN 'EXTERNAL' END AS source_type_code",
        ),
    ),
    "oe_transaction_types_tl": View(
        "oe_order_headers_all",
        (
            'order_type_id AS transaction_type_id',
            "CASE order_type_id WHEN 1 THEN 'JKT-Penjualan SAP DN' WHEN 2 THEN 'Penjualan TOKOQUICK SKF' WHEN 3 THEN 'SBY-Retur Bando DN' WHEN 4 THEN 'TRAKTOR Roll Ekspor LN' ELSE 'MDN-Penjualan Umum DN' END AS name",
        ),
        distinct='order_type_id',
    ),
    "qp_list_headers_tl": View(
        "oe_order_headers_all",
        (
            'price_list_id AS list_header_id',
            "CASE price_list_id WHEN 0 THEN 'SP Reguler' WHEN 1 THEN 'QT Harga Truck' WHEN 2 THEN 'RH Roll Khusus' ELSE 'Harga Umum' END AS name",
        ),
        where='price_list_id IS NOT NULL',
        distinct='price_list_id',
    ),
    "mtl_parameters": View(
        "supplier",
        (
            's_suppkey AS organization_id',
            "'WH' || CAST(s_suppkey AS STRING) AS organization_code",
        ),
    ),
    "org_organization_definitions": View(
        "supplier",
        (
            's_suppkey AS organization_id',
            'CAST(s_nationkey AS BIGINT) AS operating_unit',
        ),
    ),
    "hr_organization_units": View(
        "nation",
        (
            'CAST(n_nationkey AS BIGINT) AS organization_id',
            "CASE WHEN n_nationkey = 0 THEN 'HO (OU)' ELSE n_name || ' (OU)' END AS name",
        ),
    ),
    "hr_all_organization_units": View(
        "nation",
        (
            'CAST(n_nationkey AS BIGINT) AS organization_id',
            "CASE WHEN n_nationkey = 0 THEN 'HO (OU)' ELSE n_name || ' (OU)' END AS name",
        ),
    ),
    "hz_parties": View(
        "customer",
        (
            'c_custkey AS party_id',
            f"CASE WHEN c_acctbal < 0 THEN '{EXCLUDED_CUSTOMERS[1]}' WHEN c_mktsegment = 'BUILDING' "
            "THEN c_name || ' Eceran' ELSE c_name END AS party_name",
        ),
    ),
    "hz_cust_accounts_all": View(
        "customer",
        (
            'c_custkey AS cust_account_id',
            'c_custkey AS party_id',
            'CAST(c_custkey AS STRING) AS account_number',
        ),
    ),
    "hz_locations": View(
        "customer",
        (
            'c_custkey AS location_id',
            "CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE 'Kota ' || CAST(c_nationkey AS STRING) END AS city",
            'CAST(c_nationkey AS STRING) AS country',
        ),
    ),
    "hz_party_sites": View(
        "customer",
        (
            'c_custkey AS party_site_id',
            'c_custkey AS location_id',
        ),
    ),
    "hz_cust_acct_sites_all": View(
        "customer",
        (
            'c_custkey AS cust_acct_site_id',
            'c_custkey AS party_site_id',
        ),
    ),
    "hz_cust_site_uses_all": View(
        "customer",
        (
            'c_custkey AS site_use_id',
            'c_custkey AS cust_acct_site_id',
        ),
    ),
    "fnd_territories_vl": View(
        "nation",
        (
            'CAST(n_nationkey AS STRING) AS territory_code',
        ),
    ),
    "fnd_user": View(
        "customer",
        (
            'c_custkey AS user_id',
        ),
        where="c_mktsegment <> 'HOUSEHOLD'",
    ),
    "ar_adjustments_all": View(
        "lineitem",
        (
            'l_orderkey AS customer_trx_id',
            'CAST(l_linenumber AS BIGINT) AS receivables_trx_id',
            "CASE WHEN l_linestatus = 'F' THEN NULL ELSE CAST(0.0 - l_extendedprice AS DECIMAL(28,10)) END AS line_adjusted",
        ),
        where="l_returnflag = 'A'",
    ),
    "ar_receivables_trx_all": View(
        "ar_adjustments_all",
        (
            'receivables_trx_id',
            "CASE WHEN receivables_trx_id = 1 THEN 'Apply Uang Muka Customer' WHEN receivables_trx_id = 2 THEN NULL ELSE 'Adjustment ' || CAST(receivables_trx_id AS STRING) END AS name",
        ),
        distinct='receivables_trx_id',
    ),
    "wsh_delivery_details": View(
        "lineitem",
        (
            'l_orderkey * 100 + l_linenumber AS source_line_id',
            'l_suppkey AS batch_id',
        ),
    ),
}


# Column types of the driver parquet files (as written by the driver), so reading
# them needs no schema-inference job.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def driver_frames(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> dict[str, DataFrame]:
    """Driver tables as DataFrames, read with their known schemas (no inference job)."""
    out = {}
    for t in names:
        reader = spark.read.schema(DRIVER_SCHEMAS[t]) if t in DRIVER_SCHEMAS else spark.read
        out[t] = reader.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
    return out


def driver_erp(spark: SparkSession, sf_dir: str) -> ErpTables:
    """All 23 ERP tables as lazy DataFrames over the driver parquet in ``sf_dir``."""
    built: dict[str, DataFrame] = dict(driver_frames(spark, sf_dir))
    for name, view in ERP_VIEWS.items():
        built[name] = view.to_spark(built[view.source])
    return frames({n: built[n] for n in ERP_VIEWS})


def duckdb_ctes(names: list[str] | None = None) -> str:
    """The same derivations as a ``WITH`` list for DuckDB (driver tables are views there)."""
    wanted = list(ERP_VIEWS) if names is None else list(names)
    need: set[str] = set()
    stack = list(wanted)
    while stack:
        n = stack.pop()
        if n in need or n not in ERP_VIEWS:
            continue
        need.add(n)
        stack.append(ERP_VIEWS[n].source)
    return ",\n".join(f"{name} AS ({view.to_sql()})" for name, view in ERP_VIEWS.items() if name in need)
