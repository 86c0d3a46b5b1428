"""ERP source tables: names, column types, and readers.

A source arrives either as landed parquet (one directory per table) or over
JDBC (:mod:`salesmart.sources.jdbc`). Either way each table is narrowed to
the column types below at read time: ids to ``bigint`` (the JDBC mapping of
an unbounded NUMBER is ``decimal(38,10)``), quantities and prices to
decimals wide enough for the products to stay exact, so hash keys stay 8
bytes. A value that its type cannot hold exactly raises; nothing is rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exact_cast_sql

ERP_SCHEMAS: dict[str, list[tuple[str, str]]] = {
    "ra_customer_trx_all": [
        ("customer_trx_id", "bigint"), ("cust_trx_type_id", "bigint"),
        ("trx_date", "timestamp_ntz"), ("trx_number", "string"), ("ct_reference", "string"),
        ("exchange_rate", "decimal(15,6)"), ("org_id", "bigint"),
        ("sold_to_customer_id", "bigint"), ("bill_to_customer_id", "bigint"),
        ("ship_to_customer_id", "bigint"), ("ship_to_site_use_id", "bigint"),
        ("bill_to_site_use_id", "bigint"), ("previous_customer_trx_id", "bigint"),
    ],
    "ra_customer_trx_lines_all": [
        ("customer_trx_line_id", "bigint"), ("customer_trx_id", "bigint"),
        ("previous_customer_trx_line_id", "bigint"), ("line_number", "int"),
        ("line_type", "string"), ("inventory_item_id", "bigint"), ("description", "string"),
        ("quantity_invoiced", "decimal(12,4)"), ("quantity_credited", "decimal(12,4)"),
        ("unit_selling_price", "decimal(20,10)"), ("tax_classification_code", "string"),
        ("warehouse_id", "bigint"),
    ],
    "ra_cust_trx_types_all": [("cust_trx_type_id", "bigint"), ("name", "string")],
    "mtl_system_items_b": [
        ("inventory_item_id", "bigint"), ("organization_id", "bigint"), ("segment1", "string"),
    ],
    "oe_order_headers_all": [
        ("header_id", "bigint"), ("order_number", "bigint"), ("order_type_id", "bigint"),
        ("ordered_date", "timestamp_ntz"), ("price_list_id", "bigint"), ("created_by", "bigint"),
        ("shipping_instructions", "string"), ("attribute1", "string"), ("attribute2", "string"),
        ("attribute3", "string"), ("attribute4", "string"), ("attribute5", "string"),
    ],
    "oe_order_lines_all": [
        ("header_id", "bigint"), ("line_id", "bigint"), ("source_type_code", "string"),
    ],
    "oe_transaction_types_tl": [("transaction_type_id", "bigint"), ("name", "string")],
    "mtl_parameters": [("organization_id", "bigint"), ("organization_code", "string")],
    "hz_parties": [("party_id", "bigint"), ("party_name", "string")],
    "hz_cust_accounts_all": [
        ("cust_account_id", "bigint"), ("party_id", "bigint"), ("account_number", "string"),
    ],
    "hz_locations": [("location_id", "bigint"), ("city", "string"), ("country", "string")],
    "hz_party_sites": [("party_site_id", "bigint"), ("location_id", "bigint")],
    "hz_cust_acct_sites_all": [("cust_acct_site_id", "bigint"), ("party_site_id", "bigint")],
    "hz_cust_site_uses_all": [("site_use_id", "bigint"), ("cust_acct_site_id", "bigint")],
    "fnd_territories_vl": [("territory_code", "string")],
    "fnd_user": [("user_id", "bigint")],
    "org_organization_definitions": [("organization_id", "bigint"), ("operating_unit", "bigint")],
    "hr_organization_units": [("organization_id", "bigint"), ("name", "string")],
    "hr_all_organization_units": [("organization_id", "bigint"), ("name", "string")],
    "ar_adjustments_all": [
        ("customer_trx_id", "bigint"), ("receivables_trx_id", "bigint"),
        ("line_adjusted", "decimal(28,10)"),
    ],
    "ar_receivables_trx_all": [("receivables_trx_id", "bigint"), ("name", "string")],
    "wsh_delivery_details": [("source_line_id", "bigint"), ("batch_id", "bigint")],
    "qp_list_headers_tl": [("list_header_id", "bigint"), ("name", "string")],
}


def ddl(name: str) -> str:
    return ", ".join(f"{c} {t}" for c, t in ERP_SCHEMAS[name])


def narrow(df: DataFrame, name: str) -> DataFrame:
    """Select the spec's columns (case-insensitively) and cast them to the spec's types.

    One ``selectExpr`` (a cast only where the type differs); column pruning
    and casts are plain projections, so they do not stop filter pushdown.
    """
    fields = {f.name.lower(): f for f in df.schema.fields}
    missing = [c for c, _ in ERP_SCHEMAS[name] if c not in fields]
    if missing:
        raise ValueError(f"{name}: missing source columns {missing}")
    exprs, same = [], len(df.columns) == len(ERP_SCHEMAS[name])
    for (c, t), have in zip(ERP_SCHEMAS[name], df.schema.fields):
        same = same and have.name == c and have.dataType.simpleString() == t
    if same:
        return df  # already the spec's columns, order and types
    for c, t in ERP_SCHEMAS[name]:
        f = fields[c]
        if f.dataType.simpleString() == t and f.name == c:
            exprs.append(f"`{c}`")
        else:
            exprs.append(f"{exact_cast_sql(f'`{f.name}`', f.dataType, t, c)} AS `{c}`")
    return df.selectExpr(*exprs)


class ErpTables(Mapping):
    """Lazy mapping ERP table name → narrowed DataFrame.

    ``monthly_lines`` holds the invoice lines with their month where they were
    landed by month, and None otherwise.
    """

    monthly_lines: DataFrame | None = None

    def __init__(self, loader: Callable[[str], DataFrame]):
        self._loader = loader
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in ERP_SCHEMAS:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = narrow(self._loader(name), name)
        return self._cache[name]

    def __iter__(self):
        return iter(ERP_SCHEMAS)

    def __len__(self):
        return len(ERP_SCHEMAS)


#: Partition column of lines landed by month.
LINE_MONTH = "invoice_month"


def line_month(trx_date: Column) -> Column:
    """The month under which the lines of an invoice are landed."""
    return F.coalesce(F.date_format(trx_date, "yyyy-MM"), F.lit("none"))


def land_lines_by_month(lines: DataFrame, headers: DataFrame, path: str) -> None:
    """Land invoice lines under ``path``, return lines apart, by the month of their invoice (a landing helper).

    Lines without an invoice, or of one without a date, go under ``none``.
    """
    month = line_month(F.col("trx_date")).alias(LINE_MONTH)
    dated = lines.join(headers.select("customer_trx_id", month), "customer_trx_id", "left")
    (dated.fillna("none", [LINE_MONTH]).withColumn("is_return", F.col("previous_customer_trx_line_id").isNotNull())
     .hint("rebalance", "is_return", LINE_MONTH)
     .write.partitionBy("is_return", LINE_MONTH).parquet(path))


def with_monthly_lines(erp: ErpTables, path: str) -> ErpTables:
    """``erp`` with the invoice lines that :func:`land_lines_by_month` wrote under ``path``."""
    spark = erp["ra_customer_trx_all"].sparkSession
    schema = f"{ddl('ra_customer_trx_lines_all')}, is_return boolean, {LINE_MONTH} string"
    monthly = spark.read.schema(schema).parquet(path)
    out = ErpTables(lambda name: monthly if name == "ra_customer_trx_lines_all" else erp[name])
    out.monthly_lines = monthly
    return out


def parquet_tables(spark: SparkSession, root: str) -> ErpTables:
    """ERP tables landed as parquet under ``root/<table>`` (directory or ``.parquet``).

    Lines landed by month are recognised by their partition column.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs

    def load(name: str) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        where = hadoop.Path(path)  # looked up where Spark reads, not on the driver's disk
        if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            path += ".parquet"
        return spark.read.parquet(path)

    tables = ErpTables(load)
    lines = load("ra_customer_trx_lines_all")
    if LINE_MONTH in lines.columns:
        return with_monthly_lines(tables, f"{root.rstrip('/')}/ra_customer_trx_lines_all")
    return tables


def catalog_tables(spark: SparkSession, database: str) -> ErpTables:
    """ERP tables registered in the catalog as ``database.<table>`` (``spark.table``).

    Reading through the catalog keeps bucketing: land the invoice headers and
    lines with ``bucketBy(n, "customer_trx_id")`` and the mart's largest join
    (lines to headers) needs no shuffle of either side.
    """
    return ErpTables(lambda name: spark.table(f"{database}.{name}"))


def land_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Write ``df`` as a catalog table bucketed and sorted by ``key`` (a landing helper)."""
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
     .saveAsTable(table))


def frames(tables: Mapping[str, DataFrame]) -> ErpTables:
    """Wrap already-built DataFrames (tests, JDBC) in the same narrowing mapping."""
    return ErpTables(lambda name: tables[name])
