"""Business constants of the sales mart.

Everything here is data, not logic: the mart and the operators take these
values as arguments, so a different site can pass its own lists.

FIXED VALUES -- these must equal the source job's values for the mart to
produce the same rows. They are written out plainly and in their original
order.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- FIXED VALUES: item prefix code list, in its original comma order -----
ITEM_CODE_LIST = (
    "AAA,AAB,AAC,AAD,AAE,AAF,AAG,AAH,AAJ,AAK,AAL,AAM,AAN,BAB,BAC,ACA,ACB,"
    "ACC,ADA,ADB,ADD,AFA,AFB,AFC,BFA,AGC,AGF,E3A,E3B,E4A,E4B,EAA,EAB,EAR,"
    "EAX,EBB,EBE,EBG,EBJ,EBR,ECA,ECB,EDF,EDH,EDP,EEE,EER,EGA,EGB,EHA,IAG,"
    "AEA,IBD,IBE,RL,IAA,IAK,IAB,IAO,IAP,IAU,IBB,IAT,ACD,ACE,EAS,EDG,GAA,"
    "IBF,IAS"
)

# --- FIXED VALUES: category of each item code, first matching rule wins ----
ITEM_CATEGORY_RULES = (
    ("SAP", (
        "AAA", "AAB", "AAC", "AAD", "AAE", "AAF", "AAG", "AAH", "AAJ", "AAK",
        "AAL", "AAM", "AAN", "BAB", "BAC", "ACA", "ACB", "ACC", "ADA", "ADB",
        "ADD", "AFA", "AFB", "AFC", "BFA", "AGC", "AGF", "E3A", "E3B", "E4A",
        "E4B", "EAA", "EAB", "EAR", "EAX", "EBB", "EBE", "EBG", "EBJ", "EBR",
        "ECA", "ECB", "EDF", "EDH", "EDP", "EEE", "EER", "EGA", "EGB", "EHA",
        "IBD", "IBE", "RL", "ACD", "ACE", "EAS", "EDG",
    )),
    ("SHDE", ("IAA", "GAA")),
    ("SVDE", ("IAB",)),
    ("MBI", ("IAO",)),
    ("BND", ("IAP",)),
    ("BRG", ("IAU", "IBB", "IBF")),
    ("ROLL", ("IAT",)),
    ("GASKET", ("IAS",)),
    ("TR4", ("IAG", "AEA")),
    ("SGE", ("IAK",)),
)

# --- FIXED VALUES: invoice transaction types that count as sales ----------
INVOICE_TYPES = (
    "Inv. Penj. Lokal",
    "Inv. Penj. Export",
    "CM Inv. Penj. Lokal",
    "CM Inv. Penj. Export",
)

# --- FIXED VALUES: internal customers that never count as sales -----------
EXCLUDED_CUSTOMERS = (
    "KHS PAMERAN",
    "KHS DEMO",
    "KHS CUSTOMER KLAIM",
    "KHS RISET & TESTING",
)

# --- FIXED VALUES: order type name filters (LIKE patterns, case as written)
ORDER_TYPE_BRANCH_PATTERNS = ("%DN", "%LN", "%TOKOQUICK%")
ORDER_TYPE_PRODUCT_PATTERNS = (
    "%SAP%",
    "%SHDE%",
    "%SGE%",
    "%SVDE%",
    "%Mitsuboshi%",
    "%Bando%",
    "%SKF%",
    "%Nachi%",
    "%Roll%",
    "%Bearing%Quick%All%",
    "%Retur%",
    "%Gasket%",
    "%TOKOQUICK%",
)

# --- FIXED VALUES: item codes that are never sales (NOT LIKE patterns) ----
EXCLUDED_ITEM_PATTERNS = ("JAD%", "QA2%")

# --- FIXED VALUES: order-line source types and the tractor exclusion ------
SOURCE_INTERNAL = "INTERNAL"
SOURCE_EXTERNAL = "EXTERNAL"
TRACTOR_PATTERN = "%TRAKTOR%"  # tested on UPPER(order type)

# --- FIXED VALUES: item master organisation and adjustment exclusion ------
ITEM_MASTER_ORG = 81
EXCLUDED_ADJUSTMENT_TYPE = "Apply Uang Muka Customer"

# --- FIXED VALUES: returns gate (all tested on UPPER) ---------------------
RETURN_ORDER_PATTERN = "%RETUR%"
RETURN_PRICELIST_PATTERNS = ("%SP%", "%RH%ROLL%", "%SPARE%PART%", "%TOKOQUICK%")

# --- FIXED VALUES: tax gross-up, first matching pattern wins --------------
TAX_RULES = (("%10%", "1.10"), ("%11%", "1.11"))
TAX_DEFAULT_FACTOR = "1.10"

# --- FIXED VALUES: sales channel (tested on UPPER) ------------------------
CHANNEL_RULES = (
    ("order_type", "%TOKOQUICK%", "TOKOQUICK"),
    ("pricelist", "%QT%", "QUICK TRUCK"),
)
CHANNEL_DEFAULT = "UMUM"

# --- FIXED VALUES: ship-to city override, branch labels -------------------
RETAIL_CUSTOMER_PATTERN = "%Eceran"
EXPORT_ORDER_PATTERN = "%LN"
DOMESTIC_ORDER_PATTERN = "%DN"
EXPORT_BRANCH_CODE = "HO"
EXPORT_BRANCH_LABEL = "Ekspor"
ORG_NAME_START = 4          # SUBSTR(name, 4)
ORG_NAME_SUFFIX = "(OU)"    # removed from the cleaned name

# --- FIXED VALUES: refresh window -----------------------------------------
WINDOW_MONTHS = 12
PROTECTED_YEAR = 9999
INSERT_BATCH_ROWS = 10_000

# --- FIXED VALUES: display names of the mart and their contract names -----
DISPLAY_TO_CONTRACT = {
    "Cabang": "cabang",
    "Organization ID": "organization_id",
    "Tahun Invoice": "tahun_invoice",
    "Bulan Invoice": "bulan_invoice",
    "Tanggal Hari Invoice": "tanggal_hari_invoice",
    "Tgl Invoice": "tgl_invoice",
    "No. Invoice": "no_invoice",
    "No. SO": "no_so",
    "Tgl SO": "tgl_so",
    "Tipe Invoice": "tipe_invoice",
    "Order Type": "order_type",
    "Kode Barang": "kode_barang",
    "Nama Barang": "nama_barang",
    "Total Harga": "total_harga",
    "Total Harga PPN": "total_harga_ppn",
    "pricelist": "pricelist",
    "invoice_retur": "invoice_retur",
    "no_do": "no_do",
    "Qty": "qty",
    "qty_retur": "qty_retur",
    "Harga DPP/unit": "harga_dpp_per_unit",
    "Harga PPN/unit": "harga_ppn_per_unit",
    "Warehouse": "warehouse",
    "Nama Customer": "nama_customer",
    "Kota Ship To": "kota_ship_to",
    "Tipe Sparepart": "tipe_sparepart",
    "Tipe Penjualan": "tipe_penjualan",
}

# --- FIXED VALUES: expected contract columns, in target order -------------
MART_COLUMNS = (
    "cabang", "organization_id", "tahun_invoice", "bulan_invoice",
    "tanggal_hari_invoice", "tgl_invoice", "no_invoice", "no_so", "tgl_so",
    "tipe_invoice", "order_type", "kode_barang", "nama_barang", "total_harga",
    "total_harga_ppn", "pricelist", "invoice_retur", "no_do", "qty",
    "qty_retur", "harga_dpp_per_unit", "harga_ppn_per_unit", "warehouse",
    "nama_customer", "kota_ship_to", "tipe_sparepart", "tipe_penjualan",
)
MART_DATE_COLUMNS = ("tgl_invoice", "tgl_so")

# --- FIXED VALUES: full-copy target, column names and SQL types in order --
TRANSACTIONS_DDL = (
    ("REQUEST_ID", "NUMERIC"),
    ("REQUEST_DATE", "DATE"),
    ("CUSTOMER_TRX_LINE_ID", "NUMERIC"),
    ("CREATION_DATE", "DATE"),
    ("INVOICE_NUMBER", "VARCHAR(20)"),
    ("SO_NUMBER", "NUMERIC"),
    ("ORDER_TYPE", "VARCHAR(50)"),
    ("ORDER_TYPE_CODE", "VARCHAR(20)"),
    ("ORDER_TYPE_DESC", "VARCHAR(30)"),
    ("ORG_ID", "NUMERIC"),
    ("ORG_NAME", "VARCHAR(240)"),
    ("ORG_CODE", "VARCHAR(10)"),
    ("CUST_ACCOUNT_ID", "NUMERIC"),
    ("CUSTOMER_NAME", "VARCHAR(360)"),
    ("CUSTOMER_CITY", "VARCHAR(60)"),
    ("CUSTOMER_PROVINCE", "VARCHAR(80)"),
    ("LINE_NUMBER", "NUMERIC"),
    ("ITEM_ID", "NUMERIC"),
    ("ITEM_CODE", "VARCHAR(40)"),
    ("ITEM_DESCRIPTION", "VARCHAR(240)"),
    ("ITEM_TYPE", "VARCHAR(30)"),
    ("QUANTITY", "NUMERIC"),
    ("PRICE", "NUMERIC"),
    ("TOTAL_PRICE", "NUMERIC"),
    ("KOTA", "VARCHAR(50)"),
    ("PROVINSI", "VARCHAR(50)"),
    ("LOCATION_ID", "NUMERIC"),
    ("A_CUST_NAME", "VARCHAR(500)"),
    ("CITY", "VARCHAR(100)"),
    ("PROVINCE", "VARCHAR(100)"),
    ("LATITUDE", "NUMERIC"),
    ("LONGITUDE", "NUMERIC"),
)


def item_codes() -> list[str]:
    """The code list split into tokens, empty tokens skipped."""
    return [t.strip() for t in ITEM_CODE_LIST.split(",") if t.strip()]


def item_category(code: str) -> str | None:
    for category, codes in ITEM_CATEGORY_RULES:
        if code in codes:
            return category
    return None


@dataclass(frozen=True)
class MartRules:
    """All constants the mart reads, bundled so callers can override them."""

    code_list: str = ITEM_CODE_LIST
    category_rules: tuple = ITEM_CATEGORY_RULES
    invoice_types: tuple = INVOICE_TYPES
    excluded_customers: tuple = EXCLUDED_CUSTOMERS
    branch_patterns: tuple = ORDER_TYPE_BRANCH_PATTERNS
    product_patterns: tuple = ORDER_TYPE_PRODUCT_PATTERNS
    excluded_item_patterns: tuple = EXCLUDED_ITEM_PATTERNS
    item_master_org: int = ITEM_MASTER_ORG
    excluded_adjustment_type: str = EXCLUDED_ADJUSTMENT_TYPE
    window_months: int = WINDOW_MONTHS
    tax_rules: tuple = TAX_RULES
    tax_default: str = TAX_DEFAULT_FACTOR
    return_order_pattern: str = RETURN_ORDER_PATTERN
    return_pricelist_patterns: tuple = RETURN_PRICELIST_PATTERNS
    tractor_pattern: str = TRACTOR_PATTERN
    internal_source: str = SOURCE_INTERNAL
    external_source: str = SOURCE_EXTERNAL
    channel_rules: tuple = CHANNEL_RULES
    channel_default: str = CHANNEL_DEFAULT
    retail_pattern: str = RETAIL_CUSTOMER_PATTERN


DEFAULT_RULES = MartRules()
