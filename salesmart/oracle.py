"""DuckDB statements that check the registered queries independently.

They are built from the meaning of each operator, in stages of their own: sale
headers, order facts, money of lines, roll-ups by key, names and places, and at
last the fact rows.  The values of the business rules are stated here a second
time, so that a slip in :mod:`salesmart.rules` shows.
"""

from __future__ import annotations

from .sources import duckdb_ctes

# --- FIXED VALUES: item prefixes in list order, and those that are no plain spare part
PREFIXES = (
    "AAA AAB AAC AAD AAE AAF AAG AAH AAJ AAK AAL AAM AAN BAB BAC ACA ACB ACC ADA ADB ADD AFA AFB AFC BFA AGC AGF "
    "E3A E3B E4A E4B EAA EAB EAR EAX EBB EBE EBG EBJ EBR ECA ECB EDF EDH EDP EEE EER EGA EGB EHA IAG AEA IBD IBE "
    "RL IAA IAK IAB IAO IAP IAU IBB IAT ACD ACE EAS EDG GAA IBF IAS"
).split()
OTHER_KINDS = {
    "IAG": "TR4", "AEA": "TR4", "IAA": "SHDE", "GAA": "SHDE", "IAK": "SGE", "IAB": "SVDE", "IAO": "MBI", "IAP": "BND",
    "IAU": "BRG", "IBB": "BRG", "IBF": "BRG", "IAT": "ROLL", "IAS": "GASKET",
}
# --- FIXED VALUES: names and patterns
SALE_TYPES = ("Inv. Penj. Lokal", "Inv. Penj. Export", "CM Inv. Penj. Lokal", "CM Inv. Penj. Export")
INTERNAL_BUYERS = ("KHS PAMERAN", "KHS DEMO", "KHS CUSTOMER KLAIM", "KHS RISET & TESTING")
PREPAYMENT = "Apply Uang Muka Customer"
BRANCH = "(?s)((DN|LN)$|TOKOQUICK)"
PRODUCT = "(?s)(SAP|SHDE|SGE|SVDE|Mitsuboshi|Bando|SKF|Nachi|Roll|Bearing.*Quick.*All|Retur|Gasket|TOKOQUICK)"
RETURN_LISTS = "(?s)(SP|RH.*ROLL|SPARE.*PART|TOKOQUICK)"
MASTER_ORG = 81


def texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def days(column: str, lo: str, hi: str) -> str:
    """Whole days from lo to hi, both included."""
    return f"{column} >= TIMESTAMP '{lo} 00:00:00' AND {column} < TIMESTAMP '{hi} 00:00:00' + INTERVAL 1 DAY"


def order_number(reference: str) -> str:
    """The order number that a reference text stands for; null if it is no whole number."""
    number = f"TRY_CAST({reference} AS DECIMAL(38,10))"
    return f"CASE WHEN {number} = floor({number}) THEN TRY_CAST({number} AS BIGINT) END"


def allowed_order(name: str, inside: str, outside: str) -> str:
    return f"({inside} OR ({outside} AND NOT contains(upper({name}), 'TRAKTOR')))"


def passes_gate(order_type: str, pricelist: str) -> str:
    """Returns need a spare-part price list; an order without a type fails."""
    return (f"({order_type} IS NOT NULL AND (NOT contains(upper({order_type}), 'RETUR') "
            f"OR coalesce(regexp_matches(upper({pricelist}), '{RETURN_LISTS}'), FALSE)))")


def taxed(amount: str, code: str) -> str:
    """11 % only where the code has 11 and not 10; else 10 %."""
    return (f"{amount} * CASE WHEN contains({code}, '11') AND NOT contains({code}, '10') "
            "THEN CAST(1.11 AS DECIMAL(3,2)) ELSE CAST(1.10 AS DECIMAL(3,2)) END")


CHANNEL = ("CASE WHEN contains(upper({order_type}), 'TOKOQUICK') THEN 'TOKOQUICK' "
           "WHEN contains(upper({pricelist}), 'QT') THEN 'QUICK TRUCK' ELSE 'UMUM' END")

QTY = "CAST(coalesce(quantity_invoiced, quantity_credited) AS DECIMAL(12,4))"
UNIT = "CAST(unit_selling_price AS DECIMAL(20,10)) * CAST(coalesce(exchange_rate, 1) AS DECIMAL(15,6))"

# --- stages: name -> (ERP tables, earlier stages, text) ----------------------

STAGES: dict[str, tuple[str, str, str]] = {
    "kind_of_prefix": ("", "", "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{p}', '{OTHER_KINDS.get(p, 'SAP')}')" for i, p in enumerate(PREFIXES, 1))
        + ") AS v(ordinal, prefix, kind)"),
    "window_headers": ("ra_customer_trx_all", "", "SELECT * FROM ra_customer_trx_all WHERE {days}"),
    "sale_headers": ("ra_cust_trx_types_all", "window_headers", f"""
        SELECT w.*, t.name AS type_name, {order_number('w.ct_reference')} AS wanted_order
        FROM window_headers w JOIN ra_cust_trx_types_all t ON t.cust_trx_type_id = w.cust_trx_type_id
        WHERE t.name IN ({texts(SALE_TYPES)})"""),
    "account_names": ("hz_cust_accounts_all hz_parties", "", """
        SELECT a.cust_account_id AS account, a.account_number, p.party_name, p.party_id IS NOT NULL AS has_party
        FROM hz_cust_accounts_all a LEFT JOIN hz_parties p ON p.party_id = a.party_id"""),
    "site_places": ("hz_cust_site_uses_all hz_cust_acct_sites_all hz_party_sites hz_locations", "", """
        SELECT u.site_use_id AS site, l.city, l.location_id IS NOT NULL AS has_place
        FROM hz_cust_site_uses_all u
        LEFT JOIN hz_cust_acct_sites_all s ON s.cust_acct_site_id = u.cust_acct_site_id
        LEFT JOIN hz_party_sites p ON p.party_site_id = s.party_site_id
        LEFT JOIN hz_locations l ON l.location_id = p.location_id"""),
    "units": ("mtl_parameters org_organization_definitions hr_organization_units", "", """
        SELECT w.organization_id AS warehouse, w.organization_code AS code, u.name AS unit_name
        FROM org_organization_definitions d
        JOIN mtl_parameters w ON w.organization_id = d.organization_id
        JOIN hr_organization_units u ON u.organization_id = d.operating_unit"""),
    "order_sources": ("oe_order_lines_all", "", """
        SELECT header_id, bool_or(coalesce(source_type_code, 'INTERNAL') = 'INTERNAL') AS inside,
               bool_or(coalesce(source_type_code, '') = 'EXTERNAL') AS outside
        FROM oe_order_lines_all GROUP BY header_id"""),
    "typed_orders": ("oe_order_headers_all oe_transaction_types_tl", "", """
        SELECT o.*, k.name AS order_type
        FROM oe_order_headers_all o LEFT JOIN oe_transaction_types_tl k ON k.transaction_type_id = o.order_type_id"""),
    "price_names": ("qp_list_headers_tl", "", """
        SELECT list_header_id, min(name) AS pricelist FROM qp_list_headers_tl GROUP BY list_header_id"""),
    "first_delivery": ("wsh_delivery_details oe_order_lines_all oe_order_headers_all", "", """
        SELECT o.order_number, min(d.batch_id) AS no_do
        FROM wsh_delivery_details d
        JOIN oe_order_lines_all l ON l.line_id = d.source_line_id
        JOIN oe_order_headers_all o ON o.header_id = l.header_id
        GROUP BY o.order_number"""),
    "sale_orders": ("fnd_user", "typed_orders order_sources price_names first_delivery", f"""
        SELECT o.*, p.pricelist, f.no_do
        FROM typed_orders o
        JOIN order_sources s ON s.header_id = o.header_id
        LEFT JOIN price_names p ON p.list_header_id = o.price_list_id
        LEFT JOIN first_delivery f ON f.order_number = o.order_number
        WHERE regexp_matches(o.order_type, '{BRANCH}') AND regexp_matches(o.order_type, '{PRODUCT}')
          AND {allowed_order('o.order_type', 's.inside', 's.outside')}
          AND o.created_by IN (SELECT user_id FROM fnd_user)"""),
    "money": ("ra_customer_trx_lines_all", "window_headers", f"""
        SELECT l.*, h.trx_number, {QTY} AS qty, {UNIT} AS unit_price, {QTY} * ({UNIT}) AS amount
        FROM ra_customer_trx_lines_all l JOIN window_headers h ON h.customer_trx_id = l.customer_trx_id"""),
    "invoice_sums": ("", "money", "SELECT customer_trx_id, sum(amount) AS total FROM money GROUP BY customer_trx_id"),
    "adjusted": ("ar_adjustments_all ar_receivables_trx_all", "", f"""
        SELECT a.customer_trx_id, sum(coalesce(a.line_adjusted, 0)) AS total
        FROM ar_receivables_trx_all r JOIN ar_adjustments_all a ON a.receivables_trx_id = r.receivables_trx_id
        WHERE r.name <> '{PREPAYMENT}' GROUP BY a.customer_trx_id"""),
    "returned": ("ra_customer_trx_lines_all ra_customer_trx_all", "", """
        SELECT b.previous_customer_trx_line_id AS line, sum(b.quantity_credited) AS qty,
               string_agg(h.trx_number, ',' ORDER BY h.trx_number) AS numbers
        FROM ra_customer_trx_lines_all b LEFT JOIN ra_customer_trx_all h ON h.customer_trx_id = b.customer_trx_id
        WHERE b.line_type = 'LINE' AND b.previous_customer_trx_line_id IS NOT NULL
        GROUP BY b.previous_customer_trx_line_id"""),
    "facts": (
        "mtl_system_items_b hr_organization_units",
        "sale_headers sale_orders money kind_of_prefix units account_names site_places invoice_sums adjusted returned", f"""
        SELECT DISTINCT
               o.attribute1 AS nama, o.attribute2 AS alamat1, o.attribute3 AS alamat2, o.attribute4 AS kota,
               o.attribute5 AS no_telp, m.line_number, h.trx_date, h.trx_number, h.ct_reference, o.ordered_date,
               h.type_name AS trx_source, o.order_type, i.segment1, m.description, m.qty, m.unit_price AS price_dpp,
               m.amount AS price, t.total AS dpp, coalesce(j.total, 0) AS adjusting, w.code AS organization_code,
               buyer.party_name AS sold_to_customer, buyer.account_number, payer.party_name AS bill_to_customer,
               payer_at.city AS bill_city, taker.party_name AS ship_to_customer,
               CASE WHEN suffix(buyer.party_name, 'Eceran') THEN o.attribute4 ELSE taker_at.city END AS ship_to_city,
               o.shipping_instructions, o.no_do, o.pricelist, h.org_id, b.numbers AS invoice_retur,
               coalesce(b.qty, 0) AS qty_retur, m.tax_classification_code, w.unit_name AS cabang_dari_gudang,
               own.name AS cabang_dari_invoice, own.organization_id AS organization_id_invoice, k.kind
        FROM sale_headers h
        JOIN money m ON m.customer_trx_id = h.customer_trx_id AND m.line_type = 'LINE'
        JOIN sale_orders o ON o.order_number = h.wanted_order AND {passes_gate('o.order_type', 'o.pricelist')}
        JOIN mtl_system_items_b i ON i.inventory_item_id = m.inventory_item_id AND i.organization_id = {MASTER_ORG}
        JOIN kind_of_prefix k ON k.prefix = left(i.segment1, 3)
        JOIN units w ON w.warehouse = m.warehouse_id
        JOIN hr_organization_units own ON own.organization_id = h.org_id
        JOIN account_names buyer ON buyer.account = h.sold_to_customer_id
        JOIN account_names payer ON payer.account = h.bill_to_customer_id AND payer.has_party
        JOIN site_places payer_at ON payer_at.site = h.bill_to_site_use_id AND payer_at.has_place
        LEFT JOIN account_names taker ON taker.account = h.ship_to_customer_id
        LEFT JOIN site_places taker_at ON taker_at.site = h.ship_to_site_use_id
        LEFT JOIN invoice_sums t ON t.customer_trx_id = h.customer_trx_id
        LEFT JOIN adjusted j ON j.customer_trx_id = h.customer_trx_id
        LEFT JOIN returned b ON b.line = m.customer_trx_line_id
        WHERE buyer.party_name NOT IN ({texts(INTERNAL_BUYERS)})
          AND NOT prefix(i.segment1, 'JAD') AND NOT prefix(i.segment1, 'QA2')"""),
    "mart": ("", "facts", f"""
        SELECT coalesce(cabang_dari_invoice, '') AS cabang, organization_id_invoice AS organization_id,
               CAST(year(trx_date) AS INTEGER) AS tahun_invoice, CAST(month(trx_date) AS INTEGER) AS bulan_invoice,
               CAST(day(trx_date) AS INTEGER) AS tanggal_hari_invoice, trx_date AS tgl_invoice,
               coalesce(trx_number, '') AS no_invoice, coalesce(ct_reference, '') AS no_so, ordered_date AS tgl_so,
               coalesce(trx_source, '') AS tipe_invoice, coalesce(order_type, '') AS order_type,
               coalesce(segment1, '') AS kode_barang, coalesce(description, '') AS nama_barang,
               CAST(price AS DOUBLE) AS total_harga,
               CAST({taxed('price', 'tax_classification_code')} AS DOUBLE) AS total_harga_ppn,
               coalesce(pricelist, '') AS pricelist, coalesce(invoice_retur, '') AS invoice_retur, no_do,
               CAST(qty AS DOUBLE) AS qty, CAST(qty_retur AS DOUBLE) AS qty_retur,
               CAST(price_dpp AS DOUBLE) AS harga_dpp_per_unit,
               CAST({taxed('price_dpp', 'tax_classification_code')} AS DOUBLE) AS harga_ppn_per_unit,
               coalesce(organization_code, '') AS warehouse, coalesce(sold_to_customer, '') AS nama_customer,
               coalesce(ship_to_city, '') AS kota_ship_to, coalesce(kind, '') AS tipe_sparepart,
               {CHANNEL.format(order_type='order_type', pricelist='pricelist')} AS tipe_penjualan
        FROM facts"""),
}


def _chain(names: list[str]) -> list[str]:
    """The stages that the named ones stand on, and these, in order."""
    out: list[str] = []

    def add(name: str) -> None:
        for earlier in STAGES[name][1].split():
            add(earlier)
        if name not in out:
            out.append(name)

    for name in names:
        add(name)
    return out


def statement(final: str, stages: str = "", tables: str = "", window: tuple[str, str] = ("", ""),
              runs: dict[str, tuple[str, str]] | None = None, derived: bool = True) -> str:
    """``final`` over the named stages and ERP tables.

    ``window`` is the first and last day of the headers; ``runs`` adds further
    windows, whose stages get the run's name at their end.  With
    ``derived=False`` the ERP tables are there already.
    """
    chain, wanted = _chain(stages.split()), set(tables.split())
    for name in chain:
        wanted |= set(STAGES[name][0].split())
    parts = [duckdb_ctes(sorted(wanted))] if derived and wanted else []
    for end, (lo, hi) in ({"": window} | (runs or {})).items():
        for name in chain:
            text = STAGES[name][2].replace("{days}", days("trx_date", lo, hi))
            if end:
                for other in sorted(chain, key=len, reverse=True):
                    for before in ("FROM ", "JOIN "):
                        text = text.replace(f"{before}{other} ", f"{before}{other}{end} ").replace(
                            f"{before}{other}\n", f"{before}{other}{end}\n")
                    if text.endswith(f"FROM {other}"):
                        text += end
            parts.append(f"{name}{end} AS ({text})")
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


FACT_COLUMNS = (
    "nama alamat1 alamat2 kota no_telp line_number trx_date trx_number ct_reference ordered_date trx_source order_type "
    "segment1 description qty price_dpp price dpp adjusting organization_code sold_to_customer account_number "
    "bill_to_customer bill_city ship_to_customer ship_to_city shipping_instructions no_do pricelist org_id invoice_retur "
    "qty_retur tax_classification_code cabang_dari_gudang cabang_dari_invoice organization_id_invoice"
).split()
MONEY_COLUMNS = {"qty", "price_dpp", "price", "dpp", "adjusting", "qty_retur"}


def statements(lo: str, hi: str, lo_before: str, hi_before: str, protected_year: int) -> dict[str, str]:
    """The statements of the keys that read ERP tables, for the window lo to hi.

    The refresh runs first for the window before.
    """
    def over(final: str, stages: str = "", tables: str = "", **more) -> str:
        return statement(final, stages, tables, (lo, hi), **more)

    facts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in MONEY_COLUMNS else c for c in FACT_COLUMNS)
    line = "FROM money WHERE line_type = 'LINE'"
    # what a name is without its three letters and the unit mark; nothing left is null
    clean = "nullif(trim(replace(substring(name, 4), '(OU)', '')), '')"
    return {
        "sales_mart": over("SELECT * FROM mart", "mart"),
        "ordered_report": over("SELECT * FROM mart", "mart"),
        "distinct_rows": over(f"SELECT {facts} FROM facts", "facts"),
        "mart_refresh": over(
            f"""SELECT * FROM mart_before
WHERE tgl_invoice IS NULL OR tgl_invoice < TIMESTAMP '{lo} 00:00:00' OR coalesce(tahun_invoice = {protected_year}, TRUE)
UNION ALL SELECT * FROM mart""", "mart", runs={"_before": (lo_before, hi_before)}),
        "code_list_explode": over("""
SELECT CAST(k.ordinal AS INTEGER) AS ordinal, k.prefix AS item_code, k.kind AS sp_type, count(i.segment1) AS n_items
FROM kind_of_prefix k LEFT JOIN mtl_system_items_b i ON left(i.segment1, 3) = k.prefix
GROUP BY ALL""", "kind_of_prefix", "mtl_system_items_b"),
        "category_lookup": over("""
SELECT i.inventory_item_id, i.segment1, k.prefix AS item_code, k.kind AS sp_type
FROM kind_of_prefix k JOIN mtl_system_items_b i ON left(i.segment1, 3) = k.prefix""", "kind_of_prefix", "mtl_system_items_b"),
        "filter_in_list": over(f"""
SELECT h.customer_trx_id, t.name AS trx_source
FROM ra_cust_trx_types_all t JOIN ra_customer_trx_all h ON h.cust_trx_type_id = t.cust_trx_type_id
WHERE t.name IN ({texts(SALE_TYPES)})""", "", "ra_customer_trx_all ra_cust_trx_types_all"),
        "filter_not_in_list": over(f"""
SELECT party_id, party_name FROM hz_parties
WHERE NOT suffix(party_name, 'Eceran') AND party_name NOT IN ({texts(INTERNAL_BUYERS)})""", "", "hz_parties"),
        "filter_like_any": over(f"""
SELECT header_id, order_type FROM typed_orders
WHERE regexp_matches(order_type, '{BRANCH}') AND regexp_matches(order_type, '{PRODUCT}')""", "typed_orders"),
        "filter_not_like": over("""
SELECT * FROM mtl_system_items_b WHERE left(segment1, 3) NOT IN ('JAD', 'QA2')""", "", "mtl_system_items_b"),
        "filter_equality": over("""
SELECT customer_trx_line_id, customer_trx_id, line_type FROM ra_customer_trx_lines_all WHERE line_type IN ('LINE')""",
                                "", "ra_customer_trx_lines_all"),
        "returns_gate": over(f"""
SELECT header_id, order_type, pricelist FROM ({_PRICED}) WHERE {passes_gate('order_type', 'pricelist')}""",
                             "typed_orders price_names"),
        "sales_channel": over(f"""
SELECT header_id, {CHANNEL.format(order_type='order_type', pricelist='pricelist')} AS tipe_penjualan FROM ({_PRICED})""",
                              "typed_orders price_names"),
        "filter_trailing_window": over("SELECT customer_trx_id, trx_date FROM window_headers", "window_headers"),
        "date_parts": over("""
SELECT customer_trx_id, CAST(date_trunc('day', trx_date) AS DATE) AS trx_day, CAST(year(trx_date) AS INTEGER) AS tahun,
       CAST(month(trx_date) AS INTEGER) AS bulan, CAST(day(trx_date) AS INTEGER) AS hari FROM ra_customer_trx_all""",
                           "", "ra_customer_trx_all"),
        "join_inner_star": over("""
SELECT l.customer_trx_line_id, customer_trx_id, h.trx_number, t.name AS trx_source, u.name AS org_name
FROM hr_organization_units u JOIN ra_customer_trx_all h ON h.org_id = u.organization_id
JOIN ra_cust_trx_types_all t USING (cust_trx_type_id) JOIN ra_customer_trx_lines_all l USING (customer_trx_id)""",
                                "", "ra_customer_trx_lines_all ra_customer_trx_all ra_cust_trx_types_all hr_organization_units"),
        "join_left_on_constant": over(f"""
SELECT l.customer_trx_line_id, l.inventory_item_id, i.segment1
FROM ra_customer_trx_lines_all l
LEFT JOIN (SELECT * FROM mtl_system_items_b WHERE organization_id = {MASTER_ORG}) i USING (inventory_item_id)""",
                                      "", "ra_customer_trx_lines_all mtl_system_items_b"),
        "join_left_chain": over("""
SELECT h.customer_trx_id, s.city AS ship_city, a.party_name AS ship_party
FROM ra_customer_trx_all h LEFT JOIN site_places s ON s.site = h.ship_to_site_use_id
LEFT JOIN account_names a ON a.account = h.ship_to_customer_id""", "site_places account_names", "ra_customer_trx_all"),
        "join_role_playing": over("""
SELECT h.customer_trx_id,
       (SELECT party_name FROM account_names WHERE account = h.sold_to_customer_id) AS sold_to,
       (SELECT party_name FROM account_names WHERE account = h.bill_to_customer_id) AS bill_to,
       (SELECT party_name FROM account_names WHERE account = h.ship_to_customer_id) AS ship_to
FROM ra_customer_trx_all h""", "account_names", "ra_customer_trx_all"),
        "join_coerced_key": over(f"""
SELECT h.customer_trx_id, h.ct_reference, o.header_id
FROM oe_order_headers_all o JOIN ra_customer_trx_all h ON TRY_CAST(h.ct_reference AS DECIMAL(38,10)) = o.order_number""",
                                 "", "ra_customer_trx_all oe_order_headers_all"),
        "semi_join_theta": over(f"""
SELECT o.header_id, o.order_type FROM typed_orders o JOIN order_sources s USING (header_id)
WHERE {allowed_order('o.order_type', 's.inside', 's.outside')} AND o.created_by IN (SELECT user_id FROM fnd_user)""",
                                "typed_orders order_sources", "fnd_user"),
        "invoice_total": over("""
SELECT h.customer_trx_id, CAST(s.total AS DOUBLE) AS dpp FROM window_headers h LEFT JOIN invoice_sums s USING (customer_trx_id)""",
                              "invoice_sums"),
        "adjustment_sum": over("""
SELECT h.customer_trx_id, CAST(coalesce(a.total, 0) AS DOUBLE) AS adjusting
FROM window_headers h LEFT JOIN adjusted a USING (customer_trx_id)""", "window_headers adjusted"),
        "min_delivery_lookup": over("""
SELECT o.header_id, o.order_number, f.no_do FROM oe_order_headers_all o LEFT JOIN first_delivery f USING (order_number)""",
                                    "first_delivery"),
        "scalar_lookup": over("""
SELECT o.header_id, o.price_list_id, p.pricelist
FROM oe_order_headers_all o LEFT JOIN price_names p ON p.list_header_id = o.price_list_id""",
                              "price_names", "oe_order_headers_all"),
        "return_origin_type": over(f"""
SELECT w.customer_trx_id, w.trx_number, x.ot_return
FROM window_headers w LEFT JOIN (
  SELECT credit.trx_number, min(o.order_type) AS ot_return
  FROM typed_orders o
  JOIN (SELECT customer_trx_id, {order_number('ct_reference')} AS number FROM ra_customer_trx_all) origin
    ON origin.number = o.order_number
  JOIN ra_customer_trx_all credit ON credit.previous_customer_trx_id = origin.customer_trx_id
  WHERE o.order_type IS NOT NULL
  GROUP BY credit.trx_number HAVING count(DISTINCT o.order_type) = 1) x ON x.trx_number = w.trx_number""",
                                   "window_headers typed_orders"),
        "returns_qty": over("""
SELECT m.customer_trx_line_id, CAST(coalesce(r.qty, 0) AS DOUBLE) AS qty_retur
FROM money m LEFT JOIN returned r ON r.line = m.customer_trx_line_id WHERE m.line_type = 'LINE'""", "money returned"),
        "returns_invoice_list": over("""
SELECT m.customer_trx_line_id, r.numbers AS invoice_retur
FROM money m LEFT JOIN returned r ON r.line = m.customer_trx_line_id WHERE m.line_type = 'LINE'""", "money returned"),
        "branch_label": over(f"""
SELECT h.customer_trx_id,
       CASE WHEN suffix(o.order_type, 'LN') THEN 'Ekspor' ELSE u.label END AS cabang,
       CASE right(o.order_type, 2) WHEN 'LN' THEN 'Ekspor' WHEN 'DN' THEN u.label END AS cabang_dn
FROM window_headers h
LEFT JOIN typed_orders o ON o.order_number = {order_number('h.ct_reference')}
LEFT JOIN (SELECT organization_id, {clean} AS label FROM hr_all_organization_units) u ON u.organization_id = h.org_id""",
                             "window_headers typed_orders", "hr_all_organization_units"),
        "branch_code": over("""
SELECT header_id, order_type, CASE right(order_type, 2) WHEN 'LN' THEN 'HO'
       WHEN 'DN' THEN list_filter(string_split(order_type, '-'), lambda x: x <> '')[1] END AS kode_cabang
FROM typed_orders""", "typed_orders"),
        "city_override": over(f"""
SELECT h.customer_trx_id, CASE WHEN suffix(a.party_name, 'Eceran') THEN o.attribute4 ELSE s.city END AS ship_to_city
FROM window_headers h
LEFT JOIN account_names a ON a.account = h.sold_to_customer_id
LEFT JOIN site_places s ON s.site = h.ship_to_site_use_id
LEFT JOIN oe_order_headers_all o ON o.order_number = {order_number('h.ct_reference')}""",
                              "window_headers account_names site_places", "oe_order_headers_all"),
        "line_amounts": over(f"""
SELECT customer_trx_line_id, CAST(qty AS DOUBLE) AS qty, CAST(unit_price AS DOUBLE) AS price_dpp, CAST(amount AS DOUBLE) AS price
{line}""", "money"),
        "tax_gross_up": over(f"""
SELECT customer_trx_line_id, tax_classification_code,
       CAST({taxed('amount', 'tax_classification_code')} AS DOUBLE) AS total_harga_ppn,
       CAST({taxed('unit_price', 'tax_classification_code')} AS DOUBLE) AS harga_ppn_per_unit {line}""", "money"),
        "window_invoices": over("SELECT customer_trx_id, trx_number, type_name AS trx_source FROM sale_headers", "sale_headers"),
        "warehouse_chain": over("SELECT warehouse AS warehouse_id, code AS organization_code, unit_name AS cabang_dari_gudang FROM units",
                                "units"),
        "orders_in_scope": over("""
SELECT order_number, order_type, pricelist, no_do FROM sale_orders
WHERE order_number IN (SELECT wanted_order FROM sale_headers)""", "sale_orders sale_headers"),
        "lines_by_month": over("""
SELECT customer_trx_line_id, customer_trx_id, line_type, CAST(unit_selling_price AS DOUBLE) AS unit_selling_price FROM money""",
                               "money"),
        "batched_insert": over("""
SELECT customer_trx_line_id, line_type, CAST(quantity_invoiced AS DOUBLE) AS quantity_invoiced,
       CAST(unit_selling_price AS DOUBLE) AS unit_selling_price FROM ra_customer_trx_lines_all""", "", "ra_customer_trx_lines_all"),
        "rejected_references": over("""
SELECT customer_trx_id, trx_number, trx_date, ct_reference,
       CASE WHEN TRY_CAST(ct_reference AS DECIMAL(38,10)) IS NULL
              AND abs(TRY_CAST(ct_reference AS DOUBLE)) BETWEEN 1 AND 1e308 THEN 'too large'
            WHEN TRY_CAST(ct_reference AS DECIMAL(38,10)) IS NULL THEN 'no number'
            WHEN TRY_CAST(ct_reference AS DECIMAL(38,10)) % 1 <> 0 THEN 'no whole number' ELSE 'too large' END AS reason
FROM sale_headers WHERE ct_reference IS NOT NULL AND wanted_order IS NULL""", "sale_headers"),
        "ingest_exact": over(f"""
SELECT kind, CAST(l_orderkey * 100 + l_linenumber AS BIGINT) AS line_id, CAST(qty AS DOUBLE) AS qty, CAST(price AS DOUBLE) AS price,
       CAST(CAST(qty AS DECIMAL(12,4)) * (CAST(price AS DECIMAL(20,10)) * CAST(1 AS DECIMAL(15,6))) AS DOUBLE) AS amount
FROM ({EXACT_SOURCE})"""),
    }


_PRICED = """SELECT o.header_id, CASE WHEN o.order_type_id <> 5 THEN o.order_type END AS order_type, p.pricelist
  FROM typed_orders o LEFT JOIN price_names p ON p.list_header_id = o.price_list_id"""

#: Amounts with more decimals than two and six: eighths, sixteenths, and prices that end in the tenth decimal.
EXACT_SOURCE = """SELECT kind, l_orderkey, l_linenumber, CAST(l_quantity / 8 AS DECIMAL(38,10)) AS qty,
         CASE kind WHEN 'double' THEN CAST(l_extendedprice AS DECIMAL(38,10))
                   WHEN 'float' THEN CAST(l_linenumber / 16.0 AS DECIMAL(38,10))
                   ELSE CAST(l_extendedprice AS DECIMAL(38,10)) + CAST(0.0000000001 AS DECIMAL(38,10)) * l_linenumber END AS price
  FROM lineitem, (VALUES ('decimal'), ('double'), ('float'), ('text')) k(kind)"""


def mart_on_erp(lo: str, hi: str) -> str:
    """The mart where the ERP tables themselves are there (fixtures, landed tables)."""
    return statement("SELECT * FROM mart", "mart", "", (lo, hi), derived=False)
