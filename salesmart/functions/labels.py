"""Classification expressions: branch, channel, ship-to city, returns gate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules as R
from .oracle import ColumnOrName, _c, clean_org_name, first_token, like_any, sql_string, upper_like


def branch_code(order_type: ColumnOrName) -> Column:
    """``%LN`` → HO, ``%DN`` → first dash token of the order type, else null."""
    ot = _c(order_type)
    return (F.when(ot.like(R.EXPORT_ORDER_PATTERN), F.lit(R.EXPORT_BRANCH_CODE))
            .when(ot.like(R.DOMESTIC_ORDER_PATTERN), first_token(ot, "-")))


def org_label(org_name: ColumnOrName) -> Column:
    """Operating-unit name without its three-letter prefix and ``(OU)`` suffix."""
    return clean_org_name(org_name, R.ORG_NAME_START, R.ORG_NAME_SUFFIX)


def branch_label(order_type: ColumnOrName, org_name: ColumnOrName, *, domestic_only: bool) -> Column:
    """Branch name of an invoice.

    ``domestic_only=False``: ``%LN`` → Ekspor, else the cleaned org name.
    ``domestic_only=True``: ``%LN`` → Ekspor, ``%DN`` → cleaned org name, else null.
    """
    ot = _c(order_type)
    out = F.when(ot.like(R.EXPORT_ORDER_PATTERN), F.lit(R.EXPORT_BRANCH_LABEL))
    if domestic_only:
        return out.when(ot.like(R.DOMESTIC_ORDER_PATTERN), org_label(org_name))
    return out.otherwise(org_label(org_name))


def sales_channel(order_type: ColumnOrName, pricelist: ColumnOrName, rules=R.CHANNEL_RULES,
                  default: str = R.CHANNEL_DEFAULT) -> Column:
    """TOKOQUICK by order type, QUICK TRUCK by price list, else UMUM."""
    cols = {"order_type": _c(order_type), "pricelist": _c(pricelist)}
    expr = None
    for which, pattern, label in rules:
        cond = upper_like(cols[which], pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def ship_to_city(customer_name: ColumnOrName, order_city: ColumnOrName,
                 location_city: ColumnOrName, retail_pattern: str = R.RETAIL_CUSTOMER_PATTERN) -> Column:
    """Retail customers (name ending ``Eceran``) take the city typed on the order."""
    return (F.when(_c(customer_name).like(retail_pattern), _c(order_city))
            .otherwise(_c(location_city)))


def returns_gate(order_type: ColumnOrName, pricelist: ColumnOrName,
                 order_pattern: str = R.RETURN_ORDER_PATTERN,
                 pricelist_patterns=R.RETURN_PRICELIST_PATTERNS) -> Column:
    """``CASE WHEN return AND price list matches THEN 1 WHEN not return THEN 1 ELSE 0 END = 1``.

    A return order needs a matching price list; other orders pass; a null
    order type fails. Catalyst folds the CASE into a boolean.
    """
    ot_up = F.upper(_c(order_type))
    pl_up = F.upper(_c(pricelist))
    flag = (F.when(ot_up.like(order_pattern) & like_any(pl_up, pricelist_patterns), F.lit(1))
            .when(~ot_up.like(order_pattern), F.lit(1))
            .otherwise(F.lit(0)))
    return flag == 1


def category_case(code: ColumnOrName, category_rules=R.ITEM_CATEGORY_RULES) -> Column:
    """Searched CASE over the category rules; null when nothing matches."""
    if isinstance(code, str):  # one SQL expression, one round trip
        branches = " ".join(
            f"WHEN `{code}` IN ({', '.join(sql_string(x) for x in codes)}) THEN {sql_string(cat)}"
            for cat, codes in category_rules)
        return F.expr(f"CASE {branches} END")
    c = _c(code)
    expr = None
    for category, codes in category_rules:
        cond = c.isin(list(codes)) if len(codes) > 1 else (c == codes[0])
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr
