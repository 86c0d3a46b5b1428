"""Exact decimal line arithmetic and the tax gross-up.

The types are chosen so that products fit: price (10 decimals) x rate (6) is
exact, and an amount keeps 17 decimals, so it is exact unless quantity, price
and rate together use more than 17. (``decimal(38,x) * decimal(38,y)`` would
silently become ``decimal(38,6)``.) Inputs come in these types from
:mod:`salesmart.sources.tables`, which raises where one would be rounded; a
product that is too large raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .oracle import ColumnOrName, _c

QTY_TYPE = "decimal(12,4)"         # quantity, up to 10^8 units
PRICE_TYPE = "decimal(20,10)"
RATE_TYPE = "decimal(15,6)"
UNIT_PRICE_TYPE = "decimal(28,16)"  # unit price x rate, exact, up to 10^12
AMOUNT_TYPE = "decimal(38,17)"      # qty x unit price
FACTOR_TYPE = "decimal(3,2)"


def line_qty(invoiced: ColumnOrName, credited: ColumnOrName) -> Column:
    """``NVL(quantity_invoiced, quantity_credited)``."""
    return F.coalesce(_c(invoiced), _c(credited)).cast(QTY_TYPE)


def unit_price(selling_price: ColumnOrName, rate: ColumnOrName) -> Column:
    """``unit_selling_price * NVL(exchange_rate, 1)``."""
    one = F.lit(1).cast(RATE_TYPE)
    return (_c(selling_price).cast(PRICE_TYPE)
            * F.coalesce(_c(rate).cast(RATE_TYPE), one)).cast(UNIT_PRICE_TYPE)


def line_amount(qty: ColumnOrName, price: ColumnOrName) -> Column:
    """``qty * unit price``."""
    return (_c(qty).cast(QTY_TYPE) * _c(price).cast(UNIT_PRICE_TYPE)).cast(AMOUNT_TYPE)


def tax_factor(tax_code: ColumnOrName, rules=(("%10%", "1.10"), ("%11%", "1.11")),
               default: str = "1.10") -> Column:
    """Gross-up factor: first LIKE rule that matches, else the default (also for null)."""
    code = _c(tax_code)
    expr = None
    for pattern, factor in rules:
        lit = F.lit(factor).cast(FACTOR_TYPE)
        expr = F.when(code.like(pattern), lit) if expr is None else expr.when(code.like(pattern), lit)
    dflt = F.lit(default).cast(FACTOR_TYPE)
    return dflt if expr is None else expr.otherwise(dflt)


def gross_up(amount: ColumnOrName, tax_code: ColumnOrName, rules=(("%10%", "1.10"), ("%11%", "1.11")),
             default: str = "1.10") -> Column:
    """``amount * 110/100`` or ``* 111/100`` by tax code; exact decimal."""
    return _c(amount) * tax_factor(tax_code, rules, default)
