"""Scalar column expressions (all built-in Spark functions, no UDFs)."""

from .labels import (branch_code, branch_label, category_case, org_label, returns_gate,
                     sales_channel, ship_to_city)
from .oracle import (add_months_date, add_months_oracle, clean_org_name, empty_as_null, exact_cast,
                     exact_cast_sql, first_token, in_trailing_window, is_true, keeps_digits_sql,
                     like_any, not_like_all, nvl,
                     order_reference, substr_from,
                     trailing_window_bounds, trunc_day, upper_like,
                     window_start)
from .pricing import gross_up, line_amount, line_qty, tax_factor, unit_price

__all__ = [
    "add_months_date", "add_months_oracle", "branch_code", "branch_label", "category_case", "clean_org_name",
    "empty_as_null", "exact_cast", "exact_cast_sql", "first_token", "gross_up", "in_trailing_window", "is_true", "keeps_digits_sql", "like_any",
    "line_amount", "line_qty", "not_like_all", "nvl", "order_reference", "org_label", "returns_gate",
    "sales_channel", "ship_to_city", "substr_from", "tax_factor", "trailing_window_bounds",
    "trunc_day", "unit_price", "upper_like", "window_start",
]
