"""Plans: the mart, its contract, export and publishing."""

from .catalog import default_schema, replace_table
from .contract import (ContractError, apply_contract, check_columns, check_contract, column_relation, column_report,
                       contract_violations, fill_strings, lower_columns, normalise_mart, rename_columns, to_timestamps)
from .export import export_delimited, read_delimited
from .jobs import copy_transactions, copy_transactions_jdbc, refresh_sales_mart
from .mart import mart_rows, ordered_report, sales_mart, sales_mart_display
from .spine import Spine, window_invoices, window_spine
from .refresh import History, PublishError, RefreshReport, survivors

__all__ = [
    "ContractError", "check_contract", "column_relation", "contract_violations", "default_schema", "replace_table", "History", "Spine", "window_invoices", "window_spine", "PublishError", "RefreshReport", "apply_contract",
    "check_columns", "column_report", "copy_transactions", "copy_transactions_jdbc", "export_delimited", "fill_strings", "lower_columns",
    "mart_rows", "normalise_mart", "ordered_report", "read_delimited", "refresh_sales_mart",
    "rename_columns",
    "sales_mart", "sales_mart_display", "survivors", "to_timestamps",
]
