"""Sources and sinks: ERP tables from parquet or JDBC, driver-table views."""

from .batched import LoadError, batched_insert, read_table
from .driver import DRIVER_AS_OF, driver_erp, driver_frames, duckdb_ctes
from .jdbc import (ORACLE_SNAPSHOT, Snapshot, current_state, jdbc_tables, partition_bounds,
                   range_predicates, read_jdbc, read_partitioned, read_with_total, split_points, write_jdbc)
from .tables import (ERP_SCHEMAS, ErpTables, catalog_tables, frames, land_bucketed,
                     land_lines_by_month, narrow, parquet_tables, with_monthly_lines)

__all__ = [
    "DRIVER_AS_OF", "ERP_SCHEMAS", "LoadError", "batched_insert", "read_table", "ORACLE_SNAPSHOT", "ErpTables", "Snapshot", "current_state", "range_predicates",
    "read_partitioned", "read_with_total", "split_points", "catalog_tables", "land_bucketed", "land_lines_by_month", "with_monthly_lines", "driver_erp", "driver_frames", "duckdb_ctes",
    "frames", "jdbc_tables", "narrow", "parquet_tables", "partition_bounds", "read_jdbc",
    "write_jdbc",
]
