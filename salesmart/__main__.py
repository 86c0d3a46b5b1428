"""Command line for the two daily jobs (what a scheduler calls).

    python -m salesmart mart-refresh --erp-parquet ROOT --history DIR [--as-of YYYY-MM-DD]
    python -m salesmart mart-refresh --jdbc-url URL [--jdbc-schema S] --history DIR
        --jdbc-partition TABLE:COLUMN:N ... --jdbc-single TABLE ...
    python -m salesmart copy-transactions --source-parquet PATH --history DIR
    python -m salesmart copy-transactions --jdbc-url URL --source-table T --history DIR
        --jdbc-partition T:COLUMN:N | --jdbc-single T

Over JDBC every table is either split into N range queries on a numeric column,
or named as one that a single connection shall read. ``TABLE:COLUMN:quantiles:N``
takes split points with equally many rows between them instead of equal widths.
``--jdbc-snapshot now`` (or a system change number) ties all queries of the load,
the control total included, to one state of the database. Connection properties (user, password, driver) come from ``--jdbc-prop k=v``;
the session comes from ``spark-submit``/the cluster (a local one otherwise).
Prints the load report as one JSON line.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession


def _props(items: list[str]) -> dict[str, str]:
    return dict(i.split("=", 1) for i in items or [])


def _splits(items: list[str]) -> dict[str, tuple]:
    """``TABLE:COLUMN:N`` items as (column, n), and ``TABLE:COLUMN:quantiles:N`` as (column, "quantiles", n), by table."""
    out = {}
    for item in items:
        table, *how, n = item.split(":")
        out[table] = (*how, int(n))
    return out


def _snapshot(value: str | None) -> dict:
    if value is None:
        return {}
    from .sources import ORACLE_SNAPSHOT

    return {"snapshot": ORACLE_SNAPSHOT, "at": None if value == "now" else value}


def _check_named(parser: argparse.ArgumentParser, tables, splits: dict, single: list[str]) -> None:
    missing = sorted(set(tables) - set(splits) - set(single))
    if missing:
        parser.error(f"give --jdbc-partition or --jdbc-single for: {', '.join(missing)}")


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName("salesmart")
    try:  # under spark-submit the master is already set
        return builder.getOrCreate()
    except Exception:  # noqa: BLE001
        return builder.master("local[*]").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="salesmart")
    sub = p.add_subparsers(dest="cmd", required=True)

    a = sub.add_parser("mart-refresh", help="extract the trailing window and replace it in the history")
    a.add_argument("--erp-parquet", help="root with one parquet directory per ERP table")
    a.add_argument("--jdbc-url")
    a.add_argument("--jdbc-schema")
    a.add_argument("--jdbc-prop", action="append", default=[])
    a.add_argument("--jdbc-partition", action="append", default=[], metavar="TABLE:COLUMN:N")
    a.add_argument("--jdbc-single", action="append", default=[], metavar="TABLE")
    a.add_argument("--jdbc-snapshot", metavar="now|SCN", help="read one state of the database")
    a.add_argument("--history", required=True, help="root of the published mart history")
    a.add_argument("--existing", action="store_true", help="fail where no history was published yet")
    a.add_argument("--as-of", default=dt.date.today().isoformat(), help="the run's 'today' (default: today)")

    b = sub.add_parser("copy-transactions", help="typed full copy of the transactions view")
    b.add_argument("--source-parquet")
    b.add_argument("--jdbc-url")
    b.add_argument("--source-table")
    b.add_argument("--jdbc-prop", action="append", default=[])
    b.add_argument("--jdbc-partition", action="append", default=[], metavar="TABLE:COLUMN:N")
    b.add_argument("--jdbc-single", action="append", default=[], metavar="TABLE")
    b.add_argument("--jdbc-snapshot", metavar="now|SCN", help="read one state of the database")
    b.add_argument("--history", required=True, help="root of the published copy")

    args = p.parse_args(argv)
    spark = _session()
    from .plans import copy_transactions, refresh_sales_mart
    from .sources import jdbc_tables, parquet_tables, read_with_total
    from .sources.tables import ERP_SCHEMAS

    if args.cmd == "mart-refresh":
        if bool(args.erp_parquet) == bool(args.jdbc_url):
            p.error("give exactly one of --erp-parquet / --jdbc-url")
        if args.erp_parquet:
            erp = parquet_tables(spark, args.erp_parquet)
        else:
            splits = _splits(args.jdbc_partition)
            _check_named(p, ERP_SCHEMAS, splits, args.jdbc_single)
            erp = jdbc_tables(spark, args.jdbc_url, schema=args.jdbc_schema, properties=_props(args.jdbc_prop),
                              partitioning=splits, **_snapshot(args.jdbc_snapshot))
        report = refresh_sales_mart(spark, erp, args.history, args.as_of, create=not args.existing)
    else:
        if args.source_parquet:
            src, total = spark.read.parquet(args.source_parquet), None
        elif args.jdbc_url and args.source_table:
            props, splits = _props(args.jdbc_prop), _splits(args.jdbc_partition)
            _check_named(p, [args.source_table], splits, args.jdbc_single)
            src, total = read_with_total(spark, args.jdbc_url, args.source_table, splits.get(args.source_table),
                                         properties=props, **_snapshot(args.jdbc_snapshot))
        else:
            p.error("give --source-parquet or --jdbc-url with --source-table")
        report = copy_transactions(src, args.history, control_total=total)
    print(json.dumps(dataclasses.asdict(report)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
