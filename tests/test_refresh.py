"""Publishing: trailing-window replace and full replace (S7, S9, S10, S12, S14, T9-T13, T21)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from salesmart.plans import History, PublishError
from salesmart.plans.refresh import day_start
from tests.conftest import rows

SCHEMA = "k long, tgl_invoice timestamp_ntz, tahun_invoice int, src string"


def hist_rows(spark, data):
    return spark.createDataFrame(
        [(k, ts, ts.year if ts else yr, src) for k, ts, yr, src in data], SCHEMA)


def base(spark):
    d = dt.datetime
    return hist_rows(spark, [
        (1, d(2000, 5, 10), None, "old"),           # before the cutoff month
        (2, d(2000, 8, 1, 0, 0), None, "old"),      # exactly at the cutoff
        (3, d(2000, 7, 31, 23), None, "old"),       # day before, same... previous month
        (4, d(2000, 8, 15), None, "old"),           # inside the window, cutoff month
        (5, d(2001, 3, 1), None, "old"),            # inside the window
        (6, d(2002, 1, 1), None, "old"),            # future-dated
        (7, d(9999, 12, 31), None, "old"),          # protected year, inside the delete range
        (8, None, None, "old"),                     # null date (null year)
        (9, d(2000, 8, 1, 12, 0), None, "old"),     # cutoff day, afternoon
    ]).withColumn("tahun_invoice", F.when(F.col("k") == 5, F.lit(None)).otherwise(F.col("tahun_invoice")))


def fresh(spark):
    d = dt.datetime
    return hist_rows(spark, [(20, d(2000, 8, 1), None, "new"), (21, d(2001, 7, 31), None, "new"),
                             (22, d(2000, 8, 20), None, "new")])


CUT = dt.datetime(2000, 8, 1)


def test_window_replace_semantics(spark, tmp_path):
    h = History(spark, str(tmp_path / "h"))
    r0 = h.window_replace(base(spark), dt.datetime(1900, 1, 1))
    assert r0.version == 1 and r0.rows_written == 9
    r1 = h.window_replace(fresh(spark), CUT)
    got = rows(h.read(), "k", "src")
    # deleted: 2 (at cutoff), 4, 6 (future: T11), 9; kept: 1, 3 (older), 5 (null year: T9),
    # 7 (protected: T12), 8 (null date: T9)
    assert [k for k, _ in got] == [1, 3, 5, 7, 8, 20, 21, 22]
    assert (r1.rows_deleted, r1.rows_fresh) == (4, 3)
    assert r1.rows_before - r1.rows_deleted + r1.rows_fresh == r1.rows_written  # T21 identity
    # months before the cutoff month are reused untouched, not rewritten
    assert any("month=2000-05" in p and "run=0000000001" in p for p in r1.paths)
    assert all("run=0000000002" in p for p in r1.paths if not any(m in p for m in ("month=2000-05", "month=2000-07", "month=none")))


def test_refresh_is_idempotent(spark, tmp_path):
    h = History(spark, str(tmp_path / "h"))
    h.window_replace(base(spark), dt.datetime(1900, 1, 1))
    h.window_replace(fresh(spark), CUT)
    once = rows(h.read())
    h.window_replace(fresh(spark), CUT)
    assert rows(h.read()) == once


def test_emptied_month_is_not_listed(spark, tmp_path):
    h = History(spark, str(tmp_path / "h"))
    h.window_replace(base(spark), dt.datetime(1900, 1, 1))
    r = h.window_replace(fresh(spark).filter(F.lit(False)), CUT)
    assert not any("month=2002-01" in p for p in r.paths)  # the future row's month vanished
    assert rows(h.read(), "k") == [(1,), (3,), (5,), (7,), (8,)]


def test_instant_cutoff_duplicates_boundary_day(spark, tmp_path):  # T10
    d = dt.datetime
    h = History(spark, str(tmp_path / "h"))
    day = hist_rows(spark, [(1, d(2000, 8, 1, 0, 0), None, "x")])
    h.window_replace(day, dt.datetime(1900, 1, 1))
    # the source deletes from "now - 12 months" (an instant) but extracts whole days
    h.window_replace(day, d(2000, 8, 1, 15, 43))
    assert h.read().count() == 2
    h2 = History(spark, str(tmp_path / "h2"))
    h2.window_replace(day, dt.datetime(1900, 1, 1))
    h2.window_replace(day, day_start(d(2000, 8, 1, 15, 43)))
    assert h2.read().count() == 1


def test_failed_load_leaves_previous_version(spark, tmp_path):  # T13, S12
    h = History(spark, str(tmp_path / "h"))
    h.window_replace(base(spark), dt.datetime(1900, 1, 1))
    before = rows(h.read())
    broken = fresh(spark).withColumn("src", F.when(F.col("k") == 21, F.raise_error(F.lit("boom")))
                                     .otherwise(F.col("src")))
    with pytest.raises(Exception, match="boom"):
        h.window_replace(broken, CUT)
    assert h.version() == 1
    assert rows(h.read()) == before


def test_fresh_rows_before_cutoff_month_are_rejected(spark, tmp_path):
    h = History(spark, str(tmp_path / "h"))
    h.window_replace(base(spark), dt.datetime(1900, 1, 1))
    early = hist_rows(spark, [(30, dt.datetime(1999, 1, 1), None, "new")])
    with pytest.raises(PublishError):
        h.window_replace(early, CUT)
    assert h.version() == 1


def test_full_replace(spark, tmp_path):  # S7, S8, S14
    h = History(spark, str(tmp_path / "full"), date_col=None)
    df = spark.range(25000).withColumn("v", F.col("id") * 2)
    r1 = h.full_replace(df)
    r2 = h.full_replace(df.filter("id < 10"))
    assert (r1.rows_written, r2.rows_written) == (25000, 10)
    assert h.read().count() == 10  # replaced, not appended
    assert h.version() == 2
    assert os.path.isdir(str(tmp_path / "full" / "runs" / "run=0000000001"))  # old run kept


def _transactions(spark, n):
    from salesmart import rules as R
    cols = []
    for c, t in R.TRANSACTIONS_DDL:
        if t == "DATE":
            cols.append(F.lit("2001-01-01").cast("date").alias(c))
        elif t.startswith("VARCHAR"):
            cols.append(F.concat(F.lit(c[:3]), F.col("id").cast("string")).alias(c))
        else:
            cols.append(F.col("id").alias(c))
    return spark.range(n).select(*cols)


def test_copy_transactions_reconciles(spark, tmp_path):  # job B, S3, T21
    from salesmart.plans import copy_transactions
    src = _transactions(spark, 1234)
    r = copy_transactions(src, str(tmp_path / "tx"))
    assert r.rows_written == 1234
    h = History(spark, str(tmp_path / "tx"), date_col=None)
    assert dict(h.read().dtypes)["INVOICE_NUMBER"] == "string"
    assert dict(h.read().dtypes)["REQUEST_ID"] == "decimal(38,10)"
    with pytest.raises(PublishError, match="control total"):
        copy_transactions(src, str(tmp_path / "tx"), control_total=1000)
    assert h.version() == 1 and h.read().count() == 1234  # the failed copy published nothing


def test_rerun_after_crash_during_publish(spark, tmp_path):  # executors/driver lost mid-publish
    h = History(spark, str(tmp_path / "h"))
    h.window_replace(base(spark), dt.datetime(1900, 1, 1))
    # leftover of a run that died while committing version 2: no data file, only _temporary
    os.makedirs(str(tmp_path / "h" / "_versions" / "v=0000000002" / "_temporary" / "0"))
    os.makedirs(str(tmp_path / "h" / "runs" / "run=0000000002" / "_temporary" / "0"))
    assert h.version() == 1
    r = h.window_replace(fresh(spark), CUT)
    assert r.version == 2 and h.version() == 2
    assert [k for k, in rows(h.read(), "k")] == [1, 3, 5, 7, 8, 20, 21, 22]


def test_vacuum_lists_only_unreferenced_month_dirs(spark, tmp_path):  # storage stays bounded
    h = History(spark, str(tmp_path / "h"))
    h.window_replace(base(spark), dt.datetime(1900, 1, 1))    # v1: every month
    h.window_replace(fresh(spark), CUT)                       # v2: months >= 2000-08 rewritten
    h.window_replace(fresh(spark), CUT)                       # v3: the same months again
    live = set(h.live_paths())
    listed = h.vacuum(keep_versions=1)                        # dry run: nothing is deleted
    stale = [p for p in listed if "/_versions/" not in p]
    assert sorted(p.rsplit("/", 1)[1] for p in listed if "/_versions/" in p) == ["v=0000000001", "v=0000000002"]
    assert stale and not (set(stale) & live)
    assert all("run=0000000001" in p or "run=0000000002" in p for p in stale)
    # months before the cutoff written by run 1 are still live, so they are not stale
    assert any("run=0000000001" in p for p in live)
    assert {p for p in h.vacuum(keep_versions=2) if "/_versions/" not in p} < set(stale)
    assert h.vacuum(keep_versions=3) == []
    assert h.version() == 3  # a dry run removes nothing
    assert [k for k, in rows(h.read(), "k")] == [1, 3, 5, 7, 8, 20, 21, 22]


def test_command_line_copy_transactions(spark, tmp_path, capsys):  # job B from a scheduler
    import json

    from salesmart.__main__ import main
    src = str(tmp_path / "view")
    _transactions(spark, 321).write.parquet(src)
    assert main(["copy-transactions", "--source-parquet", src, "--history", str(tmp_path / "tx")]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["rows_written"] == 321 and report["mode"] == "full"


def test_a_failing_listing_is_no_empty_history(spark, tmp_path, monkeypatch):  # S10: the history must survive it
    h = History(spark, str(tmp_path / "h"))
    h.window_replace(base(spark), dt.datetime(1900, 1, 1))
    before = rows(h.read(), "k")

    def broken(path):
        raise RuntimeError(f"{path} does not exist (for the moment)")

    monkeypatch.setattr(h, "_fs_exists", broken)
    with pytest.raises(RuntimeError):
        h.window_replace(fresh(spark), CUT)
    monkeypatch.undo()
    assert h.version() == 1 and rows(h.read(), "k") == before


def test_of_two_writers_one_publishes(spark, tmp_path):  # S12
    h = History(spark, str(tmp_path / "h"))
    h.window_replace(base(spark), dt.datetime(1900, 1, 1))
    other = History(spark, str(tmp_path / "h"))
    publish, done = other._publish, []

    def late(version, paths, schema, report):  # the first one publishes while the second is writing
        if not done:
            done.append(h.window_replace(fresh(spark), CUT))
        publish(version, paths, schema, report)

    other._publish = late
    with pytest.raises(PublishError, match="another writer"):
        other.window_replace(fresh(spark).filter(F.lit(False)), CUT)
    assert h.version() == 2 and [k for k, in rows(h.read(), "k")] == [1, 3, 5, 7, 8, 20, 21, 22]


def test_a_short_write_is_not_published(spark, tmp_path, monkeypatch):  # S14
    h = History(spark, str(tmp_path / "h"))
    h.window_replace(base(spark), dt.datetime(1900, 1, 1))
    counted = h._written
    monkeypatch.setattr(h, "_written", lambda *a: counted(*a) - 1)
    with pytest.raises(PublishError, match="count mismatch"):
        h.window_replace(fresh(spark), CUT)
    assert h.version() == 1


def test_an_existing_history_can_be_demanded(spark, tmp_path):
    with pytest.raises(PublishError, match="nothing published"):
        History(spark, str(tmp_path / "typo")).window_replace(fresh(spark), CUT, create=False)


def test_rows_without_a_date_are_not_rewritten(spark, tmp_path):  # SURVEY 7.4
    h = History(spark, str(tmp_path / "h"))
    r0 = h.window_replace(base(spark), dt.datetime(1900, 1, 1))
    none = [p for p in r0.paths if p.endswith("month=none")]
    r1 = h.window_replace(fresh(spark), CUT)
    assert none and set(none) <= set(r1.paths)


# --- earlier versions, failures, the load log, rejected rows (S12, S14, X21) ---

def _days(spark, *days, year=2026):
    rows = [(i, dt.datetime(year, 1, d), year) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "id long, tgl_invoice timestamp_ntz, tahun_invoice int")


def test_earlier_versions_stay_readable_until_retired(spark, tmp_path):
    hist = History(spark, str(tmp_path / "h"))
    for days in ((1, 2), (3,), (4, 5, 6)):
        hist.window_replace(_days(spark, *days), dt.datetime(2026, 1, 1))
    assert [hist.read(v).count() for v in (1, 2, 3)] == [2, 1, 3] and hist.read().count() == 3
    for gone in (0, 4):
        with pytest.raises(PublishError, match="never published"):
            hist.read(gone)
    hist.vacuum(2, dry_run=False)
    assert hist.read(2).count() == 1
    with pytest.raises(PublishError, match="retired"):
        hist.read(1)


@pytest.mark.parametrize("step", ["_written", "_claim", "_claimed_by", "_make_claim"])
def test_a_failure_at_any_step_leaves_the_published_version(spark, tmp_path, monkeypatch, step):
    hist = History(spark, str(tmp_path / "h"))
    hist.window_replace(_days(spark, 1, 2), dt.datetime(2026, 1, 1))

    def fail(*args):
        raise OSError(f"lost at {step}")

    with monkeypatch.context() as m:
        m.setattr(History, step, fail)
        with pytest.raises(OSError, match=step):
            hist.window_replace(_days(spark, 3), dt.datetime(2026, 1, 1))
    assert hist.version() == 1 and hist.read().count() == 2
    # only a claim that was made stops the next writer, until it is old enough
    if step == "_claimed_by":
        with pytest.raises(PublishError, match="claimed"):
            hist.window_replace(_days(spark, 3), dt.datetime(2026, 1, 1))
    hist.claim_seconds = 0
    hist.window_replace(_days(spark, 3), dt.datetime(2026, 1, 1))
    assert hist.version() == 2 and hist.read().count() == 1


def test_a_writer_whose_claim_was_taken_over_does_not_publish(spark, tmp_path, monkeypatch):
    hist = History(spark, str(tmp_path / "h"), claim_seconds=0)
    hist.window_replace(_days(spark, 1), dt.datetime(2026, 1, 1))
    other = History(spark, hist.root, claim_seconds=0)
    claim = History._claim

    def slow(self, version):
        token = claim(self, version)
        if self is hist:  # meanwhile another writer holds its claim for dead
            other.window_replace(_days(spark, 7, 8, 9), dt.datetime(2026, 1, 1))
        return token

    monkeypatch.setattr(History, "_claim", slow)
    with pytest.raises(PublishError, match="taken over"):
        hist.window_replace(_days(spark, 2), dt.datetime(2026, 1, 1))
    assert hist.version() == 2 and hist.read().count() == 3


def test_a_claim_of_a_published_version_is_never_taken_over(spark, tmp_path):
    hist = History(spark, str(tmp_path / "h"), claim_seconds=0)
    hist.window_replace(_days(spark, 1), dt.datetime(2026, 1, 1))
    with pytest.raises(PublishError, match="claimed"):
        hist._claim(1)


def test_load_log(spark, tmp_path):
    hist = History(spark, str(tmp_path / "h"))
    assert hist.load_log().collect() == []
    hist.window_replace(_days(spark, 1, 2, 3), dt.datetime(2026, 1, 1))
    hist.window_replace(_days(spark, 8, 9), dt.datetime(2026, 1, 2))
    with pytest.raises(PublishError):
        hist.full_replace(_days(spark, 1), expected_rows=2)  # not published, so not in the log
    hist.full_replace(_days(spark, 1))
    log = hist.load_log().orderBy("version").collect()
    assert [(r.version, r["mode"], r.rows_before, r.rows_deleted, r.rows_fresh, r.rows_written, r.rows_loaded_so_far) for r in log] == [
        (1, "window", 0, 0, 3, 3, 3), (2, "window", 3, 2, 2, 3, 5), (3, "full", 0, 0, 1, 1, 6)]
    assert all(dt.datetime.fromisoformat(r.loaded_at).tzinfo for r in log)


def test_rejected_rows_are_published_with_the_load(spark, tmp_path):
    from salesmart.plans import refresh_sales_mart
    from salesmart.sources import frames
    from tests import erp_fixture as FX

    tabs = FX.erp_frames(spark)
    headers = tabs["ra_customer_trx_all"]
    bad = {1: "SO/1", 2: "12.5", 3: "1E30", 5: None}
    ref = F.col("ct_reference")
    for id, text in bad.items():
        ref = F.when(F.col("customer_trx_id") == id, F.lit(text)).otherwise(ref)
    erp = frames({**tabs, "ra_customer_trx_all": headers.withColumn("ct_reference", ref)})
    hist = History(spark, str(tmp_path / "h"))
    report = refresh_sales_mart(spark, erp, hist.root, FX.AS_OF)
    rows = {r.customer_trx_id: (r.ct_reference, r.reason) for r in hist.read_rejected().collect()}
    assert report.rejected_references == len(rows) == hist.load_log().first().rejected_references
    assert {i: rows[i] for i in (1, 2, 3)} == {1: ("SO/1", "no number"), 2: ("12.5", "no whole number"), 3: ("1E30", "too large")}
    assert 5 not in rows  # no reference is nothing to reject
    assert len(hist.vacuum(1)) == 0
    refresh_sales_mart(spark, erp, hist.root, FX.AS_OF)
    assert any("/rejected/" in p for p in hist.vacuum(1))
    with pytest.raises(PublishError, match="no rejected rows"):
        hist.full_replace(_days(spark, 1))
        hist.read_rejected()
