"""Publishing the mart: trailing-window replace and full replace, all-or-nothing.

The source job deletes the last twelve months of the history table in one
transaction and loads the fresh extract in another, so a failed load leaves
a hole. Here a refresh never touches data that readers can see:

* every run writes its rows into its own directory ``runs/run=<n>/``,
  partitioned by invoice month (``month=YYYY-MM``, ``month=none`` for a
  null date);
* a window refresh rewrites only the months from the cutoff month on (the
  survivors of the delete plus the fresh rows) and reuses every older month
  directory as it is, so its cost follows the window, not the history;
* the set of live directories is a one-row JSON pointer written as a new
  version directory ``_versions/v=<n>/`` by Spark's own committer once the
  data write has succeeded and its counts reconcile; readers take the
  highest committed version. A failure anywhere before that leaves the
  previous version as the readable one.

Row counts (read, deleted, fresh) are collected with ``DataFrame.observe``
during the write job and reconciled with a count of the written files (their
footers), so a short or doubled write is never published. Every attempt
writes into a folder of its own. Of two writers that start from the same
version only one can publish: it creates a claim file for the next version,
which fails where one exists. A claim without a pointer that is older than
``claim_seconds`` belongs to a dead writer, and the next one takes it over.

Earlier versions stay readable until they are vacuumed. Each pointer
keeps the counts of its run, which together are the load log; rows that a load
rejected are published with it.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules as R

NULL_MONTH = "none"

#: Age from which a claim without a pointer counts as a dead writer's. Between the two lies one small write.
CLAIM_SECONDS = 3600

#: What a pointer says of its run.
LOG_COLUMNS = ("version bigint, mode string, loaded_at string, rows_before bigint, rows_deleted bigint, rows_fresh bigint, "
               "rows_written bigint, rejected_references bigint")


class PublishError(RuntimeError):
    pass


@dataclass
class RefreshReport:
    version: int
    mode: str
    rows_before: int = 0        # rows in the rewritten months before the run
    rows_deleted: int = 0
    rows_fresh: int = 0
    rows_written: int = 0
    rejected_references: int | None = None  # order references of the window that are no numbers
    paths: list[str] = field(default_factory=list)


def cutoff_literal(value, dtype: T.DataType | None = None) -> Column:
    """The cutoff as a literal of the date column's type, built from ISO text.

    A Python ``datetime`` literal goes through the process's local time
    zone; text cast to ``timestamp_ntz``/``date`` does not depend on any zone.
    """
    if isinstance(value, (dt.datetime, dt.date)):
        text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    else:
        text = str(value)
    if isinstance(dtype, T.DateType):
        return F.lit(text[:10]).cast("date")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text).cast("timestamp")
    return F.lit(text).cast("timestamp_ntz")


def delete_predicate(date_col: str, cutoff, protect: tuple[str, int] | None,
                     dtype: T.DataType | None = None) -> Column:
    """``date >= :cutoff AND year <> :protected`` (null when an input is null)."""
    pred = F.col(date_col) >= cutoff_literal(cutoff, dtype)
    if protect is not None:
        pred = pred & (F.col(protect[0]) != F.lit(protect[1]))
    return pred


def survivors(df: DataFrame, date_col: str, cutoff, protect: tuple[str, int] | None) -> DataFrame:
    """Rows a SQL ``DELETE … WHERE pred`` keeps: those where ``pred`` is not true (null stays)."""
    dtype = df.schema[date_col].dataType
    return df.filter(~F.coalesce(delete_predicate(date_col, cutoff, protect, dtype), F.lit(False)))


def deleted_count_expr(date_col: str, cutoff, protect, dtype: T.DataType | None = None) -> Column:
    return F.sum(F.coalesce(delete_predicate(date_col, cutoff, protect, dtype), F.lit(False)).cast("long"))


def month_of(date_col: str) -> Column:
    return F.coalesce(F.date_format(F.col(date_col), "yyyy-MM"), F.lit(NULL_MONTH))


def day_start(ts) -> dt.datetime:
    d = ts.date() if isinstance(ts, dt.datetime) else ts
    return dt.datetime(d.year, d.month, d.day)


class History:
    """A published table made of immutable run directories and a version pointer."""

    def __init__(self, spark: SparkSession, root: str, *, date_col: str | None = "tgl_invoice",
                 claim_seconds: float = CLAIM_SECONDS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.date_col = date_col
        self.claim_seconds = claim_seconds

    # -- reading ------------------------------------------------------------
    def _pointer(self, version: int | None = None) -> dict | None:
        """The pointer of a version (the newest where none is named)."""
        if version is None:
            newest = self.versions(1)
            return newest[0] if newest else None
        found = [p for p in self.versions() if p["version"] == version]
        if not found:
            raise PublishError(f"version {version} was never published under {self.root}, or is retired")
        return found[0]

    def version(self) -> int:
        p = self._pointer()
        return p["version"] if p else 0

    def live_paths(self) -> list[str]:
        p = self._pointer()
        return list(p["paths"]) if p else []

    def read(self, version: int | None = None) -> DataFrame:
        """The current version, or an earlier one (empty with the stored schema when it has no rows)."""
        p = self._pointer(version)
        if p is None:
            raise PublishError(f"nothing published under {self.root}")
        schema = T.StructType.fromJson(json.loads(p["schema"]))
        if not p["paths"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*p["paths"])

    def read_rejected(self, version: int | None = None) -> DataFrame:
        """The rows that the load of a version rejected, with their reasons."""
        p = self._pointer(version)
        if p is None or not p.get("rejected"):
            raise PublishError(f"no rejected rows were published with that version under {self.root}")
        return self.spark.read.schema(T.StructType.fromJson(json.loads(p["rejected_schema"]))).parquet(p["rejected"])

    def load_log(self) -> DataFrame:
        """One row for each published version: what was read, deleted and loaded, and the rows loaded so far."""
        if not self._fs_exists(f"{self.root}/_versions"):
            return self.spark.createDataFrame([], LOG_COLUMNS).withColumn("rows_loaded_so_far", F.lit(0).cast("long"))
        runs = self.spark.read.schema(LOG_COLUMNS).option("recursiveFileLookup", "true").json(f"{self.root}/_versions")
        # one row for each run: the order needs no partitions
        so_far = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return runs.withColumn("rows_loaded_so_far", F.sum("rows_fresh").over(so_far))

    def versions(self, last: int | None = None) -> list[dict]:
        """Committed pointers, newest first (``last`` limits how many).

        The version folders are found from the file listing alone
        (``inputFiles``); only the pointers asked for are read.
        """
        if not self._fs_exists(f"{self.root}/_versions"):
            return []  # nothing was ever published; a failing listing raises instead
        files = self.spark.read.text(f"{self.root}/_versions").inputFiles()
        by_version: dict[int, list[str]] = {}
        for f in files:
            m = re.search(r"/v=(\d+)/", f)
            if m:
                by_version.setdefault(int(m.group(1)), []).append(f)
        chosen = sorted(by_version, reverse=True)[:last]
        if not chosen:
            return []
        rows = self.spark.read.text([f for v in chosen for f in by_version[v]]).collect()
        return sorted((json.loads(r["value"]) for r in rows), key=lambda d: -d["version"])

    def _path(self, path: str):
        """A path and its file system (the cluster's, whatever the scheme)."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _fs_exists(self, path: str) -> bool:
        where, fs = self._path(path)
        return fs.exists(where)

    def vacuum(self, keep_versions: int = 7, *, dry_run: bool = True) -> list[str]:
        """Data directories no longer referenced by the newest ``keep_versions`` versions,
        followed by the pointer folders of the versions that are retired.

        Every run writes its window months anew, so without this the history
        grows by a window's worth of data per run. With ``dry_run=False``
        the listed directories are deleted through the cluster file system
        (older versions then cannot be read any more; the kept ones can).
        """
        if keep_versions < 1:
            raise ValueError("keep at least the current version")
        def folders(v: dict) -> list[str]:
            return [*v["paths"], *([v["rejected"]] if v.get("rejected") else [])]

        newest = self.versions(keep_versions)
        keep = {p for v in newest for p in folders(v)}
        oldest_kept = min((v["version"] for v in newest), default=0)
        known: set[str] = set()
        retired: list[str] = []
        for v in self.versions():
            known.update(folders(v))
            if v["version"] < oldest_kept:
                retired.append(f"{self.root}/_versions/v={v['version']:010d}")
        # data first, then the pointers of the retired versions (so the listing stays short)
        stale = sorted(known - keep) + sorted(retired)
        if not dry_run and stale:
            for p in stale:
                where, fs = self._path(p)
                fs.delete(where, True)
        return stale

    # -- writing ------------------------------------------------------------
    def _publish(self, version: int, paths: list[str], schema: T.StructType, report: RefreshReport, **more) -> None:
        doc = {"version": version, "paths": paths, "schema": schema.json(),
               "mode": report.mode, "loaded_at": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds"),
               "rows_before": report.rows_before, "rows_written": report.rows_written,
               "rows_deleted": report.rows_deleted, "rows_fresh": report.rows_fresh,
               "rejected_references": report.rejected_references, **more}
        token = self._claim(version)
        if self._claimed_by(version) != token:
            raise PublishError(f"version {version} was taken over by another writer; nothing was published")
        # the folder is ours now; what else is in it is the uncommitted leftover of a crashed run
        (self.spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1)
         .write.mode("append").text(f"{self.root}/_versions/v={version:010d}"))

    def _claim_file(self, version: int) -> str:
        return f"{self.root}/_versions/v={version:010d}/_claim"

    def _claimed_by(self, version: int) -> str:
        where, fs = self._path(self._claim_file(version))
        stream = fs.open(where)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _claim(self, version: int) -> str:
        """Create the version's claim file with a token of this writer; fails when another writer has it.

        A claim that is older than ``claim_seconds`` while its version is not published was
        left by a dead writer: it is renamed, which only one of several others can do, and a new one is made.
        """
        token = uuid.uuid4().hex
        where, fs = self._path(self._claim_file(version))
        try:
            self._make_claim(version, token)
            return token
        except Exception as e:
            if not fs.exists(where):
                raise
            taken = PublishError(f"another writer has claimed version {version} ({where}); nothing was published")
            age = time.time() - fs.getFileStatus(where).getModificationTime() / 1000
            if self.version() >= version or age < self.claim_seconds:
                raise taken from e
            aside, _ = self._path(f"{self.root}/_versions/v={version:010d}/_expired-{token}")
            if not fs.rename(where, aside):
                raise taken from e
        try:
            self._make_claim(version, token)
        except Exception as e:
            raise PublishError(f"another writer has claimed version {version}; nothing was published") from e
        return token

    def _make_claim(self, version: int, token: str) -> None:
        where, fs = self._path(self._claim_file(version))
        stream = fs.create(where, False)
        try:
            stream.write(bytearray(token, "ascii"))
        finally:
            stream.close()

    def _run_dir(self, version: int) -> str:
        """A folder that no other attempt writes to."""
        return f"{self.root}/runs/run={version:010d}/{uuid.uuid4().hex}"

    def _written(self, path: str, schema: T.StructType) -> int:
        """Rows in the files of a run, from their footers."""
        if not self._fs_exists(path):
            return 0
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path).count()

    def full_replace(self, df: DataFrame, *, expected_rows: int | None = None, rebalance: bool = True) -> RefreshReport:
        """Replace everything with ``df`` (TRUNCATE + load, in one publish step).

        ``expected_rows`` is a control total taken separately from the source
        (``COUNT(*)``); when the rows written differ, nothing is published.
        With ``rebalance`` the files follow the data's size, also when the source came
        through few tasks; it sends whole rows through a shuffle, which a source whose tasks
        follow its size can do without.
        """
        version = self.version() + 1
        run_dir = self._run_dir(version)
        (df.hint("rebalance") if rebalance else df).write.parquet(run_dir)
        n = self._written(run_dir, df.schema)
        if expected_rows is not None and n != expected_rows:
            raise PublishError(f"control total {expected_rows} != rows written {n}; nothing was published")
        report = RefreshReport(version, "full", rows_fresh=n, rows_written=n, paths=[run_dir])
        self._publish(version, [run_dir], df.schema, report)
        return report

    def window_replace(self, fresh: DataFrame, cutoff, *,
                       protect: tuple[str, int] | None = ("tahun_invoice", R.PROTECTED_YEAR),
                       create: bool = True, rejected: DataFrame | None = None) -> RefreshReport:
        """Delete ``date >= cutoff`` (except protected rows) and load ``fresh``, atomically.

        With ``create=False`` an existing history is demanded: a job that
        expects one fails instead of starting anew under a wrong root.

        ``cutoff`` is compared with the date column as given: pass the start
        of a day to make the delete match an extract that covers whole days.
        ``rejected`` are rows that the load had to leave out; they are published with it.
        """
        if self.date_col is None:
            raise PublishError("window_replace needs a date column")
        dcol = self.date_col
        ptr = self._pointer()
        if ptr is None and not create:
            raise PublishError(f"nothing published under {self.root}")
        version = (ptr["version"] if ptr else 0) + 1
        cutoff_month = (cutoff.strftime("%Y-%m") if hasattr(cutoff, "strftime") else str(cutoff)[:7])

        def month_from_path(p: str) -> str:
            return p.rsplit("month=", 1)[1] if "month=" in p else NULL_MONTH

        prev_paths = list(ptr["paths"]) if ptr else []
        # rows without a date are never deleted, so their folders are reused as they are
        rewrite = [p for p in prev_paths
                   if month_from_path(p) != NULL_MONTH and month_from_path(p) >= cutoff_month]
        reuse = [p for p in prev_paths if p not in rewrite]

        tagged_fresh = fresh.withColumn("_fresh", F.lit(1))
        if rewrite:
            schema = T.StructType.fromJson(json.loads(ptr["schema"]))
            old = self.spark.read.schema(schema).parquet(*rewrite)
            old_obs = Observation("window_before")
            old = old.observe(old_obs, F.count(F.lit(1)).alias("n"),
                              deleted_count_expr(dcol, cutoff, protect, schema[dcol].dataType)
                              .alias("deleted"))
            kept = survivors(old, dcol, cutoff, protect).withColumn("_fresh", F.lit(0))
            combined = kept.unionByName(tagged_fresh)
        else:
            old_obs = None
            combined = tagged_fresh

        out_obs = Observation("window_out")
        out = (combined.withColumn("month", month_of(dcol))
               .observe(out_obs, F.count(F.lit(1)).alias("n"),
                        F.sum("_fresh").alias("fresh"),
                        F.collect_set("month").alias("months"),
                        F.sum(((F.col("_fresh") == 1) & (F.col("month") < F.lit(cutoff_month))
                               & (F.col("month") != F.lit(NULL_MONTH))).cast("long")).alias("early"))
               .drop("_fresh"))
        run_dir = self._run_dir(version)
        # rebalance by month: files per month follow its size (AQE splits a big month into
        # advisory-size pieces and merges small ones) instead of one file per task and month
        out.hint("rebalance", "month").write.partitionBy("month").parquet(run_dir)

        m = out_obs.get
        if (m.get("early") or 0) > 0:
            raise PublishError(f"{m['early']} fresh rows are dated before the cutoff month "
                               f"{cutoff_month}; nothing was published")
        before = old_obs.get if old_obs is not None else {"n": 0, "deleted": 0}
        n_before, n_deleted = before["n"] or 0, before["deleted"] or 0
        n_fresh, n_written = m["fresh"] or 0, self._written(run_dir, fresh.schema)
        if n_before - n_deleted + n_fresh != n_written:
            raise PublishError(f"count mismatch: {n_before} - {n_deleted} + {n_fresh} != {n_written}")

        new_paths = [f"{run_dir}/month={mo}" for mo in sorted(m["months"] or [])]
        paths = sorted(reuse) + new_paths
        report = RefreshReport(version, "window", rows_before=n_before, rows_deleted=n_deleted,
                               rows_fresh=n_fresh, rows_written=n_written, paths=paths)
        more = {}
        if rejected is not None:
            path, count = f"{self.root}/rejected/run={version:010d}/{uuid.uuid4().hex}", Observation("rejected")
            rejected.observe(count, F.count(F.lit(1)).alias("n")).write.parquet(path)
            report.rejected_references = count.get["n"]
            more = {"rejected": path, "rejected_schema": rejected.schema.json()}
        self._publish(version, paths, fresh.schema, report, **more)
        return report
