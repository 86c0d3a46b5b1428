"""Session helpers: local test sessions and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "salesmart",
                  broadcast_bytes: int = 64 << 20) -> SparkSession:
    """A local session for tests and benchmarks (a cluster brings its own settings).

    Single node: one JVM holds every "executor", so broadcasting a side of
    up to ``broadcast_bytes`` (Spark still checks the size) is cheaper than a
    shuffle through local disk.
    """
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.autoBroadcastJoinThreshold", str(broadcast_bytes))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session; only a session in one JVM (local tests) may go
    without it and gets a fresh folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="salesmart-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{checkpoint_dir(spark)}/salesmart-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read back: computed once, whoever reads it, and of known size.

    The files go with :func:`discard`, or when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored = path
    atexit.register(_delete, spark, path)
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that :func:`stored` returned and nothing will read again."""
    for df in frames:
        path = getattr(df, "_stored", None)
        if path:
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()  # a folder of its own
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may have ended before
        pass
