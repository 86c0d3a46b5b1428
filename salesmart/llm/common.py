"""Helpers shared by the operators: reading, staging, naming."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once a session.

    Workers import what functions refer to.  Where the driver found the package
    through its own ``sys.path`` only, they could not; Spark sends them a
    zip of the sources.
    """
    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if getattr(context, "_ships", None) == root or not os.path.isdir(root):
        return  # sent already, or installed as an archive
    name = os.path.basename(root)
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.join(name, os.path.relpath(path, root)))
    context.addPyFile(archive)
    context._ships = root


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Only a plain local session (one JVM) may go without it; it gets a
    temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def staged(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    It cuts the lineage, makes ids and counts stable, survives lost executors,
    and gives the planner the real size.  The files go when the driver ends.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_folder(spark)}/llm-{what}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(schema).parquet(path)
    out._staged = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables that :func:`staged` returned and nothing will read again."""
    for df in tables:
        path = getattr(df, "_staged", None)
        if path:
            _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may have ended before
        pass


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        candidate = f"_{name}"
        while candidate.lower() in taken:
            candidate = f"_{candidate}"
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


#: Bits of a bitmap of hashes, unless a caller sizes it: 8 MB, however many hashes there are.
MARKS = 1 << 26


def marks(hashes: DataFrame, column: str, bits: int = MARKS) -> Broadcast:
    """A broadcast bitmap with the low bits of each hash set: at most ``bits`` / 64 words reach the driver.

    ``bits`` is a power of two.
    """
    bit = F.pmod(column, F.lit(bits))
    words = (
        hashes.select(F.floor(bit / 64).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))").alias("word"))
        .groupBy("at")
        .agg(F.bit_or("word").alias("word"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words["at"].to_numpy()] = words["word"].to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(out)


def marked(bitmap: Broadcast, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    bit = hashes & np.int64(64 * len(bitmap.value) - 1)
    return (bitmap.value[bit >> 6] >> (bit & 63)) & 1 == 1
