"""Delimited text export (the bulk-load format of the source job).

Tab separated, no header, minimal quoting, null written as ``NULL`` and an
empty string as ``""`` so the two stay distinguishable on load. Each
partition writes its own file; nothing is buffered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TSV_OPTIONS = {"sep": "\t", "header": "false", "nullValue": "NULL", "quote": '"',
               "escape": '"', "emptyValue": '""'}


def export_delimited(df: DataFrame, path: str, *, sep: str = "\t", null_value: str = "NULL",
                     mode: str = "overwrite") -> None:
    opts = dict(TSV_OPTIONS, sep=sep, nullValue=null_value)
    df.write.mode(mode).options(**opts).csv(path)


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, *, sep: str = "\t",
                   null_value: str = "NULL") -> DataFrame:
    opts = dict(TSV_OPTIONS, sep=sep, nullValue=null_value)
    opts.pop("emptyValue")  # on read, a quoted empty field already is ''
    return spark.read.schema(schema).options(**opts).csv(path)
