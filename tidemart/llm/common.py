"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

BATCH_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Texts are long: fewer rows per Arrow batch keep a Python worker's memory small.  Tasks get the package on the way."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Written under the shared folder and read back: computed once, and safe when executors are lost."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def dropped(spark: SparkSession, df: DataFrame) -> None:
    """Deletes what :func:`staged` wrote for ``df``, when every reader of it is staged itself."""
    path = next(iter(df.inputFiles()), "").rpartition("/")[0]
    if path:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are; null as the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, so extra columns of any name survive."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
