"""Binary files in the folder that driver and executors share, whatever store it is in."""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder as a full URI, so executors need no default file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, label))
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = store.makeQualified(path).toString()
    return re.sub(r"^file:/+", "file:///", uri)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def is_local(store: fs.FileSystem) -> bool:
    return isinstance(store, fs.LocalFileSystem)


def one_per_task(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows that each name a file, dealt evenly: no key is hashed."""
    return spark.createDataFrame(rows, schema).repartition(max(1, len(rows)))
