"""Session settings and scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the operators rely on.  Broadcasts are left to Spark's own size check
# (autoBroadcastJoinThreshold, re-checked by AQE with measured sizes), and skewed
# join partitions to the AQE skew-join rule.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str = "tidemart", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Whole-second and calendar-day rules are defined in UTC.  Executors get the package on the way."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package's sources to the executors once per application, so they need no installed copy.

    The zip is built in the driver's own temporary folder; Spark serves it from there.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "tidemart.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only a local session without that setting gets a machine-local folder; a real
    cluster without it is refused, as its executors share no local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Written to scratch space and read back: computed once, and of a size that is known when it is joined."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs within go when it ends; else they stay until the driver happens to collect its garbage.

    For steps that write: a frame that is collected twice would make its shuffles again.
    """
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


_SCRATCH: dict[str, list[str]] = {}


def release_scratch(spark: SparkSession, keep: tuple[str, ...] = ()) -> int:
    """Deletes the scratch folders this application has made, but for ``keep``; their number.

    Call it when results that read them have been used: frames are lazy.
    """
    made = _SCRATCH.get(spark.sparkContext.applicationId, [])
    gone = [p for p in made if p not in keep]
    for path in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    made[:] = [p for p in made if p in keep]
    return len(gone)
