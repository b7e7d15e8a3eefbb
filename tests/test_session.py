import os
import subprocess
import sys

from tidemart.session import release_scratch, scratch_path

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", entry.queries()["knn_topk"](spark, {data!r}).count())
"""


def test_queries_run_from_another_folder(tmp_path, sf_dir):
    """Executors get the package from the driver, not from the working directory."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run(
        [sys.executable, "-c", CODE.format(repo=REPO, data=sf_dir)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 100" in said.stdout, said.stderr[-2000:]


def test_scratch_is_released(spark):
    kept, gone = scratch_path(spark, "a"), scratch_path(spark, "b")
    for path in (kept, gone):
        spark.range(3).write.parquet(path)
    assert release_scratch(spark, keep=(kept,)) >= 1
    assert spark.read.parquet(kept).count() == 3
    at = spark._jvm.org.apache.hadoop.fs.Path(gone)
    assert not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
