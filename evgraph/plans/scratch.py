"""Written tables that cut lineage."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a local master gets a temporary folder of its own;
    on a cluster each executor would write to its own disk there, so that is refused."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        place = tempfile.mkdtemp(prefix="evgraph-")
        atexit.register(shutil.rmtree, place, ignore_errors=True)
        found = "file://" + place
        spark.conf.set("spark.checkpoint.dir", found)
        context.setCheckpointDir(found)
    return found


class Scratch:
    """Tables in the shared folder, so a lost executor loses none of them."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.root = spark, f"{shared_dir(spark).rstrip('/')}/evgraph-{what}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Has the files of shuffles dropped whose results are written by now: Spark does so when the driver's collectors, which
        otherwise run when memory asks for it, find their plans gone."""
        gc.collect()
        self.spark._jvm.System.gc()
