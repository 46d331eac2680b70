"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that results depend on (the time zone) or that every plan here relies
# on (runtime re-planning).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one that ``spark.checkpoint.dir`` names.

    Without that setting the warehouse folder serves if it is on a shared file
    system, or if the session runs on one machine; else this raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    master = spark.sparkContext.master
    shared = "://" in warehouse and not warehouse.startswith("file:")
    if shared or master == "local" or master.startswith("local["):
        return warehouse
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute a frame once and keep it in the shared folder for later reads."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


class Stage:
    """Writes intermediate frames once as Parquet in the shared folder.

    A stage keeps a frame that several later jobs read, so that its inputs are
    parsed and joined once, column pruning works on the result, and a lost
    executor re-reads files in place of re-running the whole plan. Leaving the
    ``with`` block deletes the files.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/rinkframe-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *exc) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(path, True)
