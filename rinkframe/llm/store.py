"""Intermediate frames in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder all executors reach.

    Only a session on one machine (master ``local``) may go without the setting;
    it then gets a new temporary folder, set once for the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="rinkframe-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once as Parquet in the shared folder and read it back.

    A lost executor costs a re-read of files, never a second run of what is
    upstream. The folder is unique to the call; it can be deleted once the frames
    that read it are done.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/rinkframe-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
