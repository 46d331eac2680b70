"""Replacing partitions of a catalog table so that readers see old files or new ones.

Parquet tables know no transactions, but a catalog partition is one pointer to a folder.
New rows are written once to a folder of their own under the table, a marker with
everything that is left to do is renamed into place, and then each partition is pointed
at its new folder. A reader sees a partition before or after that step, never halfway.

A run that ends before the marker changes nothing. One that ends after it is finished by
the next writer, or by ``settle``: all steps can be taken again. Files that a swap
replaced stay until the next swap of the table, for readers that had listed them. A
table has one writer at a time; readers go through the catalog.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

_RUN = "_swap-"
# States of a run's folder: to be applied, applied with replaced files still there, settled.
_COMMIT, _DONE, _LIVE = "_commit", "_done", "_live"
_NULL = "__HIVE_DEFAULT_PARTITION__"


class Files:
    """The few file system calls that a swap needs, on the table's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.path(folder)))

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"could not rename {old} to {new}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def make(self, folder: str) -> None:
        self.fs.mkdirs(self.path(folder))

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _step(name: str) -> None:
    """Called before every step that others can see; tests stop a run here."""


def location(spark: SparkSession, table: str, partition: str | None = None) -> str | None:
    """Folder of a table or of one of its partitions."""
    extra = f" PARTITION ({partition})" if partition else ""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}{extra}").where("col_name = 'Location'")
    found = rows.select("data_type").first()
    return found[0].rstrip("/") if found else None


def partitions(spark: SparkSession, table: str) -> list[str]:
    """Names ``field=value`` of the partitions the catalog has."""
    return [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


@dataclass(frozen=True)
class Staged:
    """Rows written beside a table that no reader sees yet."""

    spark: SparkSession
    table: str
    field: str
    root: str
    run: str

    @property
    def folder(self) -> str:
        return f"{self.root}/{self.run}"

    @property
    def values(self) -> list[str | None]:
        """Partition values that have staged rows; None for NULL."""
        names = Files(self.spark, self.root).names(self.folder)
        found = [n.split("=", 1)[1] for n in names if n.startswith(f"{self.field}=")]
        return [None if v == _NULL else v for v in found]

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(self.folder)

    def discard(self) -> None:
        Files(self.spark, self.root).delete(self.folder)

    def commit(self, replace: list[str | None], drop: list[str | None] = (),
               append: list[str | None] = ()) -> None:
        """Swap staged partitions in, drop others, add staged files to others."""
        files = Files(self.spark, self.root)
        known = set(partitions(self.spark, self.table))
        old = {
            name: location(self.spark, self.table, _spec(self.spark, self.table, self.field, value))
            for value in replace if (name := _name(self.field, value)) in known}
        plan = {"table": self.table, "field": self.field, "replace": list(replace),
                "drop": list(drop), "append": list(append), "old": sorted(old.values())}
        _step("marker")
        files.write(f"{self.folder}/{_COMMIT}.tmp", json.dumps(plan))
        files.rename(f"{self.folder}/{_COMMIT}.tmp", f"{self.folder}/{_COMMIT}")
        _apply(self.spark, files, self.folder)


def stage(df: DataFrame, table: str, field: str) -> Staged:
    """Write a frame beside the table, by partition; whatever was left undone is done first."""
    spark = df.sparkSession
    settle(spark, table, clean=True)
    root = location(spark, table)
    run = f"{_RUN}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.partitionBy(field).parquet(f"{root}/{run}")
    return Staged(spark, table, field, root, run)


def settle(spark: SparkSession, table: str, clean: bool = False) -> int:
    """Finish swaps whose marker is in place; returns how many.

    With ``clean`` the files that finished swaps replaced are deleted, and so is what
    runs without a marker left behind: only the table's writer may ask for that.
    """
    root, finished = location(spark, table), 0
    files = Files(spark, root)
    for run in [n for n in files.names(root) if n.startswith(_RUN)]:
        folder = f"{root}/{run}"
        names = files.names(folder)
        if _COMMIT in names:
            _apply(spark, files, folder)
            finished += 1
            names = files.names(folder)
        if not clean or _LIVE in names:
            continue
        if _DONE not in names:
            files.delete(folder)
            continue
        for stale in json.loads(files.read(f"{folder}/{_DONE}"))["old"]:
            if stale.startswith(f"{root}/"):
                files.delete(stale)
                parent = stale.rsplit("/", 1)[0]
                if parent != root and not any("=" in n for n in files.names(parent)):
                    files.delete(parent)
        files.rename(f"{folder}/{_DONE}", f"{folder}/{_LIVE}")
    return finished


def _name(field: str, value: str | None) -> str:
    return f"{field}={_NULL if value is None else value}"


def _spec(spark: SparkSession, table: str, field: str, value: str | None) -> str:
    kind = spark.table(table).schema[field].dataType.simpleString()
    if value is None:
        return f"{field} = NULL"
    return f"{field} = DATE'{value}'" if kind == "date" else f"{field} = {int(value)}"


def _apply(spark: SparkSession, files: Files, folder: str) -> None:
    """The steps after the marker, each of which may have been taken before."""
    plan = json.loads(files.read(f"{folder}/{_COMMIT}"))
    table, field = plan["table"], plan["field"]
    known = set(partitions(spark, table))
    for value in plan["replace"]:
        name, spec = _name(field, value), _spec(spark, table, field, value)
        _step(f"replace {name}")
        if name in known:
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{folder}/{name}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{folder}/{name}'")
    if plan["drop"]:
        _step("drop")
        parts = ", ".join(f"PARTITION ({_spec(spark, table, field, v)})" for v in plan["drop"])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    for value in plan["append"]:
        name, spec = _name(field, value), _spec(spark, table, field, value)
        _step(f"append {name}")
        if name not in known:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")
        target = location(spark, table, spec)
        files.make(target)
        for file in files.names(f"{folder}/{name}"):  # those that were not moved yet
            files.rename(f"{folder}/{name}/{file}", f"{target}/{file}")
        files.delete(f"{folder}/{name}")
    spark.catalog.refreshTable(table)
    _step("done")
    files.rename(f"{folder}/{_COMMIT}", f"{folder}/{_DONE}")
