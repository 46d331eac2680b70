"""Data dictionary and column comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rinkframe.sinks import tables
from rinkframe.specs import TableSpec

_RAW = """dataset string, `table` string, `column` string, dtype string, description string,
    business_definition string, tags array<string>, equivalent string, source_field string"""


def data_dictionary(
    spark: SparkSession,
    spec: TableSpec,
    dataset: str,
    owner: str = "rinkframe",
    source_system: str = "nhl-api",
) -> DataFrame:
    """One row per column of a table."""
    rows = [
        (dataset, spec.name, c.name, c.type, c.summary, c.describe(), list(c.tags), c.source,
         c.source_field)
        for c in spec.columns
    ]
    lineage = F.to_json(
        F.struct(
            F.col("equivalent").alias("nhl_api_equivalent"),
            F.col("source_field").alias("nhl_api_source_field"),
        ),
        {"ignoreNullFields": "false"},
    )
    return spark.createDataFrame(rows, _RAW).select(
        "dataset", "table", "column", "dtype", "description", "business_definition",
        F.lit(owner).alias("owner"),
        "tags",
        F.lit(source_system).alias("source_system"),
        lineage.alias("upstream_lineage_json"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )


def apply_dictionary(spark: SparkSession, table: str, spec: TableSpec, dataset: str) -> int:
    """Replace the dictionary rows of one table."""
    rows = data_dictionary(spark, spec, dataset)
    if not spark.catalog.tableExists(table):
        tables.create_keyed(spark, table, rows.schema, ["dataset", "table"], buckets=16)
    return tables.replace_by_key(rows, table, {"dataset": dataset, "table": spec.name})


def apply_comments(spark: SparkSession, table: str, spec: TableSpec) -> None:
    """Set the comment of every column of a stored table from its spec."""
    for c in spec.columns:
        text = c.describe().replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{c.name}` COMMENT '{text}'")
