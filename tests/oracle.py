"""Compare the registered queries with their SQL in DuckDB.

    python -m tests.oracle [folder] [query name part ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

DEFAULT = "/root/testdata/sf0.001"


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, con, folder: str, query) -> str | None:
    """None if Spark and the SQL agree, else what differs."""
    df = query.run(spark, folder)
    got = bag(df.columns, df.collect())
    ran = con.execute(query.sql)
    names = [d[0] for d in ran.description]
    want = bag(names, ran.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got == want:
        return None
    return (f"{sum(got.values())} and {sum(want.values())} rows; columns {sorted(names)}; "
            f"only here {list((got - want).items())[:2]}; missing {list((want - got).items())[:2]}")


def main() -> int:
    from pyspark.sql import SparkSession

    from rinkframe.bindings import QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else DEFAULT
    parts = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, query in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        if query.sql is None:
            found = f"no SQL, {query.run(spark, folder).count()} rows"
        else:
            try:
                found = differences(spark, con, folder, query)
            except Exception as error:  # noqa: BLE001
                found = f"{type(error).__name__}: {str(error)[:900]}"
            bad += found is not None
        print(f"{time.time() - start:6.1f}s {'ok ' if found is None else 'BAD'} {name} {found or ''}",
              flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
