"""Run registered queries and their SQL side by side.

    python -m headway.verify.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(row[i]) for i in order) for row in rows)


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def differences(spark_df, connection, text: str) -> str:
    """Empty when the result is the same, else what differs."""
    rows = connection.execute(text)
    names = [d[0] for d in rows.description]
    expected = _bag(rows.fetchall(), names)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    got = _bag([tuple(r) for r in spark_df.collect()], spark_df.columns)
    if got == expected:
        return "" if got else "both empty"
    extra, lacking = list((got - expected).items())[:2], list((expected - got).items())[:2]
    return f"{got.total()} rows vs {expected.total()}; extra {extra}; lacking {lacking}"


def main(sf_dir: str = "/root/testdata/sf0.01", *only: str) -> int:
    from pyspark.sql import SparkSession

    from headway.verify.oracle import ORACLE
    from headway.verify.queries import QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    bad = 0
    for name, run in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = differences(run(spark, sf_dir), connection, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
