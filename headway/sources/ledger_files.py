"""The run ledger on storage.

A ledger is a folder of snapshots.  A new snapshot never overwrites the one it was computed from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from headway.operators.columns import conform
from headway.schemas import LEDGER
from headway.sources.tables import is_folder


def runs_folder(path: str) -> str:
    """Where a status document has its runs that are too many for one value."""
    return f"{path.rstrip('/')}/combinations"


def read_status_document(spark: SparkSession, path: str) -> DataFrame:
    """Ledger rows in a JSON document with a ``combinations`` list, or in the folder of that name beside it."""
    if is_folder(spark, path) and is_folder(spark, runs_folder(path)):
        return spark.read.schema(LEDGER).json(runs_folder(path))
    schema = T.StructType([T.StructField("combinations", T.ArrayType(LEDGER))])
    documents = spark.read.schema(schema).option("multiLine", "true").json(path)
    return documents.select(F.inline("combinations"))


def read_ledger(spark: SparkSession, path: str, snapshot: str) -> DataFrame:
    return spark.read.schema(LEDGER).json(f"{path.rstrip('/')}/{snapshot}")


def write_ledger(ledger: DataFrame, path: str, snapshot: str) -> str:
    """Write a new snapshot, one JSON object per row; an existing one is an error."""
    target = f"{path.rstrip('/')}/{snapshot}"
    conform(ledger, LEDGER).write.mode("errorifexists").json(target)
    return target


def append_audit(tally: DataFrame, path: str, as_of: str, source: str) -> None:
    """Append the record of one registration run (a one-row ``outcome_tally``)."""
    record = tally.select(
        F.lit(as_of).alias("timestamp"),
        F.struct(*tally.columns).alias("summary"),
        F.lit(source).alias("combinations_file"),
    )
    record.write.mode("append").json(path)
