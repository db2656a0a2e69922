"""Run-request envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.schemas import REQUEST_FIELDS

_FIELDS = ", ".join(f"{name}: string" for name in REQUEST_FIELDS)
_ITEM = f"struct<statusCode: int, body: string, {_FIELDS}>"


def _envelopes(c: Column) -> Column:
    """Envelopes of a request text: a list, a list of lists, or a single object."""
    text = F.btrim(c, F.lit(" \t\r\n"))
    nested = F.flatten(F.from_json(text, f"array<array<{_ITEM}>>"))
    flat = F.from_json(text, f"array<{_ITEM}>")
    return F.when(text.rlike(r"\A\[\s*\["), nested).otherwise(flat)


def parse_requests(df: DataFrame, column: str) -> DataFrame:
    """One row per request: its position, status code and fields.

    The fields come from the JSON text in ``body``, or from the object itself when it has none.
    """
    items = df.select("*", F.posexplode(_envelopes(F.col(column))).alias("position", "item"))
    body = F.from_json("item.body", f"struct<{_FIELDS}>")
    decoded = items.withColumn("decoded", F.when(F.col("item.body").isNotNull(), body))
    fields = [
        F.when(F.col("item.body").isNotNull(), F.col(f"decoded.{name}"))
        .otherwise(F.col(f"item.{name}"))
        .alias(name)
        for name in REQUEST_FIELDS
    ]
    others = [name for name in df.columns if name != column]
    return decoded.select(*others, "position", F.col("item.statusCode").alias("status_code"), *fields)


def format_requests(df: DataFrame) -> DataFrame:
    """The envelope text of each row's run, as a list of one, with all request fields the frame has."""
    body = F.to_json(F.struct(*[name for name in REQUEST_FIELDS if name in df.columns]))
    envelope = F.struct(F.lit(200).alias("statusCode"), body.alias("body"))
    return df.withColumn("request", F.to_json(F.array(envelope)))
