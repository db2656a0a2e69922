"""ISO-8601 time text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from headway.functions.ids import _col

_ISO = r"\A\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?([Zz]|[+-]\d{2}:\d{2})?)?\z"


def iso_time(c: Column | str) -> Column:
    """Timestamp of an ISO text, null when it is not one.

    A plain cast would also take partial texts such as ``12:30`` for a time of today.
    """
    c = _col(c)
    return F.when(c.rlike(_ISO), c.try_cast("timestamp"))


def older_than(c: Column | str, as_of: str, hours: int) -> Column:
    """Whether the time lies more than ``hours`` before ``as_of``; null when it is no time."""
    limit = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")
    return iso_time(c) < limit
