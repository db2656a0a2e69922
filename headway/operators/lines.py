"""Lines that serve each stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from headway.operators.columns import drop_null
from headway.operators.joins import feed_key


def stop_line_pairs(calls: DataFrame) -> DataFrame:
    """Distinct (feed, stop, short name).  Repeats are dropped before the shuffle."""
    known = drop_null(calls, ["stop_id", "route_short_name"])
    return known.select(*feed_key("stop_id", "route_short_name")).distinct()


def lines_by_stop(calls: DataFrame) -> DataFrame:
    """One row per stop with its lines as text, sorted as text and joined by ``", "``.

    A group holds each line of a stop once, however many calls the stop has; the text itself,
    which is the result, is of the same size.
    """
    # The pairs are distinct already.  Gathering them as a set would make Spark drop that step as
    # redundant, and build the sets from all calls, sorted, in its place.
    lines = F.concat_ws(", ", F.array_sort(F.collect_list("route_short_name")))
    return stop_line_pairs(calls).groupBy(*feed_key("stop_id")).agg(lines.alias("lines_by_stop"))
