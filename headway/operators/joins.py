"""Joins of feed tables.

All are equi-joins on the feed columns and one key.  A null key never matches.  No join is
given a broadcast hint: small sides are broadcast when their measured size allows it.

One key may hold a large part of a table.  The table that can be so skewed is always the left one
of an inner, left, semi or anti join, and both sides arrive by a plain shuffle.  Then Spark splits
the partition of such a key over many tasks at run time, copies of one row included.  A side that
comes from a grouping on the very join key would keep its partitioning and prevent that, so it
goes through ``reshuffled`` first; it has one row per key and is the small one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from headway.functions import combo_color, or_empty
from headway.schemas import FEED


def feed_key(*names: str) -> list[str]:
    return [*FEED, *names]


def reshuffled(df: DataFrame, column: str) -> DataFrame:
    """The same rows, with a column Spark no longer takes to be the one the frame is grouped by."""
    return df.withColumn(column, F.concat(F.col(column), F.lit("")))


def distinct_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys for the right side of a join with a large table.

    They are made distinct on the map side, before any shuffle.
    """
    return reshuffled(df.select(*on).distinct(), on[-1])


def join_suffixed(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    suffixes: tuple[str, str] = ("_x", "_y"),
    how: str = "inner",
) -> DataFrame:
    """Join where a column of both sides gets a suffix on each."""
    shared = set(left.columns) & set(right.columns) - set(on)
    left = left.withColumnsRenamed({name: name + suffixes[0] for name in shared})
    right = right.withColumnsRenamed({name: name + suffixes[1] for name in shared})
    return left.join(right, list(on), how)


def trips_with_routes(trips: DataFrame, routes: DataFrame) -> DataFrame:
    return trips.join(routes, feed_key("route_id"))


def trip_calls(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Stop times with the columns of their trip."""
    return stop_times.join(trips, feed_key("trip_id"))


def calls_with_stops(calls: DataFrame, stops: DataFrame) -> DataFrame:
    return calls.join(stops, feed_key("stop_id"))


def calls_with_routes(calls: DataFrame, routes: DataFrame) -> DataFrame:
    """Calls of routes that have a short name.  ``unmatched`` reports the others."""
    return calls.join(routes.where(F.col("route_short_name").isNotNull()), feed_key("route_id"))


def trips_with_stops(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Trips that have at least one stop time."""
    return semi_filter(trips, stop_times, feed_key("trip_id"))


def semi_filter(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(distinct_keys(keys, on), list(on), "left_semi")


def anti_filter(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    return df.join(distinct_keys(keys, on), list(on), "left_anti")


def with_lines(calls: DataFrame, lines: DataFrame) -> DataFrame:
    """Add the lines of each stop; a stop without any gets the empty text."""
    joined = calls.join(lines, feed_key("stop_id"), "left")
    return joined.withColumn("lines_by_stop", or_empty("lines_by_stop"))


def route_attributes(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Look up the combo colour and the short name of each row's route.

    A route id that occurs more than once gives one row all the same: the smallest of its pairs of
    short name and colour.  ``repeated_routes`` tells which ids these are.
    """
    one = routes.groupBy(*feed_key("route_id")).agg(F.min(F.struct("route_short_name", "route_color")).alias("r"))
    looked_up = reshuffled(one, "route_id").select(*feed_key("route_id"), "r.route_color", "r.route_short_name")
    joined = df.join(looked_up, feed_key("route_id"), "left")
    return joined.withColumn("route_color", combo_color("route_color"))


def repeated_routes(routes: DataFrame) -> DataFrame:
    """Route ids that occur more than once in their feed, with the number of rows."""
    counts = routes.groupBy(*feed_key("route_id")).agg(F.count("*").alias("n_rows"))
    return counts.where("n_rows > 1")
