"""The route → headsign index.

A combo is a (feed, route, headsign) with its trips, shapes and colour.  One combo may hold a
large share of all trips, so nothing is gathered per combo without a bound: ``combos`` has the
scalars, ``combo_shapes`` and ``combo_rows`` are long tables, and ``combo_documents`` has the
nested form, every combo cut into the same number of parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions import or_empty, sorted_set
from headway.operators.columns import drop_null
from headway.operators.joins import feed_key, route_attributes, trips_with_stops

COMBO = feed_key("route_id", "trip_headsign")
ROW = ("route_id", "trip_id", "service_id", "shape_id", "trip_headsign")


def combo_rows(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Distinct trip rows of each combo with their number of ``copies``.

    Only trips that have stop times count; rows without route or headsign belong to no combo.
    """
    grouped = drop_null(trips, ["route_id", "trip_headsign", "trip_id"])
    distinct = grouped.groupBy(*feed_key(*ROW)).agg(F.count("*").alias("copies"))
    return trips_with_stops(distinct, stop_times)


def dropped_trips(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Per feed the trips that have stop times but no route or headsign."""
    lacking = trips.where(F.col("route_id").isNull() | F.col("trip_headsign").isNull())
    counted = lacking.groupBy(*feed_key("trip_id")).agg(F.count("*").alias("n"))
    dropped = trips_with_stops(counted, stop_times)
    return dropped.groupBy(*feed_key()).agg(F.sum("n").alias("n_dropped"))


def _has_shape() -> Column:
    return F.col("shape_id").isNotNull() & (F.col("shape_id") != "")


def combo_shapes(rows: DataFrame) -> DataFrame:
    """Distinct shapes of each combo, null and empty ids left out."""
    return rows.where(_has_shape()).select(*COMBO, "shape_id").distinct()


def combos(rows: DataFrame, routes: DataFrame) -> DataFrame:
    """One row per combo: colour, and the numbers of rows, trips and shapes."""
    # Spark first makes the values distinct, then counts them: a large combo is no matter.
    counts = rows.groupBy(*COMBO).agg(
        F.sum("copies").alias("n_rows"),
        F.count_distinct("trip_id").alias("n_trips"),
        F.count_distinct(F.when(_has_shape(), F.col("shape_id"))).alias("n_shapes"),
    )
    flagged = counts.withColumn("has_stops", F.lit(True))
    return route_attributes(flagged, routes).drop("route_short_name")


def combo_parts(rows: DataFrame, parts: int = 64) -> DataFrame:
    """Number the rows of each combo with a ``part`` from 0 to ``parts`` - 1.

    One rule for all combos, large and small.  The part follows from a hash of the row, so it does
    not change when a task is run again.
    """
    spread = F.concat_ws("\x1f", *[or_empty(c) for c in ("trip_id", "service_id", "shape_id")])
    digest = F.conv(F.substring(F.md5(spread), 1, 8), 16, 10).cast("bigint")
    return rows.withColumn("part", F.pmod(digest, F.lit(parts)))


def combo_documents(rows: DataFrame, routes: DataFrame, parts: int = 64) -> DataFrame:
    """The nested form, one row per part of a combo that has rows.

    Lists of one combo are those of its parts taken together.  ``group_copies`` tells how often
    each row of ``group_data`` occurs.
    """
    shape = F.when(_has_shape(), F.col("shape_id"))
    # Rows are gathered as structs: they can be sorted, maps cannot.
    members = F.collect_list(F.struct(*ROW, "copies"))
    nested = combo_parts(rows, parts).groupBy(*COMBO, "part").agg(
        sorted_set(shape).alias("unique_shape_ids"),
        sorted_set("trip_id").alias("trip_ids"),
        F.array_sort(members).alias("sorted_rows"),
    )

    def as_map(item: Column) -> Column:
        return F.create_map(*[x for c in ROW for x in (F.lit(c), item[c])])

    nested = nested.withColumns(
        {
            "has_stops": F.lit(True),
            "group_data": F.transform("sorted_rows", as_map),
            "group_copies": F.transform("sorted_rows", lambda item: item["copies"]),
            "group_columns": F.array(*[F.lit(c) for c in ROW]),
        }
    ).drop("sorted_rows")
    return route_attributes(nested, routes).drop("route_short_name")


def valid_routes(rows: DataFrame) -> DataFrame:
    """(feed, route_id) of routes with at least one combo."""
    return rows.select(*feed_key("route_id")).distinct()
