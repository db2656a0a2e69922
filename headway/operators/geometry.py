"""Route geometry: coloured shapes and the rows that stand in where there is none."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from headway.operators.columns import drop_null
from headway.operators.joins import anti_filter, feed_key, semi_filter
from headway.schemas import FEED

LABELS = ("final_color", "route_short_name", "trip_headsign")
# Columns of the rows that stand in for geometry.
BASIC = (*LABELS, "route_id", "trip_id", "service_id", "shape_id")


def geometry_keys(df: DataFrame) -> DataFrame:
    """Distinct (shape, colour, short name, headsign) of each feed, rows without a shape left out."""
    return df.where(F.col("shape_id").isNotNull()).select(*feed_key("shape_id", *LABELS)).distinct()


def shape_points(keys: DataFrame, shapes: DataFrame) -> DataFrame:
    """Points of each key.

    The points are the left (streamed) side, so a shape with very many points is split and
    never buffered.  The hint makes the keys the built side: by its size on storage alone Spark may
    take the points for the small side and send them whole through the driver.
    """
    return shapes.join(keys.hint("shuffle_hash"), feed_key("shape_id"))


def routes_with_shape(trips: DataFrame, shapes: DataFrame) -> DataFrame:
    """(feed, route_id) of routes with at least one trip whose shape has points."""
    known = drop_null(trips, ["route_id", "shape_id"])
    used = known.select(*feed_key("route_id", "shape_id")).distinct()
    return semi_filter(used, shapes, feed_key("shape_id")).select(*feed_key("route_id")).distinct()


def feeds_with_shapes(shapes: DataFrame) -> DataFrame:
    return shapes.select(*FEED).distinct()


def shape_fallback(df: DataFrame, shapes: DataFrame) -> DataFrame:
    """Basic rows of routes without geometry, in feeds that have shapes."""
    lacking = anti_filter(df, routes_with_shape(df, shapes), feed_key("route_id"))
    return semi_filter(lacking, shapes, FEED).select(*FEED, *BASIC).distinct()


def without_shapes(df: DataFrame, shapes: DataFrame) -> DataFrame:
    """Rows of feeds that have no shapes at all; these keep all columns and all copies."""
    return anti_filter(df, shapes, FEED)
