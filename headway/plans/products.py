"""The two map products.

``macro``        coloured points of the route shapes
``macro_stops``  every scheduled stop with its trip, its route and the lines serving the stop
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from headway.functions import (
    as_text,
    clean_id,
    name_label,
    or_empty,
    route_trip_label,
    safe_color,
    stop_label,
)
from headway.operators.columns import conform, drop_null, union_tables
from headway.operators.geometry import (
    BASIC,
    feeds_with_shapes,
    geometry_keys,
    routes_with_shape,
    shape_points,
)
from headway.operators.joins import calls_with_stops, feed_key, reshuffled, trip_calls
from headway.operators.keys import LADDER, Ladder, lookup_for
from headway.operators.lines import lines_by_stop
from headway.schemas import FEED, MACRO, MACRO_STOPS


def clean_trips(trips: DataFrame) -> DataFrame:
    """Trips with clean trip and shape ids; the route id stays raw for the key ladder."""
    shape = clean_id("shape_id")
    return trips.select(
        *FEED,
        "route_id",
        clean_id("trip_id").alias("trip_id"),
        "service_id",
        F.when(shape != "", shape).alias("shape_id"),
        "trip_headsign",
    )


def _lookup(keys: DataFrame, routes: DataFrame, ladder: Ladder) -> DataFrame:
    table = routes.select(*feed_key("route_id", "route_short_name", "route_color"))
    found = lookup_for(keys, table, "route_id", ladder)
    return found.withColumn("final_color", safe_color("route_color"))


def route_lookup(trips: DataFrame, routes: DataFrame, ladder: Ladder = LADDER) -> DataFrame:
    """Attributes and final colour of the routes, keyed by the raw route id of the trips.

    It has a row per spelling of a route, from the distinct route ids of the trips.
    """
    return _lookup(trips, routes, ladder)


def routed_trips(trips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Trips with their route, which gets its resolved id."""
    joined = trips.join(lookup, feed_key("route_id"))
    return joined.withColumn("route_id", F.col("resolved")).drop("resolved")


def trip_patterns(trips: DataFrame) -> DataFrame:
    """Distinct (route, shape, headsign) of the trips, all the geometry depends on."""
    known = drop_null(trips, ["route_id"])
    return known.select(*feed_key("route_id", "shape_id", "trip_headsign")).distinct()


def macro(
    trips: DataFrame,
    routes: DataFrame,
    shapes: DataFrame | None = None,
    ladder: Ladder = LADDER,
) -> DataFrame:
    """Coloured route shapes of all feeds.

    A route with geometry gives the points of its distinct (shape, colour, names).  A route
    without any gives its distinct basic columns.  A feed without shapes gives every trip as is.

    The kind of each route follows from the distinct patterns of the trips and the distinct ids of
    the shapes.  The trips are then used only for routes without geometry, and the points go through
    one join.  The shapes are read once for their ids and once for the points.
    """
    trips = clean_trips(trips)
    if shapes is None:
        return conform(routed_trips(trips, route_lookup(trips, routes, ladder)), MACRO, lead=FEED)

    patterns = trip_patterns(trips)
    # Both uses of the shapes need their counts, so they share one shuffle of ids; a distinct
    # of ids would be folded into each use, and the shapes read for each.  No trip has the empty
    # shape id that stands for null, and ids that can't be null get no filter of their own.
    ids = shapes.select(*FEED, or_empty(clean_id("shape_id")).alias("shape_id"))
    shape_keys = ids.groupBy(*feed_key("shape_id")).agg(F.count("*").alias("n_points")).where("n_points > 0")
    lookup = _lookup(patterns, routes, ladder)
    kinds = _with_kind(lookup, patterns, shape_keys)

    def routed(rows: DataFrame, kind: str) -> DataFrame:
        return routed_trips(rows, kinds.where(F.col("kind") == kind).drop("kind"))

    known = drop_null(shapes, ["shape_id"])
    known = known.withColumn("shape_id", or_empty(clean_id("shape_id")))
    points = shape_points(geometry_keys(routed(patterns, "drawn")), known)
    basic = routed(trips, "basic").select(*FEED, *BASIC).distinct()
    return conform(union_tables(points, basic, routed(trips, "bare")), MACRO, lead=FEED)


def _with_kind(lookup: DataFrame, trips: DataFrame, shapes: DataFrame) -> DataFrame:
    """Mark each route as ``drawn`` (has geometry), ``basic``, or ``bare`` (feed has no shapes)."""
    flag = F.lit(True)
    drawn = routes_with_shape(trips, shapes).withColumn("route_drawn", flag)
    feeds = feeds_with_shapes(shapes).withColumn("feed_drawn", flag)
    flagged = lookup.join(drawn, feed_key("route_id"), "left").join(feeds, list(FEED), "left")
    # The raw spellings of a route share its geometry; there are only a few.
    any_drawn = F.max("route_drawn").over(Window.partitionBy(*feed_key("resolved")))
    kind = F.when(any_drawn, "drawn").when(F.col("feed_drawn"), "basic").otherwise("bare")
    return flagged.withColumn("kind", kind).drop("route_drawn", "feed_drawn")


def named_trips(trips: DataFrame, routes: DataFrame, ladder: Ladder = LADDER) -> DataFrame:
    """Trips joined with the routes that have a short name."""
    lookup = drop_null(route_lookup(trips, routes, ladder), ["route_short_name"])
    return routed_trips(clean_trips(drop_null(trips, ["trip_id"])), lookup)


def clean_stop_times(stop_times: DataFrame) -> DataFrame:
    """Stop times with clean ids.

    Rows without a trip or a stop match nothing.  Dropping them here is a filter on the stored
    columns.  Then no clean id is null, and ``or_empty`` lets Spark know: else the joins would add
    a filter that cleans each id once more.
    """
    return drop_null(stop_times, ["trip_id", "stop_id"]).select(
        *FEED,
        or_empty(clean_id("trip_id")).alias("trip_id"),
        or_empty(clean_id("stop_id")).alias("stop_id"),
        "stop_sequence",
        "arrival_time",
        "departure_time",
    )


#: Text columns that travel with a stop time in one array, the stop first.
CALL = ("stop_id", "stop_sequence", "arrival_time", "departure_time")


def packed_calls(times: DataFrame) -> DataFrame:
    """Stop times as (feed, trip_id, call), where ``call`` is an array of the texts of ``CALL``.

    Two branches of a plan that join this with the trips ask for the same columns, whichever of
    them they use later.  So Spark reads and shuffles the stop times once and gives the shuffle to
    both.
    """
    return times.select(*feed_key("trip_id"), F.array(*map(as_text, CALL)).alias("call"))


def unpacked(calls: DataFrame, columns: Sequence[str] = CALL) -> DataFrame:
    """Columns of ``CALL`` in place of ``call``; as in clean stop times, no stop is null."""
    cell = {name: F.col("call")[i] for i, name in enumerate(CALL)}
    cell["stop_id"] = or_empty(cell["stop_id"])
    return calls.select("*", *[cell[name].alias(name) for name in columns]).drop("call")


def stop_lines(
    trips: DataFrame, routes: DataFrame, stop_times: DataFrame, ladder: Ladder = LADDER
) -> DataFrame:
    """Lines of each stop, straight from the source tables.

    Only ids are read from the stop times here.
    """
    names = named_trips(trips, routes, ladder).select(*feed_key("trip_id", "route_short_name"))
    times = clean_stop_times(stop_times).select(*feed_key("trip_id", "stop_id"))
    return lines_by_stop(trip_calls(names, times))


def macro_stops(
    trips: DataFrame,
    routes: DataFrame,
    stop_times: DataFrame,
    stops: DataFrame,
    ladder: Ladder = LADDER,
    strict: bool = False,
) -> DataFrame:
    """Every scheduled stop of all feeds with trip, stop, route, labels and lines.

    The lines are joined to the stops and not to the calls, so the stop times go through one
    join on the trip and one on the stop.  The lines come from the same shuffle of the stop times
    as the calls.  ``strict`` casts to the declared types; by default the columns of the stop times
    are text.
    """
    named = named_trips(trips, routes, ladder)
    packed = packed_calls(clean_stop_times(stop_times))
    names = named.select(*feed_key("trip_id", "route_short_name"))
    lines = lines_by_stop(unpacked(trip_calls(names, packed), ["stop_id"]))
    places = stops.select(
        *FEED, clean_id("stop_id").alias("stop_id"), "stop_name", "stop_lat", "stop_lon"
    ).join(lines, feed_key("stop_id"), "left")

    calls = calls_with_stops(unpacked(trip_calls(named, packed)), reshuffled(places, "stop_id"))
    labelled = calls.withColumns(
        {
            "stop_sequence": as_text("stop_sequence"),
            "stop_id_2": stop_label("stop_id"),
            "stop_name_2": name_label("stop_name"),
            "route_sn_trip_hs": route_trip_label("route_short_name", "trip_headsign"),
            "lines_by_stop": or_empty("lines_by_stop"),
        }
    )
    return conform(labelled, MACRO_STOPS, strict=strict, lead=FEED)
