"""Column lists, types and status words of the feed tables and the run ledger."""

from __future__ import annotations

from pyspark.sql import types as T

FEED = ("explotation", "contract", "version")
LEDGER_KEY = ("P_EMPRESA", "P_CONTR", "P_VERSION")

# The columns that are read of each source table.
SOURCES: dict[str, T.StructType] = {
    "agency": T.StructType([
        T.StructField("agency_id", T.StringType()),
    ]),
    "routes": T.StructType([
        T.StructField("route_id", T.StringType()),
        T.StructField("route_short_name", T.StringType()),
        T.StructField("route_color", T.StringType()),
    ]),
    "trips": T.StructType([
        T.StructField("route_id", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("service_id", T.StringType()),
        T.StructField("shape_id", T.StringType()),
        T.StructField("trip_headsign", T.StringType()),
    ]),
    "stop_times": T.StructType([
        T.StructField("trip_id", T.StringType()),
        T.StructField("stop_id", T.StringType()),
        T.StructField("stop_sequence", T.StringType()),
        T.StructField("arrival_time", T.StringType()),
        T.StructField("departure_time", T.StringType()),
    ]),
    "stops": T.StructType([
        T.StructField("stop_id", T.StringType()),
        T.StructField("stop_lat", T.DoubleType()),
        T.StructField("stop_lon", T.DoubleType()),
        T.StructField("stop_name", T.StringType()),
    ]),
    "shapes": T.StructType([
        T.StructField("shape_id", T.StringType()),
        T.StructField("shape_pt_lat", T.DoubleType()),
        T.StructField("shape_pt_lon", T.DoubleType()),
        T.StructField("shape_pt_sequence", T.LongType()),
    ]),
}

# The file types a feed needs to be processed.
REQUIRED_TYPES = ("AGENCY", "ROUTES", "TRIPS", "STOPS", "STOP_TIMES")
# The file types a listing is filtered to.
LISTED_TYPES = (
    "AGENCY", "FEED_INFO", "CALENDAR_DATES", "TRIPS", "STOPS",
    "ROUTES", "CALENDAR", "PRE_STOP_TIMES", "STOP_TIMES", "SHAPES",
)

# Declared columns of the coloured shapes table.
MACRO = T.StructType([
    T.StructField("shape_id", T.StringType()),
    T.StructField("final_color", T.StringType()),
    T.StructField("route_short_name", T.StringType()),
    T.StructField("trip_headsign", T.StringType()),
    T.StructField("shape_pt_lat", T.DoubleType()),
    T.StructField("shape_pt_lon", T.DoubleType()),
    T.StructField("shape_pt_sequence", T.LongType()),
    T.StructField("shape_dist_traveled", T.DoubleType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("service_id", T.StringType()),
    T.StructField("trip_short_name", T.StringType()),
    T.StructField("direction_id", T.LongType()),
    T.StructField("block_id", T.StringType()),
    T.StructField("agency_id", T.StringType()),
    T.StructField("route_long_name", T.StringType()),
    T.StructField("route_desc", T.StringType()),
    T.StructField("route_type", T.LongType()),
    T.StructField("route_url", T.StringType()),
    T.StructField("route_color", T.StringType()),
    T.StructField("route_text_color", T.StringType()),
    T.StructField("route_sort_order", T.StringType()),
    T.StructField("continuous_pickup", T.StringType()),
    T.StructField("continuous_drop_off", T.StringType()),
])

# Declared columns of the stop calls table.
MACRO_STOPS = T.StructType([
    T.StructField("route_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("service_id", T.StringType()),
    T.StructField("shape_id", T.StringType()),
    T.StructField("trip_headsign", T.StringType()),
    T.StructField("trip_short_name", T.StringType()),
    T.StructField("direction_id", T.LongType()),
    T.StructField("block_id", T.StringType()),
    T.StructField("arrival_time", T.StringType()),
    T.StructField("stop_id", T.LongType()),
    T.StructField("stop_sequence", T.LongType()),
    T.StructField("stop_headsign", T.StringType()),
    T.StructField("continuous_pickup_x", T.LongType()),
    T.StructField("continuous_drop_off_x", T.LongType()),
    T.StructField("timepoint", T.LongType()),
    T.StructField("stop_code", T.LongType()),
    T.StructField("stop_name", T.StringType()),
    T.StructField("stop_desc", T.StringType()),
    T.StructField("stop_lat", T.DoubleType()),
    T.StructField("stop_lon", T.DoubleType()),
    T.StructField("zone_id", T.StringType()),
    T.StructField("stop_url", T.StringType()),
    T.StructField("location_type", T.LongType()),
    T.StructField("parent_station", T.StringType()),
    T.StructField("stop_timezone", T.StringType()),
    T.StructField("wheelchair_boarding", T.StringType()),
    T.StructField("level_id", T.StringType()),
    T.StructField("platform_code", T.StringType()),
    T.StructField("agency_id", T.StringType()),
    T.StructField("route_short_name", T.StringType()),
    T.StructField("route_long_name", T.StringType()),
    T.StructField("route_type", T.LongType()),
    T.StructField("route_url", T.StringType()),
    T.StructField("route_color", T.StringType()),
    T.StructField("route_sort_order", T.StringType()),
    T.StructField("continuous_pickup_y", T.StringType()),
    T.StructField("continuous_drop_off_y", T.StringType()),
    T.StructField("final_color", T.StringType()),
    T.StructField("stop_id_2", T.StringType()),
    T.StructField("stop_name_2", T.StringType()),
    T.StructField("route_sn_trip_hs", T.StringType()),
    T.StructField("lines_by_stop", T.StringType()),
    T.StructField("departure_time", T.StringType()),
    T.StructField("pickup_type", T.StringType()),
    T.StructField("drop_off_type", T.StringType()),
    T.StructField("route_desc", T.StringType()),
    T.StructField("route_text_color", T.StringType()),
    T.StructField("consec_na", T.StringType()),
    T.StructField("wheelchair_accessible", T.StringType()),
    T.StructField("bikes_allowed", T.StringType()),
])

# Fields of a run.  Times are kept as text: a bad time must be seen, not lost.
LEDGER = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("P_EMPRESA", T.StringType()),
    T.StructField("P_CONTR", T.StringType()),
    T.StructField("P_VERSION", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("retries", T.IntegerType()),
    T.StructField("registered_at", T.StringType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("reset_at", T.StringType()),
    T.StructField("last_updated", T.StringType()),
    T.StructField("preprocessed_at", T.StringType()),
    T.StructField("jobs_started_at", T.StringType()),
    T.StructField("jobs_completed_at", T.StringType()),
    T.StructField("last_checked", T.StringType()),
    T.StructField("reset_reason", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("execution_arn", T.StringType()),
    T.StructField("execution_id", T.StringType()),
    T.StructField("temp_dir", T.StringType()),
    T.StructField("macro_job_id", T.StringType()),
    T.StructField("macro_stops_job_id", T.StringType()),
    T.StructField("macro_status", T.StringType()),
    T.StructField("macro_stops_status", T.StringType()),
])

# Status words.
STATUSES = ("pending", "preprocessing", "processing", "completed", "failed")
FILE_STATUSES = ("preprocessed", "processing_macro", "processing_macro_stops")
ALL_STATUSES = STATUSES + FILE_STATUSES

# Fields of a run request.
REQUEST_FIELDS = (
    "NOMBRE_EMPRESA", "P_EMPRESA", "P_CONTR", "P_CONTR_FLAG", "P_FECHAD", "P_FECHAH",
    "P_VERSION", "V_GTFS", "P_ENV", "P_FECHAEX", "P_LINE",
)
