"""The registered queries.  Each reads whole tables and gives scalars, so SQL can check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway import functions as fn
from headway.operators import (
    checks,
    columns,
    geometry,
    joins,
    keys,
    ledger as led,
    lines,
    logs,
    reports,
)
from headway.plans import combos as cmb, discover, preprocess as pre, products
from headway.schemas import FEED, LEDGER, LEDGER_KEY, MACRO, SOURCES
from headway.session import shared_dir, tune
from headway.sources.commits import commit_product, product_commits, read_product
from headway.sources.ledger_files import append_audit, read_ledger, read_status_document, write_ledger
from headway.sources.listing import list_files
from headway.sources.requests import format_requests, parse_requests
from headway.sources.snapshots import claim_runs, commit_snapshot, read_snapshot, write_status_document
from headway.sources.tables import (
    empty_table,
    of_feed,
    of_feeds,
    read_checked,
    read_feeds,
    read_table,
    write_feed_table,
)
from headway.streaming.ingest import ingest_new_feeds, write_products
from headway.verify.star import AS_OF, FEEDS, feed_tables, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SEPARATOR = "|"


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def joined(name: str) -> Column:
    """A list as text."""
    return F.concat_ws(SEPARATOR, name).alias(name)


def key(*names: str) -> list[str]:
    return [*FEED, *names]


# Products


@query
def macro_stops(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    return products.macro_stops(t["trips"], t["routes"], t["stop_times"], t["stops"])


@query
def macro_stops_strict(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    df = products.macro_stops(t["trips"], t["routes"], t["stop_times"], t["stops"], strict=True)
    return df.select(*FEED, "trip_id", "stop_id", "stop_sequence", "stop_lat", "final_color")


@query
def macro_shapes(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    return products.macro(t["trips"], t["routes"], t["shapes"])


@query
def macro_no_shapes(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    return products.macro(t["trips"], t["routes"])


@query
def macro_short_ladder(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    df = products.macro(t["trips"], t["routes"], t["shapes"], keys.MACRO_LADDER)
    return df.groupBy(*FEED).agg(F.count("*").alias("n_rows"))


@query
def macro_row_totals(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    calls = products.macro_stops(t["trips"], t["routes"], t["stop_times"], t["stops"])
    return pre.row_totals(calls, t["routes"])


@query
def lines_by_stop(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    return products.stop_lines(t["trips"], t["routes"], t["stop_times"])


@query
def stop_line_pairs(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    named = products.named_trips(t["trips"], t["routes"])
    calls = joins.trip_calls(named, products.clean_stop_times(t["stop_times"]))
    return lines.stop_line_pairs(calls)


# Geometry


def _routed(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    trips = products.clean_trips(t["trips"])
    return products.routed_trips(trips, products.route_lookup(trips, t["routes"])), t["shapes"]


@query
def macro_shape_fallback(spark, sf_dir):
    df, shapes = _routed(spark, sf_dir)
    return geometry.shape_fallback(df, shapes)


@query
def macro_without_shapes(spark, sf_dir):
    df, shapes = _routed(spark, sf_dir)
    return geometry.without_shapes(df, shapes)


@query
def geometry_keys(spark, sf_dir):
    df, _ = _routed(spark, sf_dir)
    return geometry.geometry_keys(df)


@query
def shape_points(spark, sf_dir):
    df, shapes = _routed(spark, sf_dir)
    points = geometry.shape_points(geometry.geometry_keys(df), shapes)
    return points.groupBy(*key("shape_id", "final_color")).agg(
        F.count("*").alias("n_points"), F.max("shape_pt_sequence").alias("last_sequence")
    )


# Combos


def _combo_rows(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    trips = t["trips"].withColumn("trip_id", fn.clean_id("trip_id"))
    times = t["stop_times"].withColumn("trip_id", fn.clean_id("trip_id"))
    return cmb.combo_rows(trips, times), t["routes"], trips, times


@query
def combos(spark, sf_dir):
    rows, routes, *_ = _combo_rows(spark, sf_dir)
    return cmb.combos(rows, routes)


@query
def combo_rows(spark, sf_dir):
    return _combo_rows(spark, sf_dir)[0]


@query
def combo_shapes(spark, sf_dir):
    return cmb.combo_shapes(_combo_rows(spark, sf_dir)[0])


def _document_texts(nested):
    services = F.transform("group_data", lambda item: F.coalesce(item["service_id"], F.lit("-")))
    shapes = F.transform("group_data", lambda item: F.coalesce(item["shape_id"], F.lit("-")))
    return nested.select(
        *cmb.COMBO,
        "part",
        joined("unique_shape_ids"),
        joined("trip_ids"),
        "route_color",
        "has_stops",
        F.concat_ws(SEPARATOR, services).alias("services"),
        F.concat_ws(SEPARATOR, shapes).alias("shapes"),
        joined("group_columns"),
        F.aggregate("group_copies", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n_rows"),
    )


@query
def combo_documents(spark, sf_dir):
    rows, routes, *_ = _combo_rows(spark, sf_dir)
    return _document_texts(cmb.combo_documents(rows, routes, parts=4))


@query
def combo_json_round_trip(spark, sf_dir):
    rows, routes, *_ = _combo_rows(spark, sf_dir)
    nested = cmb.combo_documents(rows, routes, parts=4)
    path = shared_dir(spark, "combos")
    write_feed_table(nested, path, fmt="json")
    return _document_texts(spark.read.schema(nested.schema).json(path))


@query
def valid_routes(spark, sf_dir):
    return cmb.valid_routes(_combo_rows(spark, sf_dir)[0])


@query
def dropped_trips(spark, sf_dir):
    _, _, trips, times = _combo_rows(spark, sf_dir)
    return cmb.dropped_trips(trips, times)


@query
def preprocess_outcomes(spark, sf_dir):
    _, _, trips, times = _combo_rows(spark, sf_dir)
    tables = {**feed_tables(spark, sf_dir), "trips": trips, "stop_times": times}
    return pre.preprocess(tables, execution_id="exec-1").outcomes.drop("key_rung", "n_common_keys")


@query
def outcome_rungs(spark, sf_dir):
    return pre.preprocess(feed_tables(spark, sf_dir)).outcomes.select(*FEED, "key_rung", "n_common_keys")


@query
def preprocess_combos(spark, sf_dir):
    _, _, trips, times = _combo_rows(spark, sf_dir)
    tables = {**feed_tables(spark, sf_dir), "trips": trips, "stop_times": times}
    return pre.preprocess(tables).combos.groupBy(*FEED).agg(
        F.count("*").alias("n_combos"), F.sum("n_rows").alias("n_rows")
    )


# Column functions


@query
def safe_color(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    raw = F.expr(
        "CASE p_partkey % 7 WHEN 0 THEN upper(substr(md5(p_name), 1, 6)) "
        "WHEN 1 THEN ' #' || substr(md5(p_name), 1, 3) WHEN 2 THEN substr(md5(p_name), 1, 3) "
        "WHEN 3 THEN '##' || substr(md5(p_name), 1, 2) WHEN 4 THEN p_brand "
        "WHEN 5 THEN 'NaN' END"
    )
    return parts.select("p_partkey", fn.safe_color(raw).alias("final_color"))


@query
def combo_color(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    raw = F.expr(
        "CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN '#' || p_brand WHEN 2 THEN '' END"
    )
    return parts.select("p_partkey", fn.combo_color(raw).alias("route_color"))


@query
def id_normalise(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    padded = F.expr("chr(9) || ' Ab' || CAST(o_orderkey AS VARCHAR(20)) || chr(10) || ' '")
    return orders.select(
        "o_orderkey",
        fn.clean_id(padded).alias("clean"),
        fn.lower_id(padded).alias("lowered"),
        fn.or_empty(F.expr("CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END")).alias("filled"),
        fn.as_text("o_custkey").alias("customer"),
        fn.as_number(F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE '7' END")).alias("number"),
    )


@query
def zero_pad(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    raw = F.expr(
        "CASE p_partkey % 3 WHEN 0 THEN '-' WHEN 1 THEN '+' ELSE '' END "
        "|| CAST(p_size AS VARCHAR(10))"
    )
    return parts.select("p_partkey", fn.zfill(raw).alias("padded"), fn.zfill(raw, 5).alias("wide"))


@query
def strip_zeros(spark, sf_dir):
    raw = F.expr("repeat('0', p_size % 4) || CAST(p_partkey % 100 AS VARCHAR(10))")
    return table(spark, sf_dir, "part").select("p_partkey", fn.lstrip_zeros(raw).alias("stripped"))


@query
def stop_labels(spark, sf_dir):
    return table(spark, sf_dir, "stops").select(
        *key("stop_id"),
        fn.stop_label("stop_id").alias("stop_id_2"),
        fn.name_label("stop_name").alias("stop_name_2"),
        fn.route_trip_label("stop_id", "stop_name").alias("pair"),
    )


@query
def feed_paths(spark, sf_dir):
    run = table(spark, sf_dir, "ledger").select("id", *[F.col(k).alias(f) for f, k in zip(FEED, LEDGER_KEY)])
    path = fn.feed_path(F.lit("STOP_TIMES"), *FEED)
    return run.select(
        "id",
        fn.feed_id(*FEED).alias("label"),
        path.alias("path"),
        fn.output_path("MACRO_STOPS", *FEED).alias("product"),
        *[fn.path_part(path, name).alias(name) for name in FEED],
    )


@query
def row_maps(spark, sf_dir):
    routes = table(spark, sf_dir, "routes")
    as_json = fn.encode(fn.row_map("route_id", "route_short_name"))
    back = fn.decode(as_json, "struct<route_id: string, route_short_name: string>")
    return routes.select(
        *FEED, back["route_id"].alias("route_id"), back["route_short_name"].alias("short_name")
    )


# Columns and sets


@query
def conform_schema(spark, sf_dir):
    routes = table(spark, sf_dir, "routes").withColumn("shape_pt_sequence", F.col("route_id"))
    return columns.conform(routes, MACRO, strict=True, lead=FEED)


@query
def union_by_name(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    stops = t["stops"].select(*FEED, "stop_id", "stop_name")
    routes = t["routes"].select("route_id", *FEED)
    return columns.union_tables(stops, routes)


@query
def join_suffixed(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    left = t["routes"].withColumn("n", F.lit(1))
    right = t["routes"].select(*key("route_id", "route_color"))
    return columns.rename(
        joins.join_suffixed(left, right, key("route_id")), {"route_short_name": "short_name"}
    )


@query
def keep_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    twice = orders.select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("o_orderstatus"))
    return columns.keep_first(twice)


@query
def rows_with_names(spark, sf_dir):
    return columns.drop_null(table(spark, sf_dir, "routes"), ["route_short_name"])


@query
def rows_without_names(spark, sf_dir):
    return columns.missing_values(table(spark, sf_dir, "stops"), "stop_name").select(*key("stop_id"))


@query
def trips_of_routes(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    named = columns.drop_null(t["routes"], ["route_color"])
    trips = columns.only_routes(t["trips"], named.select(*key("route_id")))
    return columns.select_columns(trips, key("trip_id", "route_id"))


# Joins and keys


@query
def trips_with_routes(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    return joins.trips_with_routes(t["trips"], t["routes"])


@query
def calls_with_routes(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    calls = joins.calls_with_stops(joins.trip_calls(t["trips"], t["stop_times"]), t["stops"])
    named = joins.calls_with_routes(calls, t["routes"])
    return named.select(*key("trip_id", "stop_id", "route_id", "route_short_name", "stop_name"))


@query
def stops_with_lines(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    found = products.stop_lines(t["trips"], t["routes"], t["stop_times"])
    stops = t["stops"].withColumn("stop_id", fn.clean_id("stop_id"))
    return joins.with_lines(stops, found).select(*key("stop_id", "lines_by_stop"))


@query
def trips_with_stops(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    return joins.trips_with_stops(t["trips"], t["stop_times"])


@query
def repeated_routes(spark, sf_dir):
    return joins.repeated_routes(table(spark, sf_dir, "routes"))


@query
def route_attributes(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    trips = t["trips"].select(*key("trip_id", "route_id"))
    return joins.route_attributes(trips, t["routes"])


@query
def unmatched_routes(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    return keys.unmatched(t["trips"], t["routes"], key("route_id"))


@query
def key_overlap(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    profile = keys.key_overlap(t["trips"], t["routes"], "route_id")
    lists = ("sample_left", "sample_right")
    return profile.select(
        *[name for name in profile.columns if name not in lists], *[joined(name) for name in lists]
    )


@query
def key_choice(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    return keys.key_choice(t["trips"], t["routes"], "route_id")


@query
def resolve_keys(spark, sf_dir):
    t = feed_tables(spark, sf_dir)
    trips, routes = keys.resolve_keys(t["trips"], t["routes"], "route_id")
    return joins.trips_with_routes(trips, routes).select(*key("trip_id", "route_id", "route_color"))


# Listings, manifest and requests


@query
def listing_filter(spark, sf_dir):
    return checks.filter_listing(table(spark, sf_dir, "listing"))


@query
def listing_of_feed(spark, sf_dir):
    return checks.filter_listing(table(spark, sf_dir, "listing"), ("7", "1", "v_2"), ("STOPS", "TRIPS"))


@query
def listing_of_escaped_feed(spark, sf_dir):
    return checks.filter_listing(table(spark, sf_dir, "listing"), ("7", "1", "v:4"), ("STOPS", "TRIPS"))


@query
def listing_folders(spark, sf_dir):
    return checks.count_by_folder(checks.filter_listing(table(spark, sf_dir, "listing")))


@query
def feed_completeness(spark, sf_dir):
    found = checks.feed_completeness(table(spark, sf_dir, "listing"))
    return found.select(*FEED, joined("gtfs_types"), joined("missing_types"), "is_complete")


@query
def manifest(spark, sf_dir):
    found = discover.manifest_of(table(spark, sf_dir, "listing"), AS_OF)
    return found.withColumn("gtfs_types", joined("gtfs_types"))


@query
def manifest_summary(spark, sf_dir):
    found = discover.manifest_of(table(spark, sf_dir, "listing"), AS_OF)
    return discover.manifest_summary(found, AS_OF, "store")


@query
def requests_decode(spark, sf_dir):
    found = parse_requests(table(spark, sf_dir, "requests"), "request")
    return found.select("event_id", "position", "status_code", "P_EMPRESA", "P_CONTR", "P_VERSION", "P_LINE")


@query
def requests_round_trip(spark, sf_dir):
    named = F.concat_ws("-", "P_EMPRESA", "P_VERSION").alias("NOMBRE_EMPRESA")
    runs = format_requests(table(spark, sf_dir, "manifest").select("*", F.lit("es").alias("P_ENV"), named)).select("request")
    return parse_requests(runs, "request").select(*LEDGER_KEY, "P_ENV", "NOMBRE_EMPRESA", "status_code")


@query
def required_fields(spark, sf_dir):
    return checks.validate_required(table(spark, sf_dir, "manifest"))


# Ledger


def _ledger(spark, sf_dir):
    return columns.conform(table(spark, sf_dir, "ledger"), LEDGER)


@query
def ledger_register(spark, sf_dir):
    return led.register(table(spark, sf_dir, "manifest"), _ledger(spark, sf_dir), AS_OF)[0].select(
        "id", *LEDGER_KEY, "status", "retries", "registered_at", "reset_at", "error"
    )


@query
def ledger_outcomes(spark, sf_dir):
    return led.register(table(spark, sf_dir, "manifest"), _ledger(spark, sf_dir), AS_OF)[1]


@query
def outcome_tally(spark, sf_dir):
    outcomes = led.register(table(spark, sf_dir, "manifest"), _ledger(spark, sf_dir), AS_OF)[1]
    return led.outcome_tally(outcomes)


@query
def ledger_merge(spark, sf_dir):
    merged = led.merge_manifest(table(spark, sf_dir, "manifest"), _ledger(spark, sf_dir))
    return merged.select("id", *LEDGER_KEY, "status", "retries")


@query
def ledger_repair(spark, sf_dir):
    return led.repair(_ledger(spark, sf_dir), AS_OF)[0].select(
        "id", "status", "retries", "reset_at", "reset_reason"
    )


@query
def ledger_repair_actions(spark, sf_dir):
    return led.repair(_ledger(spark, sf_dir), AS_OF)[1].select("id", "action", "reason")


@query
def ledger_reset_failed(spark, sf_dir):
    return led.reset_failed(_ledger(spark, sf_dir), AS_OF).select(
        "id", "status", "retries", "reset_at", "last_updated", "message", "error"
    )


@query
def ledger_expire(spark, sf_dir):
    return led.expire(_ledger(spark, sf_dir), AS_OF).select("id", "status", "message", "last_updated")


@query
def ledger_job_fold(spark, sf_dir):
    states = table(spark, sf_dir, "job_states")
    return led.apply_job_states(_ledger(spark, sf_dir), states, AS_OF).select(
        "id", "status", "message", "macro_status", "macro_stops_status", "jobs_completed_at",
        "last_checked", "last_updated",
    )


@query
def ledger_updates(spark, sf_dir):
    changed = led.apply_updates(_ledger(spark, sf_dir), table(spark, sf_dir, "updates"))
    return changed.select("id", "status", "message", "error", "last_updated")


@query
def next_pending(spark, sf_dir):
    found = led.next_pending(_ledger(spark, sf_dir), 20).select("id", "status", "registered_at")
    return reports.ranked(found, F.col("registered_at").asc_nulls_first(), "id")


@query
def ledger_claim(spark, sf_dir):
    return led.claim(_ledger(spark, sf_dir), 7, AS_OF).select(
        "id", "status", "started_at", "execution_id"
    )


@query
def ledger_status_words(spark, sf_dir):
    return led.with_status(_ledger(spark, sf_dir), "failed", "preprocessed").select("id", "status")


# Reports


@query
def by_status(spark, sf_dir):
    return reports.by_status(_ledger(spark, sf_dir))


@query
def status_counts(spark, sf_dir):
    return reports.status_counts(_ledger(spark, sf_dir))


@query
def enterprise_summary(spark, sf_dir):
    return reports.enterprise_summary(_ledger(spark, sf_dir))


@query
def enterprises(spark, sf_dir):
    return reports.enterprises(_ledger(spark, sf_dir))


@query
def retry_stats(spark, sf_dir):
    return reports.retry_stats(_ledger(spark, sf_dir))


@query
def completion_pct(spark, sf_dir):
    return reports.completion_pct(_ledger(spark, sf_dir))


@query
def recent_runs(spark, sf_dir):
    return reports.ranked_recent(_ledger(spark, sf_dir)).select("id", "status", "started_at", "position")


@query
def failed_runs(spark, sf_dir):
    return reports.ranked_failed(_ledger(spark, sf_dir), 10).select("id", "last_updated", "message", "position")


@query
def errors_by_message(spark, sf_dir):
    return reports.errors_by_message(_ledger(spark, sf_dir))


@query
def error_runs(spark, sf_dir):
    return reports.error_runs(_ledger(spark, sf_dir))


@query
def detailed_report(spark, sf_dir):
    return reports.detailed_report(_ledger(spark, sf_dir)).select(
        "id", *LEDGER_KEY, "status", "retries", "started_at", "last_updated", "message"
    )


@query
def log_classes(spark, sf_dir):
    return logs.classify_log_events(table(spark, sf_dir, "logs"))


# Storage


def _store(spark, sf_dir, *names):
    """Write feed tables as CSV source folders and give their root."""
    root = shared_dir(spark, "feeds")
    for name in names:
        path = f"{root}/GTFS/{name.upper()}"
        if name == "agency":
            df = table(spark, sf_dir, "routes").select(*FEED).distinct()
            df = df.withColumn("agency_id", F.lit("A"))
        else:
            df = table(spark, sf_dir, name)
        write_feed_table(df, path, fmt="csv", n_feeds=len(FEEDS))
    return root


@query
def csv_round_trip(spark, sf_dir):
    return read_table(spark, _store(spark, sf_dir, "stops"), "stops")


@query
def parquet_round_trip(spark, sf_dir):
    path = shared_dir(spark, "trips")
    write_feed_table(table(spark, sf_dir, "trips"), path)
    return spark.read.parquet(path)


@query
def feeds_without_shapes(spark, sf_dir):
    root = _store(spark, sf_dir, "routes", "trips", "stop_times", "stops")
    found = read_feeds(spark, root, mixed_headers=False)
    shapes = found.get("shapes", empty_table(spark, "shapes"))
    kept = geometry.without_shapes(found["routes"], shapes)
    return kept.select(*FEED, *SOURCES["routes"].names)


@query
def discover_stored_feeds(spark, sf_dir):
    root = _store(spark, sf_dir, "agency", "routes", "trips", "stop_times", "stops")
    found = discover.discover_feeds(spark, root, AS_OF, exact_names=False)
    return found.withColumn("gtfs_types", joined("gtfs_types"))


@query
def ingest_feeds(spark, sf_dir):
    root = _store(spark, sf_dir, "agency", "routes", "trips", "stop_times", "stops", "shapes")
    target = shared_dir(spark, "products")
    handle = write_products(spark, root, target)
    stream = ingest_new_feeds(spark, root, shared_dir(spark, "stream"), handle, exact_names=False)
    stream.awaitTermination()
    calls = read_product(spark, f"{target}/MACRO_STOPS")
    return calls.select(*FEED, "trip_id", "stop_id", "stop_sequence", "lines_by_stop", "final_color")


@query
def ledger_round_trip(spark, sf_dir):
    path = shared_dir(spark, "ledger")
    write_ledger(_ledger(spark, sf_dir), path, "1")
    return read_ledger(spark, path, "1").select(
        "id", *LEDGER_KEY, "status", "retries", "started_at", "message"
    )


@query
def registration_audit(spark, sf_dir):
    outcomes = led.register(table(spark, sf_dir, "manifest"), _ledger(spark, sf_dir), AS_OF)[1]
    path = shared_dir(spark, "audit")
    append_audit(led.outcome_tally(outcomes), path, AS_OF, "manifest")
    return spark.read.json(path).select("timestamp", "summary.*", "combinations_file")


@query
def listed_files(spark, sf_dir):
    root = _store(spark, sf_dir, "routes")
    found = checks.with_feed_columns(list_files(spark, root))
    return found.select(*FEED, "gtfs_type").distinct()


def _broken_store(spark, sf_dir):
    """Feed tables of which one feed has a second routes file, some of whose rows have a field too many."""
    root = _store(spark, sf_dir, "routes", "trips", "stop_times", "stops", "shapes")
    extra = F.when(F.col("n_nationkey") % 5 == 0, ",extra").otherwise("")
    nations = table(spark, sf_dir, "nation")
    rows = nations.select(F.concat_ws(",", "n_nationkey", "n_name", F.concat(F.lit("AB12CD"), extra)).alias("value"), F.lit(1).alias("nth"))
    header = nations.agg(F.lit("route_id,route_short_name,route_color").alias("value"), F.lit(0).alias("nth"))
    one = rows.unionAll(header).coalesce(1).sortWithinPartitions("nth", "value")
    path = f"{root}/GTFS/ROUTES/explotation=1/contract=1/version=2025%3A04"
    one.select("value").write.mode("append").text(path)
    return root


@query
def read_errors(spark, sf_dir):
    return read_checked(spark, _broken_store(spark, sf_dir)).errors


@query
def checked_outcomes(spark, sf_dir):
    found = read_checked(spark, _broken_store(spark, sf_dir))
    done = pre.preprocess(found.tables, "run", found.errors).outcomes
    return done.select(*FEED, "status", "message", "n_routes")


def _redelivered(spark, sf_dir):
    """Trips in two commits, the second one written twice: its feeds have fewer rows or none."""
    path = shared_dir(spark, "product")
    trips = table(spark, sf_dir, "trips")
    commit_product(trips, trips, path, 0)
    again = trips.where("explotation = '1'")
    for _ in range(2):
        commit_product(again.where("contract = '2' AND trip_id LIKE '%1'"), again, path, 1)
    return path


@query
def redelivered_product(spark, sf_dir):
    return read_product(spark, _redelivered(spark, sf_dir))


@query
def product_manifest(spark, sf_dir):
    return product_commits(spark, _redelivered(spark, sf_dir)).select(*FEED, "commit", "n_rows")


def _stored_trips(spark, sf_dir):
    path = shared_dir(spark, "trips")
    write_feed_table(table(spark, sf_dir, "trips"), path)
    return spark.read.parquet(path)


@query
def stored_feed(spark, sf_dir):
    return of_feed(_stored_trips(spark, sf_dir), "1", "1", "2025:04")


@query
def stored_feeds(spark, sf_dir):
    feeds = table(spark, sf_dir, "routes").where("contract = '2'")
    return of_feeds(_stored_trips(spark, sf_dir), feeds)


def _claims(spark, sf_dir):
    """A ledger of which two callers, one after the other, have claimed seven runs; and the second's."""
    path = shared_dir(spark, "snapshots")
    commit_snapshot(_ledger(spark, sf_dir), path, 0, AS_OF)
    claim_runs(spark, path, 7, AS_OF)
    return path, claim_runs(spark, path, 7, AS_OF)


@query
def claimed_twice(spark, sf_dir):
    return read_snapshot(spark, _claims(spark, sf_dir)[0]).select("id", "status", "execution_id")


@query
def claimed_runs(spark, sf_dir):
    return _claims(spark, sf_dir)[1].select("id", *LEDGER_KEY, "execution_id")


def _document(spark, sf_dir):
    path = shared_dir(spark, "document")
    write_status_document(_ledger(spark, sf_dir), path, AS_OF)
    return path


@query
def ledger_document(spark, sf_dir):
    return read_status_document(spark, _document(spark, sf_dir)).select(
        "id", *LEDGER_KEY, "status", "retries", "started_at", "message"
    )


@query
def document_counters(spark, sf_dir):
    return spark.read.json(_document(spark, sf_dir)).drop("combinations")


@query
def written_manifest(spark, sf_dir):
    path = shared_dir(spark, "manifest")
    discover.write_manifest(discover.manifest_of(table(spark, sf_dir, "listing"), AS_OF), path, AS_OF, "store")
    entries = spark.read.schema("id string, P_EMPRESA string, P_CONTR string, P_VERSION string, status string, discovery_time string, gtfs_types array<string>").json(f"{path}/combinations")
    return entries.withColumn("gtfs_types", joined("gtfs_types"))


@query
def written_reports(spark, sf_dir):
    path = shared_dir(spark, "reports")
    reports.write_reports(_ledger(spark, sf_dir), path)
    return spark.read.json(f"{path}/errors/by_message")


_COUNTED = ("route_id", "trip_id", "shape_id")


@query
def distinct_keys(spark, sf_dir):
    return keys.distinct_keys(table(spark, sf_dir, "trips"), _COUNTED)


@query
def sketch_estimates(spark, sf_dir):
    """Whether the estimate of sketches of two halves, put together, is within three of its errors."""
    trips = table(spark, sf_dir, "trips")
    odd = F.col("trip_id").rlike("[13579]$")
    parts = [keys.key_sketches(trips.where(half), _COUNTED) for half in (odd, ~odd)]
    merged = keys.merge_sketches(parts[0].unionAll(parts[1])).drop("sketch")
    found = keys.distinct_keys(trips, _COUNTED).join(merged, [*FEED, "key"])
    off = F.abs(F.col("estimate") - F.col("n_distinct"))
    return found.select(*FEED, "key", "n_distinct", (off <= F.greatest(F.lit(1), F.col("n_distinct") * 0.05)).alias("within"))
