"""The two products on small feeds."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from headway.plans.combos import combo_documents, combo_rows, combos
from headway.plans.preprocess import preprocess, row_totals
from headway.operators.joins import route_attributes
from headway.plans.products import macro, macro_stops
from headway.schemas import FEED, MACRO, MACRO_STOPS, SOURCES

FEEDS = {
    # Routes: r1 drawn by two shapes, r2 without points, r3 without trips, r4 without a name.
    "drawn": {
        "routes": [("r1", "10", "F00"), ("r2", "2", None), ("r3", "3", None), ("r4", None, None)],
        "trips": [
            ("r1", "t1", "s", "a", "North"),
            ("r1", "t2", "s", "a", "North"),
            ("r1", " t3", "s", " b ", None),
            ("r1", "t4", "s", None, "North"),
            ("r2", "t5", "s", "nowhere", "South"),
            ("r2", "t6", "s", "", "South"),
            ("r4", "t7", "s", "a", "West"),
            ("r9", "t8", "s", "a", "East"),
            (None, "t9", "s", "a", "East"),
        ],
        "stop_times": [
            ("t1", "x", "1", "25:00:00", "25:00:30"),
            ("t1", "x", "1", "25:00:00", "25:00:30"),
            ("t3 ", "x", "2", None, None),
            ("t5", " x", "3", None, None),
            ("t5", "y", "4", None, None),
            ("t7", "z", "1", None, None),
            ("t8", "x", "1", None, None),
            ("t1", "gone", "9", None, None),
            (None, "x", "9", None, None),
            ("t1", None, "9", None, None),
        ],
        "stops": [("x", 1.0, 2.0, 'Café, "B"'), ("y", 1.0, 2.0, None), ("z", 1.0, 2.0, "Z"), ("w", 1.0, 2.0, "W")],
        "shapes": [("a", 1.0, 1.0, 1), ("a", 1.0, 1.0, 2), ("b", 1.0, 1.0, 1), (None, 1.0, 1.0, 1)],
    },
    # No shapes at all: every trip stays as it is.
    "bare": {
        "routes": [("07", "7", "abc")],
        "trips": [("7", "t1", "s", "a", "North"), ("7", "t1", "s", "a", "North")],
        "stop_times": [("t1", "x", "1", None, None)],
        "stops": [("x", 0.0, 0.0, "X")],
        "shapes": [],
    },
}


def tables(spark, *feeds):
    found = {}
    for name in ("routes", "trips", "stop_times", "stops", "shapes"):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SOURCES[name].fields)
        rows = [(feed, "1", "v", *row) for feed in feeds for row in FEEDS[feed][name]]
        found[name] = spark.createDataFrame(rows, f"explotation string, contract string, version string, {columns}")
    return found


def macro_of(t):
    return macro(t["trips"], t["routes"], t["shapes"])


def stops_of(t, **options):
    return macro_stops(t["trips"], t["routes"], t["stop_times"], t["stops"], **options)


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_macro_of_a_drawn_feed(spark):
    df = macro_of(tables(spark, "drawn"))
    assert df.columns == [*FEED, *MACRO.names]
    points = df.where("shape_pt_sequence IS NOT NULL")
    assert bag(points.select("shape_id", "final_color", "route_short_name", "trip_headsign", "shape_pt_sequence")) == Counter({
        ("a", "#ff0000", "10", "North", 1): 1,
        ("a", "#ff0000", "10", "North", 2): 1,
        ("b", "#ff0000", "10", None, 1): 1,
        ("a", "#000000", None, "West", 1): 1,
        ("a", "#000000", None, "West", 2): 1,
    })
    basic = df.where("shape_pt_sequence IS NULL")
    assert bag(basic.select("route_id", "trip_id", "shape_id")) == Counter({("r2", "t5", "nowhere"): 1, ("r2", "t6", None): 1})


def test_macro_of_a_feed_without_shapes_keeps_copies(spark):
    df = macro_of(tables(spark, "drawn", "bare")).where("explotation = 'bare'")
    assert bag(df.select("route_id", "trip_id", "final_color", "route_color")) == Counter({("007", "t1", "#aabbcc", "abc"): 2})


def test_macro_without_a_shapes_table(spark):
    t = tables(spark, "drawn")
    df = macro(t["trips"], t["routes"])
    assert df.count() == 7
    assert df.where("shape_pt_lat IS NOT NULL").count() == 0


def test_macro_stops(spark):
    df = stops_of(tables(spark, "drawn"))
    assert df.columns == [*FEED, *MACRO_STOPS.names]
    got = bag(df.select("trip_id", "stop_id", "stop_sequence", "lines_by_stop", "route_sn_trip_hs", "stop_name_2"))
    cafe = ' Nombre: Café, "B"'
    assert got == Counter({
        ("t1", "x", "1", "10, 2", "10North", cafe): 2,
        ("t3", "x", "2", "10, 2", "10", cafe): 1,
        ("t5", "x", "3", "10, 2", "2South", cafe): 1,
        ("t5", "y", "4", "2", "2South", None): 1,
    })


def test_strict_casts_to_the_declared_types(spark):
    df = stops_of(tables(spark, "drawn"), strict=True)
    assert {f.name: f.dataType for f in df.schema.fields if f.name in MACRO_STOPS.names} == {
        f.name: f.dataType for f in MACRO_STOPS.fields
    }
    assert df.where("stop_sequence IS NULL").count() == 0
    assert df.where("stop_id IS NOT NULL").count() == 0


@pytest.mark.parametrize("build", [macro_of, stops_of])
def test_feeds_do_not_affect_each_other(spark, build):
    together = bag(build(tables(spark, "drawn", "bare")))
    assert together == bag(build(tables(spark, "drawn"))) + bag(build(tables(spark, "bare")))


@pytest.mark.parametrize("build", [macro_of, stops_of])
def test_result_does_not_depend_on_partitions(spark, build):
    t = tables(spark, "drawn", "bare")
    expected = bag(build(t))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert bag(build({name: df.repartition(5) for name, df in t.items()})) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_no_job_runs_while_a_product_is_built(spark):
    t = tables(spark, "drawn", "bare")
    context = spark.sparkContext
    context.setJobGroup("building", "products")
    try:
        built = [macro_of(t), stops_of(t), macro(t["trips"], t["routes"])]
        assert not list(context.statusTracker().getJobIdsForGroup("building"))
        assert all(df.columns for df in built)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_a_repeated_route_gives_one_row(spark):
    routes = spark.createDataFrame([("a", "1", "v", "r", "B", "00FF00"), ("a", "1", "v", "r", "A", "FF0000"), ("a", "2", "v", "r", "Z", None)], "explotation string, contract string, version string, route_id string, route_short_name string, route_color string")
    rows = routes.select(*FEED, "route_id").distinct()
    found = {(r.contract, r.route_short_name, r.route_color) for r in route_attributes(rows, routes).collect()}
    assert found == {("1", "A", "#FF0000"), ("2", "Z", "#1f77b4")}


def test_row_totals_name_feeds_without_output(spark):
    t = tables(spark, "drawn", "bare")
    calls = stops_of(t).where("explotation = 'drawn'")
    rows = {r.explotation: (r.n_rows, r.produced) for r in row_totals(calls, t["routes"]).collect()}
    assert rows == {"drawn": (5, True), "bare": (0, False)}


def test_combos(spark):
    t = tables(spark, "drawn")
    t["trips"] = t["trips"].withColumn("trip_id", F.trim("trip_id"))
    rows = combo_rows(t["trips"], t["stop_times"])
    found = {(r.route_id, r.trip_headsign): (r.n_rows, r.n_trips, r.n_shapes, r.route_color) for r in combos(rows, t["routes"]).collect()}
    assert found == {
        ("r1", "North"): (1, 1, 1, "#F00"),
        ("r2", "South"): (1, 1, 1, "#1f77b4"),
        ("r4", "West"): (1, 1, 1, "#1f77b4"),
        ("r9", "East"): (1, 1, 1, "#1f77b4"),
    }


def test_combo_documents_count_copies(spark):
    t = tables(spark, "bare")
    row = combo_documents(combo_rows(t["trips"], t["stop_times"]), t["routes"], parts=1).first()
    assert (row.part, row.unique_shape_ids, row.trip_ids, row.group_copies) == (0, ["a"], ["t1"], [2])
    assert row.group_data == [dict(route_id="7", trip_id="t1", service_id="s", shape_id="a", trip_headsign="North")]


def test_repeated_route_is_an_error_row(spark):
    t = tables(spark, "drawn", "bare")
    t["routes"] = t["routes"].union(t["routes"].where("explotation = 'bare'"))
    done = preprocess(t, execution_id="e1")
    status = {r.explotation: (r.status, r.has_shapes) for r in done.outcomes.collect()}
    assert status == {"drawn": ("success", True), "bare": ("error", None)}
    assert {r.explotation for r in done.combos.collect()} == {"drawn"}
