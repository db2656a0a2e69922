"""Plans under a key that holds much of a table."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from headway.operators.geometry import shape_points
from headway.operators.joins import trips_with_stops
from headway.operators.keys import key_overlap
from headway.plans.combos import combo_documents, combo_rows, combos
from headway.plans.products import macro, macro_stops, stop_lines
from headway.schemas import FEED

def feed_literals():
    return [F.lit(v).alias(n) for n, v in zip(FEED, ("1", "1", "v"))]


@contextmanager
def settings(spark, **values):
    values = {"spark.sql." + name.replace("__", "."): str(v) for name, v in values.items()}
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def small_partitions(spark):
    """Let a few kilobytes count as large, and keep small sides from being broadcast."""
    return settings(
        spark,
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__advisoryPartitionSizeInBytes="20k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="30k",
        adaptive__skewJoin__skewedPartitionFactor="2.0",
        adaptive__coalescePartitions__parallelismFirst="false",
        shuffle__partitions="20",
        files__openCostInBytes="1",
        files__maxPartitionBytes="32k",
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Half of the calls at one stop, a third of them in one trip, most trips on one route."""
    n = 30_000
    hot = F.col("id") % 3 == 0
    times = spark.range(0, n, 1, 16).select(
        *feed_literals(),
        F.when(hot, "t0").otherwise(F.concat(F.lit("t"), (F.col("id") % 2000).cast("string"))).alias("trip_id"),
        F.when(F.col("id") % 2 == 0, "s0").otherwise(F.concat(F.lit("s"), (F.col("id") % 997).cast("string"))).alias("stop_id"),
        F.col("id").cast("string").alias("stop_sequence"),
        F.lit("10:00:00").alias("arrival_time"),
        F.md5(F.col("id").cast("string")).alias("departure_time"),
    )
    trips = spark.range(0, 2000, 1, 8).select(
        *feed_literals(),
        F.when(F.col("id") % 3 > 0, "r0").otherwise(F.concat(F.lit("r"), (F.col("id") % 50).cast("string"))).alias("route_id"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("trip_id"),
        F.lit("x").alias("service_id"),
        (F.col("id") % 7).cast("string").alias("shape_id"),
        F.lit("north").alias("trip_headsign"),
    )
    routes = spark.range(50).select(
        *feed_literals(),
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("route_id"),
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("route_short_name"),
        F.lit("ff0000").alias("route_color"),
    )
    stops = spark.range(997).select(
        *feed_literals(),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("stop_id"),
        F.lit(1.0).alias("stop_lat"),
        F.lit(2.0).alias("stop_lon"),
        F.lit("name").alias("stop_name"),
    )
    shapes = spark.range(0, 20_000, 1, 16).select(
        *feed_literals(),
        F.when(F.col("id") % 2 == 0, "0").otherwise((F.col("id") % 7).cast("string")).alias("shape_id"),
        F.rand(1).alias("shape_pt_lat"),
        F.rand(2).alias("shape_pt_lon"),
        F.col("id").alias("shape_pt_sequence"),
    )
    frames = {"stop_times": times, "trips": trips, "routes": routes, "stops": stops, "shapes": shapes}
    # Stored in several files, so that a partition can be split by the tasks that read them.
    root = tmp_path_factory.mktemp("skewed")
    for name, frame in frames.items():
        frame.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in frames}


def test_hot_stop_and_hot_trip_are_split(spark, skewed):
    t = skewed
    expected = macro_stops(t["trips"], t["routes"], t["stop_times"], t["stops"]).count()
    with small_partitions(spark):
        df = macro_stops(t["trips"], t["routes"], t["stop_times"], t["stops"])
        rows, plan = final_plan(df)
    assert plan.count("skew=true") >= 2, plan
    assert len(rows) == expected == 30_000


def test_hot_shape_is_split(spark, skewed):
    t = skewed
    expected = macro(t["trips"], t["routes"], t["shapes"]).count()
    with small_partitions(spark):
        rows, plan = final_plan(macro(t["trips"], t["routes"], t["shapes"]))
    assert "skew=true" in plan
    assert len(rows) == expected


def test_copies_of_one_trip_row_are_split_in_a_semi_join(spark, skewed):
    copies = spark.range(0, 60_000, 1, 16).select(
        *feed_literals(),
        F.when(F.col("id") % 3 > 0, "t0").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("trip_id"),
        F.md5((F.col("id") % 3).cast("string")).alias("service_id"),
    )
    with small_partitions(spark):
        rows, plan = final_plan(trips_with_stops(copies, skewed["stop_times"]))
    assert "skew=true" in plan
    assert sum(r.trip_id == "t0" for r in rows) == 40_001


def test_lines_drop_repeats_before_the_shuffle(spark, skewed):
    t = skewed
    df = stop_lines(t["trips"], t["routes"], t["stop_times"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pairs = [
        line
        for line in plan.splitlines()
        if " HashAggregate(" in line and "stop_id" in line and "route_short_name" in line
    ]
    # Once before the shuffle and once after it.
    assert len(pairs) == 2
    result = stop_lines(t["trips"], t["routes"], t["stop_times"])
    hot = result.where("stop_id = 's0'").first().lines_by_stop.split(", ")
    assert hot == sorted(set(hot)) and len(hot) > 10


def test_combo_documents_are_cut_into_bounded_parts(spark, skewed):
    rows = combo_rows(skewed["trips"], skewed["stop_times"])
    parts = combo_documents(rows, skewed["routes"], parts=16)
    sizes = parts.select("part", F.size("group_data").alias("n"), "route_id").collect()
    assert sum(r.n for r in sizes) == rows.count()
    assert {r.part for r in sizes} <= set(range(16))
    whole = {r.route_id: r.n_trips for r in combos(rows, skewed["routes"]).collect()}
    hot = [r for r in sizes if r.route_id == "r0"]
    assert whole["r0"] == sum(r.n for r in hot)
    assert len(hot) == 16 and max(r.n for r in hot) < whole["r0"] / 8


def test_key_samples_are_cut_before_the_shuffle(spark, skewed):
    df = key_overlap(skewed["trips"], skewed["stop_times"], "trip_id")
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def stored_scans(plan, path):
    """Scans of a stored table in a final plan; one that is used again shows as a reused exchange."""
    final = plan.split("== Initial Plan ==")[0]
    return sum("FileScan" in line and path in line for line in final.splitlines())


def test_stop_times_are_read_once(spark, skewed):
    t = skewed
    with small_partitions(spark):
        df = macro_stops(t["trips"], t["routes"], t["stop_times"], t["stops"])
        rows, plan = final_plan(df)
    assert "isFinalPlan=true" in plan and stored_scans(plan, "/stop_times]") == 1, plan
    assert plan.split("== Initial Plan ==")[0].count("ReusedExchange") >= 1
    lines = {r.stop_id: r.lines_by_stop for r in rows}
    assert lines == {r.stop_id: r.lines_by_stop for r in stop_lines(t["trips"], t["routes"], t["stop_times"]).collect()}


def test_shapes_are_read_for_ids_and_for_points(spark, skewed):
    t = skewed
    with small_partitions(spark):
        _, plan = final_plan(macro(t["trips"], t["routes"], t["shapes"]))
    assert stored_scans(plan, "/shapes]") == 2, plan


def test_points_that_are_small_on_storage_are_not_broadcast(spark, skewed):
    keys = spark.range(1_000_000).select(
        *feed_literals(),
        (F.col("id") % 7).cast("string").alias("shape_id"),
        F.lit("#ff0000").alias("final_color"),
        F.lit("L").alias("route_short_name"),
        (F.col("id") % 3).cast("string").alias("trip_headsign"),
    ).distinct()
    points = skewed["shapes"]
    with settings(spark, autoBroadcastJoinThreshold="8MB"):
        df = shape_points(keys, points)
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan and "BroadcastExchange" not in plan, plan
    per_shape = {r.shape_id: r["count"] for r in points.groupBy("shape_id").count().collect()}
    assert df.count() == 3 * sum(per_shape.values())
