"""Column functions on edge values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from headway import functions as fn


def apply(spark, function, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


COLORS = {
    None: "#000000",
    "": "#000000",
    "nan": "#000000",
    "NaN": "#000000",
    " nan ": "#000000",
    "FFF": "#ffffff",
    "#FFF": "#ffffff",
    "1a2": "#11aa22",
    "#AbC123": "#abc123",
    " 00ff00 ": "#00ff00",
    "001122": "#001122",
    "12345": "#000000",
    "1234567": "#000000",
    "gggggg": "#000000",
    "ggg": "#000000",
    "##ab": "###aabb",
    "##abcde": "##abcde",
    "###": "#000000",
    "ffffff\n": "#ffffff",
}


def test_safe_color(spark):
    assert dict(zip(COLORS, apply(spark, fn.safe_color, list(COLORS)))) == COLORS


def test_combo_color(spark):
    values = {None: "#1f77b4", "": "#1f77b4", "FFF": "#FFF", "#FFF": "#FFF", "xyz": "#xyz", " ": "# "}
    assert dict(zip(values, apply(spark, fn.combo_color, list(values)))) == values


@pytest.mark.parametrize("text", ["7", " 007 ", "\t7\n", " 7 ", "", "   ", "A b", "\x1f7\x85", "é ", None])
def test_clean_id_strips_like_text(spark, text):
    assert apply(spark, fn.clean_id, [text]) == [None if text is None else text.strip()]


def test_lower_id(spark):
    assert apply(spark, fn.lower_id, [" A1", "a1 ", None]) == ["a1", "a1", None]


@pytest.mark.parametrize("n", [3, 5])
def test_zfill(spark, n):
    values = ["7", "07", "1234", "", "-5", "+5", "-", "-1234", "a", "x-1"]
    assert apply(spark, lambda c: fn.zfill(c, n), values) == [v.zfill(n) for v in values]


def test_lstrip_zeros(spark):
    assert apply(spark, fn.lstrip_zeros, ["000", "007", "70", "", "-07"]) == ["", "7", "70", "", "-07"]


def test_as_number(spark):
    assert apply(spark, fn.as_number, ["7", "x", "", None, " 8 "]) == [7, None, None, None, 8]


def test_labels(spark):
    df = spark.createDataFrame([("1", "Main", "10", None), ("2", None, "A", "North")], "i string, n string, s string, h string")
    rows = df.select(
        fn.stop_label("i"), fn.name_label("n"), fn.route_trip_label("s", "h")
    ).collect()
    assert [tuple(r) for r in rows] == [("Id: 1", " Nombre: Main", "10"), ("Id: 2", None, "ANorth")]


def test_sorted_set_is_sorted_as_text(spark):
    df = spark.createDataFrame([("2",), ("10",), ("2",), (None,)], "v string")
    assert df.agg(fn.sorted_set("v").alias("s")).first().s == ["10", "2"]


TIMES = {
    "2024-01-30T10:00:00": "2024-01-30 10:00:00",
    "2024-01-30T10:00:00.123456": "2024-01-30 10:00:00.123456",
    "2024-01-30T10:00:00Z": "2024-01-30 10:00:00",
    "2024-01-30T10:00:00+02:00": "2024-01-30 08:00:00",
    "2024-01-30": "2024-01-30 00:00:00",
    "12:30": None,
    "2024-13-01T00:00:00": None,
    "soon": None,
    "": None,
    None: None,
}


def test_iso_time(spark):
    found = apply(spark, lambda c: fn.iso_time(c).cast("string"), list(TIMES))
    assert dict(zip(TIMES, found)) == TIMES


def test_older_than(spark):
    values = ["2024-01-30T10:00:00", "2024-01-30T12:00:00", "2024-01-30T13:00:00", "bad"]
    found = apply(spark, lambda c: fn.older_than(c, "2024-01-30T20:00:00", 8), values)
    assert found == [True, False, False, None]


def test_bump(spark):
    assert apply(spark, fn.bump, [None, 0, 4], "int") == [1, 1, 5]


@pytest.mark.parametrize(
    ("a", "b", "state"),
    [
        ("SUCCEEDED", "SUCCEEDED", "completed"),
        ("SUCCEEDED", "FAILED", "failed"),
        ("TIMEOUT", "STOPPED", "failed"),
        ("RUNNING", "FAILED", None),
        ("SUCCEEDED", "UNKNOWN", None),
    ],
)
def test_fold_states(spark, a, b, state):
    assert spark.range(1).select(fn.fold_states(F.lit(a), F.lit(b)).alias("s")).first().s == state


def test_paths(spark):
    df = spark.createDataFrame([("60", "1", "2025_03")], "e string, c string, v string")
    path = fn.feed_path(F.lit("STOP_TIMES"), "e", "c", "v")
    row = df.select(
        path.alias("path"),
        fn.output_path("MACRO", "e", "c", "v").alias("product"),
        fn.feed_id("e", "c", "v").alias("id"),
        fn.path_part(path, "version").alias("version"),
        fn.path_part(F.lit("GTFS/AGENCY/explotation=x1/"), "explotation").alias("no_number"),
    ).first()
    assert row.path == "GTFS/STOP_TIMES/explotation=60/contract=1/version=2025_03/stop_times.txt"
    assert row["product"] == "MAPS/MACRO/explotation=60/contract=1/version=2025_03/2025_03_macro"
    assert (row.id, row.version, row.no_number) == ("60_1_2025_03", "2025_03", "")


def test_path_parts_are_unescaped(spark):
    path = F.lit("GTFS/TRIPS/explotation=1/contract=2/version=2025%3A01+a%zz/trips.txt")
    plain = F.lit("GTFS/TRIPS/explotation=1/contract=2/version=2025%3A01+a/trips.txt")
    row = spark.range(1).select(fn.path_part(path, "version").alias("odd"), fn.path_part(plain, "version").alias("version")).first()
    assert row.version == "2025:01+a" and row.odd == "2025%3A01+a%zz"
