"""Key ladder and key profile."""

from __future__ import annotations

import pytest

from headway.operators.joins import trips_with_routes
from headway.operators.keys import (
    MACRO_LADDER,
    key_choice,
    key_overlap,
    lookup_for,
    resolve_keys,
    unmatched,
)

SCHEMA = "explotation string, contract string, version string, route_id string"
RUNGS = {
    # rung: (route ids of the trips, route ids of the routes, pairs that match under the rung)
    "exact": (["7", "A"], ["7", "a"], 1),
    "lower": ([" A", "b"], ["a", "B "], 2),
    "pad": (["007", "8"], ["7", "08"], 2),
    "strip": (["0000A", "12"], ["A", "x"], 1),
    "strip_lower": (["0000A"], ["a"], 1),
    "strip_lower_pad": (["0000-5"], ["-05"], 1),
    "none": (["T1"], ["R1"], 0),
}


def frames(spark, names):
    sides = []
    for side in (0, 1):
        rows = [(name, "1", "v", i) for name in names for i in RUNGS[name][side] + [None]]
        sides.append(spark.createDataFrame(rows, SCHEMA))
    return sides


@pytest.mark.parametrize("name", list(RUNGS))
def test_each_rung(spark, name):
    trips, routes = frames(spark, [name])
    row = key_choice(trips, routes, "route_id").first()
    assert row.rung == name
    rewritten = trips_with_routes(*resolve_keys(trips, routes, "route_id"))
    assert rewritten.count() == RUNGS[name][2]


def test_feeds_choose_on_their_own(spark):
    trips, routes = frames(spark, list(RUNGS))
    together = {r.explotation: r.rung for r in key_choice(trips, routes, "route_id").collect()}
    assert together == {name: name for name in RUNGS}


def test_short_ladder(spark):
    trips, routes = frames(spark, ["pad", "strip"])
    found = key_choice(trips, routes, "route_id", MACRO_LADDER).collect()
    assert {r.explotation: r.rung for r in found} == {"pad": "pad", "strip": "none"}


def test_lookup_equals_rewriting(spark):
    trips, routes = frames(spark, list(RUNGS))
    lookup = lookup_for(trips, routes, "route_id")
    keys = ["explotation", "contract", "version", "route_id"]
    direct = trips.join(lookup, keys).selectExpr(*keys[:3], "resolved AS route_id")
    rewritten = trips_with_routes(*resolve_keys(trips, routes, "route_id"))
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, rewritten.collect()))


def test_null_keys_never_match(spark):
    trips, routes = frames(spark, ["exact"])
    left, right = resolve_keys(trips, routes, "route_id")
    assert left.where("route_id IS NULL").count() == 1
    assert trips_with_routes(left, right).where("route_id IS NULL").count() == 0
    assert [r.route_id for r in unmatched(trips, routes, SCHEMA.replace(" string", "").split(", ")).collect()] == ["A"]


def test_key_overlap(spark):
    trips, routes = frames(spark, ["exact", "none"])
    rows = {r.explotation: r for r in key_overlap(trips, routes, "route_id").collect()}
    exact, none = rows["exact"], rows["none"]
    assert (exact.n_left, exact.n_right, exact.n_common, exact.n_only_left, exact.n_only_right) == (2, 2, 1, 1, 1)
    assert (exact.sample_left, exact.sample_right) == ([], [])
    assert (none.sample_left, none.sample_right) == (["T1"], ["R1"])
