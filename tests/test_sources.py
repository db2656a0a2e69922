"""Files in, files out."""

from __future__ import annotations

import json

import pytest

from headway.operators.checks import feed_completeness
from headway.operators.ledger import outcome_tally, register
from headway.plans.discover import discover_feeds, write_manifest
from headway.schemas import LEDGER, REQUIRED_TYPES
from headway.sources.commits import read_product
from headway.sources.ledger_files import append_audit, read_ledger, read_status_document, write_ledger
from headway.sources.listing import list_files
from headway.sources.requests import parse_requests
from headway.sources.tables import of_feed, read_optional, read_table, write_feed_table
from headway.streaming.ingest import ingest_new_feeds, write_products

AS_OF = "2024-01-30T20:00:00"


def put(root, kind, feed, text, name=None):
    folder = root / "GTFS" / kind.upper() / f"explotation={feed}" / "contract=01" / "version=20250301_20250331"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name or kind.lower()}.txt").write_text(text, encoding="utf8")


def put_feed(root, feed):
    put(root, "agency", feed, "agency_id\nA\n")
    put(root, "routes", feed, "route_id,route_short_name,route_color\n007,10,001122\n")
    put(root, "trips", feed, "route_id,service_id,trip_id,trip_headsign,shape_id\n007,s,t1,North,a\n")
    put(root, "stops", feed, "stop_id,stop_name,stop_lat,stop_lon\n0x,Stop,1.5,2.5\n")
    put(root, "stop_times", feed, "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt1,25:00:00,25:00:30,0x,1\n")


def test_headers_may_differ_between_feeds(spark, tmp_path):
    put(tmp_path, "routes", "007", "route_id,route_short_name,route_color\n01,1,001122\n")
    put(tmp_path, "routes", "8", 'route_color,extra,route_id,route_short_name\nFFF,z,"a,b","q""q"\n')
    rows = read_table(spark, str(tmp_path), "routes").collect()
    assert {tuple(r) for r in rows} == {
        ("007", "01", "20250301_20250331", "01", "1", "001122"),
        ("8", "01", "20250301_20250331", "a,b", 'q"q', "FFF"),
    }


def test_another_header_in_the_same_feed_is_an_error(spark, tmp_path):
    put(tmp_path, "routes", "1", "route_id,route_short_name,route_color\n01,1,001122\n")
    put(tmp_path, "routes", "1", "route_color,route_id,route_short_name\nFFF,a,b\n", name="second")
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, str(tmp_path), "routes").collect()


def test_missing_column_is_an_error(spark, tmp_path):
    put(tmp_path, "routes", "1", "route_id\n1\n")
    with pytest.raises(ValueError, match="route_color"):
        read_table(spark, str(tmp_path), "routes")


def test_null_words_numbers_and_line_breaks(spark, tmp_path):
    put(tmp_path, "stops", "1", 'stop_id,stop_lat,stop_lon,stop_name\n1,x,2.5,"two\nlines"\nNA,1,2,nan\n')
    rows = {(r.stop_id, r.stop_lat, r.stop_lon, r.stop_name) for r in read_table(spark, str(tmp_path), "stops").collect()}
    assert rows == {("1", None, 2.5, "two\nlines"), (None, 1.0, 2.0, None)}


def test_optional_table(spark, tmp_path):
    put(tmp_path, "routes", "1", "route_id,route_short_name,route_color\n01,1,001122\n")
    shapes, found = read_optional(spark, str(tmp_path), "shapes")
    assert not found and shapes.isEmpty() and "shape_pt_lat" in shapes.columns
    assert read_optional(spark, str(tmp_path), "routes")[1]


def test_only_the_folder_of_a_feed_is_read(spark, tmp_path):
    for feed in ("1", "2"):
        put(tmp_path, "routes", feed, "route_id,route_short_name,route_color\n01,1,001122\n")
    df = of_feed(read_table(spark, str(tmp_path), "routes"), "2", "01", "20250301_20250331")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(explotation" in plan
    assert df.count() == 1


def test_writing_a_feed_leaves_the_others(spark, tmp_path):
    columns = "explotation string, contract string, version string, x int"
    path = str(tmp_path / "out")
    write_feed_table(spark.createDataFrame([("1", "1", "v", 1), ("02", "1", "v", 2)], columns), path)
    write_feed_table(spark.createDataFrame([("1", "1", "v", 3)], columns), path)
    assert {(r.explotation, r.x) for r in spark.read.parquet(path).collect()} == {("1", 3), ("02", 2)}


def test_discovery(spark, tmp_path):
    put_feed(tmp_path, "1")
    put_feed(tmp_path, "x2")
    put_feed(tmp_path, "3")
    (tmp_path / "GTFS/STOPS/explotation=3/contract=01/version=20250301_20250331/stops.txt").rename(
        tmp_path / "GTFS/STOPS/explotation=3/contract=01/version=20250301_20250331/other.txt"
    )
    put(tmp_path, "routes", "4", "route_id\n")
    found = discover_feeds(spark, str(tmp_path), AS_OF).collect()
    assert [(r.id, r.gtfs_types) for r in found] == [("1_01_20250301_20250331", sorted(REQUIRED_TYPES))]
    judged = feed_completeness(list_files(spark, str(tmp_path))).collect()
    assert {r.explotation: r.missing_types for r in judged} == {"1": [], "3": ["STOPS"]}
    loose = discover_feeds(spark, str(tmp_path), AS_OF, exact_names=False)
    assert {r.P_EMPRESA for r in loose.collect()} == {"1", "3"}


def test_ledger_round_trip(spark, tmp_path):
    put_feed(tmp_path, "1")
    found = discover_feeds(spark, str(tmp_path), AS_OF)
    write_manifest(found, str(tmp_path / "manifest"), AS_OF, "store")
    assert spark.read.json(str(tmp_path / "manifest/summary")).first().total == 1

    (tmp_path / "status.json").write_text(json.dumps({"total": 1, "combinations": [{"id": "9_1_v", "P_EMPRESA": "9", "P_CONTR": "1", "P_VERSION": "v", "status": "failed", "retries": 2}]}))
    before = read_status_document(spark, str(tmp_path / "status.json"))
    after, outcomes = register(found, before, AS_OF)
    write_ledger(after, str(tmp_path / "ledger"), "1")
    with pytest.raises(Exception, match="(?i)exists"):
        write_ledger(after, str(tmp_path / "ledger"), "1")
    kept = read_ledger(spark, str(tmp_path / "ledger"), "1")
    assert kept.columns == LEDGER.names
    assert {(r.P_EMPRESA, r.status, r.retries) for r in kept.collect()} == {("9", "failed", 2), ("1", "pending", 0)}
    for _ in range(2):
        append_audit(outcome_tally(outcomes), str(tmp_path / "audit"), AS_OF, "manifest")
    assert [r.summary.registered for r in spark.read.json(str(tmp_path / "audit")).collect()] == [1, 1]


def test_requests(spark):
    body = json.dumps({"P_EMPRESA": "60", "P_CONTR": "1", "P_VERSION": "20250301_20250331", "P_LINE": "29"})
    item = {"statusCode": 200, "body": body}
    shapes = [item, [item, item], [[item]], json.loads(body)]
    df = spark.createDataFrame([(i, json.dumps(s)) for i, s in enumerate(shapes)], "i int, request string")
    rows = parse_requests(df, "request").collect()
    assert sorted((r.i, r.position, r.status_code) for r in rows) == [(0, 0, 200), (1, 0, 200), (1, 1, 200), (2, 0, 200), (3, 0, None)]
    assert {(r.P_EMPRESA, r.P_VERSION, r.P_LINE, r.P_ENV) for r in rows} == {("60", "20250301_20250331", "29", None)}


def test_ingest_hands_on_new_feeds_only(spark, tmp_path):
    root, target = str(tmp_path / "in"), str(tmp_path / "out")
    seen = []
    products = write_products(spark, root, target)

    def handle(feeds, batch_id):
        seen.append(sorted(r.explotation for r in feeds.collect()))
        products(feeds, batch_id)

    def run():
        ingest_new_feeds(spark, root, str(tmp_path / "checkpoint"), handle).awaitTermination()

    put_feed(tmp_path / "in", "1")
    put(tmp_path / "in", "agency", "2", "agency_id\nA\n")
    run()
    put_feed(tmp_path / "in", "2")
    run()
    run()
    assert seen == [["1"], ["2"]]
    calls = read_product(spark, f"{target}/MACRO_STOPS")
    assert {(r.explotation, r.route_id, r.stop_id, r.final_color) for r in calls.collect()} == {
        ("1", "007", "0x", "#001122"),
        ("2", "007", "0x", "#001122"),
    }
