"""Reads of some feeds, broken files, product commits and ledger snapshots."""

from __future__ import annotations

import threading

import pytest

from headway.operators import ledger as led, reports
from headway.operators.checks import feed_completeness, filter_listing
from headway.operators.keys import distinct_keys, key_sketches, merge_sketches
from headway.plans.preprocess import preprocess
from headway.schemas import FEED, LEDGER
from headway.sources.commits import commit_product, product_commits, read_product
from headway.sources.ledger_files import read_status_document
from headway.sources.snapshots import Conflict, claim_runs, commit_snapshot, latest, read_snapshot, snapshots, write_status_document
from headway.sources.tables import by_header, of_feeds, read_checked, read_table, write_feed_table
from headway.streaming.ingest import complete_feeds, folders_of, ingest_new_feeds, write_products
from tests.test_sources import put, put_feed

AS_OF = "2024-01-30T20:00:00"
ROUTES = "route_id,route_short_name,route_color\n"


def runs(spark, rows):
    """Pending runs as (id, contract, registered_at)."""
    full = [(i, "e", contract, "v", "pending", 0, at) for i, contract, at in rows]
    return spark.createDataFrame([(*r, *[None] * (len(LEDGER) - len(r))) for r in full], LEDGER)


def files_of(df):
    return {f.rsplit("/", 1)[0].split("GTFS/")[1] for f in df.inputFiles()}


def test_a_batch_reads_its_own_folders(spark, tmp_path):
    for feed in ("1", "2", "3"):
        put_feed(tmp_path, feed)
    path = str(tmp_path / "GTFS/ROUTES/explotation=2/contract=01/version=20250301_20250331/routes.txt")
    feeds = complete_feeds(spark, str(tmp_path), spark.createDataFrame([(path,)], "path string"))
    assert [r.explotation for r in feeds.collect()] == ["2"]
    folders = folders_of(feeds)
    assert set(folders) == {"AGENCY", "ROUTES", "TRIPS", "STOPS", "STOP_TIMES"}
    table = read_table(spark, str(tmp_path), "routes", folders=folders["ROUTES"])
    assert files_of(table) == {"ROUTES/explotation=2/contract=01/version=20250301_20250331"}
    assert [r.explotation for r in table.collect()] == ["2"]


def test_folders_with_pattern_signs(spark, tmp_path):
    put(tmp_path, "routes", "1", ROUTES + "a,b,c\n")
    odd = tmp_path / "GTFS/ROUTES/explotation=1/contract=01/version=a[1]{x}"
    odd.mkdir(parents=True)
    (odd / "routes.txt").write_text(ROUTES + "d,e,f\n")
    found = read_table(spark, str(tmp_path), "routes", folders=["explotation=1/contract=01/version=a[1]{x}"])
    assert [(r.version, r.route_id) for r in found.collect()] == [("a[1]{x}", "d")]


def test_headers_are_looked_up_in_one_job(spark, tmp_path):
    for feed in range(12):
        put(tmp_path, "routes", str(feed), (ROUTES if feed % 2 else "route_color,route_id,route_short_name\n") + "x,y,z\n" * 3000)
    put(tmp_path, "routes", "12", "")
    files = [str(p) for p in (tmp_path / "GTFS").rglob("*.txt")]
    frame = spark.createDataFrame([(f"file:{f}", f) for f in files], "path string, place string")
    found = by_header(spark, frame)
    assert {k: len(v) for k, v in found.items()} == {("route_id", "route_short_name", "route_color"): 6, ("route_color", "route_id", "route_short_name"): 6}
    assert by_header(spark, frame.limit(0)) == {}
    assert read_table(spark, str(tmp_path), "routes").count() == 12 * 3000


def test_one_broken_feed_is_one_error(spark, tmp_path):
    for feed in ("1", "2", "3"):
        put_feed(tmp_path, feed)
    put(tmp_path, "routes", "2", ROUTES + "007,10,001122\n008,11,001122,more\n009\n", name="second")
    put(tmp_path, "stops", "2", "stop_name,stop_id,stop_lat,stop_lon\nonly,two\n", name="second")
    tables, errors = read_checked(spark, str(tmp_path))
    found = {(r.explotation, r.table): (r.n_rows, r.example) for r in errors.collect()}
    assert found == {("2", "routes"): (2, "008,11,001122,more"), ("2", "stops"): (1, "only,two")}
    assert {name: {r.explotation for r in table.collect()} for name, table in tables.items()} == {
        name: {"1", "3"} for name in ("routes", "trips", "stop_times", "stops")
    }
    outcomes = {r.explotation: (r.status, r.message) for r in preprocess(tables, "x", errors).outcomes.collect()}
    assert outcomes["2"] == ("error", "Filas ilegibles en: routes, stops")
    assert set(outcomes) == {"1", "2", "3"} and outcomes["1"] == ("success", None)


def test_strict_reading_still_fails(spark, tmp_path):
    put(tmp_path, "routes", "1", ROUTES + "008,11,001122,more\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_table(spark, str(tmp_path), "routes").collect()


def test_ingest_empties_keeps_and_commits_again(spark, tmp_path):
    root, target = str(tmp_path / "in"), str(tmp_path / "out")
    handle, seen = write_products(spark, root, target), []

    def noted(feeds, batch_id):
        seen.append((feeds, batch_id))
        handle(feeds, batch_id)

    def run():
        ingest_new_feeds(spark, root, str(tmp_path / "checkpoint"), noted).awaitTermination()
        return sorted(r.explotation for r in read_product(spark, f"{target}/MACRO_STOPS").collect())

    for feed in ("1", "2", "3"):
        put_feed(tmp_path / "in", feed)
    assert run() == ["1", "2", "3"]
    # Delivered again: one feed without any call, one that cannot be read.
    put(tmp_path / "in", "agency", "2", "agency_id\nB\n", name="agency")
    put(tmp_path / "in", "stop_times", "2", "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n")
    put(tmp_path / "in", "agency", "3", "agency_id\nB\n", name="extra")
    put(tmp_path / "in", "routes", "3", ROUTES + "1,2,3,4,5\n", name="extra")
    put(tmp_path / "in", "agency", "2", "agency_id\nB\n", name="extra")
    assert run() == ["1", "3"]
    assert [r.explotation for r in spark.read.json(f"{target}/errors").where("batch = 1").collect()] == ["3"]
    feeds, batch_id = seen[-1]
    handle(feeds, batch_id)
    assert run() == ["1", "3"]
    assert product_commits(spark, f"{target}/MACRO_STOPS").where("commit = 1").select("explotation", "n_rows").collect() == [("2", 0)]


def test_a_commit_without_manifest_is_not_seen(spark, tmp_path):
    columns = "explotation string, contract string, version string, x int"
    path = str(tmp_path / "product")
    rows = spark.createDataFrame([("1", "1", "v:1", 1), ("2", "1", "v", 2)], columns)
    with pytest.raises(Exception):
        read_product(spark, path)
    commit_product(rows, rows, path, 0)
    write_feed_table(rows, f"{path}/data/commit=1")  # its writer was lost
    assert {(r.version, r.x) for r in read_product(spark, path).collect()} == {("v:1", 1), ("v", 2)}
    commit_product(rows.limit(0), rows.where("x = 1"), path, 1)
    assert [r.x for r in read_product(spark, path).collect()] == [2]
    commit_product(rows, rows.where("x = 1"), path, 2)  # rows of other feeds are left out
    assert {r.x for r in read_product(spark, path).collect()} == {1, 2}
    assert product_commits(spark, path).count() == 4


def test_few_feeds_are_written_without_a_shuffle(spark, tmp_path):
    rows = spark.range(0, 9000, 1, 3).selectExpr("CAST(id % 3 AS STRING) AS explotation", "'1' AS contract", "'v' AS version", "id")
    path = str(tmp_path / "product")
    shuffled = lambda n: len(list((tmp_path / f"t{n}").rglob("part-*.parquet")))
    for n in (None, 3, 100):
        write_feed_table(rows, str(tmp_path / f"t{n}"), n_feeds=n)
    assert [shuffled(n) for n in (None, 3, 100)] == [3, 9, 3]
    spark.createDataFrame([("0", "1", "v"), ("2", "1", "v"), ("7", "1", "v")], FEED_SCHEMA).write.parquet(str(tmp_path / "feeds"))
    commit_product(rows, spark.read.parquet(str(tmp_path / "feeds")), path, 0)
    assert len(list((tmp_path / "product/data").rglob("part-*.parquet"))) == 6  # two feeds, three tasks
    found = read_product(spark, path)
    assert sorted(r.id for r in found.collect()) == [i for i in range(9000) if i % 3 != 1]
    assert {(r.explotation, r.n_rows) for r in product_commits(spark, path).collect()} == {("0", 3000), ("2", 3000), ("7", 0)}


def test_feeds_are_pruned_at_run_time(spark, tmp_path, monkeypatch):
    columns = "explotation string, contract string, version string, x int"
    write_feed_table(spark.createDataFrame([(str(i), "1", "v", i) for i in range(6)], columns), str(tmp_path / "t"))
    feeds = spark.createDataFrame([("2", "1", "v"), ("9", "1", "v"), ("", "1", "v"), (None, "1", "v"), ("2", "1", "v")], FEED_SCHEMA)
    path = str(tmp_path / "feeds")
    feeds.write.parquet(path)
    found = of_feeds(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(path))
    assert [r.x for r in found.collect()] == [2]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    monkeypatch.setattr("headway.sources.tables.FEW_KEYS", 1)
    shuffled = of_feeds(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(path))
    assert [r.x for r in shuffled.collect()] == [2] and "BroadcastHint" not in shuffled._jdf.queryExecution().analyzed().toString()


FEED_SCHEMA = ", ".join(f"{name} string" for name in FEED)


def test_snapshots_form_a_chain(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert latest(spark, path) == 0 and read_snapshot(spark, path).count() == 0
    assert commit_snapshot(runs(spark, [("a", "1", AS_OF)]), path, 0, AS_OF) == 1
    assert commit_snapshot(runs(spark, [("a", "1", AS_OF), ("b", "2", AS_OF)]), path, 1, AS_OF) == 2
    with pytest.raises(Conflict):
        commit_snapshot(runs(spark, []), path, 1, AS_OF)
    assert [(r.snapshot, r.parent, r.n_runs) for r in snapshots(spark, path).orderBy("snapshot").collect()] == [(1, 0, 1), (2, 1, 2)]
    assert read_snapshot(spark, path).count() == 2 and read_snapshot(spark, path, 1).count() == 1
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path, 7)


def test_claimers_never_share_a_run(spark, tmp_path):
    path = str(tmp_path / "ledger")
    commit_snapshot(runs(spark, [(f"r{i:02d}", str(i), AS_OF) for i in range(10)]), path, 0, AS_OF)
    taken: list[list[str]] = []

    def work():
        taken.append([r.id for r in claim_runs(spark, path, 3, AS_OF).collect()])

    threads = [threading.Thread(target=work) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    ids = [i for found in taken for i in found]
    assert sorted(ids) == [f"r{i:02d}" for i in range(10)] and max(map(len, taken)) == 3
    assert latest(spark, path) == 5


def test_a_stale_claim_conflicts(spark, tmp_path, monkeypatch):
    """Both look at the same snapshot; the log's file decides."""
    path = str(tmp_path / "ledger")
    commit_snapshot(runs(spark, [("a", "1", AS_OF)]), path, 0, AS_OF)
    monkeypatch.setattr("headway.sources.snapshots.latest", lambda spark, path: 1)
    claimed = led.claim(read_snapshot(spark, path, 1), 1, AS_OF)
    assert commit_snapshot(claimed, path, 1, AS_OF) == 2
    with pytest.raises(Conflict):
        commit_snapshot(claimed, path, 1, AS_OF)


def test_claim_starts_at_most_n(spark):
    rows = runs(spark, [("a", "1", "2024-01-01T11:00:00+05:00"), ("b", "1", "2024-01-01T10:00:00Z"), ("c", "2", "2024-01-01T12:00:00Z"),
                        ("d", "3", AS_OF), ("d", "3", AS_OF), (None, "4", None)])
    started = lambda n: [r.id for r in led.claim(rows, n, AS_OF).where("status = 'processing'").orderBy("id").collect()]
    assert started(1) == ["a"]  # 06:00 comes before 10:00, whatever the text
    assert started(2) == ["a", "c"]  # b is the same feed as a
    assert started(9) == ["a", "c"]  # d has an id that occurs twice, one run has none
    assert led.claim(rows, 1, AS_OF).columns == rows.columns
    assert [r.id for r in led.next_pending(rows, 3).collect()] == [None, "a", "b"]


def test_reports_are_ordered_by_time(spark):
    rows = runs(spark, [(i, i, None) for i in "abc"])
    times = spark.createDataFrame([("a", "2024-01-01T10:00:00Z"), ("b", "2024-01-01T11:00:00+05:00"), ("c", "not a time")], "id string, at string")
    timed = rows.drop("started_at", "last_updated", "status").join(times, "id").selectExpr("*", "at AS started_at", "at AS last_updated", "'failed' AS status")
    assert [(r.id, r.position) for r in reports.ranked_recent(timed).orderBy("position").collect()] == [("a", 1), ("b", 2), ("c", 3)]
    assert [(r.id, r.position) for r in reports.ranked_failed(timed, 2).orderBy("position").collect()] == [("a", 1), ("b", 2)]


def test_status_document_keeps_counters_and_runs(spark, tmp_path):
    path = str(tmp_path / "status")
    write_status_document(runs(spark, [("a", "1", AS_OF), ("b", "2", None)]), path, AS_OF)
    row = spark.read.json(path).first()
    assert (row.total, row.pending, row.completed, row.last_updated) == (2, 2, 0, AS_OF)
    assert {r.id for r in read_status_document(spark, path).collect()} == {"a", "b"}


def test_a_document_of_many_runs_has_them_beside_it(spark, tmp_path):
    path = str(tmp_path / "status")
    some = [(f"r{i}", str(i), AS_OF) for i in range(7)] + [("r0", "0", AS_OF), (None, None, None)]
    write_status_document(runs(spark, some).repartition(3), path, AS_OF, most=8)
    documents = spark.read.json(path).collect()
    assert [(d.total, d.pending, d.last_updated, "combinations" in d) for d in documents] == [(9, 9, AS_OF, False)]
    assert len(list((tmp_path / "status/combinations").glob("part-*"))) > 1
    found = read_status_document(spark, path)
    assert found.columns == LEDGER.names
    assert sorted(str(r.id) for r in found.collect()) == sorted(str(i) for i, _, _ in some)
    # A shorter one leaves nothing of it.
    write_status_document(runs(spark, some[:2]), path, AS_OF, most=8)
    assert spark.read.json(path).first().total == 2 and read_status_document(spark, path).count() == 2
    assert not (tmp_path / "status/combinations").exists()


def test_escaped_versions_are_found(spark):
    paths = [f"s/GTFS/{kind}/explotation=1/contract=1/version=2025%3A01/{kind.lower()}.txt" for kind in ("AGENCY", "ROUTES", "STOPS", "STOP_TIMES", "TRIPS")]
    listing = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [(r.version, r.is_complete) for r in feed_completeness(listing).collect()] == [("2025:01", True)]
    assert filter_listing(listing, ("1", "1", "2025:01")).count() == 5
    assert filter_listing(listing, ("1", "1", "2025:1")).count() == 0


def test_sketches_merge(spark):
    rows = spark.range(60_000).selectExpr("'1' AS explotation", "CAST(id % 2 AS STRING) AS contract", "'v' AS version", "CAST(id % 20000 AS STRING) AS k", "CAST(NULL AS STRING) AS none")
    parts = [key_sketches(rows.where(f"CAST(k AS INT) % 3 = {i}"), ("k", "none")) for i in range(3)]
    by_feed = merge_sketches(parts[0].unionAll(parts[1]).unionAll(parts[2]))
    exact = {(r.contract, r.key): r.n_distinct for r in distinct_keys(rows, ("k", "none")).collect()}
    assert exact == {("0", "k"): 10_000, ("1", "k"): 10_000}
    assert all(abs(r.estimate - exact[(r.contract, r.key)]) < 0.05 * 10_000 for r in by_feed.collect())
    whole = merge_sketches(by_feed.drop("estimate"), ["key"]).first()
    assert abs(whole.estimate - 20_000) < 0.05 * 20_000
