"""State changes and reports of the run ledger."""

from __future__ import annotations

from headway.operators import ledger as led, reports
from headway.operators.checks import require_nonempty, validate_required
from headway.operators.columns import conform
from headway.schemas import LEDGER, LEDGER_KEY

import pytest
from pyspark.sql import functions as F

AS_OF = "2024-01-30T20:00:00"
COLUMNS = "id string, P_EMPRESA string, P_CONTR string, P_VERSION string, status string, retries int, started_at string, message string, error string"


def ledger(spark, rows):
    """Rows of (name, status, retries, started_at, message, error)."""
    full = [(name, name, "1", "v_1", *rest) for name, *rest in rows]
    return conform(spark.createDataFrame(full, COLUMNS), LEDGER)


def manifest(spark, *names):
    return spark.createDataFrame([(n, "1", "v_1") for n in names], "P_EMPRESA string, P_CONTR string, P_VERSION string")


def states(df, *columns):
    return {r.P_EMPRESA: tuple(r[c] for c in columns) for r in df.collect()}


ROWS = [
    ("new", "pending", 0, None, None, None),
    ("early", "preprocessing", None, "2024-01-30T13:00:00", None, None),
    ("stuck", "processing", 1, "2024-01-30T11:00:00", None, "e"),
    ("bad", "processing", 2, "soon", None, None),
    ("zulu", "processing", 2, "2024-01-30T19:00:00Z", None, None),
    ("timeless", "preprocessing", 0, None, None, None),
    ("done", "completed", 0, "2024-01-01T00:00:00", None, None),
    ("broken", "failed", None, "2024-01-29T00:00:00", "m", "e"),
    ("odd", "zombie", 0, None, None, "e"),
    ("half", "preprocessed", 0, None, None, None),
]


def test_register(spark):
    before = ledger(spark, ROWS)
    after, outcomes = led.register(manifest(spark, "new", "broken", "odd", "early", "half", "fresh", "fresh", "", None), before, AS_OF)
    assert states(outcomes, "result", "repeats") == {
        "new": ("skipped", 0),
        "broken": ("reset", 0),
        "odd": ("reset", 0),
        "early": ("reset", 0),
        "half": ("reset", 0),
        "fresh": ("registered", 1),
        "": ("error", 0),
        None: ("error", 0),
    }
    found = states(after, "status", "retries", "error")
    assert found["broken"] == ("pending", 1, None)
    assert found["odd"] == ("pending", 1, "e")
    assert found["early"] == ("pending", 1, None)
    assert found["fresh"] == ("pending", 0, None)
    assert found["stuck"] == ("processing", 1, "e")
    tally = led.outcome_tally(outcomes).first().asDict()
    assert tally == {"registered": 1, "reset": 4, "skipped": 2, "errors": 2}


def test_registering_twice_skips_all(spark):
    entries = manifest(spark, "a", "b")
    after, _ = led.register(entries, ledger(spark, []), AS_OF)
    again, outcomes = led.register(entries, after, AS_OF)
    assert {r.result for r in outcomes.collect()} == {"skipped"}
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, after.collect()))


def test_repair(spark):
    faulty = ROWS + [("", "processing", 0, None, None, None), (None, "completed", 0, None, None, None)]
    after, actions = led.repair(ledger(spark, faulty), AS_OF)
    assert states(actions, "action", "reason") == {
        "stuck": ("reset", "Estado processing por más de 8h"),
        "bad": ("reset", "Timestamp started_at inválido"),
        "timeless": ("reset", "Estado preprocessing sin timestamp"),
        "half": ("reset", "Estado preprocessed sin timestamp"),
        "odd": ("deleted", "Estado desconocido: zombie"),
        "": ("reset", "Falta campo P_EMPRESA"),
        None: ("deleted", "Falta campo P_EMPRESA"),
    }
    found = states(after, "status", "retries", "reset_at")
    assert found["stuck"] == ("pending", 2, AS_OF)
    assert found["early"] == ("preprocessing", None, None)
    assert found["zulu"] == ("processing", 2, None)
    assert "odd" not in found and None not in found


def test_repair_settles(spark):
    once, _ = led.repair(ledger(spark, ROWS), AS_OF)
    twice, actions = led.repair(once, AS_OF)
    assert actions.count() == 0
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_reset_failed(spark):
    found = states(led.reset_failed(ledger(spark, ROWS), AS_OF), "status", "retries", "message", "error", "last_updated")
    assert found["broken"] == ("pending", 1, None, None, AS_OF)
    assert found["stuck"] == ("processing", 1, None, "e", None)


def test_expire(spark):
    found = states(led.expire(ledger(spark, ROWS), AS_OF, since="started_at"), "status", "message")
    assert found["stuck"] == ("failed", "Timeout después de 4 horas de ejecución")
    assert found["zulu"] == ("processing", None)
    assert found["bad"] == ("processing", None)
    assert found["early"] == ("preprocessing", None)


def test_job_states(spark):
    jobs = spark.createDataFrame(
        [("stuck", "1", "v_1", "SUCCEEDED", "SUCCEEDED"), ("bad", "1", "v_1", "SUCCEEDED", "TIMEOUT"), ("done", "1", "v_1", "FAILED", "FAILED")],
        "P_EMPRESA string, P_CONTR string, P_VERSION string, macro string, macro_stops string",
    )
    found = states(led.apply_job_states(ledger(spark, ROWS), jobs, AS_OF), "status", "message", "jobs_completed_at", "last_checked")
    assert found["stuck"] == ("completed", None, AS_OF, None)
    assert found["bad"] == ("failed", "Macro: SUCCEEDED, MacroStops: TIMEOUT", AS_OF, None)
    assert found["zulu"] == ("processing", None, None, AS_OF)
    assert found["done"] == ("completed", None, None, None)


def test_latest_update_counts(spark):
    updates = spark.createDataFrame(
        [("new", "1", "v_1", "failed", "late", None, "2024-01-02"), ("new", "1", "v_1", "completed", "early", None, "2024-01-01"), ("stuck", "1", "v_1", "failed", "", "", "2024-01-01")],
        "P_EMPRESA string, P_CONTR string, P_VERSION string, status string, message string, error string, updated_at string",
    )
    found = states(led.apply_updates(ledger(spark, ROWS), updates), "status", "message", "error", "last_updated")
    assert found["new"] == ("failed", "late", None, "2024-01-02")
    assert found["stuck"] == ("failed", None, "e", "2024-01-01")
    assert found["done"] == ("completed", None, None, None)


def test_claim(spark):
    many = ledger(spark, [(f"p{i}", "pending", 0, None, None, None) for i in range(5)] + ROWS[6:])
    after = led.claim(many, 2, AS_OF)
    found = states(after, "status", "started_at", "execution_id")
    claimed = {name for name, row in found.items() if row[0] == "processing"}
    assert claimed == {"p0", "p1"}
    assert found["p0"] == ("processing", AS_OF, "run-p0-20240130200000")
    assert after.count() == many.count()


def test_reports(spark):
    rows = ledger(spark, ROWS)
    counts = reports.status_counts(rows).first()
    assert (counts.total, counts.pending, counts.processing, counts.failed) == (10, 1, 3, 1)
    pct = reports.completion_pct(rows).first()
    assert (pct.completion_percentage, pct.progress) == (10.0, 10)
    retries = reports.retry_stats(rows).first()
    assert (retries.total_retries, retries.items_with_retries, retries.max_retries) == (5, 3, 2)
    assert [r.id for r in reports.failed_runs(rows).collect()] == ["broken"]
    assert [tuple(r) for r in reports.errors_by_message(rows).collect()] == [("m", 1)]


def test_reports_of_an_empty_ledger(spark):
    rows = ledger(spark, [])
    assert reports.status_counts(rows).first().total == 0
    assert reports.completion_pct(rows).first().completion_percentage == 0.0
    assert tuple(reports.retry_stats(rows).first()) == (0, 0, 0)


def test_reports_are_written(spark, tmp_path):
    reports.write_reports(ledger(spark, ROWS), str(tmp_path))
    assert spark.read.json(f"{tmp_path}/detailed").count() == len(ROWS)
    assert spark.read.json(f"{tmp_path}/summary/status_counts").first().total == len(ROWS)


def test_required_fields(spark):
    rows = validate_required(manifest(spark, "a", "", None), LEDGER_KEY).collect()
    assert {r.P_EMPRESA: (r.is_valid, r.message) for r in rows} == {
        "a": (True, ""),
        "": (False, "Campo P_EMPRESA está vacío"),
        None: (False, "Campo requerido P_EMPRESA no encontrado"),
    }


def test_require_nonempty(spark):
    with pytest.raises(ValueError, match="nothing"):
        require_nonempty(ledger(spark, []), "nothing")


def test_file_states_are_in_flight(spark):
    old = "2020-01-01T00:00:00"
    before = ledger(spark, [(s, s, 0, old, None, None) for s in ("preprocessed", "processing_macro", "processing_macro_stops")])
    after, actions = led.repair(before, AS_OF)
    assert {r.status for r in after.collect()} == {"pending"} and actions.count() == 3
    entries = manifest(spark, "preprocessed", "processing_macro", "processing_macro_stops")
    assert {r.result for r in led.register(entries, before, AS_OF)[1].collect()} == {"reset"}
    late = states(led.expire(before, AS_OF, since="started_at"), "status")
    assert late["processing_macro"] == ("failed",) and late["preprocessed"] == ("preprocessed",)


def test_merge_twice_is_merge_once(spark):
    entries = manifest(spark, "new", "fresh", "", None)
    once = led.merge_manifest(entries, ledger(spark, ROWS))
    assert once.count() == led.merge_manifest(entries, once).count()


def test_runs_without_a_key_do_not_block_the_queue(spark):
    rows = ledger(spark, [(None, "pending", 0, None, None, None), ("good", "pending", 0, None, None, None)])
    rows = rows.withColumn("registered_at", F.when(F.col("P_EMPRESA").isNotNull(), "2024-01-01"))
    found = states(led.claim(rows, 1, AS_OF), "status")
    assert found == {None: ("pending",), "good": ("processing",)}


def test_updates_are_ordered_by_time(spark):
    updates = spark.createDataFrame(
        [("new", "1", "v_1", "failed", "late", None, "2024-01-01T10:00:00Z"), ("new", "1", "v_1", "completed", "early", None, "2024-01-01T11:00:00+05:00")],
        "P_EMPRESA string, P_CONTR string, P_VERSION string, status string, message string, error string, updated_at string",
    )
    assert states(led.apply_updates(ledger(spark, ROWS), updates), "message")["new"] == ("late",)


def test_two_states_of_a_run_give_one_row(spark):
    jobs = spark.createDataFrame(
        [("stuck", "1", "v_1", "RUNNING", "RUNNING"), ("stuck", "1", "v_1", "SUCCEEDED", "SUCCEEDED")],
        "P_EMPRESA string, P_CONTR string, P_VERSION string, macro string, macro_stops string",
    )
    before = ledger(spark, ROWS)
    after = led.apply_job_states(before, jobs, AS_OF)
    assert after.count() == before.count() and states(after, "status")["stuck"] == ("completed",)


def test_reports_are_in_order(spark):
    rows = ledger(spark, [(f"r{i}", "failed", 0, f"2024-01-0{1 + i % 5}T00:00:00", f"m{i % 3}", None) for i in range(9)])
    rows = rows.withColumn("last_updated", F.col("started_at"))
    started = [r.started_at for r in reports.recent_runs(rows).collect()]
    assert started == sorted(started, reverse=True)
    failed = [r.last_updated for r in reports.failed_runs(rows).collect()]
    assert failed == sorted(failed, reverse=True)
