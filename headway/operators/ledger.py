"""State changes of the run ledger.

Each is a function from a snapshot to the next one.  Runs are matched on the three feed keys.
``as_of`` is the time of the change as ISO text, so results can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.functions import bump, feed_id, fold_message, fold_states, iso_time, older_than
from headway.operators.checks import required_error
from headway.operators.columns import conform, union_tables
from headway.schemas import ALL_STATUSES, FILE_STATUSES, LEDGER, LEDGER_KEY

IN_FLIGHT = ("preprocessing", "processing", *FILE_STATUSES)
# Registration leaves runs in these states alone; all others start again.
SETTLED = ("pending", "processing", "completed")
# Fields cleared when a failed run is set back.
RUN_FIELDS = (
    "error", "message", "preprocessor_result", "macro_job_id", "macro_stops_job_id",
    "macro_status", "macro_stops_status", "start_time", "end_time",
)
# Fixed value: message of a run that took too long.
TIMEOUT = "Timeout después de {hours} horas de ejecución"

_KEY = list(LEDGER_KEY)


def with_status(ledger: DataFrame, *status: str) -> DataFrame:
    return ledger.where(F.col("status").isin(*status))


def _change(ledger: DataFrame, condition: Column, values: dict[str, Column | None]) -> DataFrame:
    """Set columns where the condition holds."""
    hit = F.coalesce(condition, F.lit(False))
    changes = {}
    for name, value in values.items():
        if name not in ledger.columns:
            continue
        kind = ledger.schema[name].dataType
        new = F.lit(None) if value is None else value
        changes[name] = F.when(hit, new.cast(kind)).otherwise(F.col(name))
    return ledger.withColumns(changes)


def new_entries(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Distinct valid manifest entries the ledger lacks; one without a full key can never run."""
    valid = manifest.where(required_error() == "").select(*_KEY).distinct()
    return valid.join(ledger.select(*_KEY), _KEY, "left_anti")


def merge_manifest(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """The ledger with the missing entries added as pending; known ones are left as they are."""
    return union_tables(ledger, _pending(new_entries(manifest, ledger), None))


def _pending(entries: DataFrame, as_of: str | None) -> DataFrame:
    rows = entries.select(
        feed_id(*_KEY).alias("id"),
        *_KEY,
        F.lit("pending").alias("status"),
        F.lit(0).alias("retries"),
        F.lit(as_of).cast("string").alias("registered_at"),
    )
    return conform(rows, LEDGER)


def register(
    manifest: DataFrame, ledger: DataFrame, as_of: str
) -> tuple[DataFrame, DataFrame]:
    """Register feeds: new ones become pending, failed and unsettled ones start again.

    Returns the next ledger and one outcome row per distinct entry.  ``repeats`` counts further
    copies of an entry, which find it pending and are skipped.
    """
    # Copies are counted before any join.
    entries = manifest.groupBy(*_KEY).agg(F.count("*").alias("copies"))
    checked = entries.withColumn("problem", required_error())
    valid = checked.where("problem = ''").select(*_KEY, "copies")

    # A run in the ledger without a status counts as one with an unknown status.
    status = F.col("status")
    states = ledger.select(*_KEY, F.coalesce(status, F.lit("unknown")).alias("status"))
    known = valid.join(states, _KEY, "left")
    in_ledger = status.isNotNull()
    settled = status.isin(*SETTLED)
    outcome = (
        F.when(~in_ledger, F.lit("registered"))
        .when(settled, F.lit("skipped"))
        .otherwise(F.lit("reset"))
    )
    # Messages of the outcomes.
    message = (
        F.when(~in_ledger, F.lit("Registrado exitosamente"))
        .when(settled, F.concat(F.lit("Ya existe con estado: "), status))
        .when(status == "failed", F.lit("Restablecido de fallido a pendiente"))
        .otherwise(F.concat(F.lit("Restablecido de estado "), status, F.lit(" a pendiente")))
    )
    done = known.select(*_KEY, outcome.alias("result"), message.alias("message"), "copies")
    invalid = checked.where("problem <> ''").select(
        *_KEY, F.lit("error").alias("result"), F.col("problem").alias("message"), "copies"
    )
    outcomes = done.unionByName(invalid).select(
        feed_id(*_KEY).alias("id"),
        *_KEY,
        "result",
        "message",
        (F.col("copies") - 1).alias("repeats"),
    )

    listed = ledger.join(valid.withColumn("listed", F.lit(True)), _KEY, "left")
    restart = F.col("listed") & ~F.coalesce(status.isin(*SETTLED), F.lit(False))
    failed = status == "failed"
    changed = _change(
        listed,
        restart,
        {
            "error": F.when(~F.coalesce(failed, F.lit(False)), F.col("error")),
            "reset_at": F.lit(as_of),
            "retries": bump("retries"),
            "status": F.lit("pending"),
        },
    ).drop("listed", "copies")
    return union_tables(changed, _pending(new_entries(valid, ledger), as_of)), outcomes


def outcome_tally(outcomes: DataFrame) -> DataFrame:
    """One row with the number of entries registered, reset, skipped and in error."""
    first = {name: F.count_if(F.col("result") == name) for name in ("registered", "reset")}
    # Repeats of an invalid entry are errors too; those of a valid one are skipped.
    repeats = F.col("repeats")
    is_error, is_skip = F.col("result") == "error", F.col("result") == "skipped"
    skipped = F.sum(F.when(is_error, 0).otherwise(repeats) + F.when(is_skip, 1).otherwise(0))
    errors = F.sum(F.when(is_error, repeats + 1).otherwise(0))
    return outcomes.agg(
        *[count.alias(name) for name, count in first.items()],
        F.coalesce(skipped, F.lit(0)).alias("skipped"),
        F.coalesce(errors, F.lit(0)).alias("errors"),
    )


def inconsistency(as_of: str, hours: int = 8, known: Sequence[str] = ALL_STATUSES) -> Column:
    """Why a ledger row is inconsistent; null when it is not."""
    status, started = F.col("status"), F.col("started_at")
    # Messages of the reasons.
    reasons: list[Column] = []
    for name in (*LEDGER_KEY, "status"):
        empty = F.col(name).isNull() | (F.col(name) == "")
        reasons.append(F.when(empty, F.lit(f"Falta campo {name}")))
    flying = status.isin(*IN_FLIGHT)
    state = F.concat(F.lit("Estado "), status)
    reasons += [
        F.when(flying & started.isNull(), F.concat(state, F.lit(" sin timestamp"))),
        F.when(flying & iso_time(started).isNull(), F.lit("Timestamp started_at inválido")),
        F.when(
            flying & older_than(started, as_of, hours),
            F.concat(state, F.lit(f" por más de {hours}h")),
        ),
        F.when(~status.isin(*known), F.concat(F.lit("Estado desconocido: "), status)),
    ]
    return F.coalesce(*reasons)


def repair(
    ledger: DataFrame, as_of: str, hours: int = 8, known: Sequence[str] = ALL_STATUSES
) -> tuple[DataFrame, DataFrame]:
    """Reset inconsistent rows that are in flight and delete the other inconsistent ones.

    Returns the next ledger and one row per changed run with the action and the reason.
    """
    judged = ledger.withColumn("reason", inconsistency(as_of, hours, known))
    flying = F.coalesce(F.col("status").isin(*IN_FLIGHT), F.lit(False))
    wrong = F.col("reason").isNotNull()
    action = F.when(flying, F.lit("reset")).otherwise(F.lit("deleted"))
    actions = judged.where(wrong).select("id", *_KEY, action.alias("action"), "reason")
    kept = _change(
        judged.where(~wrong | flying),
        wrong,
        {
            "reset_at": F.lit(as_of),
            "reset_reason": F.col("reason"),
            "retries": bump("retries"),
            "status": F.lit("pending"),
        },
    )
    return kept.drop("reason"), actions


def reset_failed(ledger: DataFrame, as_of: str) -> DataFrame:
    """Failed runs become pending, with one more retry and without their errors and job fields."""
    cleared: dict[str, Column | None] = dict.fromkeys(RUN_FIELDS)
    return _change(
        ledger,
        F.col("status") == "failed",
        {
            **cleared,
            "reset_at": F.lit(as_of),
            "last_updated": F.lit(as_of),
            "retries": bump("retries"),
            "status": F.lit("pending"),
        },
    )


def expire(
    ledger: DataFrame, as_of: str, hours: int = 4, since: str = "jobs_started_at"
) -> DataFrame:
    """Runs processing, in either job or both, for more than ``hours`` fail with a message."""
    running = F.col("status").isin("processing", "processing_macro", "processing_macro_stops")
    late = running & older_than(since, as_of, hours)
    return _change(
        ledger,
        late,
        {
            "message": F.lit(TIMEOUT.format(hours=hours)),
            "last_updated": F.lit(as_of),
            "status": F.lit("failed"),
        },
    )


def apply_job_states(ledger: DataFrame, job_states: DataFrame, as_of: str) -> DataFrame:
    """Take the states of the two jobs into processing runs and fold them.

    ``job_states`` has the feed keys, ``macro`` and ``macro_stops``.  A run without a row has
    unknown states and goes on.  Of several rows of a run the greatest states count, the earlier
    job first; with a column ``seen_at`` (ISO text) the latest row does.
    """
    seen = [iso_time("seen_at"), "seen_at"] if "seen_at" in job_states.columns else []
    last = F.max(F.struct(*seen, F.col("macro").alias("_a"), F.col("macro_stops").alias("_b")))
    states = job_states.groupBy(*_KEY).agg(last.alias("s")).select(*_KEY, "s._a", "s._b")
    unknown = F.lit("UNKNOWN")
    joined = ledger.join(states, _KEY, "left").withColumns(
        {"_a": F.coalesce("_a", unknown), "_b": F.coalesce("_b", unknown)}
    )
    folded = joined.withColumn("_state", fold_states("_a", "_b"))
    processing = F.col("status") == "processing"
    done, failed = F.col("_state").isNotNull(), F.col("_state") == "failed"
    now = F.lit(as_of)
    return _change(
        folded,
        processing,
        {
            "macro_status": F.col("_a"),
            "macro_stops_status": F.col("_b"),
            "message": F.when(failed, fold_message("_a", "_b")).otherwise(F.col("message")),
            "jobs_completed_at": F.when(done, now).otherwise(F.col("jobs_completed_at")),
            "last_updated": F.when(done, now).otherwise(F.col("last_updated")),
            "last_checked": F.when(done, F.col("last_checked")).otherwise(now),
            "status": F.coalesce("_state", "status"),
        },
    ).drop("_a", "_b", "_state")


def apply_updates(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """Set status, message and error of runs.

    ``updates`` has the feed keys, ``status``, ``message``, ``error`` and ``updated_at`` (ISO text).  The
    latest one of each run counts, by time and not by text; of those with the same time the
    greatest.  A time that cannot be read comes before all others.  An empty message or error leaves
    the old one.
    """
    latest = updates.groupBy(*_KEY).agg(
        F.max(F.struct(iso_time("updated_at").alias("at"), "updated_at", "status", "message", "error")).alias("u")
    )
    joined = ledger.join(latest, _KEY, "left")

    def given(name: str) -> Column:
        value = F.col(f"u.{name}")
        return F.coalesce(F.when(value != "", value), F.col(name))

    return _change(
        joined,
        F.col("u").isNotNull(),
        {
            "message": given("message"),
            "error": given("error"),
            "last_updated": F.col("u.updated_at"),
            "status": given("status"),
        },
    ).drop("u")


def next_pending(ledger: DataFrame, n: int = 1) -> DataFrame:
    """The next ``n`` pending runs, the longest registered first; those without a full key never run.

    Times are compared as times; runs without a readable one come first.
    """
    order = [iso_time("registered_at").asc_nulls_first(), F.col("registered_at").asc_nulls_first(), F.col("id")]
    return with_status(ledger, "pending").where(required_error() == "").orderBy(*order).limit(n)


def repeated_ids(ledger: DataFrame) -> DataFrame:
    """Ids that more than one run has."""
    return ledger.groupBy("id").agg(F.count("*").alias("n_rows")).where("n_rows > 1 AND id IS NOT NULL")


def claim(ledger: DataFrame, n: int, as_of: str, prefix: str = "run") -> DataFrame:
    """The next ``n`` pending runs start processing, never more.

    Runs are known by their id: one without an id, or with an id that occurs twice, is not started.
    Of several pending runs of one feed the first in order starts alone.
    """
    single = ledger.join(repeated_ids(ledger).select("id"), "id", "left_anti").where("id IS NOT NULL")
    order = [iso_time("registered_at").asc_nulls_first(), F.col("registered_at").asc_nulls_first(), F.col("id")]
    waiting = with_status(single, "pending").withColumn("nth", F.row_number().over(Window.partitionBy(*_KEY).orderBy(*order)))
    chosen = next_pending(waiting.where("nth = 1"), n).select("id", F.lit(True).alias("chosen"))
    stamp = F.date_format(F.lit(as_of).cast("timestamp"), "yyyyMMddHHmmss")
    name = F.concat_ws("-", F.lit(prefix), F.col("id"), stamp)
    return _change(
        ledger.join(chosen, "id", "left").select(*[ledger[c] for c in ledger.columns], "chosen"),
        F.col("chosen") & (F.col("status") == "pending"),
        {"execution_id": name, "started_at": F.lit(as_of), "status": F.lit("processing")},
    ).drop("chosen")
