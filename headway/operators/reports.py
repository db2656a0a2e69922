"""Summaries of the run ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.functions import iso_time
from headway.operators.ledger import with_status
from headway.schemas import ALL_STATUSES, LEDGER_KEY

# Fixed value: stands in for a failed run's missing message.
UNKNOWN_ERROR = "Desconocido"


def _count(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def _percent(completed: Column, total: Column) -> Column:
    return F.when(total > 0, completed * F.lit(100.0) / total).otherwise(F.lit(0.0))


def by_status(ledger: DataFrame) -> DataFrame:
    """Runs per status as it is; a missing status is ``unknown``."""
    status = F.coalesce("status", F.lit("unknown"))
    return ledger.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def counters(statuses: tuple[str, ...] = ALL_STATUSES) -> list[Column]:
    """The total and the number of runs in each given status, as aggregates."""
    return [F.count("*").alias("total"), *[_count(s).alias(s) for s in statuses]]


def status_counts(ledger: DataFrame, statuses: tuple[str, ...] = ALL_STATUSES) -> DataFrame:
    """One row: the total and the number of runs in each given status, zero included."""
    return ledger.agg(*counters(statuses))


def enterprise_summary(ledger: DataFrame) -> DataFrame:
    """Totals per enterprise; statuses other than these four count in the total only."""
    enterprise = F.coalesce("P_EMPRESA", F.lit("unknown")).alias("P_EMPRESA")
    shown = ("completed", "failed", "processing", "pending")
    counts = ledger.groupBy(enterprise).agg(
        F.count("*").alias("total"), *[_count(s).alias(s) for s in shown]
    )
    whole = F.floor(F.col("completed") * 100 / F.col("total"))
    return counts.withColumn("progress", whole)


def enterprises(ledger: DataFrame) -> DataFrame:
    return ledger.select("P_EMPRESA").distinct().orderBy("P_EMPRESA")


def completion_pct(ledger: DataFrame) -> DataFrame:
    """Completed share: rounded to two decimals, as a whole number, and as it is."""
    counts = status_counts(ledger).select("total", "completed")
    ratio = _percent(F.col("completed"), F.col("total"))
    return counts.select(
        "total",
        "completed",
        F.round(ratio, 2).alias("completion_percentage"),
        F.floor(ratio).alias("progress"),
        ratio.alias("progress_percentage"),
    )


def retry_stats(ledger: DataFrame) -> DataFrame:
    retries = F.coalesce("retries", F.lit(0))
    return ledger.agg(
        F.coalesce(F.sum(retries), F.lit(0)).alias("total_retries"),
        F.count_if(retries > 0).alias("items_with_retries"),
        F.coalesce(F.max(retries), F.lit(0)).alias("max_retries"),
    )


def recent_runs(ledger: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` runs started last, by time and not by text; times that cannot be read come last."""
    started = ledger.where(F.col("started_at").isNotNull() & (F.col("started_at") != ""))
    order = [iso_time("started_at").desc_nulls_last(), F.col("started_at").desc(), F.col("id")]
    return started.orderBy(*order).limit(n)


def failed_runs(ledger: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` failed runs updated last, by time and not by text."""
    order = [iso_time("last_updated").desc_nulls_last(), F.col("last_updated").desc_nulls_last(), F.col("id")]
    return with_status(ledger, "failed").orderBy(*order).limit(n)


def ranked(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Add each row's place from 1 in ``order``; for the few rows of a top-n report."""
    return rows.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def ranked_recent(ledger: DataFrame, n: int = 5) -> DataFrame:
    """``recent_runs`` with their places."""
    return ranked(recent_runs(ledger, n), iso_time("started_at").desc_nulls_last(), F.col("started_at").desc(), "id")


def ranked_failed(ledger: DataFrame, n: int = 5) -> DataFrame:
    """``failed_runs`` with their places."""
    return ranked(failed_runs(ledger, n), iso_time("last_updated").desc_nulls_last(), F.col("last_updated").desc_nulls_last(), "id")


def error_message() -> Column:
    return F.coalesce("message", "error", F.lit(UNKNOWN_ERROR))


def errors_by_message(ledger: DataFrame) -> DataFrame:
    """Failed runs per message.  The runs themselves are in ``error_runs``."""
    failed = with_status(ledger, "failed")
    return failed.groupBy(error_message().alias("error_type")).agg(F.count("*").alias("n"))


def error_runs(ledger: DataFrame) -> DataFrame:
    """Failed runs with their message, one row each: a message may affect very many."""
    failed = with_status(ledger, "failed")
    rows = failed.select(error_message().alias("error_type"), *LEDGER_KEY, "id")
    return rows.orderBy("error_type", *LEDGER_KEY, "id")


def detailed_report(ledger: DataFrame) -> DataFrame:
    """All runs sorted by feed; the id makes the order total and lets it be split anywhere."""
    return ledger.orderBy(*LEDGER_KEY, "id")


def summary(ledger: DataFrame) -> dict[str, DataFrame]:
    """The frames of the processing summary."""
    return {
        "by_status": by_status(ledger),
        "status_counts": status_counts(ledger),
        "completion": completion_pct(ledger),
        "by_enterprise": enterprise_summary(ledger),
        "recent": recent_runs(ledger),
        "failed": failed_runs(ledger),
        "retry_stats": retry_stats(ledger),
    }


def write_reports(ledger: DataFrame, path: str) -> None:
    """Write the summary, detailed and error reports as JSON below ``path``."""
    frames = {
        **{f"summary/{name}": frame for name, frame in summary(ledger).items()},
        "summary/last_failed": failed_runs(ledger, 10),
        "detailed": detailed_report(ledger),
        "errors/by_message": errors_by_message(ledger),
        "errors/runs": error_runs(ledger),
    }
    for name, frame in frames.items():
        frame.write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")
