"""Log events as text lines, sorted into classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Words in group or stream names that set a log's class.
DRIVER, PROGRESS = "driver", "progress-bar"
DEV_GROUP, ERROR_GROUP, OUTPUT_GROUP = "jobs/logs-dev", "jobs/error", "jobs/output"


def classify_log_events(df: DataFrame) -> DataFrame:
    """Add the text line, the class and the kind of each event.

    ``df`` has ``log_group``, ``stream``, ``timestamp`` (milliseconds) and ``message``.
    """
    group, stream, ms = F.col("log_group"), F.col("stream"), F.col("timestamp")
    time = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return df.withColumns(
        {
            "line": F.concat(time, F.lit(" ["), ms.cast("string"), F.lit("] "), F.col("message")),
            "log_class": F.when(stream.contains(DRIVER), "driver")
            .when(stream.contains(PROGRESS), "progress-bar")
            .when(group.contains(DEV_GROUP), "dev")
            .otherwise("general"),
            "log_kind": F.when(group.contains(ERROR_GROUP), "error")
            .when(group.contains(OUTPUT_GROUP), "output"),
        }
    )


def write_logs(df: DataFrame, path: str) -> None:
    """Write the lines in one folder per class; a large class is split over many files."""
    lines = classify_log_events(df).select("log_class", "line")
    lines.write.mode("append").partitionBy("log_class").text(path)
