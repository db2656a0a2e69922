"""The shared folder, and small writers."""

from __future__ import annotations

from headway.operators.logs import write_logs
from headway.session import shared_dir


class Conf(dict):
    """Stands in for a session's settings."""

    @property
    def conf(self):
        return self


def test_the_shared_folder_is_that_of_the_cluster():
    session = Conf({"spark.checkpoint.dir": "s3a://bucket/tmp/", "spark.master": "yarn"})
    first, second = shared_dir(session, "x"), shared_dir(session, "x")
    assert first.startswith("s3a://bucket/tmp/x-") and first != second


def test_without_it_the_warehouse_is_shared():
    assert shared_dir(Conf({"spark.sql.warehouse.dir": "hdfs://warehouse"}), "x").startswith("hdfs://warehouse/x-")


def test_logs_are_written_by_class(spark, tmp_path):
    events = spark.createDataFrame(
        [("/jobs/error", "jr-driver", 0, "a"), ("/jobs/logs-dev", "jr1", 1500, "b"), ("/jobs/output", "jr2", 2000, "c")],
        "log_group string, stream string, timestamp bigint, message string",
    )
    write_logs(events, str(tmp_path / "logs"))
    rows = {(r.log_class, r.value) for r in spark.read.text(str(tmp_path / "logs")).collect()}
    assert rows == {
        ("driver", "1970-01-01T00:00:00Z [0] a"),
        ("dev", "1970-01-01T00:00:01Z [1500] b"),
        ("general", "1970-01-01T00:00:02Z [2000] c"),
    }
