"""Run state, counters and JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from headway.functions.ids import _col

# Job states after which a job does not go on.
TERMINAL = ("SUCCEEDED", "FAILED", "TIMEOUT", "STOPPED", "ERROR")


def bump(c: Column | str) -> Column:
    """Counter plus one; an absent counter counts as zero."""
    return F.coalesce(_col(c), F.lit(0)) + F.lit(1)


def fold_states(a: Column | str, b: Column | str, terminal: tuple[str, ...] = TERMINAL) -> Column:
    """Run state of two jobs: null while one goes on, else completed or failed."""
    a, b = _col(a), _col(b)
    succeeded = (a == "SUCCEEDED") & (b == "SUCCEEDED")
    return F.when(
        a.isin(*terminal) & b.isin(*terminal),
        F.when(succeeded, F.lit("completed")).otherwise(F.lit("failed")),
    )


def fold_message(a: Column | str, b: Column | str) -> Column:
    """Message of a failed run."""
    return F.concat(F.lit("Macro: "), _col(a), F.lit(", MacroStops: "), _col(b))


def decode(c: Column | str, schema: T.DataType | str) -> Column:
    return F.from_json(_col(c), schema)


def encode(c: Column | str) -> Column:
    return F.to_json(_col(c))


def run_id(value: str | None = None) -> Column:
    """The caller's run id, or a random one."""
    return F.lit(value) if value is not None else F.uuid()
