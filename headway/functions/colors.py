"""Route colours."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from headway.functions.ids import _col, lower_id

BLACK = "#000000"
COMBO_DEFAULT = "#1f77b4"


def _with_hash(c: Column) -> Column:
    return F.when(c.startswith("#"), c).otherwise(F.concat(F.lit("#"), c))


def safe_color(c: Column | str) -> Column:
    """``#rrggbb`` in lower case; anything that is not a colour is black.

    Three digits are doubled.  Further ``#`` characters among the six are let through.
    """
    hashed = _with_hash(lower_id(c))
    doubled = F.concat(F.lit("#"), F.regexp_replace(F.substring(hashed, 2, 3), "(.)", "$1$1"))
    full = F.when(F.length(hashed) == 4, doubled).otherwise(hashed)
    return F.when(full.rlike(r"\A#[0-9a-f#]{6}\z"), full).otherwise(F.lit(BLACK))


def combo_color(c: Column | str) -> Column:
    """Raw colour with a leading ``#``, unchecked; absent or empty gives the default blue."""
    c = _col(c)
    return F.when(c.isNull() | (c == ""), F.lit(COMBO_DEFAULT)).otherwise(_with_hash(c))
