"""Feed keys in storage paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from headway.functions.ids import _col

# How the feed keys are spelled in a path.
PATTERNS = {
    "explotation": r"explotation=(\d+)",
    "contract": r"contract=(\d+)",
    "version": r"version=([^/]+)",
}


def path_part(c: Column | str, name: str) -> Column:
    """The value of one feed key in a path; empty text when the path lacks it.

    Signs that a folder name cannot hold are stored as ``%`` and their code; they are put back.
    """
    raw = F.regexp_extract(_col(c), PATTERNS[name] + "/", 1)
    return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)


def feed_id(e: Column | str, c: Column | str, v: Column | str) -> Column:
    """Label of a feed.  Versions may hold ``_``, so join on the three keys, never on this."""
    return F.concat_ws("_", _col(e), _col(c), _col(v))


def _folder(top: Column, e: Column | str, c: Column | str, v: Column | str) -> list[Column]:
    return [
        top,
        F.concat(F.lit("explotation="), _col(e)),
        F.concat(F.lit("contract="), _col(c)),
        F.concat(F.lit("version="), _col(v)),
    ]


def feed_path(kind: Column | str, e: Column | str, c: Column | str, v: Column | str) -> Column:
    """Path of one source file of a feed; the file is named after its type in lower case."""
    kind = _col(kind)
    parts = _folder(F.concat(F.lit("GTFS/"), kind), e, c, v)
    return F.concat_ws("/", *parts, F.concat(F.lower(kind), F.lit(".txt")))


def output_path(product: str, e: Column | str, c: Column | str, v: Column | str) -> Column:
    """Path of a product (``MACRO`` or ``MACRO_STOPS``) of a feed."""
    name = F.concat(_col(v), F.lit(f"_{product.lower()}"))
    return F.concat_ws("/", *_folder(F.lit(f"MAPS/{product}"), e, c, v), name)
