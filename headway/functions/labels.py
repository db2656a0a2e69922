"""Display labels and text maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from headway.functions.ids import _col, or_empty


def stop_label(stop_id: Column | str) -> Column:
    return F.concat(F.lit("Id: "), _col(stop_id))


def name_label(stop_name: Column | str) -> Column:
    """Null when the name is null."""
    return F.concat(F.lit(" Nombre: "), _col(stop_name))


def route_trip_label(short_name: Column | str, headsign: Column | str) -> Column:
    return F.concat(_col(short_name), or_empty(headsign))


def row_map(*columns: str) -> Column:
    """The named columns of a row as one map of text to text."""
    pairs = [part for name in columns for part in (F.lit(name), F.col(name).cast("string"))]
    return F.create_map(*pairs)
