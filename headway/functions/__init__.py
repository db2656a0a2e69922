"""Column functions.  All are built-in expressions: no Python runs per row."""

from headway.functions.colors import combo_color, safe_color
from headway.functions.ids import (
    as_number,
    as_text,
    clean_id,
    lower_id,
    lstrip_zeros,
    or_empty,
    sorted_set,
    zfill,
)
from headway.functions.labels import name_label, route_trip_label, row_map, stop_label
from headway.functions.paths import feed_id, feed_path, output_path, path_part
from headway.functions.runs import bump, decode, encode, fold_message, fold_states, run_id
from headway.functions.times import iso_time, older_than

__all__ = [
    "as_number", "as_text", "bump", "clean_id", "combo_color", "decode", "encode", "feed_id",
    "feed_path", "fold_message", "fold_states", "iso_time", "lower_id", "lstrip_zeros",
    "name_label", "older_than", "or_empty", "output_path", "path_part", "route_trip_label",
    "row_map", "run_id", "safe_color", "sorted_set", "stop_label", "zfill",
]
