"""Feed-shaped views over the star-schema test tables.

A view is a source and some layers of named SQL expressions.  ``tables`` makes them DataFrames and
``sql`` makes them SQL text, so both engines see the same rows.

There are six feeds, 0 to 5, that differ in how trips and routes spell the route id: equal, by case
and space, by zero padding, by leading zeros, by both, and not to be matched.  They share two
explotations, two contracts and two versions, one with a sign that folder names escape, and most of
their ids, so a join that forgets a feed column goes wrong.  Feed 3 has no shapes; the feeds 0 and 3
have a repeated route; the nations 15 to 19 use shapes without points.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-30T20:00:00"
FEEDS = ("0", "1", "2", "3", "4", "5")

# Spellings of a route id by feed: (in trips, in routes).  {n} is the number as text.
SPELLINGS = {
    "0": ("{n}", "{n}"),
    "1": ("'N' || {n}", "' n' || {n}"),
    "2": ("lpad({n}, 3, '0')", "{n}"),
    "3": ("'0000' || {n}", "{n}"),
    "4": ("'00N' || {n}", "'0n' || {n}"),
    "5": ("'T' || {n}", "'R' || {n}"),
}


def _text(number: str) -> str:
    return f"CAST({number} AS VARCHAR(20))"


def _route_id(side: int, number: str) -> str:
    cases = [f"WHEN '{f}' THEN {SPELLINGS[f][side].format(n=_text(number))}" for f in FEEDS]
    return f"CASE feed {' '.join(cases)} END"


# Columns of the test tables that are read.
TABLES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
}


class View(NamedTuple):
    source: str
    layers: list[dict[str, str]]
    join: tuple[str, str] | None = None


_FEED = {
    "explotation": "CASE WHEN feed IN ('0', '1', '2', '3') THEN '1' ELSE '2' END",
    "contract": "CASE WHEN feed IN ('0', '2', '4') THEN '1' ELSE '2' END",
    "version": "CASE WHEN feed IN ('0', '1', '4') THEN '20250301_20250331' ELSE '2025:04' END",
}
_CLOCK = (
    "lpad(CAST(4 + l_linenumber * 4 AS VARCHAR(10)), 2, '0') || ':' "
    "|| lpad(CAST(day(l_shipdate) AS VARCHAR(10)), 2, '0') || ':"
)
_RUN = {"P_EMPRESA": "P_EMPRESA", "P_CONTR": "P_CONTR", "P_VERSION": "P_VERSION"}
_KEEP = {"*": "*"}
_QUOTE = "chr(92) || '\"'"  # a quote inside JSON text inside JSON text

VIEWS: dict[str, View] = {
    "routes": View(
        "nation",
        [
            {**_KEEP, "feed": "{feeds}"},
            {**_KEEP, "copy": "{copies}"},
            {
                **_FEED,
                "route_id": _route_id(1, "n_nationkey"),
                "route_short_name": "CASE WHEN copy = 1 THEN n_name || ' bis' "
                "WHEN n_nationkey % 7 <> 3 THEN n_name END",
                "route_color": "CASE WHEN copy = 1 THEN 'AB12CD' ELSE CASE n_nationkey % 6 WHEN 1 THEN 'FA3' "
                "WHEN 2 THEN upper(substr(md5(n_name), 1, 6)) "
                "WHEN 3 THEN '#' || substr(md5(n_name), 1, 6) WHEN 4 THEN 'gggggg' "
                "WHEN 5 THEN ' ' || substr(md5(n_name), 1, 6) || ' ' END END",
            },
        ],
    ),
    "trips": View(
        "orders",
        [
            {**_KEEP, "feed": _text("o_orderkey % 6")},
            {
                **_FEED,
                "route_id": f"CASE WHEN o_orderkey % 29 <> 0 THEN {_route_id(0, 'c_nationkey')} END",
                "trip_id": f"CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE '' END || {_text('o_orderkey')}",
                "service_id": "o_orderstatus",
                "shape_id": "CASE WHEN o_orderkey % 13 = 0 THEN NULL "
                "WHEN o_orderkey % 17 = 0 THEN '' ELSE CAST((c_nationkey % 20) * 2 "
                "+ CASE WHEN o_orderkey % 12 >= 6 THEN 1 ELSE 0 END AS VARCHAR(20)) END",
                "trip_headsign": "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END",
            },
        ],
        join=("customer", "o_custkey = c_custkey"),
    ),
    "stop_times": View(
        "lineitem",
        [
            {**_KEEP, "feed": _text("l_orderkey % 6")},
            {
                **_FEED,
                "trip_id": f"{_text('l_orderkey')} || CASE WHEN l_linenumber = 7 THEN '  ' ELSE '' END",
                "stop_id": "CASE WHEN l_orderkey % 31 = 0 AND l_linenumber = 6 THEN 'X' ELSE '' END "
                f"|| {_text('l_suppkey')}",
                "stop_sequence": _text("l_linenumber"),
                "arrival_time": _CLOCK + "00'",
                "departure_time": _CLOCK + "30'",
            }
        ],
    ),
    "stops": View(
        "supplier",
        [
            {**_KEEP, "feed": "{feeds}"},
            {
                **_FEED,
                "stop_id": f"CASE WHEN feed = '1' THEN ' ' ELSE '' END || {_text('s_suppkey')}",
                "stop_name": "CASE s_suppkey % 10 WHEN 0 THEN NULL "
                "WHEN 1 THEN 'Café, \"' || s_name || '\"' || chr(10) || 'B' ELSE s_name END",
                "stop_lat": "CAST(40 AS DOUBLE) + s_acctbal / CAST(10000 AS DOUBLE)",
                "stop_lon": "CAST(-8 AS DOUBLE) - s_acctbal / CAST(20000 AS DOUBLE)",
            },
        ],
    ),
    "shapes": View(
        "part",
        [
            {**_KEEP, "feed": "{drawn}"},
            {
                **_FEED,
                "shape_id": _text("p_partkey % 30"),
                "shape_pt_lat": "CAST(42 AS DOUBLE) + p_retailprice / CAST(100000 AS DOUBLE)",
                "shape_pt_lon": "CAST(-8 AS DOUBLE) - p_retailprice / CAST(200000 AS DOUBLE)",
                "shape_pt_sequence": "p_partkey",
            },
        ],
    ),
    # One run per event, with every kind of fault.
    "ledger": View(
        "events",
        [
            {**_KEEP, "k": "{k}", "iso": "{iso}"},
            {
                "id": f"'run-' || {_text('event_id')}",
                "P_EMPRESA": _text("user_id % 10"),
                "P_CONTR": "CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN '' "
                f"ELSE {_text('event_id % 7')} END",
                "P_VERSION": f"'v_' || {_text('event_id')}",
                "status": "CASE WHEN event_id % 97 = 0 THEN 'zombie' "
                "WHEN event_id % 89 = 0 THEN 'preprocessed' WHEN event_id % 83 = 0 THEN 'processing_macro' "
                "WHEN event_id % 79 = 0 THEN 'processing_macro_stops' WHEN event_id % 101 = 0 THEN '' "
                "WHEN event_id % 103 = 0 THEN NULL WHEN event_type = 'view' THEN 'pending' "
                "WHEN event_type = 'signup' THEN 'preprocessing' "
                "WHEN event_type = 'click' THEN 'processing' "
                "WHEN event_type = 'purchase' THEN 'completed' ELSE 'failed' END",
                "retries": "CASE WHEN event_id % 31 <> 0 THEN CAST(k % 4 AS INTEGER) END",
                "registered_at": "CASE WHEN event_id % 23 <> 0 THEN iso END",
                "started_at": "CASE WHEN event_id % 13 = 0 THEN NULL "
                "WHEN event_id % 17 = 0 THEN 'bad' WHEN event_id % 19 = 0 THEN iso || 'Z' "
                "ELSE iso END",
                "jobs_started_at": "CASE WHEN event_id % 5 <> 0 THEN iso END",
                "last_updated": "iso",
                "message": "CASE k % 3 WHEN 0 THEN 'Timeout' "
                "WHEN 2 THEN 'Error ' || CAST(k % 10 AS VARCHAR(10)) END",
                "error": "CASE WHEN k % 5 = 0 THEN 'Boom' END",
            },
        ],
    ),
    "manifest": View(
        "events",
        [
            {
                "P_EMPRESA": _text("user_id % 10"),
                "P_CONTR": "CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 47 = 0 THEN '' "
                f"ELSE {_text('event_id % 7')} END",
                "P_VERSION": "CASE WHEN event_id % 53 = 0 THEN 'v_again' "
                f"WHEN event_id % 2 = 0 THEN 'v_' || {_text('event_id')} "
                f"ELSE 'w_' || {_text('event_id')} END",
            }
        ],
    ),
    # Two rows for some runs.
    "job_states": View(
        "ledger",
        [
            {**_RUN, "k": "CAST(substr(id, 5) AS BIGINT)"},
            {**_KEEP, "turn": "{turns}"},
            {**_RUN, "n": "CASE WHEN k % 10 = 0 THEN k + turn ELSE k END"},
            {
                **_RUN,
                "macro": "CASE n % 5 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'RUNNING' "
                "WHEN 2 THEN 'UNKNOWN' ELSE 'SUCCEEDED' END",
                "macro_stops": "CASE n % 7 WHEN 0 THEN 'TIMEOUT' WHEN 1 THEN 'ERROR' "
                "WHEN 2 THEN 'STOPPED' ELSE 'SUCCEEDED' END",
            },
        ],
    ),
    # Two updates of each run; which one is later shows in the offset and not in the text.
    "updates": View(
        "ledger",
        [
            {**_RUN, "last_updated": "last_updated", "n": "CAST(substr(id, 5) AS BIGINT)"},
            {**_KEEP, "turn": "{turns}"},
            {
                **_RUN,
                "status": "CASE turn WHEN 0 THEN 'completed' ELSE 'failed' END",
                "message": f"CASE n % 3 WHEN 0 THEN '' ELSE 'msg ' || {_text('n + turn')} END",
                "error": "CASE n % 4 WHEN 0 THEN 'err' WHEN 1 THEN '' END",
                "updated_at": "last_updated || CASE (n + turn) % 2 WHEN 0 THEN 'Z' ELSE '-05:00' END",
            },
        ],
    ),
    "requests": View(
        "events",
        [
            {
                "event_id": "event_id",
                "e": _text("user_id"),
                "v": f"'v_' || {_text('event_id')}",
            },
            {
                **_KEEP,
                "body": f"'\"{{{{' || {_QUOTE} || 'P_EMPRESA' || {_QUOTE} || ': ' || {_QUOTE} || e "
                f"|| {_QUOTE} || ', ' || {_QUOTE} || 'P_VERSION' || {_QUOTE} || ': ' || {_QUOTE} "
                f"|| v || {_QUOTE} || '}}}}\"'",
            },
            {
                "event_id": "event_id",
                "request": "CASE event_id % 4 "
                "WHEN 0 THEN '[{{\"statusCode\": 200, \"body\": ' || body || '}}]' "
                "WHEN 1 THEN '[[{{\"statusCode\": 200, \"body\": ' || body || '}}, ' "
                "|| '{{\"statusCode\": 500, \"body\": ' || body || '}}]]' "
                "WHEN 2 THEN '{{\"statusCode\": 200, \"body\": ' || body || '}}' "
                "ELSE '{{\"P_EMPRESA\": \"' || e || '\", \"P_VERSION\": \"' || v || '\"}}' END",
            },
        ],
    ),
    # One file per event; not every feed gets every type, and one version has a sign that is escaped.
    "listing": View(
        "events",
        [
            {
                "event_id": "event_id",
                "user_id": "user_id",
                "kind": "CASE event_id % 11 WHEN 0 THEN 'AGENCY' WHEN 1 THEN 'ROUTES' "
                "WHEN 2 THEN 'TRIPS' WHEN 3 THEN 'STOPS' WHEN 4 THEN 'STOP_TIMES' "
                "WHEN 5 THEN 'SHAPES' WHEN 6 THEN 'CALENDAR' WHEN 7 THEN 'PRE_STOP_TIMES' "
                "WHEN 8 THEN 'OTHER' WHEN 9 THEN 'AGENCY' ELSE 'STOP_TIMES' END",
            },
            {
                "path": "'store/GTFS/' || kind || '/explotation=' "
                f"|| CASE WHEN event_id % 61 = 0 THEN 'x' ELSE '' END || {_text('user_id')} "
                f"|| '/contract=' || {_text('event_id % 3')} "
                f"|| '/version=' || CASE WHEN event_id % 5 = 4 THEN 'v%3A4' ELSE 'v_' || {_text('event_id % 5')} END || '/' || lower(kind) "
                "|| CASE WHEN event_id % 67 = 0 THEN '.bak' ELSE '.txt' END"
            },
        ],
    ),
    "logs": View(
        "events",
        [
            {
                "event_id": "event_id",
                "log_group": "CASE event_type WHEN 'error' THEN '/jobs/error' "
                "WHEN 'view' THEN '/jobs/output' WHEN 'click' THEN '/jobs/logs-dev' "
                "ELSE '/jobs/other' END",
                "stream": "CASE event_id % 4 WHEN 0 THEN 'jr-driver' WHEN 1 THEN 'jr-progress-bar' "
                f"ELSE 'jr' END || {_text('user_id')}",
                "timestamp": "{millis}",
                "message": "props",
            }
        ],
    ),
}

_REPEATED = "feed IN ('0', '3') AND n_nationkey = 9"
_LISTS = {"feeds": list(FEEDS), "drawn": [f for f in FEEDS if f != "3"], "turns": [0, 1]}
_SPARK = {
    **{name: f"explode(array({str(items)[1:-1]}))" for name, items in _LISTS.items()},
    "copies": f"explode(CASE WHEN {_REPEATED} THEN array(0, 1) ELSE array(0) END)",
    "k": "CAST(get_json_object(props, '$.k') AS INT)",
    "iso": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
    "millis": "unix_millis(CAST(ts AS TIMESTAMP))",
}
_DUCK = {
    **{name: f"unnest([{str(items)[1:-1]}])" for name, items in _LISTS.items()},
    "copies": f"unnest(CASE WHEN {_REPEATED} THEN [0, 1] ELSE [0] END)",
    "k": "CAST(json_extract_string(props, '$.k') AS INTEGER)",
    "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
    "millis": "epoch_us(ts) // 1000",
}


def _items(layer: dict[str, str], engine: dict[str, str]) -> list[str]:
    return [
        expr if name == "*" else f"{expr.format(**engine)} AS {name}"
        for name, expr in layer.items()
    ]


def sql(name: str) -> str:
    """The view as SQL text; views it reads must be defined before it."""
    view = VIEWS[name]
    text = view.source
    if view.join:
        text += f" JOIN {view.join[0]} ON {view.join[1]}"
    for layer in view.layers:
        text = f"SELECT {', '.join(_items(layer, _DUCK))} FROM {text}"
        if layer is not view.layers[-1]:
            text = f"({text})"
    return text


def with_views(*names: str) -> str:
    """A WITH clause that defines the named views and those they read."""
    needed: list[str] = []
    for name in names:
        for each in (VIEWS[name].source, name):
            if each in VIEWS and each not in needed:
                needed.append(each)
    return "WITH " + ", ".join(f"{name} AS ({sql(name)})" for name in needed)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame."""
    if name not in VIEWS:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
    view = VIEWS[name]
    df = table(spark, sf_dir, view.source)
    if view.join:
        other, condition = view.join
        left, right = condition.split(" = ")
        joined = table(spark, sf_dir, other)
        df = df.join(joined, df[left] == joined[right])
    for layer in view.layers:
        df = df.selectExpr(*_items(layer, _SPARK))
    return df


def feed_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = ("routes", "trips", "stop_times", "stops", "shapes")
    return {name: table(spark, sf_dir, name) for name in names}
