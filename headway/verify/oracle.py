"""DuckDB SQL for the registered queries, written apart from the library's plans."""

from __future__ import annotations

from headway.schemas import (
    ALL_STATUSES,
    FEED,
    LISTED_TYPES,
    MACRO,
    MACRO_STOPS,
    REQUIRED_TYPES,
)
from headway.verify.star import AS_OF, sql, with_views

F = ", ".join(FEED)
RUN = "P_EMPRESA, P_CONTR, P_VERSION"
_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT"}


def feed(alias: str) -> str:
    return ", ".join(f"{alias}.{name}" for name in FEED)


def on(a: str, b: str, *names: str) -> str:
    return " AND ".join(f"{a}.{name} = {b}.{name}" for name in (*FEED, *names))


def clean(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def pad(x: str, n: int = 3) -> str:
    zeros = f"repeat('0', {n} - length({x}))"
    return (
        f"CASE WHEN length({x}) >= {n} THEN {x} WHEN substr({x}, 1, 1) IN ('-', '+') "
        f"THEN substr({x}, 1, 1) || {zeros} || substr({x}, 2) ELSE {zeros} || {x} END"
    )


def color(x: str) -> str:
    """Final colour; subqueries name the steps."""
    return (
        "(SELECT CASE WHEN regexp_full_match(d, '#[0-9a-f#]{6}') THEN d ELSE '#000000' END FROM "
        "(SELECT CASE WHEN length(h) = 4 THEN '#' || repeat(substr(h, 2, 1), 2) "
        "|| repeat(substr(h, 3, 1), 2) || repeat(substr(h, 4, 1), 2) ELSE h END AS d FROM "
        "(SELECT CASE WHEN starts_with(c, '#') THEN c ELSE '#' || c END AS h FROM "
        f"(SELECT lower({clean(f'coalesce({x}, chr(32))')}) AS c))))"
    )


def combo_blue(x: str) -> str:
    return (
        f"CASE WHEN coalesce({x}, '') = '' THEN '#1f77b4' WHEN starts_with({x}, '#') THEN {x} "
        f"ELSE '#' || {x} END"
    )


_BARE = f"ltrim({clean('x')}, '0')"
RUNGS = (
    "x",
    f"lower({clean('x')})",
    pad(f"lower({clean('x')})"),
    _BARE,
    f"lower({clean(_BARE)})",
    pad(f"lower({clean(_BARE)})"),
)
NAMES = ("exact", "lower", "pad", "strip", "strip_lower", "strip_lower_pad")


def _rung(rungs: int) -> str:
    return "CASE rung " + " ".join(f"WHEN {i} THEN {RUNGS[i]}" for i in range(rungs)) + " END"


def matched(rungs: int = len(RUNGS)) -> str:
    """Trips and routes with the route id under the rung of their feed, as ``rid``."""

    def spelled(name: str) -> str:
        keys = f"(SELECT DISTINCT {F}, route_id AS x FROM {name} WHERE route_id IS NOT NULL)"
        return " UNION ALL ".join(
            f"SELECT {F}, {i} AS rung, {RUNGS[i]} AS s FROM {keys}" for i in range(rungs)
        )

    return f"""
    choice AS (SELECT {F}, rung, n_common FROM (
        SELECT {F}, rung, count(*) AS n_common, min(rung) OVER (PARTITION BY {F}) AS best
        FROM ((SELECT {F}, rung, s FROM ({spelled("trips")}))
              INTERSECT (SELECT {F}, rung, s FROM ({spelled("routes")})))
        GROUP BY {F}, rung) WHERE rung = best),
    ktrips AS (SELECT * EXCLUDE (x), {clean(_rung(rungs))} AS rid
               FROM (SELECT *, route_id AS x FROM trips) LEFT JOIN choice USING ({F})),
    kroutes AS (SELECT * EXCLUDE (x), {clean(_rung(rungs))} AS rid
                FROM (SELECT *, route_id AS x FROM routes) LEFT JOIN choice USING ({F})),
    routed AS (SELECT {feed("t")}, t.rid AS route_id, {clean("t.trip_id")} AS trip_id, t.service_id,
                      nullif({clean("t.shape_id")}, '') AS shape_id, t.trip_headsign,
                      r.route_short_name, r.route_color, {color("r.route_color")} AS final_color
               FROM ktrips t JOIN kroutes r ON {on("t", "r", "rid")})"""


MATCHED = matched()

CALLS = f"""
    calls AS (SELECT {feed("t")}, t.route_id, t.trip_id, t.service_id, t.shape_id, t.trip_headsign,
                     t.route_short_name, t.route_color, t.final_color,
                     {clean("s.stop_id")} AS stop_id, s.stop_sequence, s.arrival_time,
                     s.departure_time
              FROM routed t JOIN stop_times s
                ON {on("t", "s")} AND t.trip_id = {clean("s.trip_id")}
              WHERE t.route_short_name IS NOT NULL),
    lines AS (SELECT {F}, stop_id, string_agg(route_short_name, ', ' ORDER BY route_short_name)
                     AS lines_by_stop
              FROM (SELECT DISTINCT {F}, stop_id, route_short_name FROM calls) GROUP BY {F}, stop_id)"""

PLACED = f"""
    placed AS (SELECT c.*, p.stop_name, p.stop_lat, p.stop_lon, l.lines_by_stop,
                      'Id: ' || c.stop_id AS stop_id_2, ' Nombre: ' || p.stop_name AS stop_name_2,
                      c.route_short_name || coalesce(c.trip_headsign, '') AS route_sn_trip_hs
               FROM calls c JOIN stops p ON {on("c", "p")} AND c.stop_id = {clean("p.stop_id")}
               JOIN lines l ON {on("c", "l", "stop_id")})"""

WITH_CALLS = f"{with_views('routes', 'trips', 'stop_times', 'stops')}, {MATCHED}, {CALLS}, {PLACED}"
WITH_TRIPS = f"{with_views('routes', 'trips', 'shapes')}, {MATCHED}"


def shaped(schema, present: str) -> str:
    """Select list of a schema: the present columns, and nulls of the declared type."""
    names = present.split()
    return f"{F}, " + ", ".join(
        f.name if f.name in names else f"CAST(NULL AS {_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in schema.fields
    )


_CALL_COLUMNS = (
    "route_id trip_id service_id shape_id trip_headsign arrival_time stop_id stop_sequence "
    "stop_name stop_lat stop_lon route_short_name route_color final_color stop_id_2 stop_name_2 "
    "route_sn_trip_hs lines_by_stop departure_time"
)
_POINT = "shape_id final_color route_short_name trip_headsign"
_LABELS = "final_color, route_short_name, trip_headsign"
_BASIC = f"{_LABELS}, route_id, trip_id, service_id, shape_id"
_HAS = f"EXISTS (SELECT 1 FROM shapes s WHERE {on('s', 'r', 'shape_id')})"
_DRAWN = f"""
    drawn AS (SELECT DISTINCT {F}, route_id FROM routed r WHERE {_HAS}),
    drawn_feeds AS (SELECT DISTINCT {F} FROM shapes)"""
_NOT_DRAWN = f"NOT EXISTS (SELECT 1 FROM drawn d WHERE {on('d', 'r', 'route_id')})"
_FEED_DRAWN = f"EXISTS (SELECT 1 FROM drawn_feeds d WHERE {on('d', 'r')})"


def macro(with_clause: str) -> str:
    points = f"SELECT DISTINCT {F}, shape_id, {_LABELS} FROM routed WHERE shape_id IS NOT NULL"
    basic = f"SELECT DISTINCT {F}, {_BASIC} FROM routed r WHERE {_NOT_DRAWN} AND {_FEED_DRAWN}"
    return f"""{with_clause}, {_DRAWN}
    SELECT {shaped(MACRO, _POINT + " shape_pt_lat shape_pt_lon shape_pt_sequence")}
    FROM (SELECT k.*, s.shape_pt_lat, s.shape_pt_lon, s.shape_pt_sequence
          FROM ({points}) k JOIN shapes s ON {on("k", "s", "shape_id")})
    UNION ALL SELECT {shaped(MACRO, _POINT + " route_id trip_id service_id")} FROM ({basic})
    UNION ALL SELECT {shaped(MACRO, _POINT + " route_id trip_id service_id route_color")}
    FROM routed r WHERE NOT {_FEED_DRAWN}"""


_COMBO = f"{F}, route_id, trip_headsign"
COMBOS = f"""{with_views("routes", "trips", "stop_times")},
    ctrips AS (SELECT * REPLACE ({clean("trip_id")} AS trip_id) FROM trips),
    ctimes AS (SELECT DISTINCT {F}, {clean("trip_id")} AS trip_id FROM stop_times),
    running AS (SELECT t.* FROM ctrips t JOIN ctimes s ON {on("t", "s", "trip_id")}),
    members AS (SELECT * FROM running WHERE route_id IS NOT NULL AND trip_headsign IS NOT NULL),
    crows AS (SELECT {F}, route_id, trip_id, service_id, shape_id, trip_headsign,
                     count(*) AS copies FROM members GROUP BY ALL)"""
_DOC_COLOR = f"""(SELECT {F}, route_id, {combo_blue("route_color")} AS route_color FROM
    (SELECT *, row_number() OVER (PARTITION BY {F}, route_id
        ORDER BY route_short_name NULLS FIRST, route_color NULLS FIRST) AS nth FROM routes)
    WHERE nth = 1)"""


def colored(select: str, source: str) -> str:
    return f"""SELECT {select}, coalesce(r.route_color, '#1f77b4') AS route_color
    FROM {source} g LEFT JOIN {_DOC_COLOR} r ON {on("g", "r", "route_id")}"""


_OUTCOMES = f"""
    repeated AS (SELECT {F} FROM routes GROUP BY {F}, route_id HAVING count(*) > 1),
    counted AS (SELECT {F}, count(DISTINCT route_id) AS n FROM members GROUP BY {F}),
    feeds AS (SELECT {F} FROM routes UNION SELECT {F} FROM trips),
    judged AS (SELECT f.*, c.n,
        EXISTS (SELECT 1 FROM repeated x WHERE {on("x", "f")}) AS twice,
        EXISTS (SELECT 1 FROM shapes x WHERE {on("x", "f")}) AS drawn
        FROM feeds f LEFT JOIN counted c ON {on("c", "f")})"""


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


LEDGER = with_views("ledger")
_NOW = f"TIMESTAMP '{AS_OF.replace('T', ' ')}'"
_TIME = "CASE WHEN {0} = 'bad' THEN NULL ELSE CAST(replace({0}, 'Z', '') AS TIMESTAMP) END"
_FLYING = """coalesce(status IN ('preprocessing', 'processing', 'preprocessed', 'processing_macro',
    'processing_macro_stops'), FALSE)"""
_REASON = f"""CASE
    WHEN coalesce(P_EMPRESA, '') = '' THEN 'Falta campo P_EMPRESA'
    WHEN coalesce(P_CONTR, '') = '' THEN 'Falta campo P_CONTR'
    WHEN coalesce(P_VERSION, '') = '' THEN 'Falta campo P_VERSION'
    WHEN coalesce(status, '') = '' THEN 'Falta campo status'
    WHEN {_FLYING} AND started_at IS NULL THEN 'Estado ' || status || ' sin timestamp'
    WHEN {_FLYING} AND {_TIME.format("started_at")} IS NULL THEN 'Timestamp started_at inválido'
    WHEN {_FLYING} AND {_TIME.format("started_at")} < {_NOW} - INTERVAL 8 HOUR
        THEN 'Estado ' || status || ' por más de 8h'
    WHEN status NOT IN {_in(ALL_STATUSES)} THEN 'Estado desconocido: ' || status END"""
_JUDGED = f"{LEDGER}, judged AS (SELECT *, {_REASON} AS reason, {_FLYING} AS flying FROM ledger)"

_SETTLED = "('pending', 'processing', 'completed')"
_REG = f"""{with_views("manifest", "ledger")},
    entries AS (SELECT {RUN}, count(*) AS copies,
        CASE WHEN P_EMPRESA IS NULL THEN 'Campo requerido P_EMPRESA no encontrado'
             WHEN P_EMPRESA = '' THEN 'Campo P_EMPRESA está vacío'
             WHEN P_CONTR IS NULL THEN 'Campo requerido P_CONTR no encontrado'
             WHEN P_CONTR = '' THEN 'Campo P_CONTR está vacío'
             WHEN P_VERSION IS NULL THEN 'Campo requerido P_VERSION no encontrado'
             WHEN P_VERSION = '' THEN 'Campo P_VERSION está vacío' ELSE '' END AS problem
        FROM manifest GROUP BY {RUN}),
    held AS (SELECT e.*, l.id IS NOT NULL AS there, coalesce(l.status, 'unknown') AS was
        FROM entries e LEFT JOIN ledger l ON e.P_EMPRESA = l.P_EMPRESA
             AND e.P_CONTR = l.P_CONTR AND e.P_VERSION = l.P_VERSION),
    results AS (SELECT concat_ws('_', {RUN}) AS id, {RUN},
        CASE WHEN problem <> '' THEN 'error' WHEN NOT there THEN 'registered'
             WHEN was IN {_SETTLED} THEN 'skipped' ELSE 'reset' END AS result,
        CASE WHEN problem <> '' THEN problem WHEN NOT there THEN 'Registrado exitosamente'
             WHEN was IN {_SETTLED} THEN 'Ya existe con estado: ' || was
             WHEN was = 'failed' THEN 'Restablecido de fallido a pendiente'
             ELSE 'Restablecido de estado ' || was || ' a pendiente' END AS message,
        copies - 1 AS repeats FROM held)"""

_FOLD = f"""{with_views("job_states", "ledger")},
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY P_EMPRESA, P_CONTR, P_VERSION
        ORDER BY macro DESC, macro_stops DESC) AS nth FROM job_states) WHERE nth = 1),
    seen AS (SELECT l.*, coalesce(j.macro, 'UNKNOWN') AS a, coalesce(j.macro_stops, 'UNKNOWN') AS b
        FROM ledger l LEFT JOIN latest j ON l.P_EMPRESA = j.P_EMPRESA
             AND l.P_CONTR = j.P_CONTR AND l.P_VERSION = j.P_VERSION),
    folded AS (SELECT *, coalesce(status = 'processing', FALSE) AS busy,
        a NOT IN ('RUNNING', 'UNKNOWN') AND b NOT IN ('RUNNING', 'UNKNOWN') AS done,
        a = 'SUCCEEDED' AND b = 'SUCCEEDED' AS good FROM seen)"""

_KINDS = sorted(REQUIRED_TYPES)
_COMPLETE = f"""{with_views("listing")},
    files AS (SELECT *, regexp_extract(path, 'GTFS/([^/]+)/', 1) AS gtfs_type,
        regexp_extract(path, 'explotation=(\\d+)/', 1) AS explotation,
        regexp_extract(path, 'contract=(\\d+)/', 1) AS contract,
        replace(regexp_extract(path, 'version=([^/]+)/', 1), '%3A', ':') AS version FROM listing),
    found AS (SELECT {F}, list_sort(list(DISTINCT gtfs_type)) AS kinds FROM files
        WHERE explotation <> '' AND path LIKE '%.txt' AND gtfs_type IN {_in(_KINDS)}
        GROUP BY {F} HAVING list_contains(list(gtfs_type), 'AGENCY')),
    complete AS (SELECT {F}, array_to_string(kinds, '|') AS gtfs_types,
        array_to_string(list_filter({_KINDS}, lambda k: NOT list_contains(kinds, k)), '|')
            AS missing_types,
        len(kinds) = {len(_KINDS)} AS is_complete FROM found)"""

_STARTED = "try_cast(replace(started_at, 'Z', '') AS TIMESTAMP) DESC NULLS LAST, started_at DESC, id"
_BROKEN = "explotation = '1' AND contract = '1' AND version = '2025:04'"
_FAILED = "coalesce(message, error, 'Desconocido') AS error_type"


def _part() -> str:
    text = "coalesce(trip_id, '') || chr(31) || coalesce(service_id, '') || chr(31) || coalesce(shape_id, '')"
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


def _view(name: str, columns: str = "*") -> str:
    return f"{with_views(name)} SELECT {columns} FROM {name}"


_STOPS_AGAIN = _view("stops")

ORACLE: dict[str, str] = {
    # Products
    "macro_stops": f"{WITH_CALLS} SELECT {shaped(MACRO_STOPS, _CALL_COLUMNS)} FROM placed",
    "macro_stops_strict": f"""{WITH_CALLS}
        SELECT {F}, trip_id, TRY_CAST(stop_id AS BIGINT) AS stop_id,
               TRY_CAST(stop_sequence AS BIGINT) AS stop_sequence, stop_lat, final_color
        FROM placed""",
    "macro_shapes": macro(WITH_TRIPS),
    "macro_no_shapes": f"""{with_views("routes", "trips")}, {MATCHED}
        SELECT {shaped(MACRO, _POINT + " route_id trip_id service_id route_color")} FROM routed""",
    "macro_short_ladder": f"""SELECT {F}, count(*) AS n_rows FROM
        ({macro(f"{with_views('routes', 'trips', 'shapes')}, {matched(3)}")}) GROUP BY {F}""",
    "macro_row_totals": f"""{WITH_CALLS}
        SELECT {feed("f")}, coalesce(n, 0) AS n_rows, coalesce(n, 0) > 0 AS produced
        FROM (SELECT DISTINCT {F} FROM routes) f
        LEFT JOIN (SELECT {F}, count(*) AS n FROM placed GROUP BY {F}) p ON {on("f", "p")}""",
    "lines_by_stop": f"{WITH_CALLS} SELECT {F}, stop_id, lines_by_stop FROM lines",
    "stop_line_pairs": f"{WITH_CALLS} SELECT DISTINCT {F}, stop_id, route_short_name FROM calls",
    # Geometry
    "macro_shape_fallback": f"""{WITH_TRIPS}, {_DRAWN}
        SELECT DISTINCT {F}, {_BASIC} FROM routed r WHERE {_NOT_DRAWN} AND {_FEED_DRAWN}""",
    "macro_without_shapes": f"""{WITH_TRIPS}, {_DRAWN}
        SELECT {F}, {_BASIC}, route_color FROM routed r WHERE NOT {_FEED_DRAWN}""",
    "geometry_keys": f"""{WITH_TRIPS}
        SELECT DISTINCT {F}, shape_id, {_LABELS} FROM routed WHERE shape_id IS NOT NULL""",
    "shape_points": f"""{WITH_TRIPS}
        SELECT {feed("k")}, k.shape_id, final_color, count(*) AS n_points,
               max(shape_pt_sequence) AS last_sequence
        FROM (SELECT DISTINCT {F}, shape_id, {_LABELS} FROM routed) k
        JOIN shapes s ON {on("k", "s", "shape_id")} GROUP BY {feed("k")}, k.shape_id, final_color""",
    # Combos
    "combos": f"""{COMBOS} {colored(
        "g.*, TRUE AS has_stops",
        f'''(SELECT {_COMBO}, count(*) AS n_rows, count(DISTINCT trip_id) AS n_trips,
             count(DISTINCT nullif(shape_id, '')) AS n_shapes FROM members GROUP BY {_COMBO})''')}""",
    "combo_rows": f"{COMBOS} SELECT * FROM crows",
    "combo_shapes": f"""{COMBOS} SELECT DISTINCT {_COMBO}, shape_id FROM members
        WHERE coalesce(shape_id, '') <> ''""",
    "combo_documents": f"""{COMBOS}, parted AS (SELECT *, {_part()} % 4 AS part FROM crows),
        nested AS (SELECT {_COMBO}, part,
            coalesce(array_to_string(list_sort(list(DISTINCT nullif(shape_id, ''))
                FILTER (coalesce(shape_id, '') <> '')), '|'), '') AS unique_shape_ids,
            array_to_string(list_sort(list(DISTINCT trip_id)), '|') AS trip_ids,
            string_agg(coalesce(service_id, '-'), '|' ORDER BY trip_id, service_id NULLS FIRST,
                       shape_id NULLS FIRST) AS services,
            string_agg(coalesce(shape_id, '-'), '|' ORDER BY trip_id, service_id NULLS FIRST,
                       shape_id NULLS FIRST) AS shapes,
            CAST(sum(copies) AS BIGINT) AS n_rows
            FROM parted GROUP BY {_COMBO}, part)
        {colored("g.*, TRUE AS has_stops, 'route_id|trip_id|service_id|shape_id|trip_headsign' AS group_columns", "nested")}""",
    "valid_routes": f"{COMBOS} SELECT DISTINCT {F}, route_id FROM members",
    "dropped_trips": f"""{COMBOS} SELECT {F}, count(*) AS n_dropped FROM running
        WHERE route_id IS NULL OR trip_headsign IS NULL GROUP BY {F}""",
    "preprocess_outcomes": f"""{COMBOS}, shapes AS ({sql("shapes")}), {_OUTCOMES}
        SELECT {F}, 'exec-1' AS execution_id,
            CASE WHEN twice OR n IS NULL THEN 'error' ELSE 'success' END AS status,
            CASE WHEN twice THEN 'DataFrame index must be unique for orient=''index''.'
                 WHEN n IS NULL THEN 'No se encontraron combinaciones válidas.' END AS message,
            CASE WHEN NOT twice AND n IS NOT NULL THEN 'GTFS_TEMP/preprocessed/explotation='
                 || explotation || '/contract=' || contract || '/version=' || version || '/exec-1' END
                 AS temp_dir,
            CASE WHEN NOT twice THEN n END AS n_routes,
            CASE WHEN NOT twice AND n IS NOT NULL THEN drawn END AS has_shapes,
            CASE WHEN NOT twice AND n IS NOT NULL THEN TRUE END AS has_data FROM judged""",
    "preprocess_combos": f"""{COMBOS}, shapes AS ({sql("shapes")}), {_OUTCOMES}
        SELECT {F}, count(*) AS n_combos, CAST(sum(n) AS BIGINT) AS n_rows
        FROM (SELECT {_COMBO}, count(*) AS n FROM members m WHERE NOT EXISTS
              (SELECT 1 FROM repeated x WHERE {on("x", "m")}) GROUP BY {_COMBO}) GROUP BY {F}""",
    # Column functions
    "safe_color": f"""SELECT p_partkey, {color("raw")} AS final_color FROM (SELECT p_partkey,
        CASE p_partkey % 7 WHEN 0 THEN upper(substr(md5(p_name), 1, 6))
            WHEN 1 THEN ' #' || substr(md5(p_name), 1, 3) WHEN 2 THEN substr(md5(p_name), 1, 3)
            WHEN 3 THEN '##' || substr(md5(p_name), 1, 2) WHEN 4 THEN p_brand
            WHEN 5 THEN 'NaN' END AS raw FROM part)""",
    "combo_color": f"""SELECT p_partkey, {combo_blue("raw")} AS route_color FROM (SELECT p_partkey,
        CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN '#' || p_brand WHEN 2 THEN '' END AS raw
        FROM part)""",
    "id_normalise": """SELECT o_orderkey, 'Ab' || CAST(o_orderkey AS VARCHAR) AS clean,
        'ab' || CAST(o_orderkey AS VARCHAR) AS lowered,
        CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE '' END AS filled,
        CAST(o_custkey AS VARCHAR) AS customer,
        CASE WHEN o_orderkey % 3 <> 0 THEN CAST(7 AS BIGINT) END AS number FROM orders""",
    "zero_pad": f"""SELECT p_partkey, {pad("raw")} AS padded, {pad("raw", 5)} AS wide
        FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '-' WHEN 1 THEN '+' ELSE '' END
              || CAST(p_size AS VARCHAR) AS raw FROM part)""",
    "strip_zeros": """SELECT p_partkey, regexp_replace(repeat('0', p_size % 4)
        || CAST(p_partkey % 100 AS VARCHAR), '^0+', '') AS stripped FROM part""",
    "stop_labels": f"""{with_views("stops")} SELECT {F}, stop_id, 'Id: ' || stop_id AS stop_id_2,
        ' Nombre: ' || stop_name AS stop_name_2, stop_id || coalesce(stop_name, '') AS pair
        FROM stops""",
    "feed_paths": f"""{LEDGER} SELECT id, concat_ws('_', {RUN}) AS label,
        'GTFS/STOP_TIMES/' || folder || '/stop_times.txt' AS path,
        'MAPS/MACRO_STOPS/' || folder || '/' || P_VERSION || '_macro_stops' AS product,
        P_EMPRESA AS explotation,
        coalesce(P_CONTR, '') AS contract, P_VERSION AS version
        FROM (SELECT *, concat_ws('/', 'explotation=' || P_EMPRESA, 'contract=' || P_CONTR,
              'version=' || P_VERSION) AS folder FROM ledger)""",
    "row_maps": _view("routes", f"{F}, route_id, route_short_name AS short_name"),
    # Columns and sets
    "conform_schema": f"""{with_views("routes")}
        SELECT {shaped(MACRO, "route_id route_short_name route_color shape_pt_sequence")}
        FROM (SELECT *, TRY_CAST(route_id AS BIGINT) AS shape_pt_sequence FROM routes)""",
    "union_by_name": f"""{with_views("routes", "stops")}
        SELECT {F}, stop_id, stop_name, CAST(NULL AS VARCHAR) AS route_id FROM stops
        UNION ALL SELECT {F}, NULL, NULL, route_id FROM routes""",
    "join_suffixed": f"""{with_views("routes")}
        SELECT {feed("a")}, a.route_id, a.route_short_name AS short_name,
               a.route_color AS route_color_x, 1 AS n, b.route_color AS route_color_y
        FROM routes a JOIN routes b ON {on("a", "b", "route_id")}""",
    "keep_first": "SELECT o_orderkey, o_orderstatus FROM orders",
    "rows_with_names": _view("routes") + " WHERE route_short_name IS NOT NULL",
    "rows_without_names": _view("stops", f"{F}, stop_id") + " WHERE stop_name IS NULL",
    "trips_of_routes": f"""{with_views("routes", "trips")} SELECT {F}, trip_id, route_id FROM trips t
        WHERE EXISTS (SELECT 1 FROM routes r WHERE {on("r", "t", "route_id")}
                      AND r.route_color IS NOT NULL)""",
    # Joins and keys
    "trips_with_routes": f"""{with_views("routes", "trips")}
        SELECT t.*, r.route_short_name, r.route_color FROM trips t
        JOIN routes r ON {on("t", "r", "route_id")}""",
    "calls_with_routes": f"""{with_views("routes", "trips", "stop_times", "stops")}
        SELECT {feed("t")}, t.trip_id, s.stop_id, t.route_id, r.route_short_name, p.stop_name
        FROM trips t JOIN stop_times s ON {on("t", "s", "trip_id")}
        JOIN stops p ON {on("s", "p", "stop_id")} JOIN routes r ON {on("t", "r", "route_id")}
        WHERE r.route_short_name IS NOT NULL""",
    "stops_with_lines": f"""{WITH_CALLS} SELECT {feed("p")}, {clean("p.stop_id")} AS stop_id,
        coalesce(l.lines_by_stop, '') AS lines_by_stop FROM stops p
        LEFT JOIN lines l ON {on("p", "l")} AND {clean("p.stop_id")} = l.stop_id""",
    "trips_with_stops": f"""{with_views("trips", "stop_times")} SELECT t.* FROM trips t
        WHERE EXISTS (SELECT 1 FROM stop_times s WHERE {on("s", "t", "trip_id")})""",
    "repeated_routes": _view("routes", f"{F}, route_id, count(*) AS n_rows")
    + f" GROUP BY {F}, route_id HAVING count(*) > 1",
    "route_attributes": f"""{with_views("routes", "trips")}, one AS (SELECT * FROM (SELECT *, row_number()
            OVER (PARTITION BY {F}, route_id ORDER BY route_short_name NULLS FIRST,
            route_color NULLS FIRST) AS nth FROM routes) WHERE nth = 1)
        SELECT {feed("t")}, t.trip_id, t.route_id, r.route_short_name,
               {combo_blue("r.route_color")} AS route_color
        FROM trips t LEFT JOIN one r ON {on("t", "r", "route_id")}""",
    "unmatched_routes": f"""{with_views("routes", "trips")}
        SELECT DISTINCT {F}, route_id FROM trips t WHERE route_id IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM routes r WHERE {on("r", "t", "route_id")})""",
    "key_overlap": f"""{with_views("routes", "trips")},
        lk AS (SELECT DISTINCT {F}, route_id AS k FROM trips WHERE route_id IS NOT NULL),
        rk AS (SELECT DISTINCT {F}, route_id AS k FROM routes),
        both_sides AS (SELECT {F}, k, max(l) AS l, max(r) AS r FROM
            (SELECT *, 1 AS l, 0 AS r FROM lk UNION ALL SELECT *, 0, 1 FROM rk) GROUP BY {F}, k)
        SELECT {F}, CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right,
            CAST(sum(l * r) AS BIGINT) AS n_common, CAST(sum(l * (1 - r)) AS BIGINT) AS n_only_left,
            CAST(sum(r * (1 - l)) AS BIGINT) AS n_only_right,
            CASE WHEN sum(l * r) = 0 THEN array_to_string(list_sort(list(k) FILTER (l = 1))[:5], '|')
                 ELSE '' END AS sample_left,
            CASE WHEN sum(l * r) = 0 THEN array_to_string(list_sort(list(k) FILTER (r = 1))[:5], '|')
                 ELSE '' END AS sample_right
        FROM both_sides GROUP BY {F}""",
    "key_choice": f"""{with_views("routes", "trips")}, {MATCHED}
        SELECT {feed("f")}, coalesce({list(NAMES)}[rung + 1], 'none') AS rung,
               coalesce(n_common, 0) AS n_common
        FROM (SELECT DISTINCT {F} FROM routes) f LEFT JOIN choice c ON {on("f", "c")}""",
    "resolve_keys": f"""{with_views("routes", "trips")}, {MATCHED}
        SELECT {feed("t")}, t.trip_id, t.rid AS route_id, r.route_color
        FROM ktrips t JOIN kroutes r ON {on("t", "r", "rid")}""",
    # Listings, manifest and requests
    "listing_filter": _view("listing")
    + f" WHERE path LIKE '%.txt' AND split_part(path, '/', 3) IN {_in(LISTED_TYPES)}",
    "listing_of_feed": _view("listing")
    + """ WHERE path LIKE '%.txt' AND split_part(path, '/', 3) IN ('STOPS', 'TRIPS')
        AND contains(path, '/explotation=7/contract=1/version=v_2/')""",
    "listing_of_escaped_feed": _view("listing")
    + """ WHERE path LIKE '%.txt' AND split_part(path, '/', 3) IN ('STOPS', 'TRIPS')
        AND contains(path, '/explotation=7/contract=1/version=v%3A4/')""",
    "listing_folders": f"""{with_views("listing")}
        SELECT left(path, length(path) - length(split_part(path, '/', -1)) - 1) AS folder,
               count(*) AS n_files FROM listing
        WHERE path LIKE '%.txt' AND split_part(path, '/', 3) IN {_in(LISTED_TYPES)} GROUP BY 1""",
    "feed_completeness": f"{_COMPLETE} SELECT * FROM complete",
    "manifest": f"""{_COMPLETE} SELECT explotation || '_' || contract || '_' || version AS id,
        explotation AS P_EMPRESA, contract AS P_CONTR, version AS P_VERSION, 'pending' AS status,
        '{AS_OF}' AS discovery_time, gtfs_types FROM complete WHERE is_complete""",
    "manifest_summary": f"""{_COMPLETE} SELECT count(*) AS total, '{AS_OF}' AS timestamp,
        'store' AS root FROM complete WHERE is_complete""",
    "requests_decode": """SELECT event_id, CAST(turn AS INTEGER) AS position,
            CASE WHEN event_id % 4 = 3 THEN NULL WHEN turn = 1 THEN 500 ELSE 200 END AS status_code,
            CAST(user_id AS VARCHAR) AS P_EMPRESA, CAST(NULL AS VARCHAR) AS P_CONTR,
            'v_' || CAST(event_id AS VARCHAR) AS P_VERSION, CAST(NULL AS VARCHAR) AS P_LINE
        FROM (SELECT event_id, user_id, unnest(CASE WHEN event_id % 4 = 1 THEN [0, 1] ELSE [0] END)
              AS turn FROM events)""",
    "requests_round_trip": f"""{with_views("manifest")} SELECT {RUN}, 'es' AS P_ENV, P_EMPRESA || '-' || P_VERSION AS NOMBRE_EMPRESA, 200 AS status_code FROM manifest""",
    "required_fields": f"""{with_views("manifest")} SELECT {RUN},
        CASE WHEN P_CONTR IS NULL THEN 'Campo requerido P_CONTR no encontrado'
             WHEN P_CONTR = '' THEN 'Campo P_CONTR está vacío' ELSE '' END AS message,
        coalesce(P_CONTR, '') <> '' AS is_valid FROM manifest""",
    # Ledger
    "ledger_register": f"""{_REG}
        SELECT l.id, l.P_EMPRESA, l.P_CONTR, l.P_VERSION,
            CASE WHEN again THEN 'pending' ELSE l.status END AS status,
            CASE WHEN again THEN coalesce(l.retries, 0) + 1 ELSE l.retries END AS retries,
            l.registered_at, CASE WHEN again THEN '{AS_OF}' END AS reset_at,
            CASE WHEN again AND l.status = 'failed' THEN NULL ELSE l.error END AS error
        FROM (SELECT l.*, coalesce(r.result = 'reset', FALSE) AS again FROM ledger l
              LEFT JOIN results r ON l.P_EMPRESA = r.P_EMPRESA AND l.P_CONTR = r.P_CONTR
              AND l.P_VERSION = r.P_VERSION) l
        UNION ALL SELECT id, {RUN}, 'pending', 0, '{AS_OF}', NULL, NULL FROM results
        WHERE result = 'registered'""",
    "ledger_outcomes": f"{_REG} SELECT * FROM results",
    "outcome_tally": f"""{_REG} SELECT count(*) FILTER (result = 'registered') AS registered,
        count(*) FILTER (result = 'reset') AS reset,
        CAST(sum(CASE result WHEN 'skipped' THEN repeats + 1 WHEN 'error' THEN 0 ELSE repeats END)
             AS BIGINT) AS skipped,
        CAST(sum(CASE result WHEN 'error' THEN repeats + 1 ELSE 0 END) AS BIGINT) AS errors
        FROM results""",
    "ledger_merge": f"""{with_views("manifest", "ledger")}
        SELECT id, {RUN}, status, retries FROM ledger UNION ALL
        SELECT concat_ws('_', {RUN}), {RUN}, 'pending', 0 FROM (SELECT DISTINCT {RUN} FROM manifest m
            WHERE P_EMPRESA <> '' AND P_CONTR <> '' AND P_VERSION <> '' AND NOT EXISTS (SELECT 1 FROM ledger l WHERE l.P_EMPRESA = m.P_EMPRESA
                AND l.P_CONTR = m.P_CONTR AND l.P_VERSION = m.P_VERSION))""",
    "ledger_repair": f"""{_JUDGED} SELECT id,
        CASE WHEN reason IS NOT NULL THEN 'pending' ELSE status END AS status,
        CASE WHEN reason IS NOT NULL THEN coalesce(retries, 0) + 1 ELSE retries END AS retries,
        CASE WHEN reason IS NOT NULL THEN '{AS_OF}' END AS reset_at, reason AS reset_reason
        FROM judged WHERE flying OR reason IS NULL""",
    "ledger_repair_actions": f"""{_JUDGED} SELECT id, CASE WHEN flying THEN 'reset' ELSE 'deleted' END
        AS action, reason FROM judged WHERE reason IS NOT NULL""",
    "ledger_reset_failed": f"""{LEDGER},
        f AS (SELECT *, coalesce(status = 'failed', FALSE) AS again FROM ledger)
        SELECT id, CASE WHEN again THEN 'pending' ELSE status END AS status,
        CASE WHEN again THEN coalesce(retries, 0) + 1 ELSE retries END AS retries,
        CASE WHEN again THEN '{AS_OF}' END AS reset_at,
        CASE WHEN again THEN '{AS_OF}' ELSE last_updated END AS last_updated,
        CASE WHEN NOT again THEN message END AS message,
        CASE WHEN NOT again THEN error END AS error FROM f""",
    "ledger_expire": f"""{LEDGER}, f AS (SELECT *, coalesce(status IN ('processing',
            'processing_macro', 'processing_macro_stops') AND CAST(jobs_started_at AS TIMESTAMP) < {_NOW} - INTERVAL 4 HOUR, FALSE) AS late FROM ledger)
        SELECT id, CASE WHEN late THEN 'failed' ELSE status END AS status,
        CASE WHEN late THEN 'Timeout después de 4 horas de ejecución' ELSE message END AS message,
        CASE WHEN late THEN '{AS_OF}' ELSE last_updated END AS last_updated FROM f""",
    "ledger_job_fold": f"""{_FOLD} SELECT id,
        CASE WHEN busy AND done THEN CASE WHEN good THEN 'completed' ELSE 'failed' END
             ELSE status END AS status,
        CASE WHEN busy AND done AND NOT good THEN 'Macro: ' || a || ', MacroStops: ' || b
             ELSE message END AS message,
        CASE WHEN busy THEN a END AS macro_status, CASE WHEN busy THEN b END AS macro_stops_status,
        CASE WHEN busy AND done THEN '{AS_OF}' END AS jobs_completed_at,
        CASE WHEN busy AND NOT done THEN '{AS_OF}' END AS last_checked,
        CASE WHEN busy AND done THEN '{AS_OF}' ELSE last_updated END AS last_updated FROM folded""",
    "ledger_updates": f"""{with_views("updates", "ledger")},
        last AS (SELECT * FROM (SELECT *, row_number() OVER
            (PARTITION BY {RUN} ORDER BY CAST(updated_at AS TIMESTAMPTZ) DESC) AS nth FROM updates) WHERE nth = 1)
        SELECT l.id, coalesce(u.status, l.status) AS status,
            coalesce(nullif(u.message, ''), l.message) AS message,
            coalesce(nullif(u.error, ''), l.error) AS error,
            coalesce(u.updated_at, l.last_updated) AS last_updated
        FROM ledger l LEFT JOIN last u ON l.P_EMPRESA = u.P_EMPRESA AND l.P_CONTR = u.P_CONTR
            AND l.P_VERSION = u.P_VERSION""",
    "next_pending": f"""{LEDGER} SELECT id, status, registered_at, row_number() OVER (ORDER BY registered_at NULLS FIRST, id)::INT AS position FROM ledger
        WHERE status = 'pending' AND P_EMPRESA <> '' AND P_CONTR <> '' AND P_VERSION <> '' ORDER BY registered_at NULLS FIRST, id LIMIT 20""",
    "ledger_claim": f"""{LEDGER}, chosen AS (SELECT id FROM ledger WHERE status = 'pending'
            AND P_EMPRESA <> '' AND P_CONTR <> '' AND P_VERSION <> '' ORDER BY registered_at NULLS FIRST, id LIMIT 7)
        SELECT id, CASE WHEN id IN (SELECT id FROM chosen) THEN 'processing' ELSE status END AS status,
        CASE WHEN id IN (SELECT id FROM chosen) THEN '{AS_OF}' ELSE started_at END AS started_at,
        CASE WHEN id IN (SELECT id FROM chosen) THEN 'run-' || id || '-20240130200000' END
            AS execution_id FROM ledger""",
    "ledger_status_words": f"""{LEDGER} SELECT id, status FROM ledger
        WHERE status IN ('failed', 'preprocessed')""",
    # Reports
    "by_status": f"""{LEDGER} SELECT coalesce(status, 'unknown') AS status, count(*) AS n
        FROM ledger GROUP BY 1""",
    "status_counts": f"""{LEDGER} SELECT count(*) AS total,
        count(*) FILTER (status = 'pending') AS pending,
        count(*) FILTER (status = 'preprocessing') AS preprocessing,
        count(*) FILTER (status = 'processing') AS processing,
        count(*) FILTER (status = 'completed') AS completed,
        count(*) FILTER (status = 'failed') AS failed,
        count(*) FILTER (status = 'preprocessed') AS preprocessed,
        count(*) FILTER (status = 'processing_macro') AS processing_macro,
        count(*) FILTER (status = 'processing_macro_stops') AS processing_macro_stops FROM ledger""",
    "enterprise_summary": f"""{LEDGER} SELECT P_EMPRESA, count(*) AS total,
        count(*) FILTER (status = 'completed') AS completed,
        count(*) FILTER (status = 'failed') AS failed,
        count(*) FILTER (status = 'processing') AS processing,
        count(*) FILTER (status = 'pending') AS pending,
        count(*) FILTER (status = 'completed') * 100 // count(*) AS progress
        FROM ledger GROUP BY P_EMPRESA""",
    "enterprises": f"{LEDGER} SELECT DISTINCT P_EMPRESA FROM ledger",
    "retry_stats": f"""{LEDGER} SELECT CAST(sum(coalesce(retries, 0)) AS BIGINT) AS total_retries,
        count(*) FILTER (retries > 0) AS items_with_retries, max(coalesce(retries, 0)) AS max_retries
        FROM ledger""",
    "completion_pct": f"""{LEDGER}, c AS (SELECT count(*) AS total,
            count(*) FILTER (status = 'completed') AS completed FROM ledger)
        SELECT total, completed, round(completed * 100.0::DOUBLE / total, 2) AS completion_percentage,
               completed * 100 // total AS progress,
               completed * 100.0::DOUBLE / total AS progress_percentage FROM c""",
    "recent_runs": f"""{LEDGER} SELECT id, status, started_at, row_number() OVER (ORDER BY {_STARTED})::INT AS position
        FROM ledger WHERE coalesce(started_at, '') <> '' ORDER BY {_STARTED} LIMIT 5""",
    "failed_runs": f"""{LEDGER} SELECT id, last_updated, message, row_number() OVER (ORDER BY last_updated DESC, id)::INT AS position
        FROM ledger WHERE status = 'failed' ORDER BY last_updated DESC, id LIMIT 10""",
    "errors_by_message": f"""{LEDGER} SELECT {_FAILED}, count(*) AS n FROM ledger
        WHERE status = 'failed' GROUP BY 1""",
    "error_runs": f"{LEDGER} SELECT {_FAILED}, {RUN}, id FROM ledger WHERE status = 'failed'",
    "detailed_report": f"""{LEDGER} SELECT id, {RUN}, status, retries, started_at, last_updated,
        message FROM ledger""",
    "log_classes": f"""{with_views("logs")} SELECT *,
        strftime(make_timestamp(timestamp // 1000 * 1000000), '%Y-%m-%dT%H:%M:%SZ') || ' ['
            || CAST(timestamp AS VARCHAR) || '] ' || message AS line,
        CASE WHEN contains(stream, 'driver') THEN 'driver'
             WHEN contains(stream, 'progress-bar') THEN 'progress-bar'
             WHEN contains(log_group, 'logs-dev') THEN 'dev' ELSE 'general' END AS log_class,
        CASE log_group WHEN '/jobs/error' THEN 'error' WHEN '/jobs/output' THEN 'output' END
            AS log_kind FROM logs""",
    # Storage
    "csv_round_trip": _STOPS_AGAIN,
    "parquet_round_trip": _view("trips"),
    "feeds_without_shapes": _view("routes"),
    "discover_stored_feeds": f"""{with_views("routes")} SELECT DISTINCT
        explotation || '_' || contract || '_' || version AS id, explotation AS P_EMPRESA,
        contract AS P_CONTR, version AS P_VERSION, 'pending' AS status,
        '{AS_OF}' AS discovery_time, '{"|".join(_KINDS)}' AS gtfs_types FROM routes""",
    "ledger_round_trip": f"""{LEDGER} SELECT id, {RUN}, status, retries, started_at, message
        FROM ledger""",
    "ingest_feeds": f"""{WITH_CALLS} SELECT {F}, trip_id, stop_id, stop_sequence, lines_by_stop,
        final_color FROM placed""",
    "listed_files": _view("routes", f"DISTINCT {F}, 'ROUTES' AS gtfs_type"),
}
ORACLE["combo_json_round_trip"] = ORACLE["combo_documents"]
ORACLE["registration_audit"] = (
    f"SELECT *, '{AS_OF}' AS timestamp, 'manifest' AS combinations_file FROM ({ORACLE['outcome_tally']})"
)
_REDELIVERED = "explotation = '1' AND contract = '2' AND trip_id LIKE '%1'"
_KEYS = ("route_id", "trip_id", "shape_id")
_DISTINCT = " UNION ALL ".join(f"SELECT {F}, '{k}' AS key, count(DISTINCT {k}) AS n_distinct FROM trips WHERE {k} IS NOT NULL GROUP BY {F}" for k in _KEYS)
ORACLE |= {
    "read_errors": """SELECT '1' AS explotation, '1' AS contract, '2025:04' AS version, 'routes' AS "table", count(*) AS n_rows,
        min(CAST(n_nationkey AS VARCHAR) || ',' || n_name || ',AB12CD,extra') AS example FROM nation WHERE n_nationkey % 5 = 0""",
    "checked_outcomes": f"""SELECT {F}, CASE WHEN {_BROKEN} THEN 'error' ELSE status END AS status,
        CASE WHEN {_BROKEN} THEN 'Filas ilegibles en: routes' ELSE message END AS message,
        CASE WHEN NOT ({_BROKEN}) THEN n_routes END AS n_routes FROM ({ORACLE["preprocess_outcomes"]})""",
    "redelivered_product": _view("trips") + f" WHERE explotation = '2' OR ({_REDELIVERED})",
    "product_manifest": f"""{with_views("trips")}
        SELECT {F}, CAST(0 AS BIGINT) AS commit, count(*) AS n_rows FROM trips GROUP BY {F} UNION ALL
        SELECT {F}, 1, count(*) FILTER ({_REDELIVERED}) FROM trips WHERE explotation = '1' GROUP BY {F}""",
    "stored_feed": _view("trips") + f" WHERE {_BROKEN}",
    "stored_feeds": _view("trips") + " WHERE contract = '2'",
    "claimed_twice": f"""{LEDGER}, chosen AS (SELECT id FROM ledger WHERE status = 'pending'
            AND P_EMPRESA <> '' AND P_CONTR <> '' AND P_VERSION <> '' ORDER BY registered_at NULLS FIRST, id LIMIT 14)
        SELECT id, CASE WHEN id IN (SELECT id FROM chosen) THEN 'processing' ELSE status END AS status,
        CASE WHEN id IN (SELECT id FROM chosen) THEN 'run-' || id || '-20240130200000' END
            AS execution_id FROM ledger""",
    "claimed_runs": f"""{LEDGER} SELECT id, P_EMPRESA, P_CONTR, P_VERSION, 'run-' || id || '-20240130200000' AS execution_id FROM ledger WHERE status = 'pending'
            AND P_EMPRESA <> '' AND P_CONTR <> '' AND P_VERSION <> '' ORDER BY registered_at NULLS FIRST, id LIMIT 7 OFFSET 7""",
    "ledger_document": ORACLE["ledger_round_trip"],
    "document_counters": f"SELECT *, '{AS_OF}' AS last_updated FROM ({ORACLE['status_counts']})",
    "written_manifest": f"SELECT id, P_EMPRESA, P_CONTR, P_VERSION, status, discovery_time, gtfs_types FROM ({ORACLE['manifest']})",
    "written_reports": ORACLE["errors_by_message"],
    "distinct_keys": f"{with_views('trips')} {_DISTINCT}",
    "sketch_estimates": f"{with_views('trips')} SELECT *, TRUE AS within FROM ({_DISTINCT})",
}
ORACLE["outcome_rungs"] = f"SELECT {F}, rung AS key_rung, n_common AS n_common_keys FROM ({ORACLE['key_choice']})"
