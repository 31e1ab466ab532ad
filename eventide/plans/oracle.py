"""ANSI SQL oracles (DuckDB dialect) for the registered queries.

They are written independently of the Spark plans - plain window functions
and joins over the stored tables - and must give the same rows.  Parameters
come from :mod:`eventide.plans.params`.
"""

from __future__ import annotations

from . import params as P
from ..functions import geo as G
from ..functions.text import WS
from ..operators import topn as T
from ..operators import watermark as W
from ..sources import rides as R

# events with event time in ms and the replay arrival time
EV = (f"SELECT event_id, ts, user_id, event_type, value, (epoch_us(ts) // 1000) AS t_ms, "
      f"(epoch_us(ts) // 1000) + ((event_id * {W.ARRIVAL_MULT}) % {W.ARRIVAL_SPREAD_S}) * 1000 AS arr_ms "
      f"FROM events")


def _coord(name: str, key: str = "ride_id") -> str:
    base, mult, span = R.COORD_RULES[name]
    return (f"CAST(CAST({base} + ({key} * {mult}) % {span} AS DOUBLE) / CAST(10000 AS DOUBLE) "
            f"AS FLOAT) AS {name}")


RIDES = f"""SELECT ride_id, is_start, event_time, {', '.join(_coord(c) for c in R.COORD_RULES)},
  CAST(1 + ride_id % 4 AS SMALLINT) AS passenger_cnt,
  {R.DRIVER_BASE} + (ride_id * 7) % {R.N_TAXIS} AS taxi_id,
  {R.DRIVER_BASE} + ride_id % {R.N_DRIVERS} AS driver_id
FROM (SELECT o_orderkey AS ride_id, TRUE AS is_start, o_orderdate AS event_time FROM orders
      UNION ALL
      SELECT l_orderkey, FALSE, min(l_shipdate) FROM lineitem GROUP BY l_orderkey)"""

FARES = """SELECT l_orderkey AS ride_id, l_shipdate AS start_time,
  CAST(l_extendedprice AS FLOAT) AS total_fare, l_linenumber AS fare_line, l_partkey AS fare_part
FROM lineitem"""


def _in_box(lon: str, lat: str) -> str:
    return (f"(CAST({lon} AS DOUBLE) >= CAST({G.LON_WEST} AS DOUBLE) AND "
            f"CAST({lon} AS DOUBLE) <= CAST({G.LON_EAST} AS DOUBLE) AND "
            f"CAST({lat} AS DOUBLE) >= CAST({G.LAT_SOUTH} AS DOUBLE) AND "
            f"CAST({lat} AS DOUBLE) <= CAST({G.LAT_NORTH} AS DOUBLE))")


def _gx(lon: str) -> str:
    return (f"CAST(floor((CAST({abs(G.LON_WEST)} AS DOUBLE) - CAST(abs({lon}) AS DOUBLE)) "
            f"/ CAST({G.DELTA_LON} AS DOUBLE)) AS INTEGER)")


def _gy(lat: str) -> str:
    return (f"CAST(floor((CAST({G.LAT_NORTH} AS DOUBLE) - CAST({lat} AS DOUBLE)) "
            f"/ CAST({G.DELTA_LAT} AS DOUBLE)) AS INTEGER)")


NYC = (f"SELECT * FROM ({RIDES}) WHERE is_start AND {_in_box('start_lon', 'start_lat')} "
       f"AND {_in_box('end_lon', 'end_lat')}")


def _dist(lon1, lat1, lon2, lat2) -> str:
    dlat = f"CAST(({lat1} - {lat2}) AS DOUBLE)"
    dlon = f"(CAST(({lon1} - {lon2}) AS DOUBLE) * cos(CAST({lat2} AS DOUBLE)))"
    return f"(CAST({G.DEG_LEN} AS DOUBLE) * sqrt({dlat} * {dlat} + {dlon} * {dlon}))"


_PLON = f"CAST(CAST({P.NEAR_LON} AS DOUBLE) AS FLOAT)"
_PLAT = f"CAST(CAST({P.NEAR_LAT} AS DOUBLE) AS FLOAT)"

HOURLY = ("SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, user_id, "
          "round(sum(value), 2) AS tips FROM events GROUP BY ALL")

MEANS = ("SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, "
         "time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end, user_id, "
         "round(sum(value), 2) / count(*) AS avg_value, "
         "CAST(round(round(sum(value), 2) * 100) AS BIGINT) AS sum_cents, count(*) AS n "
         "FROM events GROUP BY ALL")


def _late_scan() -> str:
    d, s, lt = P.LATE_DELAY_MS, P.LATE_SIZE_MS, P.LATE_LATENESS_MS
    return f"""
sc AS (SELECT *,
   max(t_ms) OVER (ORDER BY arr_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_before,
   max(t_ms) OVER (ORDER BY arr_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_incl
   FROM ({EV})),
c AS (SELECT *, max_before - {d + 1} AS wm_before, max_incl - {d + 1} AS wm_after,
   t_ms - t_ms % {s} AS ws, t_ms - t_ms % {s} + {s} AS we FROM sc),
k AS (SELECT *, CASE WHEN wm_before IS NOT NULL AND we - 1 + {lt} <= wm_before THEN 'too_late'
                     WHEN wm_before IS NOT NULL AND we - 1 <= wm_before THEN 'late'
                     ELSE 'on_time' END AS status FROM c)"""


def _silence(gap: int) -> str:
    return f"""SELECT user_id, cnt AS count, CAST(ts AS TIMESTAMP) AS last_modified FROM (
  SELECT user_id, make_timestamp(t_ms * 1000) AS ts,
    row_number() OVER (PARTITION BY user_id ORDER BY t_ms, event_id) AS cnt,
    lead(t_ms) OVER (PARTITION BY user_id ORDER BY t_ms, event_id) AS nt, t_ms
  FROM ({EV})) WHERE nt IS NULL OR nt - t_ms > {gap}"""


def _pairs(src: str, key: str, order: str, timeout: int | None) -> str:
    """Pairing rule in SQL: islands by side repeat / gap, position parity."""
    gap = f" OR t_ms - lag(t_ms) OVER w > {timeout}" if timeout is not None else ""
    ngap = f" OR lead(t_ms) OVER w - t_ms > {timeout}" if timeout is not None else ""
    return f"""
a AS (SELECT *,
   CASE WHEN lag(side) OVER w IS NULL OR lag(side) OVER w = side{gap} THEN 1 ELSE 0 END AS new_island,
   CASE WHEN lead(side) OVER w IS NULL OR lead(side) OVER w = side{ngap} THEN 1 ELSE 0 END AS next_new,
   lead(side) OVER w AS n_side, lead(t_ms) OVER w AS n_t
   FROM ({src}) WINDOW w AS (PARTITION BY {key} ORDER BY {order})),
b AS (SELECT *, sum(new_island) OVER (PARTITION BY {key} ORDER BY {order}
                                      ROWS UNBOUNDED PRECEDING) AS island FROM a),
p AS (SELECT *, row_number() OVER (PARTITION BY {key}, island ORDER BY {order}) - 1 AS pos,
   lag(event_key) OVER (PARTITION BY {key}, island ORDER BY {order}) AS prev_key FROM b)"""


_TIMED_SRC = (f"SELECT user_id, event_id, event_id AS event_key, ts, t_ms, "
              f"CASE WHEN event_type = '{P.MATCH_RIDE_TYPE}' THEN 'ride' ELSE 'fare' END AS side "
              f"FROM ({EV}) WHERE event_type IN ('{P.MATCH_RIDE_TYPE}', '{P.MATCH_FARE_TYPE}')")

_RF_SRC = f"""SELECT ride_id, 0 AS side, (epoch_us(event_time) // 1000) AS t_ms, CAST(NULL AS INTEGER) AS fare_line,
     CAST(NULL AS BIGINT) AS fare_part, CAST(NULL AS FLOAT) AS total_fare
   FROM ({RIDES}) WHERE is_start
   UNION ALL
   SELECT ride_id, 1, (epoch_us(start_time) // 1000), fare_line, fare_part, total_fare FROM ({FARES})"""
_RF_ORDER = ("t_ms, side, fare_line NULLS FIRST, fare_part NULLS FIRST, "
             "total_fare NULLS FIRST")

REPORT_ENTRY = (f"'No' || CAST(rn - 1 AS VARCHAR) || ':' || '{T.ENTRY_ID_LABEL}' || "
                f"CAST(user_id AS VARCHAR) || '{T.ENTRY_AVG_LABEL}' || "
                f"CAST(m4 // 10000 AS VARCHAR) || '.' || lpad(CAST(m4 % 10000 AS VARCHAR), 4, '0') "
                f"|| chr(10)")


def _path_sql() -> str:
    """GEO-3 closed form, same rule as :func:`eventide.functions.geo.path_cells`."""
    return f"""
pts AS (SELECT {_gx('start_lon')} AS x1, {_gy('start_lat')} AS y1,
               {_gx('end_lon')} AS x2, {_gy('end_lat')} AS y2 FROM ({NYC})),
o AS (SELECT CASE WHEN x1 > x2 THEN x2 ELSE x1 END AS sx, CASE WHEN x1 > x2 THEN y2 ELSE y1 END AS sy,
             CASE WHEN x1 > x2 THEN x1 ELSE x2 END AS ex, CASE WHEN x1 > x2 THEN y1 ELSE y2 END AS ey0
      FROM pts),
m AS (SELECT *, ey0 < sy AS falling, CASE WHEN ey0 < sy THEN 2 * sy - ey0 ELSE ey0 END AS ey FROM o),
sl AS (SELECT *, CAST(ey - sy AS DOUBLE) / (CAST(ex - sx AS DOUBLE) + 1e-8) AS s,
              row_number() OVER () AS rid FROM m),
cols AS (SELECT sl.*, gx.x,
     CASE WHEN gx.x = sx THEN sy
          ELSE greatest(sy, CAST(floor((gx.x - 1 - sx + 0.5) * s + sy - 0.5 + 0.05) AS INTEGER) + 1) END AS a
   FROM sl, generate_series(sx, ex) AS gx(x)),
cols2 AS (SELECT *, CASE WHEN x = ex THEN ey
          ELSE greatest(a, CAST(floor((x - sx + 0.5) * s + sy - 0.5 - 0.05) AS INTEGER) + 1) END AS b
   FROM cols),
cells AS (SELECT CAST(x + {G.NUMBER_OF_GRID_X} * (CASE WHEN falling THEN 2 * sy - gy.y ELSE gy.y END)
                       AS INTEGER) AS cell_id
   FROM cols2, generate_series(a, b) AS gy(y))"""


ORACLE: dict[str, str] = {
    "hourly_best_user": f"""
WITH h AS ({HOURLY})
SELECT window_end, user_id, tips FROM h
QUALIFY row_number() OVER (PARTITION BY window_end ORDER BY tips DESC, user_id) = 1""",

    "hourly_tips_inclusive_end": f"""
WITH w AS (SELECT *, max(t_ms) OVER (ORDER BY arr_ms, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1 AS wm_before FROM ({EV}))
SELECT user_id, make_timestamp((t_ms - t_ms % {P.HOURLY_MS} + {P.HOURLY_MS} - 1) * 1000) AS window_end,
       round(sum(value), 2) AS tips
FROM w WHERE wm_before IS NULL OR t_ms > wm_before GROUP BY ALL""",

    "rolling_hour_best": f"""
WITH h AS ({HOURLY}),
r AS (SELECT *, max(tips) OVER (PARTITION BY window_end ORDER BY user_id ROWS UNBOUNDED PRECEDING) AS mt
      FROM h)
SELECT window_end, user_id AS upto_user_id,
       min(user_id) OVER (PARTITION BY window_end, mt) AS user_id, mt AS tips FROM r""",

    "window_min_record": """
SELECT event_id, user_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 15 MINUTE, ts)
                           ORDER BY value, ts, event_id) = 1""",

    "window_min_with_bounds": """
SELECT user_id, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end, event_id, ts, value
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 15 MINUTE, ts)
                           ORDER BY value, ts, event_id) = 1""",

    "late_rows": f"""
WITH {_late_scan()}
SELECT event_id, user_id, ts, value, make_timestamp(ws * 1000) AS window_start,
       wm_before AS watermark_ms
FROM k WHERE status = 'too_late'""",

    "window_min_late_changelog": f"""
WITH {_late_scan()},
fire AS (SELECT g.kk * {P.LATE_SIZE_MS} AS we, wm_after AS fire_wm
   FROM k, generate_series(CAST(floor((coalesce(wm_before, wm_after) + 1) / {P.LATE_SIZE_MS}) AS BIGINT) + 1,
                           CAST(floor((wm_after + 1) / {P.LATE_SIZE_MS}) AS BIGINT)) AS g(kk)
   WHERE max_before IS NULL OR t_ms > max_before),
ot AS (SELECT user_id, ws, we, min({{'v': value, 'a': arr_ms, 'i': event_id, 'ts': ts}}) AS rec
   FROM k WHERE status = 'on_time' GROUP BY ALL),
on_time AS (SELECT ot.user_id, ot.ws, ot.we, coalesce(fire.fire_wm, {W.END_OF_INPUT_WM}) AS watermark_ms,
   CASE WHEN fire.fire_wm IS NULL THEN 'final' ELSE 'on_time' END AS kind, rec
   FROM ot LEFT JOIN fire ON ot.we = fire.we),
acc AS (SELECT *, min({{'v': value, 'a': arr_ms, 'i': event_id, 'ts': ts}}) OVER (
     PARTITION BY user_id, ws ORDER BY arr_ms, event_id ROWS UNBOUNDED PRECEDING) AS rec
   FROM k WHERE status <> 'too_late'),
late AS (SELECT user_id, ws, we, wm_before AS watermark_ms, 'late' AS kind, rec FROM acc
   WHERE status = 'late'),
u AS (SELECT * FROM on_time UNION ALL SELECT * FROM late)
SELECT user_id, make_timestamp(ws * 1000) AS window_start, make_timestamp(we * 1000) AS window_end,
       watermark_ms, kind, rec.i AS event_id, rec.ts AS ts, rec.v AS value FROM u""",

    "top3_mean": f"""
WITH m AS ({MEANS})
SELECT window_start, window_end,
       row_number() OVER (PARTITION BY window_start ORDER BY avg_value DESC, user_id) AS rank,
       user_id, avg_value FROM m
QUALIFY rank <= {P.TOP_N}""",

    "top3_exclude_last": f"""
WITH m AS ({MEANS}),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY avg_value DESC, user_id) AS rank,
             count(*) OVER (PARTITION BY window_start) AS cnt FROM m)
SELECT window_start, window_end, rank, user_id, avg_value FROM r
WHERE rank <= least({P.TOP_N}, cnt - 1)""",

    "top3_report": f"""
WITH m AS ({MEANS}),
r AS (SELECT (epoch_us(window_end) // 1000) AS window_end_ms, user_id, sum_cents, n,
             row_number() OVER (PARTITION BY window_start ORDER BY avg_value DESC, user_id) AS rn,
             count(*) OVER (PARTITION BY window_start) AS cnt,
             (sum_cents * 200 + n) // (2 * n) AS m4 FROM m)
SELECT window_end_ms,
       chr(10) || '{T.RULE}' || chr(10) || '{T.HEADER_LABEL}' || CAST(window_end_ms AS VARCHAR) || chr(10)
       || coalesce(string_agg(CASE WHEN rn <= least({P.TOP_N}, cnt - 1) THEN {REPORT_ENTRY} END, ''
                              ORDER BY rn), '')
       || '{T.RULE}' || chr(10) || chr(10) AS report
FROM r GROUP BY window_end_ms""",

    "running_count": """
SELECT event_id, user_id,
       count(*) OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id ROWS UNBOUNDED PRECEDING) AS running_count
FROM events""",

    "key_count": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",

    "ride_order": f"""
SELECT row_number() OVER (ORDER BY event_time, NOT is_start, ride_id) AS position, ride_id, is_start,
       event_time FROM ({RIDES})""",

    "word_count": f"""
WITH l AS (SELECT unnest(string_split(regexp_replace(text, '\\n\\z', ''), chr(10))) AS line FROM documents),
t AS (SELECT CASE WHEN line = '' THEN [''] WHEN regexp_matches(line, '^{WS}+\\z') THEN []::VARCHAR[]
                  ELSE string_split_regex(regexp_replace(line, '{WS}+\\z', ''), '{WS}') END AS toks FROM l)
SELECT word, count(*) AS n FROM (SELECT unnest(toks) AS word FROM t) GROUP BY word""",

    "fraud_alerts": f"""
WITH x AS (SELECT *, lag(value) OVER w AS pv, lag(t_ms) OVER w AS pt FROM ({EV})
           WINDOW w AS (PARTITION BY user_id ORDER BY t_ms, event_id))
SELECT user_id AS account_id, event_id, ts, value AS amount FROM x
WHERE pv < {P.FRAUD_SMALL} AND value > {P.FRAUD_LARGE} AND t_ms - pt <= {P.FRAUD_WITHIN_MS}""",

    "silence_counts_60s": _silence(P.SILENCE_SHORT_MS),
    "silence_counts_1h": _silence(P.SILENCE_LONG_MS),

    "session_counts": f"""
WITH a AS (SELECT user_id, t_ms, event_id,
     CASE WHEN lag(t_ms) OVER w IS NULL OR t_ms - lag(t_ms) OVER w > {P.SESSION_GAP_MS} THEN 1 ELSE 0 END AS nw
   FROM ({EV}) WINDOW w AS (PARTITION BY user_id ORDER BY t_ms, event_id)),
b AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY t_ms, event_id ROWS UNBOUNDED PRECEDING) AS sid
   FROM a)
SELECT user_id, make_timestamp(min(t_ms) * 1000) AS session_start,
       make_timestamp((max(t_ms) + {P.SESSION_GAP_MS}) * 1000) AS session_end, count(*) AS n
FROM b GROUP BY user_id, sid""",

    "long_rides": f"""
WITH g AS (SELECT ride_id, min(CASE WHEN is_start THEN (epoch_us(event_time) // 1000) END) AS s,
                  min(CASE WHEN NOT is_start THEN (epoch_us(event_time) // 1000) END) AS e
           FROM ({RIDES}) GROUP BY ride_id)
SELECT ride_id, make_timestamp(s * 1000) AS start_time, make_timestamp(e * 1000) AS end_time FROM g
WHERE s IS NOT NULL AND (e IS NULL OR e - s > {P.LONG_RIDE_MS})""",

    "ride_fare_match": f"""
WITH src AS (SELECT *, ride_id AS event_key FROM ({_RF_SRC})),
a AS (SELECT *,
   CASE WHEN lag(side) OVER w IS NULL OR lag(side) OVER w = side THEN 1 ELSE 0 END AS new_island,
   lag(side) OVER w AS p_side, lag(t_ms) OVER w AS p_t, lag(fare_line) OVER w AS p_line,
   lag(total_fare) OVER w AS p_fare
   FROM src WINDOW w AS (PARTITION BY ride_id ORDER BY {_RF_ORDER})),
b AS (SELECT *, sum(new_island) OVER (PARTITION BY ride_id ORDER BY {_RF_ORDER}
                                      ROWS UNBOUNDED PRECEDING) AS island FROM a),
p AS (SELECT *, row_number() OVER (PARTITION BY ride_id, island ORDER BY {_RF_ORDER}) - 1 AS pos FROM b)
SELECT ride_id,
  make_timestamp(CASE WHEN p_side = 0 THEN p_t ELSE t_ms END * 1000) AS ride_time,
  make_timestamp(CASE WHEN p_side = 0 THEN t_ms ELSE p_t END * 1000) AS fare_time,
  CASE WHEN p_side = 0 THEN fare_line ELSE p_line END AS fare_line,
  CASE WHEN p_side = 0 THEN total_fare ELSE p_fare END AS total_fare
FROM p WHERE pos % 2 = 1""",

    "timed_match": f"""
WITH {_pairs(_TIMED_SRC, 'user_id', 't_ms, event_id', P.MATCH_TIMEOUT_MS).strip()},
q AS (SELECT p.*, lag(ts) OVER (PARTITION BY user_id, island ORDER BY t_ms, event_id) AS prev_ts FROM p)
SELECT user_id,
  CASE WHEN side = 'fare' THEN prev_key ELSE event_id END AS ride_event_id,
  CASE WHEN side = 'fare' THEN prev_ts ELSE ts END AS ride_ts,
  CASE WHEN side = 'fare' THEN event_id ELSE prev_key END AS fare_event_id,
  CASE WHEN side = 'fare' THEN ts ELSE prev_ts END AS fare_ts
FROM q WHERE pos % 2 = 1""",

    "timed_unmatched": f"""
WITH {_pairs(_TIMED_SRC, 'user_id', 't_ms, event_id', P.MATCH_TIMEOUT_MS).strip()}
SELECT user_id, side, event_id, ts,
  CASE WHEN n_side = side AND n_t - t_ms <= {P.MATCH_TIMEOUT_MS} THEN 'superseded' ELSE 'timeout' END AS reason
FROM p WHERE pos % 2 = 0 AND next_new = 1""",

    "geofence": f"SELECT ride_id, is_start, start_lon, start_lat, end_lon, end_lat FROM ({RIDES}) "
                f"WHERE {_in_box('start_lon', 'start_lat')} AND {_in_box('end_lon', 'end_lat')}",

    "rides_per_cell": f"""
SELECT {_gx('start_lon')} + {_gy('start_lat')} * {G.NUMBER_OF_GRID_X} AS cell_id, count(*) AS n
FROM ({NYC}) GROUP BY 1""",

    "cell_centres": f"""
WITH c AS (SELECT {_gx('start_lon')} + {_gy('start_lat')} * {G.NUMBER_OF_GRID_X} AS cell_id, count(*) AS n
           FROM ({NYC}) GROUP BY 1)
SELECT cell_id,
  CAST(CAST({abs(G.LON_WEST)} AS DOUBLE) - (cell_id % {G.NUMBER_OF_GRID_X}) * CAST({G.DELTA_LON} AS DOUBLE)
       - CAST({G.DELTA_LON} AS DOUBLE) / 2 AS FLOAT) * CAST(-1.0 AS FLOAT) AS center_lon,
  CAST(CAST({G.LAT_NORTH} AS DOUBLE)
       - CAST((cell_id - cell_id % {G.NUMBER_OF_GRID_X}) // {G.NUMBER_OF_GRID_X} AS INTEGER)
         * CAST({G.DELTA_LAT} AS DOUBLE)
       - CAST({G.DELTA_LAT} AS DOUBLE) / 2 AS FLOAT) AS center_lat, n
FROM c""",

    "path_coverage": f"""
WITH {_path_sql().strip()}
SELECT cell_id, count(*) AS n FROM cells GROUP BY cell_id""",

    "distance_per_driver": f"""
SELECT driver_id, count(*) AS rides,
       round(sum({_dist('start_lon', 'start_lat', 'end_lon', 'end_lat')}), 4) AS total_distance
FROM ({NYC}) GROUP BY driver_id""",

    "rides_near_point": f"""
WITH r AS (SELECT ride_id, is_start,
   CASE WHEN is_start THEN {_dist(_PLON, _PLAT, 'start_lon', 'start_lat')}
        ELSE {_dist(_PLON, _PLAT, 'end_lon', 'end_lat')} END AS d
   FROM ({RIDES}))
SELECT ride_id, is_start, round(d, 4) AS distance FROM r WHERE d <= {P.NEAR_RADIUS}""",

    "heading_sectors": f"""
WITH a AS (SELECT CAST(trunc(degrees(atan2(CAST(end_lat - start_lat AS DOUBLE),
                  CAST(end_lon - start_lon AS DOUBLE) * cos(CAST(start_lat AS DOUBLE))))) AS INTEGER) + 179 AS ang
           FROM ({NYC}))
SELECT CAST(trunc(ang / {P.HEADING_SECTOR_DEG}) AS INTEGER) AS sector, count(*) AS n FROM a GROUP BY 1""",

    "bounded_scan": f"""
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts < TIMESTAMP '{P.BOUNDED_BEGIN}' + INTERVAL {P.BOUNDED_DAYS} DAY""",
}

_LINES = f"""
WITH e AS ({EV}),
l AS (SELECT CAST(user_id AS VARCHAR) || ',' ||
        CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
             ELSE CAST(t_ms // 1000 AS VARCHAR) END || ',' ||
        CAST(CAST(round(value * 100) AS BIGINT) // 100 AS VARCHAR) || '.' ||
        lpad(CAST(CAST(round(value * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') AS line FROM e),
p AS (SELECT line, string_split(line, ',') AS f FROM l WHERE trim(line) <> ''),
q AS (SELECT line, f, len(f) = 3 AND TRY_CAST(f[2] AS BIGINT) IS NOT NULL
                     AND TRY_CAST(f[3] AS DOUBLE) IS NOT NULL AS ok FROM p)"""

ORACLE["csv_roundtrip"] = _LINES + """
SELECT f[1] AS id, TRY_CAST(f[2] AS BIGINT) AS timestamp, TRY_CAST(f[3] AS DOUBLE) AS temperature
FROM q WHERE ok"""
ORACLE["csv_quarantine"] = _LINES + "\nSELECT line FROM q WHERE NOT ok"

ORACLE["lines_sensor"] = ("SELECT CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000000 AS timestamp, "
                          "round(value, 2) AS temperature FROM events")
ORACLE["lines_request"] = ("SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS operation_type, "
                           "epoch_us(ts) // 1000000 AS timestamp FROM events")
ORACLE["stream_lines_request"] = ORACLE["lines_request"]
ORACLE["lines_ride"] = (f"SELECT CAST(ride_id AS VARCHAR) AS ride_id, CASE WHEN is_start THEN 'START' ELSE 'END' END AS type, "
                        f"epoch_us(event_time) // 1000000 AS timestamp FROM ({RIDES})")
ORACLE["lines_fare"] = ("SELECT CAST(l_orderkey AS VARCHAR) AS ride_id, CAST(l_extendedprice AS DOUBLE) AS fare, "
                        "epoch_us(l_shipdate) // 1000000 AS timestamp FROM lineitem")

# ----------------------------------------------------------------- streaming lane
# At the end of the available input the watermark is max(event time) - delay
# (in ms); windows closed by it and timers with expiry <= it have fired.
_MAXMS = "(SELECT max(epoch_us(ts) // 1000) FROM events)"

ORACLE["stream_hourly_best"] = f"""
WITH h AS ({HOURLY})
SELECT window_end, user_id, tips FROM h
WHERE epoch_us(window_end) // 1000 <= {_MAXMS}
QUALIFY row_number() OVER (PARTITION BY window_end ORDER BY tips DESC, user_id) = 1"""

ORACLE["stream_top3"] = f"""
WITH m AS ({MEANS})
SELECT window_start, window_end,
       row_number() OVER (PARTITION BY window_start ORDER BY avg_value DESC, user_id) AS rank,
       user_id, avg_value FROM m
WHERE epoch_us(window_end) // 1000 <= {_MAXMS} - 2000
QUALIFY rank <= {P.TOP_N}"""

ORACLE["stream_window_min_updates"] = ORACLE["window_min_with_bounds"]

ORACLE["stream_fraud"] = f"""
WITH x AS (SELECT *, lag(value) OVER w AS pv, lag(t_ms) OVER w AS pt FROM ({EV})
           WINDOW w AS (PARTITION BY user_id ORDER BY t_ms, event_id))
SELECT user_id AS account_id, event_id, make_timestamp(t_ms * 1000) AS ts, value AS amount FROM x
WHERE pv < {P.FRAUD_SMALL} AND value > {P.FRAUD_LARGE} AND t_ms - pt <= {P.FRAUD_WITHIN_MS}"""

ORACLE["stream_silence_1h"] = f"""SELECT user_id, cnt AS count, make_timestamp(t_ms * 1000) AS last_modified FROM (
  SELECT user_id, t_ms,
    row_number() OVER (PARTITION BY user_id ORDER BY t_ms, event_id) AS cnt,
    lead(t_ms) OVER (PARTITION BY user_id ORDER BY t_ms, event_id) AS nt
  FROM ({EV}))
WHERE (nt IS NOT NULL AND nt - t_ms > {P.SILENCE_LONG_MS})
   OR (nt IS NULL AND t_ms + {P.SILENCE_LONG_MS} + 1 <= {_MAXMS})"""

ORACLE["stream_pseudo_window"] = f"""
SELECT user_id, make_timestamp((t_ms - t_ms % {P.HOURLY_MS} + {P.HOURLY_MS} - 1) * 1000) AS window_end,
       round(sum(value), 2) AS tips
FROM ({EV}) WHERE t_ms - t_ms % {P.HOURLY_MS} + {P.HOURLY_MS} - 1 + 1 <= {_MAXMS} GROUP BY ALL"""

ORACLE["stream_long_rides"] = f"""
WITH s AS (SELECT o_orderkey AS ride_id, o_orderdate AS start_time, epoch_us(o_orderdate) // 1000 AS st
           FROM orders),
e AS (SELECT l_orderkey AS ride_id, epoch_us(l_shipdate) // 1000 AS et FROM lineitem),
wm AS (SELECT least((SELECT max(st) FROM s), (SELECT max(et) FROM e)) - 60000 AS wm)
SELECT ride_id, start_time FROM s, wm
WHERE s.st + {P.LONG_RIDE_MS} < wm.wm
  AND NOT EXISTS (SELECT 1 FROM e WHERE e.ride_id = s.ride_id
                  AND e.et >= s.st - {P.END_BEFORE_START_MS} AND e.et <= s.st + {P.LONG_RIDE_MS})"""

_SMAX = (f"(SELECT max(epoch_us(ts) // 1000) FROM events "
         f"WHERE event_type IN ('{P.MATCH_RIDE_TYPE}', '{P.MATCH_FARE_TYPE}'))")

ORACLE["stream_match"] = f"""
WITH {_pairs(_TIMED_SRC, 'user_id', 't_ms, event_id', P.MATCH_TIMEOUT_MS).strip()},
q AS (SELECT p.*, lag(t_ms) OVER (PARTITION BY user_id, island ORDER BY t_ms, event_id) AS prev_t FROM p)
SELECT user_id,
  CASE WHEN side = 'fare' THEN prev_key ELSE event_id END AS ride_event_id,
  make_timestamp(CASE WHEN side = 'fare' THEN prev_t ELSE t_ms END * 1000) AS ride_ts,
  CASE WHEN side = 'fare' THEN event_id ELSE prev_key END AS fare_event_id,
  make_timestamp(CASE WHEN side = 'fare' THEN t_ms ELSE prev_t END * 1000) AS fare_ts
FROM q WHERE pos % 2 = 1"""

ORACLE["stream_unmatched"] = f"""
WITH {_pairs(_TIMED_SRC, 'user_id', 't_ms, event_id', P.MATCH_TIMEOUT_MS).strip()}
SELECT user_id, side, event_id, make_timestamp(t_ms * 1000) AS ts,
  CASE WHEN n_side = side AND n_t - t_ms <= {P.MATCH_TIMEOUT_MS} THEN 'superseded' ELSE 'timeout' END AS reason
FROM p WHERE pos % 2 = 0 AND next_new = 1
  AND (n_side IS NOT NULL OR t_ms + {P.MATCH_TIMEOUT_MS} + 1 <= {_SMAX})"""

ORACLE["stream_word_count"] = ORACLE["word_count"]
ORACLE["stream_key_count"] = ORACLE["key_count"]
ORACLE["stream_sessions"] = f"""
WITH a AS (SELECT user_id, ts, event_id,
     CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > CAST({P.SESSION_GAP_MS} AS BIGINT) * 1000
          THEN 1 ELSE 0 END AS nw
   FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
   FROM a),
s AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {P.SESSION_GAP_MS // 60000} MINUTE AS session_end,
             count(*) AS n FROM b GROUP BY user_id, sid)
SELECT * FROM s WHERE epoch_us(session_end) <= {_MAXMS} * 1000"""

ORACLE["stream_rolling_best"] = f"""
WITH h AS ({HOURLY}),
c AS (SELECT * FROM h WHERE epoch_us(window_end) // 1000 <= {_MAXMS}),
r AS (SELECT *, max(tips) OVER (PARTITION BY window_end ORDER BY user_id ROWS UNBOUNDED PRECEDING) AS mt
      FROM c)
SELECT window_end, user_id AS upto_user_id,
       min(user_id) OVER (PARTITION BY window_end, mt) AS user_id, mt AS tips FROM r"""

# replayed to the end, in arrival order
for _name, _of in (("ride_fare_match", "ride_fare_match"), ("late_rows", "late_rows"), ("late_changelog", "window_min_late_changelog")):
    ORACLE[f"stream_{_name}"] = ORACLE[_of]

ORACLE["stream_top3_gathered"] = ORACLE["stream_top3"]
ORACLE["stream_fraud_carried"] = ORACLE["fraud_alerts"]
ORACLE["stream_fraud_wall_clock"] = f"""
WITH x AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY t_ms, event_id) AS pv FROM ({EV}))
SELECT user_id AS account_id, event_id, make_timestamp(t_ms * 1000) AS ts, value AS amount FROM x
WHERE pv < {P.FRAUD_SMALL} AND value > {P.FRAUD_LARGE}"""

ORACLE["accumulated_mean"] = "SELECT user_id, sum(round(value * 100)) / count(value) AS mean_cents, count(value) AS n FROM events GROUP BY user_id"
ORACLE["accumulated_top"] = f"""
SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank, event_id, value
FROM events WHERE value IS NOT NULL QUALIFY rank <= {P.TOP_N}"""

ORACLE["ride_fare_pairs"] = ORACLE["ride_fare_match"]
ORACLE["line_windows"] = """
SELECT CAST(user_id AS VARCHAR) AS id, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, count(*) AS n FROM events GROUP BY ALL"""
ORACLE["window_median"] = """
SELECT user_id, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
       median(value) AS median FROM events GROUP BY ALL"""
