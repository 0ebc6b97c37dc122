"""Independent DuckDB SQL for every named query.

The Spark side goes through JSON text (build -> split -> parse -> roll up);
these statements compute the same numbers by plain arithmetic on ``events``
(rules in FIXTURES.md), so a parser or rollup fault shows up as a mismatch.
Sums are cast to BIGINT and days rendered as text to line up the types.
"""

from __future__ import annotations

# Trip fields derived from an events row.
_TRIPS = """
e AS (
  SELECT event_id, ts, user_id, value, event_type,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         CAST(84 + event_id % 16 AS INTEGER) AS b
  FROM events
),
t AS (
  SELECT event_id, ts,
         strftime(ts, '%Y-%m-%d') AS day,
         CAST(hour(ts) AS INTEGER) AS hour,
         CAST(user_id AS VARCHAR) AS terminal_id,
         CAST(floor(value) AS INTEGER) AS mileage,
         k % 7 AS acce_times, b AS acce_score,
         (k // 10) % 5 AS dece_times, b + 1 AS dece_score,
         CAST(event_id % 5 AS INTEGER) AS turn_times, b AS turn_score,
         b + 1 AS overspeed_score, b AS tired_score,
         CAST((event_id % 4 + k % 7) // 4 AS INTEGER) AS acce_over_3g,
         CAST((event_id % 4 + (k // 10) % 5) // 4 AS INTEGER) AS dece_over_3g,
         b + 1 AS control_score, b AS economy_score, b + 1 AS focus_score,
         b AS road_score, b + 1 AS envir_score
  FROM e
),
f AS (
  SELECT *, acce_times + dece_times + turn_times AS three_harsh,
         acce_over_3g + dece_over_3g AS over_3g,
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS epoch_s
  FROM t
)"""

_COUNTERS = """count(*) AS n_trips,
  CAST(sum(mileage) AS BIGINT) AS mileage,
  CAST(sum(acce_times) AS BIGINT) AS acce_times,
  CAST(sum(dece_times) AS BIGINT) AS dece_times,
  CAST(sum(turn_times) AS BIGINT) AS turn_times,
  CAST(sum(three_harsh) AS BIGINT) AS three_harsh,
  CAST(sum(over_3g) AS BIGINT) AS over_3g"""

_DAYS = """days AS (
  SELECT strftime(d, '%Y-%m-%d') AS day
  FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM f)
)"""

# Dense (day, hour) spine of the six hourly series plus three-harsh.
_SPINE = f"""{_DAYS},
grid AS (SELECT day, CAST(h AS INTEGER) AS hour FROM days, range(0, 24) AS r(h)),
ht AS (SELECT day, hour, {_COUNTERS} FROM f GROUP BY day, hour),
firsts AS (SELECT day, terminal_id, min(hour) AS hour FROM f GROUP BY day, terminal_id),
hd AS (SELECT day, hour, count(*) AS drivers FROM firsts GROUP BY day, hour),
spine AS (
  SELECT g.day, g.hour,
         coalesce(ht.mileage, 0) AS mileage,
         coalesce(hd.drivers, 0) AS drivers,
         coalesce(ht.acce_times, 0) AS acce_times,
         coalesce(ht.dece_times, 0) AS dece_times,
         coalesce(ht.turn_times, 0) AS turn_times,
         coalesce(ht.over_3g, 0) AS over_3g,
         coalesce(ht.three_harsh, 0) AS three_harsh
  FROM grid g LEFT JOIN ht USING (day, hour) LEFT JOIN hd USING (day, hour)
)"""

_SPINE_COLS = ["mileage", "drivers", "acce_times", "dece_times", "turn_times", "over_3g", "three_harsh"]

_CUMULATIVE = ",\n".join(
    f"  CAST(sum({c}) OVER (PARTITION BY day ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    f" AS BIGINT) AS {c}" for c in _SPINE_COLS)

_BUCKET = """CASE WHEN s <= 90 THEN 0 WHEN s <= 92 THEN 1 WHEN s <= 94 THEN 2
              WHEN s <= 97 THEN 3 ELSE 4 END"""
_LABEL = """CASE bucket WHEN 0 THEN '<60' WHEN 1 THEN '60-70' WHEN 2 THEN '70-80'
             WHEN 3 THEN '80-90' ELSE '>90' END"""
_RANGE = """CASE bucket WHEN 0 THEN '<=90' WHEN 1 THEN '91-92' WHEN 2 THEN '93-94'
             WHEN 3 THEN '95-97' ELSE '>=98' END"""

_SCORED = """scored AS (
  SELECT *, CAST(trunc(trip_score_raw) AS INTEGER) AS s FROM (
    SELECT *, (acce_score + dece_score + turn_score + 2 * overspeed_score + 2 * tired_score
               + 3 * control_score + 3 * economy_score + 3 * focus_score + 3 * road_score
               + 3 * envir_score) / 22.0 AS trip_score_raw
    FROM f)
),
dist AS (
  SELECT d.day, d.bucket, coalesce(c.n, 0) AS n_trips
  FROM (SELECT day, CAST(bk AS INTEGER) AS bucket FROM days, range(0, 5) AS r(bk)) d
  LEFT JOIN (SELECT day, """ + _BUCKET + """ AS bucket, count(*) AS n FROM scored GROUP BY ALL) c
  USING (day, bucket)
)"""

# Heartbeats of terminal 7: every message of user 7 carries its marker.
_BEATS = """beats AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS terminal_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS s, ts
  FROM events WHERE user_id = 7
)"""

_HOURLY_TOTALS = f"""WITH {_TRIPS}
SELECT day, hour, {_COUNTERS} FROM f GROUP BY day, hour"""

ORACLE_SQL: dict[str, str] = {
    "payload_lines": f"""WITH {_TRIPS}
SELECT day, terminal_id, count(DISTINCT event_id // 1024) AS n_payloads, count(*) AS n_lines,
       CAST(sum(mileage) AS BIGINT) AS mileage
FROM f GROUP BY day, terminal_id""",

    "trip_parse": f"""WITH {_TRIPS}
SELECT event_id, 0 AS line_no, mileage, terminal_id, acce_times, acce_score, dece_times, dece_score,
       turn_times, turn_score, overspeed_score, tired_score, acce_over_3g, dece_over_3g,
       control_score, economy_score, focus_score, road_score, envir_score
FROM f""",

    "trip_variant": f"""WITH {_TRIPS}
SELECT event_id, 0 AS line_no, mileage, terminal_id, acce_times, acce_score, dece_times, dece_score,
       turn_times, turn_score, overspeed_score, tired_score, acce_over_3g, dece_over_3g,
       control_score, economy_score, focus_score, road_score, envir_score,
       CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 7 AS VARCHAR) END AS firmware_build
FROM f""",

    "trip_repair": f"""WITH {_TRIPS}
SELECT event_id, 0 AS line_no, mileage, terminal_id, acce_times, acce_score, dece_times, dece_score,
       turn_times, turn_score, overspeed_score, tired_score, acce_over_3g, dece_over_3g,
       control_score, economy_score, focus_score, road_score, envir_score
FROM f""",

    "heartbeat_filter": f"""WITH {_BEATS}
SELECT event_id, terminal_id, s AS epoch_s FROM beats""",

    "over_3g_counts": f"""WITH {_TRIPS}
SELECT event_id, acce_over_3g, dece_over_3g, over_3g FROM f""",

    "time_buckets": f"""WITH {_TRIPS}
SELECT event_id, strftime(ts, '%H') AS hh, epoch_s,
       CAST(epoch_us(date_trunc('hour', ts)) // 1000000 AS BIGINT) AS hour_start_s,
       CAST(epoch_us(date_trunc('day', ts)) // 1000000 AS BIGINT) AS day_start_s,
       CAST(epoch_us(date_trunc('minute', ts)) // 1000000 AS BIGINT) AS minute_start_s
FROM f""",

    "daily_totals": f"""WITH {_TRIPS}
SELECT day, {_COUNTERS} FROM f GROUP BY day""",

    "daily_drivers": f"""WITH {_TRIPS}
SELECT day, count(DISTINCT terminal_id) AS drivers FROM f GROUP BY day""",

    "daily_spine": f"""WITH {_TRIPS}, {_DAYS},
agg AS (SELECT day, {_COUNTERS}, count(DISTINCT terminal_id) AS drivers FROM f GROUP BY day)
SELECT days.day,
       coalesce(n_trips, 0) AS n_trips, coalesce(mileage, 0) AS mileage,
       coalesce(acce_times, 0) AS acce_times, coalesce(dece_times, 0) AS dece_times,
       coalesce(turn_times, 0) AS turn_times, coalesce(three_harsh, 0) AS three_harsh,
       coalesce(over_3g, 0) AS over_3g, coalesce(drivers, 0) AS drivers
FROM days LEFT JOIN agg USING (day)""",

    "running_totals": f"""WITH {_TRIPS},
flagged AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY day, terminal_id ORDER BY ts, event_id) = 1
                 THEN 1 ELSE 0 END AS first_seen
  FROM f
)
SELECT event_id, day,
  CAST(count(*) OVER w AS BIGINT) AS n_trips,
  CAST(sum(mileage) OVER w AS BIGINT) AS mileage,
  CAST(sum(acce_times) OVER w AS BIGINT) AS acce_times,
  CAST(sum(dece_times) OVER w AS BIGINT) AS dece_times,
  CAST(sum(turn_times) OVER w AS BIGINT) AS turn_times,
  CAST(sum(three_harsh) OVER w AS BIGINT) AS three_harsh,
  CAST(sum(over_3g) OVER w AS BIGINT) AS over_3g,
  CAST(sum(first_seen) OVER w AS BIGINT) AS drivers
FROM flagged
WINDOW w AS (PARTITION BY day ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",

    "trip_score": f"""WITH {_TRIPS}, {_DAYS}, {_SCORED}
SELECT event_id, trip_score_raw, s AS trip_score, {_BUCKET} AS bucket FROM scored""",

    "score_distribution": f"""WITH {_TRIPS}, {_DAYS}, {_SCORED}
SELECT day, bucket, {_LABEL} AS label, {_RANGE} AS score_range, n_trips FROM dist""",

    "subscore_distribution": f"""WITH {_TRIPS}, {_DAYS},
subs AS (
  SELECT day, unnest([acce_score, dece_score, turn_score, overspeed_score, tired_score,
                      control_score, economy_score, focus_score, road_score, envir_score]) AS v
  FROM f
),
c AS (
  SELECT day, CASE WHEN v < 60 THEN 0 WHEN v < 70 THEN 1 WHEN v < 80 THEN 2
                   WHEN v <= 90 THEN 3 ELSE 4 END AS bucket, count(*) AS n
  FROM subs GROUP BY ALL
),
g AS (SELECT day, CAST(bk AS INTEGER) AS bucket FROM days, range(0, 5) AS r(bk))
SELECT g.day, g.bucket, {_LABEL.replace('bucket', 'g.bucket')} AS label, coalesce(c.n, 0) AS n_scores
FROM g LEFT JOIN c USING (day, bucket)""",

    "score_share": f"""WITH {_TRIPS}, {_DAYS}, {_SCORED},
tot AS (SELECT *, sum(n_trips) OVER (PARTITION BY day) AS day_total FROM dist),
bp AS (
  SELECT *, CASE WHEN day_total > 0
                 THEN CAST((20000 * n_trips + day_total) // (2 * day_total) AS INTEGER) END AS share_bp
  FROM tot
)
SELECT day, bucket, {_LABEL} AS label, n_trips,
       CASE WHEN day_total > 0 THEN n_trips / day_total END AS share,
       share_bp,
       CAST(share_bp // 10000 AS VARCHAR) || '.' || lpad(CAST(share_bp % 10000 AS VARCHAR), 4, '0') AS share_text
FROM bp""",

    "hourly_totals": _HOURLY_TOTALS,

    "hourly_new_drivers": f"""WITH {_TRIPS},
firsts AS (SELECT day, terminal_id, min(hour) AS hour FROM f GROUP BY day, terminal_id)
SELECT day, hour, count(*) AS drivers FROM firsts GROUP BY day, hour""",

    "hourly_cumulative": f"""WITH {_TRIPS}, {_SPINE}
SELECT day, hour,
{_CUMULATIVE}
FROM spine""",

    "hourly_delta": f"""WITH {_TRIPS}, {_SPINE}
SELECT day, hour, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in _SPINE_COLS)} FROM spine""",

    "hourly_changed": f"""WITH {_TRIPS}, {_SPINE}
SELECT * FROM (
  UNPIVOT (SELECT day, hour, mileage, drivers, acce_times, dece_times, turn_times, over_3g FROM spine)
  ON mileage, drivers, acce_times, dece_times, turn_times, over_3g
  INTO NAME metric VALUE delta
) WHERE delta <> 0""",

    "hourly_skip23": f"""WITH {_TRIPS}, {_SPINE}
SELECT day, hour, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in _SPINE_COLS)} FROM spine
WHERE hour <> 23""",

    "hourly_spine": f"""WITH {_TRIPS}, {_SPINE}
SELECT day, hour, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in _SPINE_COLS)} FROM spine""",

    "hourly_cut_early": f"""WITH {_TRIPS},
cut AS (
  SELECT * REPLACE (
    CASE WHEN CAST(ts + INTERVAL 10 SECOND AS DATE) > CAST(ts AS DATE) THEN 23
         ELSE CAST(hour(ts + INTERVAL 10 SECOND) AS INTEGER) END AS hour)
  FROM f
)
SELECT day, hour, {_COUNTERS} FROM cut GROUP BY day, hour""",

    "heartbeat_last": f"""WITH {_BEATS}
SELECT terminal_id, strftime(ts, '%Y-%m-%d') AS day, max(s) AS last_beat_s FROM beats GROUP BY ALL""",

    "heartbeat_outages": f"""WITH {_BEATS},
seq AS (SELECT terminal_id, s, lead(s) OVER (PARTITION BY terminal_id ORDER BY s) AS next_s FROM beats)
SELECT terminal_id, s + 600 AS outage_start_s, next_s AS outage_end_s, next_s - s - 600 AS outage_s
FROM seq WHERE next_s - s > 600""",

    "heartbeat_status": f"""WITH {_BEATS},
span AS (SELECT terminal_id, min(s) // 3600 AS h0, (max(s) + 600) // 3600 AS h1 FROM beats GROUP BY ALL),
grid AS (SELECT terminal_id, unnest(generate_series(h0, h1)) AS h FROM span),
st AS (
  SELECT g.terminal_id, g.h, h * 3600 + 3599 AS as_of_s,
         (SELECT max(b.s) FROM beats b WHERE b.terminal_id = g.terminal_id AND b.s <= g.h * 3600 + 3599)
           AS last_beat_s
  FROM grid g
)
SELECT terminal_id, strftime(to_timestamp(h * 3600) AT TIME ZONE 'UTC', '%Y-%m-%d') AS day,
       CAST(hour(to_timestamp(h * 3600) AT TIME ZONE 'UTC') AS INTEGER) AS hour,
       CAST(as_of_s AS BIGINT) AS as_of_s, last_beat_s, as_of_s < last_beat_s + 600 AS alive
FROM st""",

    "widecol_count": """SELECT count(DISTINCT time_bucket(INTERVAL 10 MINUTE, ts)) AS n_rows FROM events""",

    "widecol_project": """SELECT strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y%m%d%H%M') AS row_key,
       '10' AS frequency,
       CAST(count(*) AS VARCHAR) AS totalNum,
       CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0
            THEN CAST(count(*) FILTER (WHERE event_type = 'error') AS VARCHAR) END AS weakNum,
       CAST(count(*) FILTER (WHERE floor(value) = 0) AS VARCHAR) AS zeroSpeedNum,
       CAST(count(*) FILTER (WHERE event_type = 'view') AS VARCHAR) AS notOpenGpsNum,
       CAST(count(DISTINCT user_id) AS VARCHAR) AS onlineNum
FROM events GROUP BY 1""",

    "widecol_versions": """SELECT strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y%m%d%H%M') AS row_key,
       CASE WHEN count(*) % 2 = 1 THEN CAST(count(*) AS VARCHAR) END AS totalNum,
       CAST(NULL AS VARCHAR) AS weakNum
FROM events GROUP BY 1""",

    "heartbeat_multi": """WITH p AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, event_id // 1024 AS block, min(event_id) AS event_id,
         CAST(epoch_us(max(ts)) // 1000000 AS BIGINT) AS epoch_s
  FROM events GROUP BY 1, 2
), m AS (
  SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, event_id // 1024 AS block, CAST(user_id AS VARCHAR) AS terminal_id
  FROM events WHERE user_id IN (7, 8, 11)
)
SELECT event_id, terminal_id, epoch_s FROM p JOIN m USING (day, block)""",

    # The dirty fixture damages every row whose id is a multiple of 97 (kind
    # by id % 3); Spark parses all rows and must reject exactly those.
    "trip_rejects": """SELECT CASE event_id % 3 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'mileage'
            ELSE 'acceRapidEvents.points' END AS reject_reason,
       count(*) AS n_rejects
FROM events WHERE event_id % 97 = 0 GROUP BY 1""",
}


def _serving_sql() -> str:
    hourly_keys = [("mileage", "BS_TOTAL_MILE_TODAY_BY_HOUR", "totalMileage"),
                   ("drivers", "BS_DRIVING_USER_NUM_BY_HOUR", "totalPersonCounts"),
                   ("acce_times", "BS_ACCELERATION_RAPID_TIMES_BY_HOUR", "totalAccelerationRapidTimes"),
                   ("dece_times", "BS_DECELERATION_RAPID_TIMES_BY_HOUR", "totalDecelerationRapidTimes"),
                   ("turn_times", "BS_SUDDEN_TURN_TIMES_BY_HOUR", "totalSuddenTurnTimes"),
                   ("over_3g", "BS_ACC_GREATER_THEN_3G_TIMES_BY_HOUR", "totalThreeGTimes")]
    daily_keys = [("mileage", "BS_MILE_TODAY"), ("drivers", "BS_DRIVING_USER_NUM_TODAY"),
                  ("acce_times", "BS_ACCELERATION_RAPID_TIMES_DAY"),
                  ("dece_times", "BS_DECELERATION_RAPID_TIMES_DAY"),
                  ("turn_times", "BS_SUDDEN_TURN_TIMES_DAY"), ("three_harsh", "BS_THREE_QUICKNESS_TODAY"),
                  ("over_3g", "BS_THREE_G_TODAY")]
    parts = []
    for col, key in daily_keys:
        parts.append(f"SELECT day, '{key}' AS key, '' AS field, CAST(sum({col}) AS VARCHAR) AS value "
                     f"FROM spine GROUP BY day")
    for col, key, snap in hourly_keys:
        parts.append(f"SELECT day, '{key}', lpad(CAST(hour AS VARCHAR), 2, '0'), CAST({col} AS VARCHAR) FROM spine")
        parts.append(f"SELECT day, 'BS_BY_HOUR', '{snap}', CAST(sum({col}) AS VARCHAR) FROM spine GROUP BY day")
    parts.append(f"SELECT day, 'BS_DRIVING_SCHEDULE_COUNT_TODAY', {_LABEL}, CAST(n_trips AS VARCHAR) FROM dist")
    parts.append(f"""SELECT day, 'BS_DRIVING_SCHEDULE_SCORE_TODAY', {_LABEL},
  coalesce(CAST(share_bp // 10000 AS VARCHAR) || '.' || lpad(CAST(share_bp % 10000 AS VARCHAR), 4, '0'), '0.0')
FROM (SELECT *, CASE WHEN day_total > 0 THEN (20000 * n_trips + day_total) // (2 * day_total) END AS share_bp
      FROM (SELECT *, sum(n_trips) OVER (PARTITION BY day) AS day_total FROM dist))""")
    parts.append("SELECT strftime(ts, '%Y-%m-%d'), 'BIG_SCREEN_MONITOR', terminal_id, CAST(max(s) AS VARCHAR) "
                 "FROM beats GROUP BY 1, terminal_id")
    return f"WITH {_TRIPS}, {_SPINE}, {_SCORED}, {_BEATS}\n" + "\nUNION ALL\n".join(parts)


ORACLE_SQL["serving_kv"] = _serving_sql()

ORACLE_SQL["widecol_range"] = ORACLE_SQL["widecol_project"] + "\nHAVING row_key >= '202401100600' AND row_key < '20240113'"

# The payload text depends on the event id through its remainders by 16 and 5.
ORACLE_SQL["payload_dedup"] = f"""WITH {_TRIPS},
sent AS (
  SELECT f.* EXCLUDE (ts, event_id), f.event_id % 80 AS same, k, f.event_id * 4 + try AS event_id, f.ts + after * INTERVAL 1 SECOND AS ts
  FROM f JOIN (SELECT event_id, k FROM e) USING (event_id)
  JOIN (VALUES (0, 0, 1), (1, 40, 7), (2, 740, 21)) r(try, after, every_) ON f.event_id % every_ = 0
),
kept AS (
  SELECT * FROM (
    SELECT *, lag(ts) OVER (PARTITION BY terminal_id, mileage, k, same ORDER BY ts, event_id) AS before_ FROM sent)
  WHERE before_ IS NULL OR ts - before_ > INTERVAL 600 SECOND
)
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_trips, CAST(sum(mileage) AS BIGINT) AS mileage,
       CAST(sum(over_3g) AS BIGINT) AS over_3g
FROM kept GROUP BY 1"""

ORACLE_SQL["trip_liveness"] = f"""WITH {_TRIPS},
beats AS (
  SELECT CAST(user_id AS VARCHAR) AS terminal_id, ts AS beat_ts FROM events WHERE event_id % 3 = 0 AND user_id IN (7, 8, 11)
)
SELECT event_id, f.terminal_id, CAST(epoch_us(beat_ts) // 1000000 AS BIGINT) AS last_beat_s,
       coalesce(epoch_us(ts) - epoch_us(beat_ts) < 600000000, false) AS alive
FROM f ASOF LEFT JOIN beats ON f.terminal_id = beats.terminal_id AND f.ts >= beats.beat_ts"""

ORACLE_SQL["reading_delta"] = """WITH r AS (
  SELECT event_id, user_id, ts, (CAST(epoch_us(ts) // 1000000 AS BIGINT) // 60 + user_id * 37) % 1000 AS reading
  FROM events WHERE event_id % 3 <> 0
), d AS (
  SELECT ts, reading, lag(reading) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM r
)
SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_readings,
       count(*) FILTER (WHERE reading < was) AS resets,
       CAST(sum(CASE WHEN was IS NULL THEN 0 WHEN reading < was THEN reading ELSE reading - was END) AS BIGINT) AS delta
FROM d GROUP BY 1, 2"""

ORACLE_SQL["heartbeat_runs"] = """WITH b AS (
  SELECT CAST(user_id AS VARCHAR) AS terminal_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS s
  FROM events WHERE user_id IN (7, 8, 11)
), marked AS (
  SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY terminal_id ORDER BY s) <= 600 THEN 0 ELSE 1 END AS begins FROM b
), numbered AS (
  SELECT *, sum(begins) OVER (PARTITION BY terminal_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS run FROM marked
)
SELECT terminal_id, min(s) AS first_beat_s, max(s) AS last_beat_s, max(s) + 600 AS expired_s
FROM numbered GROUP BY terminal_id, run"""

ORACLE_SQL["drivers_trailing_week"] = f"""WITH {_TRIPS}, {_DAYS}
SELECT days.day, count(DISTINCT terminal_id) AS drivers
FROM days LEFT JOIN f ON CAST(f.ts AS DATE) BETWEEN CAST(days.day AS DATE) - 6 AND CAST(days.day AS DATE)
GROUP BY days.day"""

ORACLE_SQL["running_incremental"] = ORACLE_SQL["running_totals"]
