"""Schemas, names and fixed values.

Everything in the "fixed values" block must equal what the dashboards and the
original job use: JSON field names, published key names, score weights, cut
points and bucket labels.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the published dashboard contract)
# ---------------------------------------------------------------------------

# JSON field names of a trip-summary message, in the order they are read.
JSON_MILEAGE = "mileage"
JSON_TERMINAL = "terminalId"
JSON_ACCE = "acceRapidEvents"
JSON_DECE = "deceRapidEvents"
JSON_TURN = "suddenTurnEvents"
JSON_OVERSPEED = "overSpeedEvents"
JSON_TIRED = "tiredDrivingEvents"
JSON_SUBSCORES = ["controlScore", "economyScore", "focusScore", "roadScore", "envirScore"]

# Thresholds for hard acceleration (strictly above) and hard braking
# (strictly below) point values.
ACCE_THRESHOLD = 3.0
DECE_THRESHOLD = -4.0

# Weighted trip score: weights of acce, dece, turn, overspeed, tired,
# control, economy, focus, road, envir scores; divided by 22.
SCORE_WEIGHTS = [1, 1, 1, 2, 2, 3, 3, 3, 3, 3]
SCORE_DIVISOR = 22.0

# Trip-score buckets (by integer score): <=90, 91-92, 93-94, 95-97, >=98.
SCORE_BUCKET_UPPER = [90, 92, 94, 97]
# Labels the dashboard uses for the five buckets.
BUCKET_LABELS = ["<60", "60-70", "70-80", "80-90", ">90"]
# Older per-sub-score buckets: <60, [60,70), [70,80), [80,90], >90.
SUBSCORE_BUCKET_LOWER = [60, 70, 80]
SUBSCORE_TOP_INCLUSIVE = 90

# Published keys.
KEY_MILE_TODAY = "BS_MILE_TODAY"
KEY_DRIVERS_TODAY = "BS_DRIVING_USER_NUM_TODAY"
KEY_ACCE_DAY = "BS_ACCELERATION_RAPID_TIMES_DAY"
KEY_DECE_DAY = "BS_DECELERATION_RAPID_TIMES_DAY"
KEY_TURN_DAY = "BS_SUDDEN_TURN_TIMES_DAY"
KEY_THREE_TODAY = "BS_THREE_QUICKNESS_TODAY"
KEY_3G_TODAY = "BS_THREE_G_TODAY"
KEY_SCORE_COUNT = "BS_DRIVING_SCHEDULE_COUNT_TODAY"
KEY_SCORE_SHARE = "BS_DRIVING_SCHEDULE_SCORE_TODAY"
KEY_BY_HOUR = "BS_BY_HOUR"
KEY_MILE_BY_HOUR = "BS_TOTAL_MILE_TODAY_BY_HOUR"
KEY_DRIVERS_BY_HOUR = "BS_DRIVING_USER_NUM_BY_HOUR"
KEY_ACCE_BY_HOUR = "BS_ACCELERATION_RAPID_TIMES_BY_HOUR"
KEY_DECE_BY_HOUR = "BS_DECELERATION_RAPID_TIMES_BY_HOUR"
KEY_TURN_BY_HOUR = "BS_SUDDEN_TURN_TIMES_BY_HOUR"
KEY_3G_BY_HOUR = "BS_ACC_GREATER_THEN_3G_TIMES_BY_HOUR"
KEY_MONITOR = "BIG_SCREEN_MONITOR"
# Field names inside the BS_BY_HOUR snapshot hash.
BY_HOUR_FIELDS = ["totalMileage", "totalPersonCounts", "totalAccelerationRapidTimes",
                  "totalDecelerationRapidTimes", "totalSuddenTurnTimes", "totalThreeGTimes"]

# Heartbeat time-to-live in seconds: main job, monitor job.
HEARTBEAT_TTL_MAIN_S = 600
HEARTBEAT_TTL_MONITOR_S = 120
# Early hour cut of the hourly timer, seconds.
HOUR_CUT_EARLY_S = 10
# Micro-batch interval of the live job.
TRIGGER_INTERVAL = "3 seconds"

# Wide-column table: family and the six projected qualifiers.
WIDECOL_FAMILY = "info"
WIDECOL_QUALIFIERS = ["frequency", "totalNum", "weakNum", "zeroSpeedNum", "notOpenGpsNum", "onlineNum"]

# ---------------------------------------------------------------------------
# Derived names used by this package
# ---------------------------------------------------------------------------

# The six hourly series, in dashboard order: (column, hourly key, snapshot field).
HOURLY_METRICS = [
    ("mileage", KEY_MILE_BY_HOUR, BY_HOUR_FIELDS[0]),
    ("drivers", KEY_DRIVERS_BY_HOUR, BY_HOUR_FIELDS[1]),
    ("acce_times", KEY_ACCE_BY_HOUR, BY_HOUR_FIELDS[2]),
    ("dece_times", KEY_DECE_BY_HOUR, BY_HOUR_FIELDS[3]),
    ("turn_times", KEY_TURN_BY_HOUR, BY_HOUR_FIELDS[4]),
    ("over_3g", KEY_3G_BY_HOUR, BY_HOUR_FIELDS[5]),
]
HOURLY_COLUMNS = [m[0] for m in HOURLY_METRICS]

# Daily scalar keys: (column, key).
DAILY_KEYS = [
    ("mileage", KEY_MILE_TODAY),
    ("drivers", KEY_DRIVERS_TODAY),
    ("acce_times", KEY_ACCE_DAY),
    ("dece_times", KEY_DECE_DAY),
    ("turn_times", KEY_TURN_DAY),
    ("three_harsh", KEY_THREE_TODAY),
    ("over_3g", KEY_3G_TODAY),
]

# Trip row produced by the parser (17 fields of the message + envelope).
TRIP_FIELDS = [
    ("mileage", T.IntegerType()),
    ("terminal_id", T.StringType()),
    ("acce_times", T.IntegerType()),
    ("acce_score", T.IntegerType()),
    ("dece_times", T.IntegerType()),
    ("dece_score", T.IntegerType()),
    ("turn_times", T.IntegerType()),
    ("turn_score", T.IntegerType()),
    ("overspeed_score", T.IntegerType()),
    ("tired_score", T.IntegerType()),
    ("acce_over_3g", T.IntegerType()),
    ("dece_over_3g", T.IntegerType()),
    ("control_score", T.IntegerType()),
    ("economy_score", T.IntegerType()),
    ("focus_score", T.IntegerType()),
    ("road_score", T.IntegerType()),
    ("envir_score", T.IntegerType()),
]
TRIP_COLUMNS = [name for name, _ in TRIP_FIELDS]
# Sub-scores in weight order (pairs with SCORE_WEIGHTS).
SUBSCORE_COLUMNS = ["acce_score", "dece_score", "turn_score", "overspeed_score", "tired_score",
                    "control_score", "economy_score", "focus_score", "road_score", "envir_score"]

# Message envelope: one record of the message log (offset-like id, record
# time, text payload with one or more CRLF-separated JSON lines).
MESSAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("value", T.StringType(), True),
])

# Wide-column cell table.
CELL_SCHEMA = T.StructType([
    T.StructField("row_key", T.BinaryType(), False),
    T.StructField("family", T.StringType(), False),
    T.StructField("qualifier", T.StringType(), False),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("version", T.LongType(), True),
])
