"""Message and cell tables derived, by Spark, from the ``events`` table.

The trip-summary producer and the wide-column writer are outside this code
base, so their output is re-created deterministically from ``events``
(rules in FIXTURES.md).  All of it is column arithmetic on one scan: no
shuffle, except for multi-line payloads (bounded groups) and the cell table
(one aggregation per 10-minute bucket).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.schema import WIDECOL_FAMILY

# Lines per multi-line payload are bounded by grouping on a block of this many
# consecutive event ids (per terminal and day): no payload can grow with the data.
PAYLOAD_ID_BLOCK = 1024
# Damaged rows in the dirty variant: every row whose id is a multiple of this.
DIRTY_EVERY = 97


def _sql_points(times: str, base: float, step: float, idle_value: str) -> str:
    """SQL text: JSON array of ``times`` points ``base + step * ((event_id + i) % 4)``;
    one ignored point ``idle_value`` when ``times`` is 0.  Values are plain
    decimals, so the array is built as text without a JSON encoder."""
    value = f"CAST({base!r}D + CAST((event_id + i) % 4 AS DOUBLE) * {step!r}D AS STRING)"
    pts = (f"concat('[', array_join(transform(sequence(0, {times} - 1), "
           f"i -> concat('{{\"acceValue\":\"', {value}, '\"}}')), ','), ']')")
    return f"CASE WHEN {times} > 0 THEN {pts} ELSE '[{{\"acceValue\":\"{idle_value}\"}}]' END"


def _sql_object(fields: list[tuple[str, str]]) -> str:
    parts = []
    for n, (name, value) in enumerate(fields):
        parts += [f"'{',' if n else ''}\"{name}\":'", f"CAST({value} AS STRING)"]
    return "concat('{', " + ", ".join(parts) + ", '}')"


def _sql_encoded(obj: str) -> str:
    # Even ids carry nested objects, odd ids carry them as JSON-encoded
    # strings; the objects hold no backslashes, so escaping quotes suffices.
    return (f"CASE WHEN event_id % 2 = 0 THEN {obj} "
            f"ELSE concat('\"', replace({obj}, '\"', '\\\\\"'), '\"') END")


def _sql_trip_json(dirty: bool) -> str:
    """SQL text of a trip-summary JSON object over columns ``event_id``,
    ``user_id``, ``value`` and the staged ``_k``, ``_b``."""
    bad_points = f"(event_id % {DIRTY_EVERY} = 0 AND event_id % 3 = 2)" if dirty else "false"
    acce_t = f"(CASE WHEN {bad_points} THEN 1 ELSE _k % 7 END)"
    acce_pts = (f"(CASE WHEN {bad_points} THEN '[{{\"acceValue\":\"x\"}}]' "
                f"ELSE {_sql_points('(_k % 7)', 2.0, 0.5, '9.9')} END)")
    dece_t = "((_k DIV 10) % 5)"
    objs = {
        "acceRapidEvents": _sql_object([("times", acce_t), ("score", "_b"), ("points", acce_pts)]),
        "deceRapidEvents": _sql_object([("times", dece_t), ("score", "_b + 1"),
                                        ("points", _sql_points(dece_t, -3.0, -0.5, "-9.9"))]),
        "suddenTurnEvents": _sql_object([("times", "event_id % 5"), ("score", "_b")]),
        "overSpeedEvents": _sql_object([("score", "_b + 1")]),
        "tiredDrivingEvents": _sql_object([("score", "_b")]),
    }
    mileage = "concat('\"mileage\":', CAST(floor(value) AS STRING), ',')"
    if dirty:
        mileage = f"(CASE WHEN event_id % {DIRTY_EVERY} = 0 AND event_id % 3 = 1 THEN '' ELSE {mileage} END)"
    parts = ["'{'", mileage, "'\"terminalId\":\"'", "CAST(user_id AS STRING)", "'\"'"]
    for name, obj in objs.items():
        parts += [f"',\"{name}\":'", _sql_encoded(obj)]
    for name, value in [("controlScore", "_b + 1"), ("economyScore", "_b"), ("focusScore", "_b + 1"),
                        ("roadScore", "_b"), ("envirScore", "_b + 1")]:
        parts += [f"',\"{name}\":'", f"CAST({value} AS STRING)"]
    parts.append("'}'")
    return "concat(" + ", ".join(parts) + ")"


def with_trip_json(events: DataFrame, dirty: bool = False, name: str = "_json") -> DataFrame:
    """Add column ``name``: the trip-summary JSON text of each ``events`` row.

    ``k`` is extracted in its own projection so the JSON builder reads it as
    a column instead of re-running ``get_json_object`` per use; the builder
    is SQL text (one call into the JVM, not one per column operator).
    """
    keep = [f"`{c}`" for c in events.columns]
    keyed = events.selectExpr(*keep, "CAST(get_json_object(props, '$.k') AS INT) AS _k",
                              "84 + event_id % 16 AS _b")
    built = keyed.selectExpr(*keep, f"{_sql_trip_json(dirty)} AS `{name}`")
    if dirty:
        # Cut-off JSON: the first half of the text.
        cut = f"event_id % {DIRTY_EVERY} = 0 AND event_id % 3 = 0"
        built = built.selectExpr(*keep, f"CASE WHEN {cut} THEN substring(`{name}`, 1, "
                                        f"CAST(length(`{name}`) DIV 2 AS INT)) ELSE `{name}` END AS `{name}`")
    return built


def trip_messages(events: DataFrame, dirty: bool = False) -> DataFrame:
    """One message per event: ``(event_id, ts, value)`` with a trailing CRLF,
    as a producer writing one trip per record would.  Narrow (map only)."""
    return with_trip_json(events, dirty).select(
        "event_id", "ts", F.concat(F.col("_json"), F.lit("\r\n")).alias("value"))


def trip_payloads(events: DataFrame, by_terminal: bool = True) -> DataFrame:
    """Multi-line payloads: per terminal, day and block of event ids, the trip
    lines joined by CRLF in id order plus a trailing CRLF.  With ``by_terminal``
    false, per day and block only: a payload then holds several terminals.

    Envelope id = first event id of the payload, envelope time = its last
    trip's time.  Groups are bounded by ``PAYLOAD_ID_BLOCK`` lines.
    """
    lines = with_trip_json(events, name="_line").select(
        "event_id", "ts", "user_id", "_line",
        F.to_date("ts").alias("_day"),
        F.call_function("div", F.col("event_id"), F.lit(PAYLOAD_ID_BLOCK)).alias("_block"))
    grouped = lines.groupBy(*(["user_id"] if by_terminal else []), "_day", "_block").agg(
        F.min("event_id").alias("event_id"),
        F.max("ts").alias("ts"),
        F.array_sort(F.collect_list(F.struct("event_id", "_line"))).alias("_lines"))
    return grouped.select(
        "event_id", "ts",
        F.concat(F.array_join(F.transform("_lines", lambda x: x["_line"]), "\r\n"), F.lit("\r\n")).alias("value"))


def widecol_cells(events: DataFrame) -> DataFrame:
    """Wide-column cells per 10-minute bucket of ``events``.

    ``row_key`` = UTF-8 of ``yyyyMMddHHmm`` of the bucket start; qualifiers as
    decimal text bytes; ``weakNum`` left out when 0 (a missing cell).
    """
    bucket = F.window("ts", "10 minutes").start
    agg = events.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("totalNum"),
        F.count(F.when(F.col("event_type") == "error", 1)).alias("weakNum"),
        F.count(F.when(F.floor("value") == 0, 1)).alias("zeroSpeedNum"),
        F.count(F.when(F.col("event_type") == "view", 1)).alias("notOpenGpsNum"),
        F.count_distinct("user_id").alias("onlineNum"))
    long = agg.select(
        F.encode(F.date_format("bucket", "yyyyMMddHHmm"), "UTF-8").alias("row_key"),
        F.explode(F.array(
            F.struct(F.lit("frequency").alias("q"), F.lit(10).cast("long").alias("v")),
            *[F.struct(F.lit(q).alias("q"), F.col(q).alias("v"))
              for q in ["totalNum", "weakNum", "zeroSpeedNum", "notOpenGpsNum", "onlineNum"]])).alias("c"))
    return long.where(~((F.col("c.q") == "weakNum") & (F.col("c.v") == 0))).select(
        "row_key",
        F.lit(WIDECOL_FAMILY).alias("family"),
        F.col("c.q").alias("qualifier"),
        F.encode(F.col("c.v").cast("string"), "UTF-8").alias("value"))


def versioned_cells(events: DataFrame) -> DataFrame:
    """Wide-column cells with versions, per 10-minute bucket of ``events``.

    Two versions of ``totalNum``: the newest holds the number of events, the
    older one a text that sorts after any digit, so a byte maximum would be
    wrong.  Buckets with an even number of events have no cell but ``note``.
    """
    bucket = F.window("ts", "10 minutes").start
    agg = events.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    older = F.struct(F.lit("totalNum").alias("q"), F.lit("zzz").alias("v"), F.lit(1).cast("long").alias("version"))
    newer = F.struct(F.lit("totalNum").alias("q"), F.col("n").cast("string").alias("v"), F.lit(2).cast("long").alias("version"))
    note = F.struct(F.lit("note").alias("q"), F.lit("x").alias("v"), F.lit(1).cast("long").alias("version"))
    cells = F.when(F.col("n") % 2 == 0, F.array(note)).otherwise(F.array(note, older, newer))
    return agg.select(
        F.encode(F.date_format("bucket", "yyyyMMddHHmm"), "UTF-8").alias("row_key"), F.explode(cells).alias("c")
    ).select("row_key", F.lit(WIDECOL_FAMILY).alias("family"), F.col("c.q").alias("qualifier"),
             F.encode(F.col("c.v"), "UTF-8").alias("value"), F.col("c.version").alias("version"))


def retried_messages(messages: DataFrame) -> DataFrame:
    """Messages of a producer that retries: every seventh is sent again 40 seconds
    later, every 21st once more 700 seconds after that, as records with ids of their own
    (``4 * event_id`` and the number of the try)."""
    tries = F.expr("CASE WHEN event_id % 21 = 0 THEN array(0, 40, 740) WHEN event_id % 7 = 0 THEN array(0, 40) ELSE array(0) END")
    return messages.select("event_id", "ts", "value", F.posexplode(tries).alias("try", "after")).select(
        (F.col("event_id") * 4 + F.col("try")).alias("event_id"),
        (F.col("ts") + F.make_interval(secs=F.col("after"))).alias("ts"), "value")


def counter_readings(events: DataFrame) -> DataFrame:
    """Irregular cumulative readings ``(event_id, terminal_id, ts, reading)``: a counter per
    user that grows by one a minute and begins again after 1,000, read at two of three events."""
    reading = F.expr("CAST(pmod(unix_seconds(ts) div 60 + user_id * 37, 1000) AS BIGINT)")
    return events.where("event_id % 3 != 0").select(
        "event_id", F.col("user_id").cast("string").alias("terminal_id"), "ts", reading.alias("reading"))


def drifted_messages(events: DataFrame) -> DataFrame:
    """Trip messages of mixed firmware: every third names the mileage ``mileageKm`` and
    every message but these has a field ``firmware`` with an object ``{"build": n}``."""
    drift = ("CASE WHEN event_id % 3 = 0 THEN replace(_json, '\"mileage\":', '\"mileageKm\":') "
             "ELSE concat('{\"firmware\":{\"build\":', CAST(event_id % 7 AS STRING), '},', substring(_json, 2)) END")
    return with_trip_json(events).selectExpr("event_id", "ts", f"concat({drift}, '\r\n') AS value")
