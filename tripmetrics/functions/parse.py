"""Trip-message parsing (P1, P2) and the per-trip scalar rules.

A trip line is parsed in two passes with ``from_json``: the outer object
declares every leaf and every event object as STRING, so a nested object and
a JSON-encoded string holding the same object both arrive as JSON text; the
second pass parses the five event objects.  Numbers are converted with
``try_cast`` so a bad value becomes NULL instead of failing the batch; a
single CASE names the first bad field of a line.  All of it stays inside
whole-stage code generation -- no Python per row.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmetrics.schema import (ACCE_THRESHOLD, DECE_THRESHOLD, JSON_ACCE, JSON_DECE, JSON_MILEAGE,
                                JSON_OVERSPEED, JSON_SUBSCORES, JSON_TERMINAL, JSON_TIRED, JSON_TURN,
                                TRIP_COLUMNS, TRIP_FIELDS)
from tripmetrics.functions.timecols import EARLIEST, LATEST
from tripmetrics.sources.messages import split_payloads

_CORRUPT = "_corrupt"
_OUTER_FIELDS = [JSON_MILEAGE, JSON_TERMINAL, JSON_ACCE, JSON_DECE, JSON_TURN, JSON_OVERSPEED,
                 JSON_TIRED, *JSON_SUBSCORES]
OUTER_SCHEMA = ", ".join(f"{f} STRING" for f in _OUTER_FIELDS) + f", {_CORRUPT} STRING"
RAPID_SCHEMA = f"times STRING, score STRING, points ARRAY<STRUCT<acceValue: STRING>>, {_CORRUPT} STRING"
TURN_SCHEMA = f"times STRING, score STRING, {_CORRUPT} STRING"
SCORE_SCHEMA = f"score STRING, {_CORRUPT} STRING"
LANDED_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("line_no", T.IntegerType()),
     T.StructField("ts", T.TimestampType()), T.StructField("line", T.StringType())]
    + [T.StructField(n, t) for n, t in TRIP_FIELDS]
    + [T.StructField("reject_reason", T.StringType()), T.StructField("rejected", T.BooleanType())])
_JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}


_O, _A, _D, _T, _OV, _TI = "_o", "_a", "_d", "_t", "_ov", "_ti"
_observations = itertools.count()


def _next_observation_name() -> str:
    return f"trip_parse_{next(_observations)}"


def _sql_int(path: str) -> str:
    return f"try_cast(try_cast({path} AS DOUBLE) AS INT)"


def _sql_count_points(times: str, points: str, op: str, threshold: float) -> str:
    return (f"CAST(CASE WHEN {times} > 0 THEN size(filter({points}, p -> "
            f"try_cast(p.acceValue AS DOUBLE) {op} {threshold!r})) ELSE 0 END AS INT)")


def _sql_bad_points(times: str, points: str) -> str:
    return (f"({times} > 0 AND ({points} IS NULL OR "
            f"exists({points}, p -> try_cast(p.acceValue AS DOUBLE) IS NULL)))")


def _sql_from_json(text: str, schema: str) -> str:
    opts = ", ".join(f"'{k}', '{v}'" for k, v in _JSON_OPTS.items())
    return f"from_json({text}, '{schema}', map({opts}))"


def parse_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """P1+P2 on split lines: all trip columns plus ``reject_reason``.

    Keeps every input column; downstream filters pick good rows or rejects.
    Staged projections (outer object, then event objects, then typed
    columns, then the reason) make every ``from_json`` run once per row:
    the optimizer does not merge a projection that would repeat an
    expensive expression, and it prunes each parsed struct to the fields
    read from it.  Expressions are SQL text: one call into the JVM per
    stage instead of one per column operator.
    """
    outer = lines.selectExpr("*", f"{_sql_from_json(f'`{line_col}`', OUTER_SCHEMA)} AS {_O}")
    events = outer.selectExpr(
        "*",
        f"{_sql_from_json(f'{_O}.{JSON_ACCE}', RAPID_SCHEMA)} AS {_A}",
        f"{_sql_from_json(f'{_O}.{JSON_DECE}', RAPID_SCHEMA)} AS {_D}",
        f"{_sql_from_json(f'{_O}.{JSON_TURN}', TURN_SCHEMA)} AS {_T}",
        f"{_sql_from_json(f'{_O}.{JSON_OVERSPEED}', SCORE_SCHEMA)} AS {_OV}",
        f"{_sql_from_json(f'{_O}.{JSON_TIRED}', SCORE_SCHEMA)} AS {_TI}")
    return typed_lines(events, lines.columns)


def typed_lines(events: DataFrame, columns: list[str]) -> DataFrame:
    """Typed trip columns and ``reject_reason`` from the parsed objects of a line: the outer
    object and the five event objects as structs of text (null: no such object).  Keeps ``columns``."""
    keep = [f"`{c}`" for c in columns]
    sub_names = {"control_score": JSON_SUBSCORES[0], "economy_score": JSON_SUBSCORES[1],
                 "focus_score": JSON_SUBSCORES[2], "road_score": JSON_SUBSCORES[3],
                 "envir_score": JSON_SUBSCORES[4]}
    typed = {
        "mileage": _sql_int(f"{_O}.{JSON_MILEAGE}"),
        "terminal_id": f"{_O}.{JSON_TERMINAL}",
        "acce_times": _sql_int(f"{_A}.times"),
        "acce_score": _sql_int(f"{_A}.score"),
        "dece_times": _sql_int(f"{_D}.times"),
        "dece_score": _sql_int(f"{_D}.score"),
        "turn_times": _sql_int(f"{_T}.times"),
        "turn_score": _sql_int(f"{_T}.score"),
        "overspeed_score": _sql_int(f"{_OV}.score"),
        "tired_score": _sql_int(f"{_TI}.score"),
        **{col: _sql_int(f"{_O}.{field}") for col, field in sub_names.items()},
    }
    stage = events.selectExpr("*", *[f"{expr} AS {name}" for name, expr in typed.items()])

    def obj_bad(obj: str) -> str:
        return f"({obj} IS NULL OR {obj}.{_CORRUPT} IS NOT NULL)"

    # First failing field, in the order a reader of the message touches them.
    checks: list[tuple[str, str]] = [
        (f"ts IS NULL OR ts < TIMESTAMP '{EARLIEST}' OR ts >= TIMESTAMP '{LATEST}'", "event_time"),
        (obj_bad(_O), "malformed_json"),
        ("mileage IS NULL", JSON_MILEAGE),
        ("terminal_id IS NULL", JSON_TERMINAL),
        (obj_bad(_A), JSON_ACCE),
        ("acce_times IS NULL", f"{JSON_ACCE}.times"),
        ("acce_score IS NULL", f"{JSON_ACCE}.score"),
        (_sql_bad_points("acce_times", f"{_A}.points"), f"{JSON_ACCE}.points"),
        (obj_bad(_D), JSON_DECE),
        ("dece_times IS NULL", f"{JSON_DECE}.times"),
        ("dece_score IS NULL", f"{JSON_DECE}.score"),
        (_sql_bad_points("dece_times", f"{_D}.points"), f"{JSON_DECE}.points"),
        (obj_bad(_T), JSON_TURN),
        ("turn_times IS NULL", f"{JSON_TURN}.times"),
        ("turn_score IS NULL", f"{JSON_TURN}.score"),
        (obj_bad(_OV), JSON_OVERSPEED),
        ("overspeed_score IS NULL", f"{JSON_OVERSPEED}.score"),
        (obj_bad(_TI), JSON_TIRED),
        ("tired_score IS NULL", f"{JSON_TIRED}.score"),
    ] + [(f"{col} IS NULL", field) for col, field in sub_names.items()]
    reason = "CASE " + " ".join(f"WHEN {cond} THEN '{name}'" for cond, name in checks) + " END"
    out = stage.selectExpr(
        *keep, *TRIP_COLUMNS[:10],
        f"{_sql_count_points('acce_times', f'{_A}.points', '>', ACCE_THRESHOLD)} AS acce_over_3g",
        f"{_sql_count_points('dece_times', f'{_D}.points', '<', DECE_THRESHOLD)} AS dece_over_3g",
        *TRIP_COLUMNS[12:],
        f"{reason} AS reject_reason")
    # Line and reject counts as observed metrics (visible per batch in a
    # stream's progress).  The node also keeps a later filter on
    # ``reject_reason`` above the parse: pushed below, the filter would
    # re-run every from_json it references.
    return out.observe(_next_observation_name(),
                       F.count(F.lit(1)).alias("lines"),
                       F.count(F.col("reject_reason")).alias("rejects"))


def in_time_range(messages: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """Messages with ``since <= ts < until`` (timestamp text, session zone).

    Applied to the envelope, below the parse, so it reaches the scan; a filter
    put on the parsed rows stays above the parse."""
    if since is not None:
        messages = messages.where(F.col("ts") >= F.lit(since).cast("timestamp"))
    if until is not None:
        messages = messages.where(F.col("ts") < F.lit(until).cast("timestamp"))
    return messages


def land_lines(messages: DataFrame, path: str) -> None:
    """Parse messages once for several readers: rows of ``parse_lines`` as a table at ``path``,
    partitioned by ``rejected``.  Only rejects keep their text."""
    rejected = F.col("reject_reason").isNotNull()
    parsed = parse_lines(split_payloads(messages)).withColumns(
        {"line": F.when(rejected, F.col("line")), "rejected": rejected})
    parsed.select(*LANDED_SCHEMA.names).write.partitionBy("rejected").parquet(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """What ``land_lines`` stored at ``path``."""
    return spark.read.schema(LANDED_SCHEMA).parquet(path)


def _parsed(messages: DataFrame) -> DataFrame:
    """Parsed lines of messages, or of rows that are parsed already."""
    return messages if "reject_reason" in messages.columns else parse_lines(split_payloads(messages))


def parse_trips(messages: DataFrame, mode: str = "permissive", since: str | None = None,
                until: str | None = None) -> DataFrame:
    """Messages -> good trips ``(event_id, line_no, ts, <17 trip fields>)``.

    ``since`` / ``until`` limit the message times before anything is parsed.

    ``mode="failfast"`` raises on the first malformed line (the original
    job's behaviour); ``"permissive"`` drops rejects, which
    ``rejected_trips`` returns.  Both also take the rows that ``land_lines`` stored.
    """
    parsed = _parsed(in_time_range(messages, since, until))
    if mode.lower() == "failfast":
        parsed = parsed.withColumn(
            "reject_reason",
            F.when(F.col("reject_reason").isNotNull(),
                   F.raise_error(F.concat(F.lit("malformed trip message, field "), F.col("reject_reason"))))
            .otherwise(F.col("reject_reason")))
    elif mode.lower() != "permissive":
        raise ValueError(f"unknown parse mode {mode!r}")
    return parsed.where(F.col("reject_reason").isNull()).select("event_id", "line_no", "ts", *TRIP_COLUMNS)


def rejected_trips(messages: DataFrame) -> DataFrame:
    """Quarantine: ``(event_id, line_no, ts, line, reject_reason)`` of bad lines."""
    parsed = _parsed(messages)
    return parsed.where(F.col("reject_reason").isNotNull()).select(
        "event_id", "line_no", "ts", "line", "reject_reason")


def over_3g(trips: DataFrame) -> DataFrame:
    """per-trip high-g points = hard accelerations + hard brakings."""
    return trips.withColumn("over_3g", F.expr("CAST(acce_over_3g AS BIGINT) + dece_over_3g"))
