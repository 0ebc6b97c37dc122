"""P1 over VARIANT: raw lines landed once, read under versioned parse rules.

``raw_lines`` turns each message line into a VARIANT, so a field that no rule knows yet is
stored too; a line that is no JSON object keeps its text instead.  Event objects that come as
JSON-encoded strings are decoded when they land.  ``parse_variants`` reads trips from such rows by
``ParseRules``: each field has one or more names, of which the first found counts, and
further columns can be read besides the 17.  Extraction by path reaches the
scan: only the asked-for paths are read from the stored variants.

Rows that the text parser (``functions.parse``) accepts give the same trip here.  An object that names
a field twice is malformed JSON here; there the parser picks one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.functions.parse import _CORRUPT, _A, _D, _O, _OV, _T, _TI, typed_lines
from tripmetrics.schema import (JSON_ACCE, JSON_DECE, JSON_MILEAGE, JSON_OVERSPEED, JSON_SUBSCORES, JSON_TERMINAL,
                                JSON_TIRED, JSON_TURN, TRIP_COLUMNS)
from tripmetrics.sources.messages import split_payloads

EVENT_OBJECTS = [JSON_ACCE, JSON_DECE, JSON_TURN, JSON_OVERSPEED, JSON_TIRED]
_LEAVES = {JSON_ACCE: ("times", "score"), JSON_DECE: ("times", "score"), JSON_TURN: ("times", "score"),
           JSON_OVERSPEED: ("score",), JSON_TIRED: ("score",)}
_ALIASES = {JSON_ACCE: _A, JSON_DECE: _D, JSON_TURN: _T, JSON_OVERSPEED: _OV, JSON_TIRED: _TI}


class ParseRules(NamedTuple):
    """``names``: other names of a field, tried in order after its own, as
    ``{"mileage": ("mileageKm",)}`` or, within an event object,
    ``{"acceRapidEvents.times": ("count",)}``.  ``extra``: columns besides the 17, as
    ``{"firmware": ("$.firmware", "string")}`` (path, SQL type; null where absent)."""

    version: int = 1
    names: dict[str, tuple[str, ...]] = {}
    extra: dict[str, tuple[str, str]] = {}


def _decoded(name: str) -> str:
    return f"_{name}_decoded"


def raw_lines(messages: DataFrame) -> DataFrame:
    """``(event_id, line_no, ts, payload, <decoded event objects>, line)`` of message lines, or of
    rows that hold a ``line`` already.  ``payload`` is null and ``line`` kept where a line is
    no JSON object."""
    lines = messages if "line" in messages.columns else split_payloads(messages)
    parsed = lines.selectExpr("event_id", "line_no", "ts", "line", "try_parse_json(line) AS _any").selectExpr(
        "event_id", "line_no", "ts", "line",
        "CASE WHEN startswith(schema_of_variant(_any), 'OBJECT') THEN _any END AS payload")
    texts = parsed.selectExpr("*", *[f"try_variant_get(payload, '$.{n}', 'variant') AS `_{n}`" for n in EVENT_OBJECTS])
    return texts.selectExpr(
        "event_id", "line_no", "ts", "payload",
        *[f"CASE WHEN schema_of_variant(`_{n}`) = 'STRING' "
          f"THEN try_parse_json(try_variant_get(`_{n}`, '$', 'string')) END AS `{_decoded(n)}`" for n in EVENT_OBJECTS],
        "CASE WHEN payload IS NULL THEN line END AS line")


def _first(found: list[str]) -> str:
    return found[0] if len(found) == 1 else f"coalesce({', '.join(found)})"


def _leaf(rules: ParseRules, obj: str | None, name: str, sql_type: str = "string") -> str:
    """The field under its names, in the payload or in the decoded event object."""
    names = (name, *rules.names.get(f"{obj}.{name}" if obj else name, ()))
    if obj is None:
        return _first([f"try_variant_get(payload, '$.{n}', '{sql_type}')" for n in names])
    return _first([f"try_variant_get({src}, '{path}.{n}', '{sql_type}')" for n in names
                   for src, path in (("payload", f"$.{obj}"), (f"`{_decoded(obj)}`", "$"))])


def _is_object(obj: str) -> str:
    return (f"(startswith(schema_of_variant(try_variant_get(payload, '$.{obj}', 'variant')), 'OBJECT') "
            f"OR startswith(schema_of_variant(`{_decoded(obj)}`), 'OBJECT'))")


def parse_variants(raw: DataFrame, rules: ParseRules = ParseRules()) -> DataFrame:
    """Trip columns, the rules' extra columns, ``reject_reason`` and ``rules_version`` of landed raw rows."""
    outer = ", ".join(f"'{n}', {_leaf(rules, None, n)}" for n in [JSON_MILEAGE, JSON_TERMINAL, *JSON_SUBSCORES])
    structs = [f"CASE WHEN payload IS NOT NULL THEN named_struct({outer}, '{_CORRUPT}', CAST(NULL AS STRING)) END AS {_O}"]
    for obj in EVENT_OBJECTS:
        fields = [f"'{leaf}', {_leaf(rules, obj, leaf)}" for leaf in _LEAVES[obj]]
        if obj in (JSON_ACCE, JSON_DECE):
            fields.append(f"'points', {_leaf(rules, obj, 'points', 'array<struct<acceValue:string>>')}")
        structs.append(f"CASE WHEN {_is_object(obj)} THEN named_struct({', '.join(fields)}, "
                       f"'{_CORRUPT}', CAST(NULL AS STRING)) END AS {_ALIASES[obj]}")
    extra = [f"try_variant_get(payload, '{path}', '{sql_type}') AS `{name}`" for name, (path, sql_type) in rules.extra.items()]
    keep = ["event_id", "line_no", "ts", "line", *rules.extra]
    objects = raw.selectExpr("event_id", "line_no", "ts", "line", *extra, *structs)
    return typed_lines(objects, keep).withColumn("rules_version", F.lit(rules.version))


def variant_trips(raw: DataFrame, rules: ParseRules = ParseRules()) -> DataFrame:
    """The good trips, with the rules' extra columns."""
    return parse_variants(raw, rules).where("reject_reason IS NULL").select(
        "event_id", "line_no", "ts", *TRIP_COLUMNS, *rules.extra)
