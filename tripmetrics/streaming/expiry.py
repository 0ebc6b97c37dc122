"""Liveness keys that expire live (L3, W3): a row when a device has gone silent.

A device is alive from a beat until its TTL has run out; beats at most a TTL apart are one
run.  ``stream_expiry`` keeps the open runs of a device as state and sets an event-time
timer for the end of each.  When the watermark passes it, a row is written, with
no further message of the device: beats of any other device move the watermark.

Beats are put together to runs where they are read, before the shuffle by device, so a
device that sends a third of all beats moves a row per batch of records and gap.  State
per device: the runs that the watermark has not passed (a delay's worth at most).  Beats older than the
watermark are dropped, as in every query that has one; so read whole landing batches
(``streams.landed_beats`` without a file limit).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tripmetrics.operators.heartbeat import heartbeat_filter
from tripmetrics.schema import HEARTBEAT_TTL_MAIN_S
from tripmetrics.streaming.streams import DEFAULT_WATERMARK, _append_files

_RUN = "terminal_id string, first_s long, last_s long"
_EXPIRED = "terminal_id string, first_beat_s long, last_beat_s long, expired_s long"


# Both are made by functions, so that workers get them by value and need not have the package.
def _runs_of(ttl_s: int):
    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            pdf = pdf.sort_values(["terminal_id", "s"], kind="stable")
            same = pdf["terminal_id"].eq(pdf["terminal_id"].shift()) & (pdf["s"].diff() <= ttl_s)
            runs = pdf.groupby((~same).cumsum()).agg(
                terminal_id=("terminal_id", "first"), first_s=("s", "min"), last_s=("s", "max"))
            yield runs.reset_index(drop=True)

    return run


def _expiry_processor(ttl_s: int) -> StatefulProcessor:
    class Expiry(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.open = handle.getListState("open", "first_s long, last_s long")

        @staticmethod
        def _timer(last_s: int) -> int:
            # a beat in the second of the expiry still keeps the device alive
            return (last_s + ttl_s + 1) * 1000

        def handleInputRows(self, key, rows, timerValues):
            runs = [(r[0], r[1]) for r in self.open.get()] if self.open.exists() else []
            known = {last for _, last in runs}
            merged: list[list[int]] = []
            for first, last in sorted(runs + [(r["first_s"], r["last_s"]) for r in rows]):
                if merged and first - merged[-1][1] <= ttl_s:
                    merged[-1][1] = max(merged[-1][1], last)
                else:
                    merged.append([first, last])
            self.open.put([(f, l) for f, l in merged])
            ends = {last for _, last in merged}
            for last in known - ends:
                self.handle.deleteTimer(self._timer(last))
            for last in ends - known:
                self.handle.registerTimer(self._timer(last))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            from pyspark.sql import Row

            at = expiredTimerInfo.getExpiryTimeInMs()
            runs = [(r[0], r[1]) for r in self.open.get()] if self.open.exists() else []
            left = [r for r in runs if self._timer(r[1]) != at]
            if left:
                self.open.put(left)
            else:
                self.open.clear()
            for first, last in runs:
                if self._timer(last) == at:
                    yield Row(terminal_id=key[0], first_beat_s=first, last_beat_s=last, expired_s=last + ttl_s)

        def close(self) -> None:
            pass

    return Expiry()


def stream_expiry(source: DataFrame, path: str, terminal_ids: list[str] | DataFrame | None = None, *,
                  ttl_s: int = HEARTBEAT_TTL_MAIN_S, watermark: str = DEFAULT_WATERMARK,
                  checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Table ``(terminal_id, first_beat_s, last_beat_s, expired_s, day)``: a row per run of
    beats, when the watermark has passed its expiry.  The rows are those of
    ``heartbeat.heartbeat_runs`` up to there.

    ``source``: raw messages (filtered for ``terminal_ids``) or beats ``(event_id, ts, terminal_id)``.
    """
    beats = source if "value" not in source.columns else heartbeat_filter(source, terminal_ids)
    seconds = beats.where(F.col("terminal_id").isNotNull() & F.col("ts").isNotNull()).select(
        "terminal_id", F.unix_timestamp("ts").alias("s"))
    runs = seconds.mapInPandas(_runs_of(ttl_s), _RUN)
    timed = runs.withColumn("last_ts", F.timestamp_seconds("last_s")).withWatermark("last_ts", watermark)
    expired = timed.groupBy("terminal_id").transformWithState(
        statefulProcessor=_expiry_processor(ttl_s), outputStructType=_EXPIRED, outputMode="append", timeMode="EventTime")
    out = expired.withColumn("day", F.to_date(F.timestamp_seconds("expired_s")))
    return _append_files(out, "heartbeat_expiry", path, ["day"], checkpoint, trigger)
