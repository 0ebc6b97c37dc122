"""P2 repair: rejected lines that newer parse rules accept, or that were sent corrected, become trips.

``repair`` appends them to a table of their own, partitioned by day, keyed by
``(event_id, line_no)``: a line that is repaired already is left out, so a run that is
repeated (or was cut short) adds nothing twice.  The landed table is not rewritten; readers
unite both, and the live rollups stream from both, so a repair counts once everywhere.
A repair is final, as rollups already hold it: later rules repair what is still rejected.

A correction of a line that was not rejected, or whose text the rules still reject, is ignored; a
correction wins over the landed text; of several corrections of one line the smallest good text
wins.  A correction may carry ``ts`` (a reject for its time needs one); null keeps the landed time.
Rejects whose key is null cannot be told apart and stay rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmetrics.functions.variants import ParseRules, parse_variants, raw_lines
from tripmetrics.schema import TRIP_COLUMNS, TRIP_FIELDS

KEY = ["event_id", "line_no"]
REPAIRED_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("line_no", T.IntegerType()),
     T.StructField("ts", T.TimestampType())]
    + [T.StructField(n, t) for n, t in TRIP_FIELDS]
    + [T.StructField("rules_version", T.IntegerType()), T.StructField("corrected", T.BooleanType()),
       T.StructField("day", T.DateType())])


def repaired_lines(rejects: DataFrame, rules: ParseRules, corrections: DataFrame | None = None) -> DataFrame:
    """Trips of the rejects ``(event_id, line_no, ts, line)`` that the rules accept now, one per line."""
    keyed = rejects.where("event_id IS NOT NULL AND line_no IS NOT NULL").select(*KEY, "ts", "line")
    tries = keyed.withColumn("corrected", F.lit(False))
    if corrections is not None:
        ts = F.col("_ts") if "ts" in corrections.columns else F.lit(None).cast("timestamp")
        sent = corrections.withColumnRenamed("ts", "_ts").withColumnRenamed("line", "_line")
        tries = tries.unionByName(keyed.join(sent, KEY).select(
            *KEY, F.coalesce(ts, "ts").alias("ts"), F.col("_line").alias("line"), F.lit(True).alias("corrected")))
    # the text stays with its try, as several tries can have one key
    tagged = tries.select(F.struct(*KEY, "corrected", "line").alias("event_id"), "line_no", "ts", "line")
    parsed = parse_variants(raw_lines(tagged), rules).where("reject_reason IS NULL")
    trip = F.struct("ts", *TRIP_COLUMNS, "rules_version", "event_id.corrected")
    best = parsed.groupBy(F.col("event_id.event_id").alias("event_id"), "line_no").agg(
        F.min_by(trip, F.struct(~F.col("event_id.corrected"), F.col("event_id.line"), "ts")).alias("trip"))
    return best.select(*KEY, "trip.*").withColumn("day", F.to_date("ts")).select(*REPAIRED_SCHEMA.names)


def read_repaired(spark, path: str) -> DataFrame:
    return spark.read.schema(REPAIRED_SCHEMA).parquet(path)


def repair(rejects: DataFrame, path: str, rules: ParseRules, corrections: DataFrame | None = None) -> None:
    """Append the trips of ``rejects`` that can be repaired now and are not yet in the table at
    ``path`` (a folder that exists).  One repair of a table at a time."""
    held = read_repaired(rejects.sparkSession, path).select(*KEY)
    fresh = repaired_lines(rejects.join(held, KEY, "left_anti"), rules, corrections)
    fresh.write.mode("append").partitionBy("day").parquet(path)


def with_repairs(trips: DataFrame, repaired: DataFrame) -> DataFrame:
    """Landed trips and repaired ones, in batch or stream."""
    cols = [*KEY, "ts", *TRIP_COLUMNS]
    return trips.select(*cols).unionByName(repaired.select(*cols))


def still_rejected(rejects: DataFrame, repaired: DataFrame) -> DataFrame:
    return rejects.join(repaired.select(*KEY), KEY, "left_anti")
