"""Wide-column cell tables.

A wide-column table is read as cells ``(row_key, family, qualifier, value,
version)`` -- the layout any wide-column export or connector produces.  Projections
pivot a fixed qualifier list into columns in a single hash aggregate keyed by
``row_key`` (the pivot values are given, so no extra job discovers them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.schema import CELL_SCHEMA, WIDECOL_FAMILY, WIDECOL_QUALIFIERS


def read_cells(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Batch read of a cell table with the fixed cell schema."""
    return spark.read.format(file_format).schema(CELL_SCHEMA).load(path)


def widecol_count(cells: DataFrame) -> DataFrame:
    """Number of rows (distinct row keys) of the table: ``(n_rows)``."""
    return cells.agg(F.count_distinct("row_key").alias("n_rows"))


def utf8_text(value: Column) -> Column:
    """Cell bytes as UTF-8 text."""
    return F.decode(value, "UTF-8")


def be_int32(value: Column) -> Column:
    """4-byte big-endian two's-complement integer cell -> INT."""
    unsigned = F.conv(F.hex(value), 16, 10).cast("long")
    return F.when(F.length(value) == 4,
                  F.when(unsigned >= 2 ** 31, unsigned - 2 ** 32).otherwise(unsigned).cast("int"))


def widecol_project(cells: DataFrame, family: str = WIDECOL_FAMILY,
                    qualifiers: list[str] | None = None,
                    decoders: dict[str, callable] | None = None) -> DataFrame:
    """``row_key`` as text plus one column per qualifier of
    ``family``: the newest version of the cell (of equal versions the greater
    bytes), NULL if the row has no such cell.  Every row of the table is
    kept, also one that has none of the cells.  ``decoders`` maps a qualifier
    to a bytes decoder (default UTF-8 text)."""
    quals = qualifiers or WIDECOL_QUALIFIERS
    decoders = decoders or {}
    version = F.col("version") if "version" in cells.columns else F.lit(0).cast("long")

    def newest(q: str) -> Column:
        own = (F.col("family") == family) & (F.col("qualifier") == q)
        rank = F.struct(F.coalesce(version, F.lit(-(2 ** 63))).alias("version"), F.col("value"))
        return F.max(F.when(own, rank)).getField("value").alias(q)

    pivoted = cells.groupBy("row_key").agg(*[newest(q) for q in quals])
    return pivoted.select(
        utf8_text(F.col("row_key")).alias("row_key"),
        *[decoders.get(q, utf8_text)(F.col(q)).alias(q) for q in quals])


def write_sorted(cells: DataFrame, path: str, files: int | None = None) -> None:
    """Lay a cell table out for range scans: files hold disjoint ranges of row
    keys, sorted, so the least and greatest keys of files and row groups are narrow.  All cells
    of a row key are in one file (a range never splits equal keys)."""
    dealt = cells.repartitionByRange(files, "row_key") if files else cells.repartitionByRange("row_key")
    dealt.sortWithinPartitions("row_key", "family", "qualifier").write.mode("overwrite").parquet(path)


def key_range(cells: DataFrame, start: str | None = None, stop: str | None = None) -> DataFrame:
    """S7/S8 over part of the table: the cells with ``start <= row_key < stop`` (UTF-8
    bytes, null: open).  The bounds are plain comparisons with binary literals, so they
    reach the Parquet row groups."""
    rows = cells
    if start is not None:
        rows = rows.where(F.col("row_key") >= F.lit(bytearray(start.encode())))
    if stop is not None:
        rows = rows.where(F.col("row_key") < F.lit(bytearray(stop.encode())))
    return rows


def ensure_table(spark: SparkSession, name: str, schema=CELL_SCHEMA, path: str | None = None) -> bool:
    """Create the cell table if it does not exist; True when created."""
    if spark.catalog.tableExists(name):
        return False
    empty = spark.createDataFrame([], schema)
    writer = empty.write.format("parquet").mode("ignore")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return True
