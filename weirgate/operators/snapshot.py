"""State of keyed entities as of a batch, from change events or from source history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The total order of change events: the source's log position first, then how they arrived.
SOURCE_ORDER = ("source_lsn", "transaction_order", "partition", "offset")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key. The filter on row_number prunes groups before the shuffle, so hot keys send one row."""
    newest = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def latest_by_max(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The same by aggregation: the row at the greatest order, partially aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def admitted(events: DataFrame, batch: int, through: date | None = None) -> DataFrame:
    """Events up to a batch, whenever they arrived, without tombstones; through also bounds a backfill's days."""
    out = events.where((F.col("batch_id") <= F.lit(batch)) & ~F.col("is_tombstone"))
    return out if through is None else out.where(F.col("event_date") <= F.lit(through))


def current_events(events: DataFrame, batch: int, through: date | None = None) -> DataFrame:
    """The winning event of each key as of a batch; keys whose winner is a delete are gone."""
    return latest(admitted(events, batch, through), ("key_json",), SOURCE_ORDER).where("operation <> 'd'")


def snapshot(events: DataFrame, row_type: T.StructType, batch: int, through: date | None = None) -> DataFrame:
    """Typed rows of an entity as of a batch, with where each came from."""
    row = F.from_json("row_json", row_type).alias("row")
    kept = ("batch_id", "source_lsn", "topic", "partition", "offset", "operation")
    typed = current_events(events, batch, through).select(row, *kept)
    own = [f"row.{f}" for f in row_type.fieldNames() if f != "batch_id"]
    return typed.select(*own, *kept)


def history_ranked(history: DataFrame, keys: Sequence[str], batch: str, sequence: str, cutoff: int) -> DataFrame:
    """The newest history row of each key up to a batch."""
    return latest(history.where(F.col(batch) <= F.lit(cutoff)), keys, (batch, sequence))


def history_state(history: DataFrame, keys: Sequence[str], cutoff: int, *, batch: str = "batch_id", sequence: str = "history_id", deleted: str | None = "is_deleted") -> DataFrame:
    """Source truth as of a batch."""
    newest = history_ranked(history, keys, batch, sequence, cutoff)
    return newest if deleted is None else newest.where(~F.coalesce(F.col(deleted), F.lit(False)))


def history_deleted(history: DataFrame, keys: Sequence[str], cutoff: int, *, batch: str = "batch_id", sequence: str = "history_id", deleted: str | None = "is_deleted") -> DataFrame:
    """Keys whose newest history row is a delete; none if the source does not say."""
    newest = history_ranked(history, keys, batch, sequence, cutoff)
    return newest.where(F.lit(False) if deleted is None else F.col(deleted)).select(*keys)


def with_deletion(history: DataFrame, operation: str = "operation") -> DataFrame:
    """History with its operation as one letter and is_deleted derived from it."""
    letter = F.left(F.upper(F.col(operation)), F.lit(1))
    return history.withColumn(operation, letter).withColumn("is_deleted", letter == "D")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df, unless a key repeats."""
    found = duplicate_keys(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"key occurs {found[0]['occurrences']} times: {[found[0][k] for k in keys]}")
    return df


def high_water(df: DataFrame, column: str) -> Column:
    """The largest value of a column of a stored table, 0 if there is none, as an uncorrelated scalar subquery."""
    return F.coalesce(df.agg(F.max(column)).scalar(), F.lit(0))
