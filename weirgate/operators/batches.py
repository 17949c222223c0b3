"""Facts about the batches of source tables: event days, mutations and checksums."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_days(events: DataFrame) -> DataFrame:
    """The different days of events."""
    return events.select("event_date").distinct()


def mutation_counts(tables: Iterable[DataFrame]) -> DataFrame:
    """(batch_id, mutations) over several tables, counted in each before they meet."""
    counted = [t.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")) for t in tables]
    return reduce(DataFrame.unionByName, counted).groupBy("batch_id").agg(F.sum("n").alias("mutations"))


def record_text(kind: str, *values: Column) -> Column:
    """A mutation as text: its kind and values with colons between."""
    return F.concat_ws(":", F.lit(kind), *(v.cast("string") for v in values))


def checksums(mutations: DataFrame) -> DataFrame:
    """(batch_id, checksum) of mutations (batch_id, record): the MD5 of a batch's records in order, with bars between.

    The digest is of one text by definition, so a batch's records meet in one task: source batches are closed and small.
    """
    joined = F.array_join(F.array_sort(F.collect_list("record")), "|")
    return mutations.groupBy("batch_id").agg(F.md5(joined).alias("checksum"))
