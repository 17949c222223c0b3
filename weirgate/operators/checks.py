"""Data tests: each gives its violating rows, so no rows means passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import amount, joined_key, off_by


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def repeats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values (or combinations) that occur more than once, with how often."""
    known = df
    if len(columns) == 1:  # nulls are no values; combinations with nulls are combinations
        known = df.where(F.col(columns[0]).isNotNull())
    return known.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference is not null and names no parent."""
    known = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti").select(*child.columns)


def negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def not_positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) <= 0)


def entity_counts(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Entities whose staging and mart tables have different numbers of rows."""
    out = None
    for name, (expected, actual) in pairs.items():
        counts = [df.agg(F.count(F.lit(1)).alias(c)) for df, c in ((expected, "expected_count"), (actual, "actual_count"))]
        row = counts[0].crossJoin(counts[1]).select(F.lit(name).alias("entity_name"), "expected_count", "actual_count")  # one row each
        out = row if out is None else out.unionByName(row)
    return out.withColumn("count_difference", F.col("actual_count") - F.col("expected_count")).where("count_difference <> 0")


def order_amounts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose total is not that of their lines."""
    lines = items.groupBy("order_id").agg(F.sum("line_amount").cast("decimal(18,2)").alias("lines"))
    found = orders.join(lines, "order_id", "left").withColumn("actual_amount", F.coalesce("lines", F.lit(0).cast("decimal(18,2)")))
    wrong = found.where(off_by(F.col("actual_amount"), F.col("order_total")))
    return wrong.select("order_id", F.col("order_total").alias("expected_amount"), "actual_amount", (F.col("actual_amount") - F.col("order_total")).cast("decimal(18,2)").alias("amount_difference"))


def item_amounts(items: DataFrame) -> DataFrame:
    """Lines whose amount is not quantity times price."""
    expected = amount(F.col("quantity"), F.col("unit_price"))
    wrong = items.where(off_by(F.col("line_amount"), expected))
    return wrong.select("order_item_id", expected.alias("expected_amount"), F.col("line_amount").alias("actual_amount"), (F.col("line_amount") - expected).cast("decimal(18,2)").alias("amount_difference"))


def _over(silver: dict[str, DataFrame], keys: dict[str, tuple[str, ...]], column: str, alias: str, beyond) -> DataFrame:
    out = None
    for name, df in silver.items():
        part = df.where(beyond(F.col(column))).select(F.lit(name).alias("source_name"), joined_key(*(F.col(k) for k in keys[name])).alias("record_key"), F.col(column).alias(alias))
        out = part if out is None else out.unionByName(part)
    return out


def beyond_batch(silver: dict[str, DataFrame], keys: dict[str, tuple[str, ...]], batch: int) -> DataFrame:
    """Snapshot rows that are newer than the batch."""
    return _over(silver, keys, "batch_id", "source_batch_id", lambda c: c > F.lit(batch))


def beyond_time(silver: dict[str, DataFrame], keys: dict[str, tuple[str, ...]], end: str) -> DataFrame:
    """Snapshot rows that were changed at or after the end of the interval."""
    return _over(silver, keys, "updated_at", "source_updated_at", lambda c: c.cast("timestamp") >= F.lit(end).cast("timestamp"))
