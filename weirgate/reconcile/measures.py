"""Measures of one side of a comparison, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import canonical, encode, framed, require
from .rules import Aggregate, Rule

ALL = "__all__"
#: Most rows of a table whose exact checksums are taken.
EXACT_ROWS = 1_000_000


def display_key(df: DataFrame, rule: Rule, columns: Sequence[str]) -> Column:
    """Canonical parts with bars between."""
    if not columns:
        return F.lit(ALL)
    return F.concat_ws("|", *(canonical(df[c], rule.columns[c]) for c in columns))


def grouped_counts(df: DataFrame, rule: Rule, columns: Sequence[str]) -> DataFrame:
    """(group, value) with the number of rows of each group."""
    return df.groupBy(display_key(df, rule, columns).alias("group")).agg(F.count(F.lit(1)).cast("string").alias("value"))


def row_counts(source: DataFrame, target: DataFrame, rule: Rule) -> DataFrame:
    """One row: entity, expected, actual, passed."""
    n, m = (df.agg(F.count(F.lit(1)).alias(name)) for df, name in ((source, "expected"), (target, "actual")))
    return n.crossJoin(m).select(F.lit(rule.entity).alias("entity"), "expected", "actual", (F.col("expected") == F.col("actual")).alias("passed"))


def aggregate(df: DataFrame, rule: Rule, spec: Aggregate) -> DataFrame:
    """(group, value) with the canonical aggregate of each group; nulls are left out, and no rows give no groups."""
    kind = rule.columns[spec.column]
    c = df[spec.column]
    if spec.operation == "sum":
        exact = c if isinstance(df.schema[spec.column].dataType, T.DecimalType) else c.cast("decimal(38,0)" if kind == "integer" else "decimal(38,10)")
        kind, made = "decimal", F.sum(exact)  # at the column's own scale
    else:
        made = F.min(c) if spec.operation == "min" else F.max(c)
    sums = df.groupBy(display_key(df, rule, spec.by).alias("group")).agg(made.alias("v"))
    return sums.select("group", canonical(F.col("v"), kind).alias("value"))


def exact_checksums(df: DataFrame, rule: Rule, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: for each column the SHA-256 of the framed canonical keys and values in key order.

    All rows of a column meet in one array, so compare() takes this for tables of at most EXACT_ROWS rows; larger ones use
    sums.
    """
    names = list(columns or rule.columns)
    coded = encode(df, dict(rule.columns))
    key = F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(rule.key)))

    def digest(name: str) -> Column:
        item = F.concat(*(framed(F.col(k)) for k in rule.key), framed(F.col(name)))
        rows = F.array_sort(F.collect_list(F.struct(key.alias("key"), item.alias("item"))))
        return F.sha2(F.unhex(F.array_join(F.transform(rows, lambda r: r["item"]), "")), 256).alias(name)

    return coded.agg(*map(digest, names))


def summed_checksums(df: DataFrame, rule: Rule, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: for each column the row count and the sum of a hash of key and value; any order, partially aggregated."""
    names = list(columns or rule.columns)
    coded = encode(df, dict(rule.columns))

    def digest(name: str) -> Column:
        h = F.xxhash64(*(F.col(k) for k in rule.key), F.col(name))
        h2 = F.xxhash64(F.lit(name), F.col(name), *(F.col(k) for k in rule.key))
        return F.concat_ws(":", F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.sum(h2.cast("decimal(38,0)"))).alias(name)

    return coded.agg(*map(digest, names))


CHECKSUMS = {"exact": exact_checksums, "sums": summed_checksums}


def still_present(candidate: DataFrame, deleted: DataFrame, rule: Rule) -> DataFrame:
    """(group) display keys of deleted rows that the candidate has."""
    require(candidate, {k: rule.columns[k] for k in rule.key})
    gone = deleted.select(display_key(deleted, rule, rule.key).alias("group"))
    return candidate.select(display_key(candidate, rule, rule.key).alias("group")).join(gone, "group", "left_semi")


def differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(group, expected, actual) where two (group, value) tables differ, missing groups included."""
    e, a = expected.withColumnRenamed("value", "expected"), actual.withColumnRenamed("value", "actual")
    return e.join(a, "group", "full").where(~F.col("expected").eqNullSafe(F.col("actual")))
