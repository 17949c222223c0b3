"""Keyed upserts into Parquet tables, as versions that a pointer names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .snapshot import duplicate_keys


def same_columns(target: DataFrame, source: DataFrame) -> None:
    """Raises if names or types differ: a changed schema fails the load."""
    a, b = ([(f.name, f.dataType.simpleString()) for f in df.schema] for df in (target, source))
    if a != b:
        raise ValueError(f"schema changed: {sorted(set(a) ^ set(b)) or 'order of columns'}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """target with rows of source put in by key: equal keys are replaced, others added, none deleted."""
    same_columns(target, source)
    return target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(source)


def merge(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """upsert, or source alone for a first load; a source that repeats a key is refused."""
    if not duplicate_keys(source, keys).isEmpty():
        raise ValueError(f"rows to merge repeat a key of {list(keys)}")
    return source if target is None else upsert(target, source, keys)


def increment(target: DataFrame, source: DataFrame, batch: str) -> DataFrame:
    """Rows of source from the target's newest batch on (that one again, for it may have been partial)."""
    water = F.coalesce(target.agg(F.max(batch)).scalar(), F.lit(0))
    return source.where(F.col(batch) >= water)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions of a stored table, oldest first."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name[len("version=") :]))
    return sorted(found)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest finished version of a stored table."""
    found = versions(spark, path)
    return spark.read.parquet(f"{path}/version={found[-1]:010d}") if found else None


def store(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], batch: str | None = None) -> str:
    """Merge source into a stored table as its next version; gives the version's path.

    With batch, only rows from the table's newest batch on are merged. A version counts once it is finished, so a crash
    leaves the one before.
    """
    before = current(spark, path)
    rows = increment(before, source, batch) if before is not None and batch else source
    number = (versions(spark, path) or [0])[-1] + 1
    out = f"{path}/version={number:010d}"
    merge(before, rows, keys).write.mode("overwrite").parquet(out)
    return out
