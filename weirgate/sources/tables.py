"""Reading: topic logs, history of events, snapshots, source history, candidates, control tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A record of a topic.
RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def topic_stream(spark: SparkSession, topic: str, *, log: str | None = None, servers: str | None = None, starting: str = "earliest") -> DataFrame:
    """A stream of a topic's records: from Kafka brokers, or from a folder of Parquet files with the same columns."""
    if starting not in ("earliest", "latest"):
        raise ValueError("starting must be earliest or latest")
    if (log is None) == (servers is None):
        raise ValueError("give either a log folder or brokers")
    if servers is not None:
        options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "true"}
        records = spark.readStream.format("kafka").options(**options).load()
    else:
        records = spark.readStream.schema(RECORD).parquet(log).where(F.col("topic") == topic)
    return records.select(*RECORD.fieldNames())


def or_empty(read: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
    """What read gives, or an empty table of the schema if its path does not exist; other errors are raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return SparkSession.active().createDataFrame([], schema)


def bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All events under an entity's folder; event_date, run_id and stream_batch are partitions and prune directories.

    Folders that lie beside partitions (archives without them) can be read by giving their own path.
    """
    return or_empty(lambda: spark.read.schema(schema).option("basePath", path).parquet(path), schema)


def silver(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return or_empty(lambda: spark.read.schema(schema).parquet(path), schema)


def footer_rows(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table; only footers are read."""
    return spark.read.parquet(path).count()


def written(df: DataFrame, path: str) -> DataFrame:
    """Write df over path, read it back, and insist that every row arrived."""
    spark = df.sparkSession
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    found = back.count()
    if found != seen.get["rows"]:
        raise RuntimeError(f"{path}: wrote {seen.get['rows']} rows, found {found}")
    return back


def history(source: DataFrame, batch: str, cutoff: int) -> DataFrame:
    """Source history up to a batch; the filter reaches the scan (or the database, for a JDBC source)."""
    return source.where(F.col(batch) <= F.lit(cutoff))


def jdbc_history(spark: SparkSession, url: str, table: str, columns: list[str], batch: str, cutoff: int, **options: str) -> DataFrame:
    """The same from a database."""
    read = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return history(read.select(*columns), batch, cutoff)


def candidate(spark: SparkSession, path: str, batch: str, cutoff: int) -> DataFrame:
    """A candidate table's rows up to a batch."""
    return spark.read.parquet(path).where(F.col(batch) <= F.lit(cutoff))


def lossless(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns of another warehouse, found by name in any case, in the types asked for where that loses nothing.

    Integral decimals become integers and 0 and 1 become booleans; anything else of another type fails the read.
    """
    by_name = {c.lower(): c for c in df.columns}
    out = []
    for name, kind in types.items():
        if name.lower() not in by_name:
            raise KeyError(name)
        c = F.col(f"`{by_name[name.lower()]}`")
        found = df.schema[by_name[name.lower()]].dataType
        wrong = F.raise_error(F.lit(f"{name}: not a {kind}"))
        if found.simpleString() == kind:
            value: Column = c
        elif kind in ("int", "bigint") and isinstance(found, (T.DecimalType, T.LongType, T.IntegerType, T.ShortType)):
            value = F.when(c.isNull() | (c == F.floor(c)), c.cast(kind)).otherwise(wrong.cast(kind))
        elif kind == "boolean" and isinstance(found, (T.DecimalType, T.LongType, T.IntegerType, T.ShortType)):
            value = F.when(c.isNull(), F.lit(None).cast("boolean")).when(c.isin(0, 1), c == 1).otherwise(wrong.cast("boolean"))
        else:
            raise TypeError(f"{name}: {found.simpleString()} is not a {kind}")
        out.append(value.alias(name))
    return df.select(*out)


class Once:
    """A reader that fetches each (entity, batch) once; what an executor loses is fetched again from lineage."""

    def __init__(self, read: Callable[[str, int], DataFrame]):
        self._read, self._kept = read, {}

    def __call__(self, entity: str, batch: int) -> DataFrame:
        if (entity, batch) not in self._kept:
            self._kept[entity, batch] = self._read(entity, batch).persist()
        return self._kept[entity, batch]

    def clear(self) -> None:
        for df in self._kept.values():
            df.unpersist()
        self._kept.clear()


def last_closed(batches: DataFrame, end: Any, batch: str = "batch_id", completed: str = "completed_at") -> DataFrame:
    """One row, batch_id: the newest batch that was completed before end; batches without a time are still loading."""
    return batches.where(F.col(completed) < F.lit(end)).agg(F.max(batch).alias("batch_id"))


def cutoff(batches: DataFrame, end: Any) -> int:
    """The batch that a run ending at end is as of; an error if none is closed."""
    found = last_closed(batches, end).first()[0]
    if found is None:
        raise LookupError("no closed batch before the end of the interval")
    return int(found)
