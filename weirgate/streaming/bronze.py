"""Bounded ingestion: a topic's new records become immutable events and dead letters, once for each micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import Layout, Run
from .parse import classified, dead_letters, events


def writer(layout: Layout, run: Run, entity: str) -> Callable[[DataFrame, int], None]:
    """What a micro-batch does. It overwrites the folder of its number, so a replay changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        kept = classified(batch, F.lit(run.end)).persist()  # evaluated once for both tables
        try:
            events(kept).write.mode("overwrite").partitionBy("event_date").parquet(layout.bronze_part(entity, run.run_id, number))
            broken = dead_letters(kept)
            if not broken.isEmpty():
                broken.write.mode("overwrite").parquet(layout.dead_letter_part(entity, run.run_id, number))
        finally:
            kept.unpersist()

    return write


def ingest(stream: DataFrame, layout: Layout, run: Run, entity: str, topic: str, pipeline: str = "retail") -> None:
    """Take what a topic has now, then stop. The checkpoint is the topic's, so later runs go on from there."""
    query = (
        stream.writeStream.foreachBatch(writer(layout, run, entity))
        .option("checkpointLocation", layout.checkpoint(pipeline, topic))
        .trigger(availableNow=True)
        .queryName(f"{pipeline}-{entity}")
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()


def ingest_all(sources: Iterable[tuple[DataFrame, str, str]], layout: Layout, run: Run, pipeline: str = "retail") -> None:
    """ingest for several (stream, entity, topic) side by side; the first failure is raised after all have ended."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        futures = [pool.submit(ingest, stream, layout, run, entity, topic, pipeline) for stream, entity, topic in sources]
    for future in futures:
        future.result()
