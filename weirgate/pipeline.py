"""The whole run: ingest, snapshot, model, test, reconcile, publish."""

from __future__ import annotations

import argparse
import json
import logging
import sys
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import publish
from .context import Layout, Run
from .entities import ENTITIES, METADATA
from .operators import checks as tests
from .operators import merge
from .operators.declared import DECLARED, violations
from .operators.snapshot import history_deleted, history_state, snapshot
from .plans import marts, staging
from .reconcile.rules import RETAIL
from .reconcile.service import Report, validate
from .sources import tables
from .streaming.bronze import ingest_all

LOG = logging.getLogger("weirgate")

#: Columns of event tables as stored; event_date, run_id and stream_batch are partitions.
_KINDS = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(), "date": T.DateType()}
EVENTS = T.StructType(
    [
        T.StructField(name, _KINDS[kind])
        for name, kind in map(str.split, (
            "entity string, operation string, key_json string, before_json string, after_json string, row_json string, batch_id long, source_lsn long, source_timestamp_ms long, transaction_order long, "
            "topic string, partition int, offset long, kafka_timestamp timestamp, raw_payload string, is_tombstone boolean, run_id string, stream_batch string, event_date date"
        ).split(", "))
    ]
)
#: A mart's key and the column that its increments go by.
MARTS = {"dim_customer": (("customer_id",), "source_batch_id"), "dim_product": (("product_id",), "source_batch_id"), "dim_date": (("date_key",), None), "fact_order": (("order_id",), "source_batch_id"), "fact_order_item": (("order_id", "line_number"), "source_batch_id")}
#: What each model is made of; a model is built after these.
NEEDS = {
    **{f"stg_{e}": (f"silver_{e}",) for e in ENTITIES},
    **{f"validation_{e}": (f"stg_{e}",) for e in ENTITIES},
    "orders_enriched": ("stg_orders", "stg_customers", "stg_order_items"),
    "order_items_enriched": ("stg_order_items", "stg_orders", "stg_products"),
    "dim_customer": ("stg_customers",),
    "dim_product": ("stg_products",),
    "dim_date": ("orders_enriched",),
    "fact_order": ("orders_enriched",),
    "fact_order_item": ("order_items_enriched",),
}


class JsonLines(logging.Formatter):
    """Log records as one JSON object a line."""

    def format(self, record: logging.LogRecord) -> str:
        body = {"time": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            body["error"] = self.formatException(record.exc_info)
        return json.dumps(body | getattr(record, "fields", {}))


@dataclass
class Metrics:
    """Numbers of a run, for a text file that a scraper reads."""

    values: dict[str, float] = field(default_factory=dict)

    def text(self) -> str:
        return "".join(f"weirgate_{k} {v}\n" for k, v in sorted(self.values.items()))

    def save(self, path: str | Path) -> None:
        path = Path(path)
        path.parent.mkdir(parents=True, exist_ok=True)
        draft = path.with_suffix(".tmp")
        draft.write_text(self.text())
        draft.replace(path)


def ancestors(names: list[str]) -> list[str]:
    """The models that the named ones need, themselves included, each after what it needs."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in NEEDS and name not in out:
            for need in NEEDS[name]:
                visit(need)
            out.append(name)

    for name in names:
        visit(name)
    return out


def build(run: Run, silver: dict[str, DataFrame], names: list[str]) -> dict[str, DataFrame]:
    """Lazy models over snapshots; nothing is computed until a mart is written."""
    b, rid = run.batch_id, run.run_id
    made = {f"silver_{e}": df for e, df in silver.items()}
    makers: dict[str, Callable[..., DataFrame]] = {
        **{f"stg_{e}": lambda df, e=e: staging.STAGING[e](df, b) for e in ENTITIES},
        **{f"validation_{e}": lambda df, e=e: staging.compared(e, df) for e in ENTITIES},
        "orders_enriched": marts.orders_enriched,
        "order_items_enriched": marts.order_items_enriched,
        "dim_customer": lambda df: marts.dim_customer(df, rid, b),
        "dim_product": lambda df: marts.dim_product(df, rid, b),
        "dim_date": lambda df: marts.dim_date(df, run.start.astimezone(UTC).date(), run.end.astimezone(UTC).date(), rid, b),
        "fact_order": lambda df: marts.fact_order(df, rid, b),
        "fact_order_item": lambda df: marts.fact_order_item(df, rid, b),
    }
    for name in ancestors(names):
        made[name] = makers[name](*(made[n] for n in NEEDS[name]))
    return made


def write_silver(spark: SparkSession, layout: Layout, run: Run, through: date | None = None, archive: str | None = None) -> dict[str, DataFrame]:
    """Snapshots of all entities as of the run's batch, from stored events (or an archive of them)."""
    out = {}
    for name, entity in ENTITIES.items():
        path = Layout(archive).bronze(name) if archive else layout.bronze(name)
        events = tables.bronze(spark, path, EVENTS)
        rows = snapshot(events, entity.row_type(), run.batch_id, through)
        if through is not None and rows.isEmpty() and not snapshot(events, entity.row_type(), run.batch_id).isEmpty():
            LOG.warning("no event of %s is as old as %s; the snapshot is empty", name, through)
        out[name] = tables.written(rows, layout.silver(name, run.run_id))
    return out


def data_tests(run: Run, silver: dict[str, DataFrame], m: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tests over several tables; each result must be empty."""
    keys = {e.name: e.key for e in ENTITIES.values()}
    return {
        "entity_counts": tests.entity_counts({"customer": (m["stg_customers"], m["dim_customer"]), "product": (m["stg_products"], m["dim_product"]), "order": (m["stg_orders"], m["fact_order"]), "order_item": (m["stg_order_items"], m["fact_order_item"])}),
        "order_amounts": tests.order_amounts(m["fact_order"], m["fact_order_item"]),
        "item_amounts": tests.item_amounts(m["fact_order_item"]),
        "batch_cutoff": tests.beyond_batch(silver, keys, run.batch_id),
        "time_cutoff": tests.beyond_time(silver, keys, run.end.astimezone(UTC).isoformat()),
    }


def failed_tests(run: Run, silver: dict[str, DataFrame], m: dict[str, DataFrame]) -> list[str]:
    """The names of all tests that fail: those over several tables, and the declared ones of each."""
    failed = [name for name, rows in data_tests(run, silver, m).items() if not rows.isEmpty()]
    for name in DECLARED:
        failed += [r.test for r in violations(name, m).where("violations > 0").collect()]
    return failed


@dataclass
class Outcome:
    run: Run
    report: Report
    failed_tests: list[str]
    published: str | None
    metrics: Metrics


def run_pipeline(
    spark: SparkSession,
    layout: Layout,
    run: Run,
    registry: publish.Registry,
    history: Callable[[str], DataFrame],
    log: str | None = None,
    servers: str | None = None,
    topics: dict[str, str] | None = None,
    archive: str | None = None,
    through: date | None = None,
    checksums: str = "sums",
) -> Outcome:
    """One run from a topic log (or brokers, or an archive of events) to published marts; a failed check publishes nothing.

    checksums: sums, for any size, or exact, for tables of at most EXACT_ROWS rows.
    """
    began, metrics = time.time(), Metrics()
    if archive is None:
        names = topics or {e: f"cdc.retail.{e}" for e in ENTITIES}
        ingest_all([(tables.topic_stream(spark, t, log=log, servers=servers), e, t) for e, t in names.items()], layout, run)
    silver = write_silver(spark, layout, run, through, archive)
    models = build(run, silver, [*MARTS, *(f"validation_{e}" for e in ENTITIES)])
    paths = {}
    for name, (keys, batch) in MARTS.items():
        paths[name] = merge.store(spark, layout.candidate(run.namespace, name), models[name], keys, batch)
        models[name] = spark.read.parquet(paths[name])
        metrics.values[f"rows{{table=\"{name}\"}}"] = models[name].count()
    failed = failed_tests(run, silver, models)

    def compared(entity: str) -> DataFrame:
        return models[f"validation_{entity}"].where(f"batch_id <= {run.batch_id}")

    keys = {r.entity: r.key for r in RETAIL}
    report = validate(run, lambda e: history_state(history(e), keys[e], run.batch_id), compared, lambda e: history_deleted(history(e), keys[e], run.batch_id), RETAIL, checksums)
    registry.record_validation(report, str(report.save(Path(registry.folder, "reports"))), failed)
    metrics.values |= {"checks_passed": len(report.checks) - len(report.failures), "checks_failed": len(report.failures), "tests_failed": len(failed), "seconds": time.time() - began}
    for c in report.checks:
        if c.name == "row_count":
            metrics.values[f"row_delta{{entity=\"{c.entity}\"}}"] = int(c.expected) - int(c.actual)
    done = None
    if report.passed and not failed:
        done = publish.promote(spark, registry, run, report, paths)
    for c in report.failures:
        LOG.error("check failed: %s %s", c.entity, c.name, extra={"fields": {"expected": c.expected, "actual": c.actual}})
    metrics.save(Path(registry.folder, "metrics.prom"))
    return Outcome(run, report, failed, done, metrics)


def main(arguments: list[str] | None = None) -> int:
    """weirgate run|backfill: a run over stored topic logs, or over archived events."""
    from .session import build as build_session

    p = argparse.ArgumentParser(prog="weirgate")
    p.add_argument("command", choices=("run", "backfill"))
    p.add_argument("--root", required=True, help="folder of tables")
    p.add_argument("--control", required=True, help="folder of control files")
    p.add_argument("--history", required=True, help="folder of source history tables, one Parquet table for each entity")
    p.add_argument("--log", help="folder of topic records as Parquet")
    p.add_argument("--servers", help="brokers instead of a log")
    p.add_argument("--archive", help="root of archived events, for a backfill")
    p.add_argument("--partition-end", type=date.fromisoformat, help="last event day of a backfill")
    p.add_argument("--batches", help="Parquet table of closed batches; its cutoff is taken where no batch is given")
    p.add_argument("--batch-id", type=int)
    p.add_argument("--checksums", choices=("sums", "exact"), default="sums")
    p.add_argument("--interval-start", type=datetime.fromisoformat, required=True)
    p.add_argument("--interval-end", type=datetime.fromisoformat, required=True)
    a = p.parse_args(arguments)
    if a.command == "backfill" and not a.archive:
        p.error("a backfill needs --archive")
    if a.batch_id is None and not a.batches:
        p.error("give --batch-id or --batches")
    handler = logging.StreamHandler()
    handler.setFormatter(JsonLines())
    LOG.addHandler(handler)
    spark = build_session()
    batch = a.batch_id or tables.cutoff(spark.read.parquet(a.batches), a.interval_end)
    run = Run.named(a.interval_start, a.interval_end, batch)
    out = run_pipeline(spark, Layout(a.root), run, publish.Registry(a.control), lambda e: spark.read.parquet(f"{a.history}/{e}"), a.log, a.servers, archive=a.archive if a.command == "backfill" else None, through=a.partition_end, checksums=a.checksums)
    print(json.dumps({"run_id": run.run_id, "batch_id": batch, "passed": out.report.passed, "failed_tests": out.failed_tests, "published": out.published}))
    return 0 if out.published else 1


if __name__ == "__main__":
    sys.exit(main())
