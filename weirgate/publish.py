"""Publication behind gates: all marts of a run become visible at once, by one rename, or not at all."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .context import Run
from .functions.expressions import quoted
from .plans.serving import published
from .reconcile.service import Report


class Refused(Exception):
    """A gate is shut."""


@dataclass(frozen=True)
class Registry:
    """Control tables in a folder: validations by run, publications by run, and the manifest that readers follow.

    A file is replaced by renaming a finished draft over it. One publisher works at a time.
    """

    folder: str

    def _read(self, name: str) -> dict:
        path = Path(self.folder, f"{name}.json")
        return json.loads(path.read_text()) if path.exists() else {}

    def _write(self, name: str, content: dict) -> None:
        path = Path(self.folder, f"{name}.json")
        path.parent.mkdir(parents=True, exist_ok=True)
        draft = path.with_suffix(f".{os.getpid()}.tmp")
        draft.write_text(json.dumps(content, indent=1, sort_keys=True))
        os.replace(draft, path)

    def record_validation(self, report: Report, path: str = "", failed_tests: Sequence[str] | None = None) -> None:
        """Put the run's verdict in, in place of an earlier one of the same run.

        It is passed only where the report is and data tests ran without a failure; None says that they did not run.
        """
        rows = self._read("validations")
        failed = len(report.failures)
        rows[report.run_id] = {"batch_id": report.batch_id, "status": "passed" if report.passed and failed_tests is not None and not failed_tests else "failed", "failed_tests": None if failed_tests is None else list(failed_tests), "validated_at": report.made_at, "checks_passed": len(report.checks) - failed, "checks_failed": failed, "report": str(path)}
        self._write("validations", rows)

    def validations(self) -> dict:
        return self._read("validations")

    def publications(self) -> dict:
        return self._read("publications")

    def manifest(self) -> dict:
        return self._read("manifest")

    def status(self, spark: SparkSession) -> DataFrame:
        """Published runs with their validation, newest first."""
        checks = self.validations()
        rows = [(run, checks[run]["status"], checks[run]["validated_at"], p["published_at"], checks[run]["checks_passed"], checks[run]["checks_failed"]) for run, p in self.publications().items() if p["state"] == "published" and run in checks]
        rows.sort(key=lambda r: r[3], reverse=True)
        return spark.createDataFrame(rows, "run_id string, status string, validated_at string, published_at string, checks_passed int, checks_failed int")


class Discarded(Registry):
    """A registry for diagnostic comparisons: it records nothing, so nothing can be published on its word."""

    def _write(self, name: str, content: dict) -> None:
        return None


def promote(spark: SparkSession, registry: Registry, run: Run, report: Report, tables: Mapping[str, str], batch_column: str = "pipeline_batch_id") -> str:
    """Publish a run's tables (view name to path); gives published, or unchanged if this run already is.

    Gates, in order: the report is this run's and passed; the audit says so too, and that data tests passed; no newer batch
    is published; the run was not published as another batch. Then every table must resolve. The run is pending until the
    manifest is replaced, so a crash leaves readers with the last publication, and a retry goes on.
    """
    if not report.passed or (report.run_id, report.batch_id) != (run.run_id, run.batch_id):
        raise Refused("the report is not a passed one of this run")
    audit = registry.validations().get(run.run_id)
    if not audit or audit["status"] != "passed" or audit["batch_id"] != run.batch_id:
        raise Refused("no passed validation of this run on record")
    if audit.get("failed_tests") != []:
        raise Refused("no passed data tests of this run on record")
    done = registry.publications()
    newest = max((p["batch_id"] for p in done.values() if p["state"] == "published"), default=0)
    if newest > run.batch_id:
        raise Refused(f"batch {newest} is published already")
    own = done.get(run.run_id)
    if own and own["batch_id"] != run.batch_id:
        raise Refused("the run was published as another batch")
    if own and own["state"] == "published":
        return "unchanged"
    if not tables:
        raise Refused("nothing to publish")
    for view, path in tables.items():
        quoted(view)
        spark.read.parquet(path).select(batch_column).limit(1).collect()  # a missing table ends it here
    entry = {"batch_id": run.batch_id, "state": "pending", "published_at": None}
    registry._write("publications", {**done, run.run_id: entry})
    registry._write("manifest", {"run_id": run.run_id, "batch_id": run.batch_id, "batch_column": batch_column, "tables": dict(tables)})
    entry = {**entry, "state": "published", "published_at": datetime.now(UTC).isoformat()}
    registry._write("publications", {**done, run.run_id: entry})
    return "published"


def views(spark: SparkSession, registry: Registry) -> dict[str, DataFrame]:
    """The published tables as temporary views, all of one manifest."""
    manifest = registry.manifest()
    out = {}
    for view, path in manifest.get("tables", {}).items():
        out[view] = published(spark.read.parquet(path), manifest["batch_id"], manifest["batch_column"])
        out[view].createOrReplaceTempView(view)
    return out
