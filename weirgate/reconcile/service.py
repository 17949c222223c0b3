"""The comparison of source truth with a candidate: named checks, a verdict, a report. Nothing passes by default."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import Run
from ..operators.snapshot import unique
from .measures import CHECKSUMS, EXACT_ROWS, aggregate, differences, grouped_counts, row_counts, still_present
from .rules import RETAIL, Rule

#: Groups that a check's texts show.
SHOWN = 100


@dataclass(frozen=True)
class Check:
    entity: str
    name: str
    passed: bool
    expected: str = ""
    actual: str = ""


@dataclass(frozen=True)
class Report:
    run_id: str
    batch_id: int
    checks: tuple[Check, ...]
    made_at: str = field(default_factory=lambda: datetime.now(UTC).isoformat())

    @property
    def passed(self) -> bool:
        """At least one check, and none that failed."""
        return bool(self.checks) and all(c.passed for c in self.checks)

    @property
    def failures(self) -> tuple[Check, ...]:
        return tuple(c for c in self.checks if not c.passed)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.run_id, self.batch_id, *asdict(c).values()) for c in self.checks]
        return spark.createDataFrame(rows, "run_id string, batch_id long, entity string, name string, passed boolean, expected string, actual string")

    def save(self, folder: str | os.PathLike) -> Path:
        """Write the report beside its name and move it there, so that readers never see half of it."""
        folder = Path(folder)
        folder.mkdir(parents=True, exist_ok=True)
        path = folder / f"{re.sub(r'[^A-Za-z0-9_.-]', '_', self.run_id)}.json"
        body = {"run_id": self.run_id, "batch_id": self.batch_id, "made_at": self.made_at, "passed": self.passed, "checks": [asdict(c) for c in self.checks]}
        draft = path.with_suffix(f".{os.getpid()}.tmp")
        draft.write_text(json.dumps(body, indent=1, sort_keys=True))
        draft.replace(path)
        return path


def _whole(groups: DataFrame) -> str:
    """How many (group, value) rows there are, and a hash over all of them, in any order."""
    h = [F.xxhash64(F.lit(k), F.col("group"), F.col("value").isNull(), F.col("value")).cast("decimal(38,0)") for k in (1, 2)]
    r = groups.agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(x), F.lit(0)).alias(f"h{k}") for k, x in enumerate(h))).first()
    return f" ... {r.n} groups in all, hash {r.h0}:{r.h1}"


def _shown(groups: DataFrame, first: list[str]) -> str:
    """The groups named by first, then others by name, up to SHOWN; what is left out is in the count and the hash."""
    rank = F.when(F.col("group").isin(first), 0).otherwise(1) if first else F.lit(1)
    rows = groups.orderBy(rank, "group").limit(SHOWN + 1).collect()
    text = json.dumps({r["group"]: r["value"] for r in rows[:SHOWN]}, ensure_ascii=False)
    return text + (_whole(groups) if len(rows) > SHOWN else "")


def _groups(entity: str, name: str, expected: DataFrame, actual: DataFrame) -> Check:
    """Groups that differ are shown first."""
    differ = [r["group"] for r in differences(expected, actual).orderBy("group").limit(SHOWN).collect()]
    return Check(entity, name, not differ, _shown(expected, differ), _shown(actual, differ))


def compare(rule: Rule, source: DataFrame, target: DataFrame, deleted: DataFrame | None, checksums: str = "sums") -> list[Check]:
    """All checks of an entity, in order."""
    source, target = source.persist(), target.persist()  # read by every check
    try:
        unique(source, rule.key)
        unique(target, rule.key)
        counts = row_counts(source, target, rule).first()
        n, m = counts.expected, counts.actual
        if checksums == "exact" and max(n, m) > EXACT_ROWS:
            raise ValueError(f"{rule.entity}: exact checksums are for tables of at most {EXACT_ROWS} rows, take sums")
        out = [
            Check(rule.entity, "non_empty", rule.allow_empty or bool(n and m), "empty allowed" if rule.allow_empty else "rows present", f"source {n}, candidate {m}"),
            Check(rule.entity, "row_count", counts.passed, str(n), str(m)),
        ]
        for name, columns in rule.partitions.items():
            out.append(_groups(rule.entity, f"partition_count:{name}", grouped_counts(source, rule, columns), grouped_counts(target, rule, columns)))
        if rule.deletes:
            if deleted is None:
                raise LookupError("deletes are declared but the source can't name them")
            present = still_present(target, deleted, rule)
            left = [r["group"] for r in present.orderBy("group").limit(SHOWN + 1).collect()]
            more = _whole(present.withColumn("value", F.lit(""))) if len(left) > SHOWN else ""
            out.append(Check(rule.entity, "deleted_absent", not left, "[]", json.dumps(left[:SHOWN]) + more))
        a, b = (CHECKSUMS[checksums](df, rule).first().asDict() for df in (source, target))
        out += [Check(rule.entity, f"checksum:{c}", a[c] == b[c], a[c], b[c]) for c in rule.columns]
        for spec in rule.aggregates:
            out.append(_groups(rule.entity, f"aggregate:{spec.name}", aggregate(source, rule, spec), aggregate(target, rule, spec)))
        return out
    finally:
        source.unpersist()
        target.unpersist()


Reader = Callable[[str], DataFrame]


def validate(run: Run, source: Reader, target: Reader, deleted: Reader | None, rules: Iterable[Rule] = RETAIL, checksums: str = "sums") -> Report:
    """The report of a run. An error fails its entity (evaluation happens inside the guard) and the others go on."""
    checks: list[Check] = []
    for rule in rules:
        try:
            checks += compare(rule, source(rule.entity), target(rule.entity), deleted(rule.entity) if deleted and rule.deletes else None, checksums)
        except Exception as error:  # noqa: BLE001  fail closed, whatever it was
            checks.append(Check(rule.entity, "query_error", False, "all checks evaluated", f"{type(error).__name__}: {str(error)[:500]}"))
    return Report(run.run_id, run.batch_id, tuple(checks))


def compare_reports(reports: Mapping[str, Report]) -> dict:
    """Whether reports of several targets agree: every check on every target, with one verdict and value, all passed."""
    names = list(dict.fromkeys((c.entity, c.name) for r in reports.values() for c in r.checks))
    by_target = {t: {(c.entity, c.name): c for c in r.checks} for t, r in reports.items()}
    missing, disagreements = [], []
    for entity, name in names:
        found = {t: own.get((entity, name)) for t, own in by_target.items()}
        absent = sorted(t for t, c in found.items() if c is None)
        if absent:
            missing.append({"entity": entity, "name": name, "missing_on": absent})
        elif len({(c.passed, c.expected, c.actual) for c in found.values()}) > 1:
            disagreements.append({"entity": entity, "name": name, "expected": {t: c.expected for t, c in found.items()}, "actual": {t: c.actual for t, c in found.items()}})
    failed = sorted(t for t, r in reports.items() if not r.passed)
    return {"agreed": len(reports) > 1 and not (missing or disagreements or failed), "checks": len(names), "missing": missing, "disagreements": disagreements, "failed_targets": failed}


def summary(checks: DataFrame) -> DataFrame:
    """How many checks passed and failed, by entity."""
    return checks.groupBy("entity").agg(F.count_if("passed").alias("checks_passed"), F.count_if(~F.col("passed")).alias("checks_failed"))
