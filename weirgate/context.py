"""What identifies a run, and where it keeps its tables."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from datetime import UTC, date, datetime
from urllib.parse import quote

_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.:+-]{0,199}")


def digest(*parts: object) -> str:
    """A stable hexadecimal name for some values."""
    return hashlib.sha256(json.dumps([str(p) for p in parts]).encode()).hexdigest()


@dataclass(frozen=True)
class Run:
    """One pipeline run: everything is as of batch_id, over [start, end)."""

    run_id: str
    batch_id: int
    start: datetime
    end: datetime

    def __post_init__(self) -> None:
        if not _RUN_ID.fullmatch(self.run_id or ""):
            raise ValueError("run_id must be 1 to 200 letters, digits or _.:+- and begin with a letter or digit")
        if isinstance(self.batch_id, bool) or not isinstance(self.batch_id, int) or self.batch_id < 1:
            raise ValueError("batch_id must be a positive integer")
        if self.start.tzinfo is None or self.end.tzinfo is None:
            raise ValueError("interval bounds need a time zone")
        if self.start >= self.end:
            raise ValueError("the interval must not be empty")

    @property
    def namespace(self) -> str:
        """The candidate namespace of the run."""
        return f"candidate_{self.batch_id}_{digest(self.run_id)[:12]}"

    @staticmethod
    def named(start: datetime, end: datetime, batch_id: int) -> Run:
        """A run whose id follows from its interval and batch, so that a retry is the same run."""
        key = digest(start.astimezone(UTC).isoformat(), end.astimezone(UTC).isoformat(), batch_id)
        return Run(f"run-{batch_id}-{key[:16]}", batch_id, start, end)


def component(value: object) -> str:
    """A path component; everything but letters, digits, _ . - ~ is percent-encoded."""
    text = quote(str(value), safe="")
    if text in ("", ".", ".."):
        raise ValueError(f"no path component: {value!r}")
    return text


@dataclass(frozen=True)
class Layout:
    """Paths under one root, local or in an object store."""

    root: str

    def _join(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    def bronze(self, entity: str) -> str:
        return self._join("bronze", f"entity={component(entity)}")

    def bronze_part(self, entity: str, run_id: str, stream_batch: int) -> str:
        """Where a micro-batch writes; a replay of it writes to the same place."""
        return f"{self.bronze(entity)}/run_id={component(run_id)}/stream_batch={stream_batch:020d}"

    def bronze_day(self, entity: str, run_id: str, stream_batch: int, day: date) -> str:
        return f"{self.bronze_part(entity, run_id, stream_batch)}/event_date={day.isoformat()}"

    def dead_letters(self, entity: str) -> str:
        return self._join("dead_letters", f"entity={component(entity)}")

    def dead_letter_part(self, entity: str, run_id: str, stream_batch: int) -> str:
        return f"{self.dead_letters(entity)}/run_id={component(run_id)}/stream_batch={stream_batch:020d}"

    def silver(self, entity: str, run_id: str) -> str:
        return self._join("silver", f"run_id={component(run_id)}", f"table={component(entity)}")

    def checkpoint(self, pipeline: str, topic: str) -> str:
        return self._join("checkpoints", component(pipeline), component(topic))

    def candidate(self, namespace: str, table: str) -> str:
        return self._join("candidates", component(namespace), component(table))

    def control(self, name: str) -> str:
        return self._join("control", component(name))
