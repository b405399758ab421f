"""Run parameters.

The reference stamps ``datetime.now()`` on every record, which makes outputs
unrepeatable. Here the wall clock is a job argument: one ``RunContext`` per run
fixes the ingestion timestamp, the ``as_of`` day for relative date windows and
the lineage values, so a rerun (or a task retry) produces identical rows.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


def iso_text(ts: _dt.datetime) -> str:
    """Python ``isoformat`` of a naive datetime: fraction only when micros != 0."""
    return ts.replace(tzinfo=None).isoformat()


@dataclass(frozen=True)
class RunContext:
    # Instant of the run (naive, UTC); rendered as ISO text on every record.
    ingest_ts: _dt.datetime = field(
        default_factory=lambda: _dt.datetime(2001, 8, 1, 6, 0, 0))
    # Day the relative windows are anchored on ("yesterday", "last 180 days").
    as_of: _dt.date = _dt.date(2001, 8, 1)
    environment: str = "dev"
    pipeline_version: str = "1.2.0"
    data_owner: str = "cloud-ops"
    customer_id: str = "collector-customer"

    @property
    def ingest_iso(self) -> str:
        return iso_text(self.ingest_ts)

    @property
    def as_of_iso(self) -> str:
        return self.as_of.isoformat()


DEFAULT_CONTEXT = RunContext()
