"""Counts taken while rows are written, instead of by reading them again.

``Observation`` rides along with the write: the totals are partial aggregates of the very
tasks that write, merged when the job ends, so the input is scanned once. They
are a fixed set of aggregates; counts per key need the keys to be known (families, the
days of a window), and one more total tells whether any row had another key.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlake.operators.validate import REASON


def write_observed(df: DataFrame, write: Callable[[DataFrame], object], totals: dict[str, Column]) -> dict:
    """Run ``write`` on ``df`` and return the totals of the rows that it wrote. ``write`` must run
    one job over the whole of ``df``."""
    seen = Observation()
    write(df.observe(seen, *[c.alias(n) for n, c in totals.items()]))
    return seen.get


def _of_known_keys(df: DataFrame, write, keys: Sequence, key: Column, counts: dict[str, Column]) -> list[tuple]:
    """(key, counts ...) of every known key that has rows, counted while writing."""
    totals = {f"{n}_{i}": F.count_if(key.eqNullSafe(F.lit(k)) & c) for i, k in enumerate(keys) for n, c in counts.items()}
    total = write_observed(df, write, {**totals, "all_rows": F.count(F.lit(1))})
    rows = [(k, *(total[f"{n}_{i}"] for n in counts)) for i, k in enumerate(keys)]
    known = sum(r[1] for r in rows)
    if known != total["all_rows"]:
        raise ValueError(f"{total['all_rows'] - known} rows have a key that was not expected")
    return [r for r in rows if r[1]]


def ingest_observed(validated: DataFrame, write: Callable[[DataFrame], object], families: Sequence[str | None],
                    by: str = "data_type") -> DataFrame:
    """``ingest_summary`` of the rows that ``write`` writes: per family total, processed and failed."""
    passed = F.col(REASON).isNull()
    rows = _of_known_keys(validated, write, families, F.col(by), {"total": F.lit(True), "ok": passed, "bad": ~passed})
    return validated.sparkSession.createDataFrame(
        rows, f"{by} string, total_records long, processed_records long, failed_records long")


def landing_observed(landed: DataFrame, write: Callable[[DataFrame], object], window: tuple[_dt.date, _dt.date],
                     date_col: str = "cost_date") -> DataFrame:
    """``landed_file_stats`` of the rows that ``write`` writes, for the days [start, end) of a window."""
    start, end = window
    days = [(start + _dt.timedelta(days=n)).isoformat() for n in range((end - start).days)]
    rows = _of_known_keys(landed, write, days, F.col(date_col).cast("string"), {"record_count": F.lit(True)})
    return landed.sparkSession.createDataFrame(rows, "cost_date string, record_count long")
