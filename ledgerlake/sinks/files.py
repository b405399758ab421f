"""File sinks: date-partitioned CSV landing, failed records, checkpoints."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.scalars import date_parts
from ledgerlake.params import RunContext
from ledgerlake.schemas import CHECKPOINT, string_schema


ROWS_PER_FILE = 1_000_000


def write_partitioned_csv(df: DataFrame, path: str, date_col: str = "cost_date",
                          columns: list[str] | None = None) -> str:
    """Land rows under ``year=YYYY/month=MM/day=DD/`` as header CSV.

    Only the days present in ``df`` are replaced (dynamic partition overwrite).
    Rows are rebalanced by day: Spark splits a large day over tasks and files and
    joins small ones, and a file holds at most ``ROWS_PER_FILE`` rows. Cells are quoted
    when they need it, so a comma inside a service name cannot shift columns.
    """
    parts = date_parts(F.to_date(F.col(date_col)))
    cols = columns or [c for c in df.columns if c != date_col]
    out = df.select(*[F.col(f"`{c}`") for c in cols],
                    parts["year"].alias("year"), parts["month"].alias("month"), parts["day"].alias("day"))
    (out.hint("rebalance", "year", "month", "day")
        .write.option("maxRecordsPerFile", ROWS_PER_FILE).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("header", "true").option("escape", '"')
        .partitionBy("year", "month", "day").csv(path))
    return path


def read_partitioned_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read a landed tree back; partition values stay text (``04`` is not 4)."""
    schema = string_schema(columns)
    for p in ("year", "month", "day"):
        schema = schema.add(p, T.StringType())
    return (spark.read.schema(schema).option("header", "true").option("multiLine", "true")
            .option("escape", '"').csv(path))


def write_failed_records(quarantine: DataFrame, path: str, ctx: RunContext) -> str:
    """Quarantined rows, whole, as JSON under ``failed_date=YYYY-MM-DD/run=<stamp>/``.
    A run owns its folder: writing it again replaces it, so nothing doubles."""
    run = ctx.ingest_ts.strftime("%Y%m%d%H%M%S%f")
    (quarantine.write.mode("overwrite").option("ignoreNullFields", "false")
        .json(f"{path}/failed_date={ctx.as_of_iso}/run={run}"))
    return path


def write_checkpoint(spark: SparkSession, prefix: str, query: str, last_id: str | None,
                     processed_count: int, at: _dt.datetime) -> str:
    """``{prefix}/checkpoint-YYYYmmddHHMMSS.json`` holding one small JSON document."""
    target = f"{prefix}/checkpoint-{at.strftime('%Y%m%d%H%M%S')}.json"
    doc = spark.createDataFrame([(query, last_id, processed_count)], CHECKPOINT)
    doc.coalesce(1).write.mode("append").json(target)
    return target
