"""Landed cost responses (nested JSON documents)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import COST_RESPONSE


def read_cost_responses(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed response document (JSON lines), explicit schema. Responses
    landed under ``cost_month=<yyyy-MM>/`` carry that month as a partition column."""
    return spark.read.schema(T.StructType([*COST_RESPONSE.fields, T.StructField("cost_month", T.StringType())])).json(path)


def scan_daily_costs(responses: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """Keep the DAILY periods with ``start <= Start < end`` (the default window is
    one day: [as_of - 1, as_of)). Folders outside the window are never read."""
    s, e = F.lit(start.isoformat()), F.lit(end.isoformat())
    if "cost_month" in responses.columns:  # prunes the scan to the window's folders
        month = F.col("cost_month")
        responses = responses.filter(month.isNull() | month.between(start.isoformat()[:7], end.isoformat()[:7]))
    kept = F.filter("ResultsByTime", lambda r: (r["TimePeriod"]["Start"] >= s) & (r["TimePeriod"]["Start"] < e))
    return responses.select(kept.alias("ResultsByTime")).filter(F.size("ResultsByTime") > 0)


def yesterday_window(as_of: _dt.date) -> tuple[_dt.date, _dt.date]:
    return as_of - _dt.timedelta(days=1), as_of
