"""Aggregations. All are partial + final hash aggregates: a hot key collapses to one
row per map task before the shuffle, so skew does not concentrate raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import money
from ledgerlake.operators.validate import REASON, WARNING_KINDS, WARNINGS


def daily_cost_by_service_account(usage: DataFrame, *, date_col: str = "usage_date",
                                  service_col: str = "service", account_col: str = "account_id",
                                  cost_col: str = "cost") -> DataFrame:
    """SUM of unblended cost per DAILY bucket x SERVICE x LINKED_ACCOUNT.

    The sum is exact (decimal with 12 places, never rounded to cents) so the
    result does not depend on the order rows arrive in; ``cost`` is returned as the
    decimal's double value and ``amount`` as its text (the response field is text).
    Rows without a usable cost (unparsable, NaN, out of range) stay out of the sum
    and are counted in ``unsummed_rows``; a sum beyond 38 digits is NULL. Neither ends the job.
    """
    agg = usage.groupBy(
        F.date_format(F.col(date_col), "yyyy-MM-dd").alias("cost_date"),
        F.col(service_col).alias("service"), F.col(account_col).alias("account_id"),
    ).agg(F.try_sum(money(F.col(cost_col))).alias("_sum"), F.count(F.lit(1)).alias("usage_rows"),
          F.count_if(money(F.col(cost_col)).isNull()).alias("unsummed_rows"))
    return agg.select("cost_date", "service", "account_id",
                      F.col("_sum").cast("double").alias("cost"),
                      F.col("_sum").cast("string").alias("amount"), "usage_rows", "unsummed_rows")


def ingest_summary(validated: DataFrame, by: str = "data_type") -> DataFrame:
    """Per run / family: total, processed (valid) and failed (quarantined) records."""
    return validated.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(REASON).isNull()).alias("processed_records"),
        F.count_if(F.col(REASON).isNotNull()).alias("failed_records"),
    )


def warning_summary(validated: DataFrame, by: str = "data_type",
                    kinds: tuple[str, ...] | None = WARNING_KINDS) -> DataFrame:
    """Records per (group, warning kind); warnings are per-row log lines in the reference.

    With the known kinds (each appears at most once per record) this is one
    partial + final aggregate of ``count_if(array_contains(...))`` columns,
    unpivoted; ``kinds=None`` explodes the arrays instead (any kind).
    """
    if kinds is None:
        return (validated.select(by, F.explode(WARNINGS).alias("warning"))
                .groupBy(by, "warning").agg(F.count(F.lit(1)).alias("records")))
    wide = validated.groupBy(by).agg(
        *[F.count_if(F.array_contains(WARNINGS, k)).alias(k) for k in kinds])
    return (wide.unpivot(by, list(kinds), "warning", "records")
            .filter(F.col("records") > 0))


def landed_file_stats(landed: DataFrame, date_col: str = "cost_date") -> DataFrame:
    """``record-count`` and ``cost-date`` metadata per landed day file."""
    return landed.groupBy(F.col(date_col).alias("cost_date")).agg(
        F.count(F.lit(1)).alias("record_count"))


def extract_checkpoint(paged: DataFrame, key: str = "Id", page_size: int = 2000) -> DataFrame:
    """Per full page of a keyset extract: ``last_id`` and cumulative ``processed_count``.

    ``paged`` carries ``batch_number`` (from ``assign_batches``) in key order; as
    every page but the last is full, the running count is ``min(page * size, total)``
    and needs no window.
    """
    pages = paged.groupBy("batch_number").agg(
        F.max(key).alias("last_id"), F.first("total_batches").alias("total_batches"),
        F.count(F.lit(1)).alias("page_rows"))
    return pages.select(
        F.col("batch_number").alias("page_number"), "last_id", "page_rows",
        (F.col("batch_number") * page_size - F.lit(page_size) + F.col("page_rows")).alias("processed_count"))


def latest_schema_version(registry: DataFrame) -> DataFrame:
    """Lexicographic max version per data type (so "v10" sorts before "v2")."""
    return registry.groupBy("data_type").agg(F.max("version").alias("latest_version"))
