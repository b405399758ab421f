"""End-to-end jobs composed from the operators (batch form).

Each job is a chain of DataFrame -> DataFrame steps; nothing is collected.
The validated frame keeps every input row (``reject_reason`` NULL = valid);
sinks split it into the delivered table and the quarantine table.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.aggregate import daily_cost_by_service_account
from ledgerlake.operators.enrich import map_cost_category, tag_records
from ledgerlake.operators.ordering import union_families
from ledgerlake.operators.project import (derive_cost_keys, flatten_daily_costs, project_accounts,
                                          project_billing, project_opportunities)
from ledgerlake.operators.validate import REASON, WARNINGS, split_valid_quarantine, validate_records
from ledgerlake.params import DEFAULT_CONTEXT, RunContext
from ledgerlake.session import materialized
from ledgerlake.sinks.files import write_checkpoint, write_failed_records, write_partitioned_csv
from ledgerlake.sources.billing import MALFORMED, split_malformed
from ledgerlake.sources.checkpoint import scan_checkpoint
from ledgerlake.sources.costs import scan_daily_costs, yesterday_window
from ledgerlake.sources.crm import keyset_page, scan_accounts, scan_opportunities


def transform_billing(raw: DataFrame, account_map: DataFrame,
                      ctx: RunContext = DEFAULT_CONTEXT) -> DataFrame:
    """parse -> category lookup -> constants."""
    return project_billing(raw, ctx).transform(lambda d: map_cost_category(d, account_map))


def ingest_billing(raw: DataFrame, account_map: DataFrame, ctx: RunContext = DEFAULT_CONTEXT,
                   quarantine_path: str | None = None) -> DataFrame:
    """scan rows -> (malformed split) -> transform -> tag -> validate.

    Returns every row of ``raw`` with ``reject_reason``/``warnings``; a malformed one
    has no fields but its text (``raw_line``) and the reason ``malformed_row``. When a
    quarantine path is given, the rows are materialized once, the rejected and malformed ones
    are written there whole, and the result reads the same rows.
    """
    good, malformed = split_malformed(raw)
    validated = transform_billing(good, account_map, ctx).transform(lambda d: tag_records(d, ctx)).transform(
        validate_records)
    if MALFORMED in malformed.columns:
        lines = malformed.select(F.col(MALFORMED).alias("raw_line"), REASON,
                                 F.array().cast("array<string>").alias(WARNINGS))
        validated = validated.withColumn("raw_line", F.lit(None).cast("string")).unionByName(
            lines, allowMissingColumns=True)
    else:
        validated = validated.withColumn("raw_line", F.lit(None).cast("string"))
    if quarantine_path:
        validated = materialized(validated, "ingested")
        _, rejected = split_valid_quarantine(validated)
        write_failed_records(rejected, quarantine_path, ctx)
    return validated


def sync_crm(accounts: DataFrame, opportunities: DataFrame,
             ctx: RunContext = DEFAULT_CONTEXT) -> DataFrame:
    """Two extracts -> tag (with version) -> validate -> one frame of both families."""
    arr = project_accounts(scan_accounts(accounts), ctx).transform(
        lambda d: tag_records(d, ctx, stamp_version=True)).transform(validate_records)
    opp = project_opportunities(scan_opportunities(opportunities, ctx.as_of), ctx).transform(
        lambda d: tag_records(d, ctx, stamp_version=True)).transform(validate_records)
    return union_families(arr, opp)


def land_daily_costs(responses: DataFrame, path: str | None = None,
                     ctx: RunContext = DEFAULT_CONTEXT,
                     window: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
    """Cost responses for the window (default: yesterday) -> landed daily layout.

    Writes the date-partitioned CSV tree when ``path`` is given.
    """
    start, end = window or yesterday_window(ctx.as_of)
    rows = flatten_daily_costs(scan_daily_costs(responses, start, end))
    landed = derive_cost_keys(rows, ctx)
    if path:
        write_partitioned_csv(landed, path)
    return landed


def usage_costs(raw: DataFrame) -> DataFrame:
    """Billing usage rows -> (usage_date, service, account_id, cost) for the daily
    aggregate; an unparsable cost is left out of the sum."""
    from ledgerlake.functions.scalars import python_float
    return raw.select(
        F.to_date(F.col("`lineItem/UsageStartDate`")).alias("usage_date"),
        F.col("`lineItem/ProductCode`").alias("service"),
        F.col("`lineItem/UsageAccountId`").alias("account_id"),
        python_float(F.col("`lineItem/UnblendedCost`")).alias("cost"))


def daily_costs_from_usage(raw: DataFrame) -> DataFrame:
    return daily_cost_by_service_account(usage_costs(raw))


def resume_extract(src: DataFrame, prefix: str, page_size: int, ctx: RunContext = DEFAULT_CONTEXT,
                   key: str = "Id", query: str = "extract") -> DataFrame:
    """The next page of a keyset extract: newest checkpoint below ``prefix`` -> rows after
    its key -> page; the page's last key is saved as the next checkpoint. A page
    without rows saves nothing. Several pages of one run need distinct ``ctx.ingest_ts``."""
    spark = src.sparkSession
    saved = scan_checkpoint(spark, prefix)
    last, done = (None, 0) if saved is None else saved.select("last_id", "processed_count").first()
    page = keyset_page(src, page_size, last, key)
    found = page.agg(F.max(key).alias("last"), F.count(F.lit(1)).alias("n")).first()
    if found["n"]:
        write_checkpoint(spark, prefix, query, found["last"], done + found["n"], ctx.ingest_ts)
    return page


def resume_to_end(src: DataFrame, prefix: str, page_size: int, ctx: RunContext = DEFAULT_CONTEXT,
                  key: str = "Id") -> DataFrame:
    """All rows of a keyset extract with their ``page`` (from 1): ``resume_extract`` run after run, one
    minute apart, until a page comes back empty. Pages are written as they come and read back
    together. Rows without a key are no part of a keyset extract."""
    spark, folder = src.sparkSession, f"{prefix.rstrip('/')}-pages"
    page, found, src = 0, True, src.where(F.col(key).isNotNull())
    while found:
        page += 1
        run = dataclasses.replace(ctx, ingest_ts=ctx.ingest_ts + _dt.timedelta(minutes=page - 1))
        rows = resume_extract(src, prefix, page_size, run, key)
        rows.write.mode("overwrite").parquet(f"{folder}/page={page}")
        found = not spark.read.schema(rows.schema).parquet(f"{folder}/page={page}").isEmpty()
    return spark.read.schema(T.StructType([*src.schema.fields, T.StructField("page", T.IntegerType())])).parquet(folder)
