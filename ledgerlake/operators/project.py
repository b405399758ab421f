"""Projections: raw source rows -> typed record families."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import col_or_lit, paired_float
from ledgerlake.params import DEFAULT_CONTEXT, RunContext
from ledgerlake.schemas import (ARR, BILLING, OPPORTUNITY, SOURCE_BILLING, SOURCE_CRM,
                                STAMPED_VERSION, registered_fields)

PARSE_FAILED = "_amount_parse_failed"


def project_accounts(accounts: DataFrame, ctx: RunContext = DEFAULT_CONTEXT) -> DataFrame:
    """CRM Account rows -> ``salesforce_arr`` records.

    ``arr`` is 0 unless the landed extract carries an ``Arr`` column.
    """
    arr = F.col("Arr").cast("double") if "Arr" in accounts.columns else F.lit(0.0)
    return accounts.select(
        F.col("Id").alias("account_id"),
        F.col("Name").alias("account_name"),
        col_or_lit(accounts, "Industry").alias("industry"),
        col_or_lit(accounts, "Type").alias("customer_type"),
        arr.alias("arr"),
        F.lit(ctx.ingest_iso).alias("timestamp"),
        F.lit(ARR).alias("data_type"),
        F.lit(SOURCE_CRM).alias("source"),
    )


def project_opportunities(opps: DataFrame, ctx: RunContext = DEFAULT_CONTEXT) -> DataFrame:
    """CRM Opportunity rows -> ``salesforce_opportunity`` records.

    ``Amount`` defaults to 0 only when the column is absent; a NULL stays NULL
    here (validation turns it into 0.0 later).
    """
    close = col_or_lit(opps, "CloseDate")
    return opps.select(
        F.col("Id").alias("opportunity_id"),
        F.col("Name").alias("opportunity_name"),
        F.col("AccountId").alias("account_id"),
        col_or_lit(opps, "Amount", 0.0, "double").cast("double").alias("amount"),
        col_or_lit(opps, "StageName").alias("stage"),
        F.date_format(close, "yyyy-MM-dd").alias("close_date"),
        col_or_lit(opps, "Type").alias("type"),
        col_or_lit(opps, "Probability", None, "double").cast("double").alias("probability"),
        col_or_lit(opps, "IsClosed", None, "boolean").alias("is_closed"),
        col_or_lit(opps, "IsWon", None, "boolean").alias("is_won"),
        F.lit(ctx.ingest_iso).alias("timestamp"),
        F.lit(OPPORTUNITY).alias("data_type"),
        F.lit(SOURCE_CRM).alias("source"),
    )


def billing_stamps(ctx: RunContext = DEFAULT_CONTEXT) -> dict[str, Column]:
    """The constants of every billing record. A job that sorts or shuffles many records leaves them out
    until the rows are in place."""
    return {"timestamp": F.lit(ctx.ingest_iso), "data_type": F.lit(BILLING), "source": F.lit(SOURCE_BILLING),
            "schema_version": F.lit(STAMPED_VERSION)}


def project_billing(raw: DataFrame, ctx: RunContext = DEFAULT_CONTEXT,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Raw slash-named billing rows -> ``aws_cur`` records (before the category lookup).

    Blank defaults apply only to absent columns; cost and usage are parsed as
    a pair (either failing zeroes both, flagged in ``_amount_parse_failed``).
    ``keep`` carries extra raw columns through under their own names.
    """
    cost, usage, failed = paired_float(raw, "lineItem/UnblendedCost", "lineItem/UsageAmount")
    return raw.select(
        col_or_lit(raw, "lineItem/UsageAccountId").alias("account_id"),
        col_or_lit(raw, "lineItem/ProductCode").alias("service"),
        col_or_lit(raw, "lineItem/ResourceId", "").alias("resource_id"),
        cost.alias("cost"),
        usage.alias("usage_amount"),
        col_or_lit(raw, "lineItem/UsageType", "").alias("usage_type"),
        col_or_lit(raw, "bill/BillingPeriod", "").alias("billing_period"),
        *[c.alias(k) for k, c in billing_stamps(ctx).items()],
        failed.alias(PARSE_FAILED),
        *[F.col(f"`{k}`").alias(k) for k in keep],
    )


def flatten_daily_costs(responses: DataFrame) -> DataFrame:
    """Nested cost responses -> one row per (day, service, account) with the amount text."""
    days = responses.select(F.inline("ResultsByTime"))
    groups = days.select(F.col("TimePeriod.Start").alias("cost_date"), F.inline("Groups"))
    return groups.select(
        "cost_date",
        F.get("Keys", 0).alias("service"),
        F.get("Keys", 1).alias("account_id"),
        F.col("Metrics.UnblendedCost.Amount").alias("cost"),
    )


def derive_cost_keys(costs: DataFrame, ctx: RunContext = DEFAULT_CONTEXT,
                     billing_period_from_row: bool = False) -> DataFrame:
    """Landed daily layout: line item id, time interval, billing period, usage "1".

    The reference takes the billing period from *yesterday* (the run day), not
    from the row's date; ``billing_period_from_row`` switches to the row date
    for backfills covering many days.
    """
    yesterday = F.date_sub(F.lit(ctx.as_of), 1)
    period_src = F.to_date("cost_date") if billing_period_from_row else yesterday
    return costs.select(
        F.format_string("ce-%s-%s-%s", "cost_date", "service", "account_id").alias("identity/LineItemId"),
        F.format_string("%sT00:00:00Z/%sT23:59:59Z", "cost_date", "cost_date").alias("identity/TimeInterval"),
        F.col("account_id").alias("lineItem/UsageAccountId"),
        F.col("service").alias("lineItem/ProductCode"),
        F.col("cost").alias("lineItem/UnblendedCost"),
        F.date_format(period_src, "yyyy-MM").alias("bill/BillingPeriod"),
        F.lit("1").alias("lineItem/UsageAmount"),
        F.col("cost_date"),
    )


def select_registered_fields(df: DataFrame, data_type: str, version: str) -> DataFrame:
    """Order / restrict columns to the registry's required + optional fields that exist."""
    return df.select([F.col(c) for c in registered_fields(data_type, version) if c in df.columns])
