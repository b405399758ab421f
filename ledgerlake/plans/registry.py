"""Registered queries: one per operator of the inventory, with its oracle SQL.

Every query reads the driver tables (through the adapters) or files Spark
derives from them, over the whole tables. Struct and array outputs are
flattened to text so both engines render them the same way.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import correlation_id, date_parts, iso_timestamp, money
from ledgerlake.operators import aggregate as agg
from ledgerlake.operators import delivery as dl
from ledgerlake.operators import validate as val
from ledgerlake.operators.enrich import flatten_lineage, join_on_correlation, map_cost_category, tag_records
from ledgerlake.operators.ordering import assign_batches, route_by_volume, union_families
from ledgerlake.operators.project import (project_accounts, project_billing, project_opportunities,
                                          select_registered_fields)
from ledgerlake.params import DEFAULT_CONTEXT as CTX
from ledgerlake.plans import sql as Q
from ledgerlake.plans.pipelines import daily_costs_from_usage, transform_billing
from ledgerlake.session import scratch_path
from ledgerlake.sources import crm
from ledgerlake.sources.account_map import scan_account_map_items
from ledgerlake.sources.adapters import adapter, billing_raw

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- building blocks
def accounts_src(spark, sf):
    """The landed CRM Account extract (Parquet), so filters reach the scan."""
    from ledgerlake.sources.landing import land_extract
    return spark.read.parquet(land_extract(spark, sf, "v_accounts"))


def opportunities_src(spark, sf):
    """The landed CRM Opportunity extract (Parquet)."""
    from ledgerlake.sources.landing import land_extract
    return spark.read.parquet(land_extract(spark, sf, "v_opportunities"))


def account_map(spark, sf):
    return adapter(spark, sf, "v_account_map")


def delivery_log(spark, sf):
    return adapter(spark, sf, "v_delivery_log")


def billing_records(spark, sf) -> DataFrame:
    """Billing export -> transformed, tagged, validated records."""
    return (transform_billing(billing_raw(spark, sf), account_map(spark, sf), CTX)
            .transform(lambda d: tag_records(d, CTX)).transform(val.validate_records))


def arr_records(spark, sf) -> DataFrame:
    return (project_accounts(crm.scan_accounts(accounts_src(spark, sf)), CTX)
            .transform(lambda d: tag_records(d, CTX, stamp_version=True)).transform(val.validate_records))


def opportunity_records(spark, sf) -> DataFrame:
    return (project_opportunities(crm.scan_opportunities(opportunities_src(spark, sf), CTX.as_of), CTX)
            .transform(lambda d: tag_records(d, CTX, stamp_version=True)).transform(val.validate_records))


def all_records(spark, sf) -> DataFrame:
    return union_families(billing_records(spark, sf), arr_records(spark, sf), opportunity_records(spark, sf))


def flat(df: DataFrame) -> DataFrame:
    """Lineage struct -> columns; warnings array -> comma-joined text."""
    if "obs_lineage" in df.columns:
        df = flatten_lineage(df)
    if val.WARNINGS in df.columns:
        df = df.withColumn(val.WARNINGS, F.array_join(val.WARNINGS, ","))
    return df


BILLING_OUT = ["account_id", "service", "resource_id", "cost", "usage_amount", "usage_type", "billing_period",
               "timestamp", "data_type", "source", "schema_version"]
BILLING_OUT_SQL = ", ".join(BILLING_OUT)
TAG_OUT = ["obs_correlation_id", "obs_ingest_timestamp", "obs_data_version", "lineage_environment",
           "lineage_pipeline_version", "lineage_data_owner"]
TAG_OUT_SQL = ", ".join(TAG_OUT)


# ---------------------------------------------------------------- flagship
@register("billing_cost_by_category", Q.compose("""
SELECT cost_category, cast(cast(sum(try_cast(cast(cost AS varchar) AS decimal(28,12))) AS varchar) AS double) AS total_cost,
       count(*) AS records,
       count(*) FILTER (WHERE reject_reason IS NULL) AS valid_records,
       count(*) FILTER (WHERE try_cast(cast(cost AS varchar) AS decimal(28,12)) IS NULL) AS unsummed_rows
FROM billing_val GROUP BY cost_category""", "billing_val"))
def q_billing_cost_by_category(spark, sf):
    recs = billing_records(spark, sf)
    return recs.groupBy("cost_category").agg(
        F.try_sum(money(F.col("cost"))).cast("double").alias("total_cost"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col(val.REASON).isNull()).alias("valid_records"),
        F.count_if(money(F.col("cost")).isNull()).alias("unsummed_rows"))


# ---------------------------------------------------------------- projections
@register("project_billing", Q.compose(f"SELECT {BILLING_OUT_SQL} FROM billing", "billing"))
def q_project_billing(spark, sf):
    return project_billing(billing_raw(spark, sf), CTX).select(*BILLING_OUT)


@register("to_float_pair", Q.compose("""
SELECT line_item_id, cost, usage_amount, parse_failed FROM billing""", "billing"))
def q_to_float_pair(spark, sf):
    raw = billing_raw(spark, sf)
    return project_billing(raw, CTX, keep=["identity/LineItemId"]).select(
        F.col("`identity/LineItemId`").alias("line_item_id"), "cost", "usage_amount",
        F.col("_amount_parse_failed").alias("parse_failed"))


@register("default_if_absent", Q.compose("""
SELECT account_id, '' AS resource_id, '' AS usage_type, '' AS billing_period FROM v_billing_raw""",
                                         "v_billing_raw"))
def q_default_if_absent(spark, sf):
    """A layout without ResourceId / UsageType / BillingPeriod: absent columns default to ''."""
    raw = billing_raw(spark, sf).drop("lineItem/ResourceId", "lineItem/UsageType", "bill/BillingPeriod")
    return project_billing(raw, CTX).select("account_id", "resource_id", "usage_type", "billing_period")


@register("project_accounts", Q.compose("""
SELECT account_id, account_name, industry, customer_type, arr, timestamp, data_type, source FROM arr_all""", "arr_all"))
def q_project_accounts(spark, sf):
    return project_accounts(accounts_src(spark, sf), CTX)


@register("project_opportunities", Q.compose("""
SELECT opportunity_id, opportunity_name, account_id, amount, stage, close_date, type, probability,
       is_closed, is_won, timestamp, data_type, source FROM opp_all""", "opp_all"))
def q_project_opportunities(spark, sf):
    return project_opportunities(opportunities_src(spark, sf), CTX)


@register("select_registered_fields", Q.compose("""
SELECT account_id, account_name, arr, timestamp, data_type, source, industry, customer_type FROM arr_all""", "arr_all"))
def q_select_registered_fields(spark, sf):
    recs = project_accounts(accounts_src(spark, sf), CTX)
    return select_registered_fields(recs, "salesforce_arr", "v2")


# ---------------------------------------------------------------- scans and filters (CRM)
ACC_COLS = "Id, Name, Industry, Type, Arr"
OPP_COLS = ("Id, Name, AccountId, Amount, StageName, cast(CloseDate AS varchar) AS CloseDate, Type, "
            "Probability, IsClosed, IsWon")


def _opp_out(df: DataFrame) -> DataFrame:
    return df.withColumn("CloseDate", F.col("CloseDate").cast("string"))


@register("scan_accounts", Q.compose(f"SELECT {ACC_COLS} FROM v_accounts WHERE Type = 'Customer'", "v_accounts"))
def q_scan_accounts(spark, sf):
    return crm.scan_accounts(accounts_src(spark, sf))


@register("filter_customer_accounts", Q.compose(
    "SELECT * FROM v_accounts WHERE Type = 'Customer'", "v_accounts"))
def q_filter_customer_accounts(spark, sf):
    return crm.filter_customer_accounts(accounts_src(spark, sf))


@register("scan_opportunities", Q.compose(
    f"SELECT {OPP_COLS} FROM v_opportunities WHERE CloseDate >= DATE '{Q.RECENT_FROM}'", "v_opportunities"))
def q_scan_opportunities(spark, sf):
    return _opp_out(crm.scan_opportunities(opportunities_src(spark, sf), CTX.as_of))


@register("filter_recent_opportunities", Q.compose(
    f"SELECT {OPP_COLS} FROM v_opportunities WHERE CloseDate >= DATE '{Q.RECENT_FROM}'", "v_opportunities"))
def q_filter_recent_opportunities(spark, sf):
    return _opp_out(crm.filter_recent_opportunities(opportunities_src(spark, sf), CTX.as_of))


@register("sort_by_id", Q.compose(f"SELECT {ACC_COLS} FROM v_accounts WHERE Type = 'Customer' ORDER BY Id",
                                  "v_accounts"))
def q_sort_by_id(spark, sf):
    return crm.sort_by_id(crm.scan_accounts(accounts_src(spark, sf)))


PAGE = 2000  # CRM page size (fixed value of the reference)


@register("filter_after_key", Q.compose(f"""
SELECT {OPP_COLS} FROM v_opportunities
WHERE Id > (SELECT max(Id) FROM (SELECT Id FROM v_opportunities ORDER BY Id LIMIT {PAGE}))""", "v_opportunities"))
def q_filter_after_key(spark, sf):
    """Everything after the first page of the opportunity extract (keyset continuation)."""
    src = opportunities_src(spark, sf)
    last = crm.last_key(crm.keyset_page(src, PAGE))
    return _opp_out(crm.filter_after_key(src, last))


@register("keyset_page", Q.compose(f"""
SELECT {OPP_COLS} FROM v_opportunities
WHERE Id > (SELECT max(Id) FROM (SELECT Id FROM v_opportunities ORDER BY Id LIMIT {PAGE}))
ORDER BY Id LIMIT {PAGE}""", "v_opportunities"))
def q_keyset_page(spark, sf):
    """The second page of the opportunity extract: ``Id > last ORDER BY Id LIMIT 2000``."""
    src = opportunities_src(spark, sf)
    last = crm.last_key(crm.keyset_page(src, PAGE))
    return _opp_out(crm.keyset_page(src, PAGE, last))


@register("extract_checkpoint", Q.compose(f"""
SELECT page_number, max(Id) AS last_id, count(*) AS page_rows,
       (page_number - 1) * {PAGE} + count(*) AS processed_count
FROM (SELECT Id, cast((row_number() OVER (ORDER BY Id) - 1) // {PAGE} + 1 AS bigint) AS page_number
      FROM v_opportunities) GROUP BY page_number""", "v_opportunities"))
def q_extract_checkpoint(spark, sf):
    src = opportunities_src(spark, sf).select("Id")
    return agg.extract_checkpoint(assign_batches(src, PAGE, ["Id"]), "Id", PAGE)


# ---------------------------------------------------------------- joins / enrichment
@register("map_cost_category", Q.compose(f"""
SELECT line_item_id, account_id, cost_category FROM billing_cat""", "billing_cat"))
def q_map_cost_category(spark, sf):
    raw = billing_raw(spark, sf)
    recs = project_billing(raw, CTX, keep=["identity/LineItemId"])
    return map_cost_category(recs, account_map(spark, sf)).select(
        F.col("`identity/LineItemId`").alias("line_item_id"), "account_id", "cost_category")


ITEMS_MAP_SQL = ("SELECT account_id, arg_max(business_unit, seq) AS cost_category FROM v_account_items "
                 "WHERE account_id IS NOT NULL AND business_unit IS NOT NULL GROUP BY account_id")


@register("scan_account_map_items", Q.compose("SELECT * FROM items_map", "items_map",
                                              extra={"items_map": (ITEMS_MAP_SQL, ["v_account_items"])}))
def q_scan_account_map_items(spark, sf):
    return scan_account_map_items(adapter(spark, sf, "v_account_items"))


@register("transform_billing", Q.compose(f"""
SELECT b.line_item_id, {', '.join('b.' + c for c in BILLING_OUT)},
       coalesce(m.cost_category, 'unallocated') AS cost_category
FROM billing b LEFT JOIN items_map m ON b.account_id = m.account_id""", "billing", "items_map",
                                          extra={"items_map": (ITEMS_MAP_SQL, ["v_account_items"])}))
def q_transform_billing(spark, sf):
    """Billing transform with the key-value-store map (one entry per supplier account)."""
    items = scan_account_map_items(adapter(spark, sf, "v_account_items"))
    recs = project_billing(billing_raw(spark, sf), CTX, keep=["identity/LineItemId"])
    return map_cost_category(recs, items).select(
        F.col("`identity/LineItemId`").alias("line_item_id"), *BILLING_OUT, "cost_category")



@register("tag_records", Q.compose(f"""
SELECT {BILLING_OUT_SQL}, cost_category, {TAG_OUT_SQL} FROM billing_tag""", "billing_tag"))
def q_tag_records(spark, sf):
    recs = transform_billing(billing_raw(spark, sf), account_map(spark, sf), CTX).transform(
        lambda d: tag_records(d, CTX))
    return flat(recs).select(*BILLING_OUT, "cost_category", *TAG_OUT)


@register("correlation_id", Q.compose("""
SELECT Id, AccountId, sha256(coalesce(AccountId, 'None')) AS obs_correlation_id FROM v_opportunities""",
                                      "v_opportunities"))
def q_correlation_id(spark, sf):
    """Raw opportunity rows: the key falls back to ``AccountId``."""
    src = opportunities_src(spark, sf).select("Id", "AccountId")
    return src.withColumn("obs_correlation_id", correlation_id(F.col("AccountId")))


@register("data_version", Q.compose(f"""
SELECT account_id, md5(timestamp || '-' || source) AS obs_data_version FROM arr_all""", "arr_all"))
def q_data_version(spark, sf):
    from ledgerlake.functions.scalars import data_version
    recs = project_accounts(accounts_src(spark, sf), CTX)
    return recs.select("account_id", data_version(F.col("timestamp"), F.col("source")).alias("obs_data_version"))


@register("join_on_correlation", Q.compose("""
SELECT o.Id AS opportunity_id, o.AccountId AS account_id, a.Name AS account_name, o.Amount AS amount,
       a.Arr AS arr, sha256(o.AccountId) AS obs_correlation_id
FROM v_opportunities o JOIN v_accounts a ON sha256(o.AccountId) = sha256(a.Id)
WHERE a.Type = 'Customer'""", "v_opportunities", "v_accounts"))
def q_join_on_correlation(spark, sf):
    """All opportunities (tagged) joined to Customer accounts (tagged) on the correlation key."""
    opps = tag_records(project_opportunities(opportunities_src(spark, sf), CTX), CTX, stamp_version=True)
    accs = tag_records(project_accounts(crm.scan_accounts(accounts_src(spark, sf)), CTX), CTX, stamp_version=True)
    j = join_on_correlation(opps.select("obs_correlation_id", "opportunity_id", "account_id", "amount"),
                            accs.select("obs_correlation_id", F.col("account_name"), F.col("arr")))
    return j.select("opportunity_id", "account_id", "account_name", "amount", "arr", "obs_correlation_id")


@register("union_crm_families", Q.compose(f"""
SELECT data_type, account_id, account_name, arr, NULL::varchar AS opportunity_id, NULL::double AS amount,
       schema_version, obs_correlation_id FROM arr_tag
UNION ALL
SELECT data_type, account_id, NULL, NULL, opportunity_id, amount, schema_version, obs_correlation_id FROM opp_tag""",
                                          "arr_tag", "opp_tag"))
def q_union_crm_families(spark, sf):
    arr = tag_records(project_accounts(crm.scan_accounts(accounts_src(spark, sf)), CTX), CTX, stamp_version=True)
    opp = tag_records(project_opportunities(crm.scan_opportunities(opportunities_src(spark, sf), CTX.as_of), CTX),
                      CTX, stamp_version=True)
    u = union_families(arr, opp)
    return u.select("data_type", "account_id", "account_name", "arr", "opportunity_id", "amount",
                    "schema_version", "obs_correlation_id")


# ---------------------------------------------------------------- validation
@register("validate_records", Q.compose("SELECT * FROM all_val", "all_val"))
def q_validate_records(spark, sf):
    return flat(all_records(spark, sf)).select(
        "data_type", "account_id", "opportunity_id", val.REASON, val.WARNINGS)


@register("split_valid_quarantine", Q.compose(
    "SELECT data_type, account_id, opportunity_id, reject_reason FROM all_val WHERE reject_reason IS NOT NULL",
    "all_val"))
def q_split_valid_quarantine(spark, sf):
    _, quarantine = val.split_valid_quarantine(all_records(spark, sf))
    return quarantine.select("data_type", "account_id", "opportunity_id", val.REASON)


@register("ingest_summary", Q.compose("""
SELECT data_type, count(*) AS total_records, count(*) FILTER (WHERE reject_reason IS NULL) AS processed_records,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS failed_records FROM all_val GROUP BY data_type""",
                                      "all_val"))
def q_ingest_summary(spark, sf):
    return agg.ingest_summary(all_records(spark, sf))


@register("warning_summary", Q.compose("""
SELECT data_type, warning, count(*) AS records
FROM (SELECT data_type, unnest(string_split(warnings, ',')) AS warning FROM all_val WHERE warnings <> '')
GROUP BY data_type, warning""", "all_val"))
def q_warning_summary(spark, sf):
    return agg.warning_summary(all_records(spark, sf))


@register("check_arr", Q.compose("""
SELECT account_id, arr, CASE WHEN arr IS NULL THEN 'arr_not_number' WHEN arr < 0 THEN 'arr_negative' END AS arr_check
FROM arr_all""", "arr_all"))
def q_check_arr(spark, sf):
    recs = project_accounts(accounts_src(spark, sf), CTX)
    return recs.select("account_id", "arr", val.check_arr(F.col("arr")).alias("arr_check"))


@register("check_amount", Q.compose("""
SELECT opportunity_id, CASE WHEN amount < 0 THEN 'amount_negative' END AS amount_check,
       CASE WHEN amount < 0 THEN amount ELSE coalesce(amount, 0.0) END AS amount
FROM opp_all""", "opp_all"))
def q_check_amount(spark, sf):
    recs = project_opportunities(opportunities_src(spark, sf), CTX)
    text = F.col("amount").cast("string")
    chk = val.check_amount(text)
    return recs.select("opportunity_id", chk.alias("amount_check"),
                       F.when(chk.isNull(), val.normalize_amount(text)).otherwise(F.col("amount")).alias("amount"))


@register("check_cost", Q.compose("""
SELECT line_item_id, unblended_cost,
       CASE WHEN try_cast(unblended_cost AS double) IS NULL THEN 'cost_not_number' END AS cost_check
FROM v_billing_raw""", "v_billing_raw"))
def q_check_cost(spark, sf):
    raw = billing_raw(spark, sf)
    cost = F.col("`lineItem/UnblendedCost`")
    return raw.select(F.col("`identity/LineItemId`").alias("line_item_id"), cost.alias("unblended_cost"),
                      val.check_cost(cost).alias("cost_check"))


@register("flag_crm_id_format", Q.compose(f"""
SELECT Id, NOT regexp_matches(Id, {Q.CRM_RX}) AS id_format_warning,
       NOT regexp_matches(AccountId, {Q.CRM_RX}) AS account_id_format_warning FROM v_opportunities""",
                                          "v_opportunities"))
def q_flag_crm_id_format(spark, sf):
    src = opportunities_src(spark, sf)
    return src.select("Id", val.flag_crm_id_format(F.col("Id")).alias("id_format_warning"),
                      val.flag_crm_id_format(F.col("AccountId")).alias("account_id_format_warning"))


@register("flag_account_id_format", Q.compose(f"""
SELECT line_item_id, account_id, NOT regexp_matches(account_id, {Q.ACCT_RX}) AS account_id_format_warning
FROM v_billing_raw""", "v_billing_raw"))
def q_flag_account_id_format(spark, sf):
    raw = billing_raw(spark, sf)
    acct = F.col("`lineItem/UsageAccountId`")
    return raw.select(F.col("`identity/LineItemId`").alias("line_item_id"), acct.alias("account_id"),
                      val.flag_account_id_format(acct).alias("account_id_format_warning"))


@register("flag_negative_cost", Q.compose("""
SELECT line_item_id, cost, cost < 0 AS negative_cost_warning FROM billing""", "billing"))
def q_flag_negative_cost(spark, sf):
    recs = project_billing(billing_raw(spark, sf), CTX, keep=["identity/LineItemId"])
    return recs.select(F.col("`identity/LineItemId`").alias("line_item_id"), "cost",
                       val.flag_negative_cost(F.col("cost")).alias("negative_cost_warning"))


@register("fill_schema_version", Q.compose("""
SELECT account_id, 'v2' AS schema_version, CASE WHEN arr IS NULL THEN 'arr_not_number' WHEN arr < 0 THEN 'arr_negative'
       WHEN account_id IS NULL THEN 'account_id_null' END AS reject_reason FROM arr_all""", "arr_all"))
def q_fill_schema_version(spark, sf):
    """Untagged ARR records carry no version: the latest registered one (v2) is stamped."""
    recs = project_accounts(accounts_src(spark, sf), CTX).transform(val.validate_records)
    return recs.select("account_id", "schema_version", val.REASON)


@register("stamp_schema_version", Q.compose("""
SELECT account_id, 'v1' AS schema_version FROM arr_all""", "arr_all"))
def q_stamp_schema_version(spark, sf):
    recs = tag_records(project_accounts(accounts_src(spark, sf), CTX), CTX, stamp_version=True)
    return recs.select("account_id", "schema_version")


@register("route_by_volume", Q.compose("""
SELECT 'crm' AS pipeline, count(*) AS records, CASE WHEN count(*) > 5000 THEN 'work_batches' ELSE 'direct' END AS route
FROM (SELECT account_id FROM arr UNION ALL SELECT account_id FROM opp)
UNION ALL
SELECT 'billing', count(*), CASE WHEN count(*) > 5000 THEN 'work_batches' ELSE 'direct' END FROM v_billing_raw""",
                                      "arr", "opp", "v_billing_raw"))
def q_route_by_volume(spark, sf):
    crm_n = union_families(
        project_accounts(crm.scan_accounts(accounts_src(spark, sf)), CTX).select("account_id"),
        project_opportunities(crm.scan_opportunities(opportunities_src(spark, sf), CTX.as_of), CTX)
        .select("account_id")).agg(F.count(F.lit(1)).alias("records")).withColumn("pipeline", F.lit("crm"))
    bill_n = billing_raw(spark, sf).agg(F.count(F.lit(1)).alias("records")).withColumn("pipeline", F.lit("billing"))
    return route_by_volume(crm_n.unionByName(bill_n)).select("pipeline", "records", "route")


# ---------------------------------------------------------------- aggregation
@register("daily_cost_by_service_account", Q.compose("SELECT * FROM daily", "daily"))
def q_daily_cost_by_service_account(spark, sf):
    return daily_costs_from_usage(billing_raw(spark, sf))


# ---------------------------------------------------------------- scalar functions
@register("iso_timestamp", Q.compose("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
       CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || lpad(cast(epoch_us(ts) % 1000000 AS varchar), 6, '0') END
       AS iso_ts FROM events""", ))
def q_iso_timestamp(spark, sf):
    from ledgerlake.sources.adapters import table
    ev = table(spark, sf, "events")
    return ev.select("event_id", iso_timestamp(F.col("ts")).alias("iso_ts"))


@register("date_parts", Q.compose("""
SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y%m%d') AS compact, strftime(ts, '%Y%m%d%H%M%S') AS stamp
FROM events""", ))
def q_date_parts(spark, sf):
    from ledgerlake.sources.adapters import table
    ev = table(spark, sf, "events")
    parts = date_parts(F.col("ts"))
    return ev.select("event_id", *[c.alias(k) for k, c in parts.items()])


# ---------------------------------------------------------------- delivery outcomes
@register("classify_delivery", Q.compose("SELECT event_id, status_code, delivery_class FROM dlog", "dlog"))
def q_classify_delivery(spark, sf):
    log = delivery_log(spark, sf)
    return log.select("event_id", "status_code", dl.classify_delivery(F.col("status_code")).alias("delivery_class"))


@register("plan_retry_delay", Q.compose("""
SELECT event_id, delivery_class,
       CASE delivery_class WHEN 'delivered' THEN 'done' WHEN 'rate_limited' THEN 'retry' WHEN 'non_retryable' THEN 'dead_letter'
            ELSE (CASE WHEN attempt >= 3 THEN 'dead_letter' ELSE 'retry' END) END AS next_action,
       CASE delivery_class WHEN 'rate_limited' THEN cast(coalesce(retry_after, 5) AS double)
            WHEN 'retryable' THEN pow(2.0, attempt) END AS wait_seconds,
       CASE WHEN delivery_class = 'rate_limited' THEN cast(attempt AS double)
            WHEN delivery_class = 'retryable' AND attempt < 3 THEN cast(attempt + 1 AS double) END AS next_attempt,
       CASE WHEN attempt < 3 THEN pow(2.0, attempt - 1) * 5 END AS crm_wait_seconds
FROM dlog""", "dlog"))
def q_plan_retry_delay(spark, sf):
    out = dl.plan_retry_delay(delivery_log(spark, sf))
    return out.select("event_id", "delivery_class", "next_action", "wait_seconds",
                      F.col("next_attempt").cast("double").alias("next_attempt"), "crm_wait_seconds")


@register("split_dead_letters", Q.compose("""
SELECT batch_no, bool_or(delivery_class = 'delivered') AS delivered,
       count(*) FILTER (WHERE delivery_class = 'retryable') AS retryable_failures,
       bool_or(delivery_class = 'non_retryable') AS non_retryable,
       count(*) FILTER (WHERE delivery_class = 'rate_limited') AS rate_limited, count(*) AS attempts,
       CASE WHEN bool_or(delivery_class = 'delivered') THEN 'delivered'
            WHEN bool_or(delivery_class = 'non_retryable') OR count(*) FILTER (WHERE delivery_class = 'retryable') >= 3
            THEN 'dead_letter' ELSE 'pending' END AS outcome
FROM dlog GROUP BY batch_no""", "dlog"))
def q_split_dead_letters(spark, sf):
    return dl.split_dead_letters(delivery_log(spark, sf))


@register("failure_run_trips", Q.compose("""
SELECT sink_id, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, status_code, cast(since AS bigint) AS failures_since_success
FROM (SELECT *, sum(1 - succ) OVER (PARTITION BY sink_id, seg ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS since
      FROM (SELECT *, sum(succ) OVER (PARTITION BY sink_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS seg
            FROM (SELECT *, CASE WHEN delivery_class = 'delivered' THEN 1 ELSE 0 END AS succ
                  FROM dlog WHERE delivery_class <> 'rate_limited')))
WHERE succ = 0 AND since = 5""", "dlog"))
def q_failure_run_trips(spark, sf):
    trips = dl.failure_run_trips(delivery_log(spark, sf))
    return trips.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).withColumn(
        "failures_since_success", F.col("failures_since_success").cast("bigint"))


@register("trips_per_sink", Q.compose("""
SELECT sink_id, count(*) AS trips
FROM (SELECT *, sum(1 - succ) OVER (PARTITION BY sink_id, seg ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS since
      FROM (SELECT *, sum(succ) OVER (PARTITION BY sink_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS seg
            FROM (SELECT *, CASE WHEN delivery_class = 'delivered' THEN 1 ELSE 0 END AS succ
                  FROM dlog WHERE delivery_class <> 'rate_limited')))
WHERE succ = 0 AND since = 5 GROUP BY sink_id""", "dlog"))
def q_trips_per_sink(spark, sf):
    return dl.trips_per_sink(dl.failure_run_trips(delivery_log(spark, sf)))


# ---------------------------------------------------------------- batching
@register("assign_batches", Q.compose("""
SELECT o_orderkey, cast((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 + 1 AS bigint) AS batch_number,
       cast(ceil(count(*) OVER () / 1000.0) AS bigint) AS total_batches FROM orders"""))
def q_assign_batches(spark, sf):
    from ledgerlake.sources.adapters import table
    orders = table(spark, sf, "orders").select("o_orderkey")
    return assign_batches(orders, 1000, ["o_orderkey"])


# ---------------------------------------------------------------- composites and remaining scans
@register("sync_crm", Q.compose("""
SELECT data_type, account_id, NULL::varchar AS opportunity_id, arr, NULL::double AS amount, schema_version,
       reject_reason, warnings FROM arr_val
UNION ALL
SELECT data_type, account_id, opportunity_id, NULL, amount, schema_version, reject_reason, warnings FROM opp_val""",
                                "arr_val", "opp_val"))
def q_sync_crm(spark, sf):
    """Both CRM extracts -> tagged, versioned, validated records in one frame."""
    from ledgerlake.plans.pipelines import sync_crm
    out = flat(sync_crm(accounts_src(spark, sf), opportunities_src(spark, sf), CTX))
    return out.select("data_type", "account_id", "opportunity_id", "arr", "amount", "schema_version",
                      val.REASON, val.WARNINGS)


@register("lineage_struct", Q.compose(f"SELECT account_id, {Q.LINEAGE} FROM arr_all", "arr_all"))
def q_lineage_struct(spark, sf):
    recs = tag_records(project_accounts(accounts_src(spark, sf), CTX), CTX)
    return flatten_lineage(recs.select("account_id", "obs_lineage"))


@register("scan_account_map_json", Q.compose("""
SELECT account_id, business_unit AS cost_category FROM v_account_items WHERE business_unit IS NOT NULL""",
                                             "v_account_items"))
def q_scan_account_map_json(spark, sf):
    """Mapping fragments stored as JSON object text, one per supplier account;
    fragments of incomplete items are unparsable text and yield nothing."""
    from ledgerlake.sources.account_map import scan_account_map_json
    items = adapter(spark, sf, "v_account_items")
    text = F.when(F.col("business_unit").isNull(), F.lit("{unparsable")).otherwise(
        F.to_json(F.create_map(F.col("account_id"), F.col("business_unit"))))
    return scan_account_map_json(items.select(text.alias("value")))


# ---------------------------------------------------------------- registry, fallbacks, resume, crosswalk
@register("latest_schema_version", Q.compose("""
SELECT data_type, max('v' || cast(1 + length(account_id) % 12 AS varchar)) AS latest_version, count(*) AS records
FROM all_val WHERE account_id IS NOT NULL GROUP BY data_type""", "all_val"))
def q_latest_schema_version(spark, sf):
    """Latest version per family of a registry table with one row per record (versions
    v1 to v12 from the id's length): the text maximum, so v9 is later than v12."""
    recs = all_records(spark, sf).where("account_id IS NOT NULL")
    rows = recs.select("data_type", F.concat(F.lit("v"), (F.length("account_id") % 12 + 1).cast("string")).alias("version"))
    counts = rows.groupBy("data_type").agg(F.count(F.lit(1)).alias("records"))
    return agg.latest_schema_version(rows).join(counts, "data_type")


@register("account_map_default", Q.compose("""
SELECT b.line_item_id, CASE b.account_id WHEN '123456789012' THEN 'production' WHEN '234567890123' THEN 'staging'
       WHEN '345678901234' THEN 'development' ELSE 'unallocated' END AS cost_category FROM billing b""", "billing"))
def q_account_map_default(spark, sf):
    """Billing records against an account map that turned out empty: the default applies."""
    from ledgerlake.sources.account_map import account_map_or_default
    empty = scan_account_map_items(adapter(spark, sf, "v_account_items").where("business_unit = 'no such unit'"))
    recs = project_billing(billing_raw(spark, sf), CTX, keep=["identity/LineItemId"])
    return map_cost_category(recs, account_map_or_default(spark, empty)).select(
        F.col("`identity/LineItemId`").alias("line_item_id"), "cost_category")


RESUMED_PAGES = 8


@register("resume_extract", Q.compose(f"""
SELECT Id, Name, AccountId, cast((rn - 1) // size + 1 AS integer) AS page FROM (
  SELECT Id, Name, AccountId, row_number() OVER (ORDER BY Id) AS rn, cast(ceil(count(*) OVER () / {RESUMED_PAGES - 0.5}) AS bigint) AS size
  FROM v_opportunities)""", "v_opportunities"))
def q_resume_extract(spark, sf):
    """An extract that saves a checkpoint after each page, every page a run that resumes from the
    last, until a page comes back empty. The page size grows with the table, so that the number of
    pages doesn't; the last page is short."""
    from ledgerlake.plans.pipelines import resume_to_end
    src = opportunities_src(spark, sf).select("Id", "Name", "AccountId")
    size = max(1, math.ceil(src.count() / (RESUMED_PAGES - 0.5)))
    return resume_to_end(src, scratch_path(spark, "resume"), size, CTX)


@register("join_on_crosswalk", Q.compose("""
SELECT b.line_item_id, b.account_id, a.Name AS account_name, a.Arr AS arr, sha256(a.Id) AS obs_correlation_id
FROM billing b
JOIN (SELECT DISTINCT s_suppkey, lpad(cast(s_suppkey AS varchar), 12, '0') AS account_id,
             'ACC' || lpad(cast(s_suppkey AS varchar), 15, '0') AS crm_account_id FROM supplier) x
  ON x.account_id = b.account_id
JOIN v_accounts a ON a.Id = x.crm_account_id""", "billing", "v_accounts"))
def q_join_on_crosswalk(spark, sf):
    """Billing records joined to CRM accounts through a crosswalk of their ids."""
    from ledgerlake.operators.enrich import join_on_crosswalk
    from ledgerlake.sources.adapters import table
    number = F.col("s_suppkey").cast("string")
    crosswalk = table(spark, sf, "supplier").select(F.lpad(number, 12, "0").alias("account_id"), F.concat(
        F.lit("ACC"), F.lpad(number, 15, "0")).alias("crm_account_id")).distinct()
    bill = tag_records(project_billing(billing_raw(spark, sf), CTX, keep=["identity/LineItemId"]), CTX).withColumnRenamed(
        "identity/LineItemId", "line_item_id").select("line_item_id", "account_id", "obs_correlation_id")
    accs = tag_records(project_accounts(accounts_src(spark, sf), CTX), CTX).select("obs_correlation_id", "account_name", "arr")
    return join_on_crosswalk(bill, accs, crosswalk).select("line_item_id", "account_id", "account_name", "arr", "obs_correlation_id")
