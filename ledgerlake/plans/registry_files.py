"""Registered queries over files and messages that Spark derives from the tables:
CSV / Parquet exports, cost responses, the landed daily tree, work envelopes,
arrival events, plus masking and the two streaming jobs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.mask import mask_sensitive_fields
from ledgerlake.operators import aggregate as agg
from ledgerlake.operators import validate as val
from ledgerlake.operators.enrich import map_cost_category, tag_records
from ledgerlake.operators.project import (PARSE_FAILED, billing_stamps, derive_cost_keys, flatten_daily_costs,
                                          project_accounts, project_billing, project_opportunities)
from ledgerlake.plans import sql as Q
from ledgerlake.plans.pipelines import daily_costs_from_usage, ingest_billing, land_daily_costs
from ledgerlake.plans.registry import (BILLING_OUT, BILLING_OUT_SQL, CTX, TAG_OUT, TAG_OUT_SQL, account_map,
                                       accounts_src, all_records, billing_records, flat, opportunities_src, register)
from ledgerlake.schemas import LANDED_DAILY_LAYOUT
from ledgerlake.session import materialized, scratch_path
from ledgerlake.sinks.envelopes import (envelope_dead_letters, envelope_delivery_batches,
                                        envelope_work_batches)
from ledgerlake.sinks.files import read_partitioned_csv, write_failed_records, write_partitioned_csv
from ledgerlake.sources import billing as bsrc
from ledgerlake.sources import crm
from ledgerlake.sources import landing
from ledgerlake.sources.adapters import BILLING_RAW_DUCK, BILLING_RAW_NAMES, billing_raw, table
from ledgerlake.sources.costs import read_cost_responses, scan_daily_costs, yesterday_window
from ledgerlake.sources.envelopes import record_field, scan_batch_envelopes
from ledgerlake.sources.events import parse_arrival_events
from ledgerlake.streaming.jobs import stream_batch_envelopes, stream_billing_files

RAW_COLS = list(BILLING_RAW_NAMES.values())
RAW_SQL = Q.compose(f"SELECT {BILLING_RAW_DUCK} FROM v_billing_raw", "v_billing_raw")
FIRST_DAY, END_DAY = _dt.date(1900, 1, 1), _dt.date(2100, 1, 1)  # "all days" window


def _raw_out(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in RAW_COLS])


# ---------------------------------------------------------------- billing file scans
@register("scan_billing_csv", RAW_SQL)
def q_scan_billing_csv(spark, sf):
    raw = bsrc.scan_billing_csv(spark, landing.land_billing_csv(spark, sf))
    good, _ = bsrc.split_malformed(raw)
    return _raw_out(good)


@register("scan_billing_parquet", RAW_SQL)
def q_scan_billing_parquet(spark, sf):
    return _raw_out(bsrc.scan_billing_parquet(spark, landing.land_billing_parquet(spark, sf)))


@register("convert_parquet_to_csv", RAW_SQL)
def q_convert_parquet_to_csv(spark, sf):
    src = landing.land_billing_parquet(spark, sf)
    dst = bsrc.convert_parquet_to_csv(spark, src, scratch_path(spark, "converted-csv"))
    good, _ = bsrc.split_malformed(bsrc.scan_billing_csv(spark, dst))
    return _raw_out(good)


# lines with an unquoted comma, as the landed exports hold them
MALFORMED_EXTRA = {"broken": (f"""
SELECT concat_ws(',', {', '.join(f"{k} || ',x'" if k == "resource_id" else k if k != "usage_start" else "cast(usage_start AS varchar)"
                                 for k in BILLING_RAW_NAMES)}) AS raw_line
FROM v_billing_raw WHERE line_item_id LIKE '%00-1'""", ["v_billing_raw"])}


@register("scan_by_format", Q.compose(f"""
SELECT {BILLING_RAW_DUCK}, NULL::varchar AS raw_line FROM v_billing_raw
UNION ALL BY NAME SELECT raw_line FROM broken""", "v_billing_raw", "broken", extra=MALFORMED_EXTRA))
def q_scan_by_format(spark, sf):
    """Every row of a mixed folder, the malformed ones as their raw text."""
    raw = bsrc.scan_by_format(spark, landing.land_billing_mixed(spark, sf))
    return raw.select(*[F.col(f"`{c}`") for c in RAW_COLS], F.col(bsrc.MALFORMED).alias("raw_line"))


INGEST_OUT_SQL = f"{BILLING_OUT_SQL}, cost_category, {TAG_OUT_SQL}, reject_reason, warnings"


@register("ingest_billing", Q.compose(f"""
SELECT {INGEST_OUT_SQL}, NULL::varchar AS raw_line FROM billing_val
UNION ALL BY NAME SELECT raw_line, 'malformed_row' AS reject_reason, '' AS warnings FROM broken""",
                                      "billing_val", "broken", extra=MALFORMED_EXTRA))
def q_ingest_billing(spark, sf):
    """The whole job with its quarantine: valid, rejected and malformed rows."""
    raw = bsrc.scan_billing_csv(spark, landing.land_billing_csv(spark, sf))
    out = ingest_billing(raw, account_map(spark, sf), CTX, quarantine_path=scratch_path(spark, "ingest-quarantine"))
    return flat(out).select(*BILLING_OUT, "cost_category", *TAG_OUT, val.REASON, val.WARNINGS, "raw_line")


# ---------------------------------------------------------------- cost responses and landing
def _responses(spark, sf):
    daily = daily_costs_from_usage(billing_raw(spark, sf))
    return read_cost_responses(spark, landing.land_cost_responses(spark, sf, daily))


@register("flatten_daily_costs", Q.compose("SELECT cost_date, service, account_id, amount AS cost FROM daily",
                                           "daily"))
def q_flatten_daily_costs(spark, sf):
    return flatten_daily_costs(scan_daily_costs(_responses(spark, sf), FIRST_DAY, END_DAY))


@register("scan_daily_costs", Q.compose(
    f"SELECT cost_date, service, account_id, amount AS cost FROM daily WHERE cost_date = '{Q.YESTERDAY}'", "daily"))
def q_scan_daily_costs(spark, sf):
    start, end = yesterday_window(CTX.as_of)
    return flatten_daily_costs(scan_daily_costs(_responses(spark, sf), start, end))


KEYS_SQL = f"""
SELECT 'ce-' || cost_date || '-' || service || '-' || account_id AS "identity/LineItemId",
       cost_date || 'T00:00:00Z/' || cost_date || 'T23:59:59Z' AS "identity/TimeInterval",
       account_id AS "lineItem/UsageAccountId", service AS "lineItem/ProductCode", amount AS "lineItem/UnblendedCost",
       '{Q.YESTERDAY[:7]}' AS "bill/BillingPeriod", '1' AS "lineItem/UsageAmount", cost_date
FROM daily"""


@register("derive_cost_keys", Q.compose(KEYS_SQL, "daily"))
def q_derive_cost_keys(spark, sf):
    return derive_cost_keys(flatten_daily_costs(scan_daily_costs(_responses(spark, sf), FIRST_DAY, END_DAY)), CTX)


LANDED_SQL = Q.compose(f"""
SELECT * EXCLUDE (cost_date), substr(cost_date, 1, 4) AS year, substr(cost_date, 6, 2) AS month,
       substr(cost_date, 9, 2) AS day FROM keys""", "keys", extra={"keys": (KEYS_SQL, ["daily"])})


def _landed_tree(spark, sf):
    def write(path):
        rows = derive_cost_keys(flatten_daily_costs(scan_daily_costs(_responses(spark, sf), FIRST_DAY, END_DAY)),
                                CTX)
        write_partitioned_csv(rows, path)
    return landing._once(spark, sf, "landed-daily", write)


@register("write_partitioned_csv", LANDED_SQL)
def q_write_partitioned_csv(spark, sf):
    return read_partitioned_csv(spark, _landed_tree(spark, sf), LANDED_DAILY_LAYOUT)


@register("landed_file_stats", Q.compose(
    "SELECT cost_date, count(*) AS record_count FROM daily GROUP BY cost_date", "daily"))
def q_landed_file_stats(spark, sf):
    back = read_partitioned_csv(spark, _landed_tree(spark, sf), LANDED_DAILY_LAYOUT)
    return agg.landed_file_stats(back.withColumn("cost_date", F.concat_ws("-", "year", "month", "day")))


@register("land_daily_costs", Q.compose(f"""
SELECT * EXCLUDE (cost_date), substr(cost_date, 1, 4) AS year, substr(cost_date, 6, 2) AS month,
       substr(cost_date, 9, 2) AS day FROM keys WHERE cost_date = '{Q.YESTERDAY}'""", "keys",
                                        extra={"keys": (KEYS_SQL, ["daily"])}))
def q_land_daily_costs(spark, sf):
    """The scheduled daily job: yesterday's costs -> landed partitioned CSV -> read back."""
    path = scratch_path(spark, "land-daily")
    land_daily_costs(_responses(spark, sf), path, CTX)
    return read_partitioned_csv(spark, path, LANDED_DAILY_LAYOUT)


# ---------------------------------------------------------------- envelopes
BILL_ORDER = ["account_id", "service", "resource_id", "cost", "usage_amount", "usage_type", "billing_period"]
BILL_ORDER_SQL = ", ".join(BILL_ORDER)


def _complete_billing(spark, sf):
    """What turns the varying columns of billing records into whole ones: constants, category, tags."""
    accounts = account_map(spark, sf)
    return lambda d: d.withColumns(billing_stamps(CTX)).transform(
        lambda r: map_cost_category(r, accounts)).transform(lambda r: tag_records(r, CTX))


def _tagged_crm(d: DataFrame) -> DataFrame:
    return tag_records(d, CTX, stamp_version=True)


def billing_rows(spark, sf) -> DataFrame:
    return project_billing(billing_raw(spark, sf), CTX).drop(PARSE_FAILED, *billing_stamps(CTX))


def arr_rows(spark, sf) -> DataFrame:
    return project_accounts(crm.scan_accounts(accounts_src(spark, sf)), CTX)


def opp_rows(spark, sf) -> DataFrame:
    return project_opportunities(crm.scan_opportunities(opportunities_src(spark, sf), CTX.as_of), CTX)


def work_envelopes(spark, sf) -> DataFrame:
    """Fan-out messages: billing in numbered batches of 1000, CRM families in
    batches of 100 (separate flushes, so a message never mixes families)."""
    from concurrent.futures import ThreadPoolExecutor
    sent = CTX.ingest_iso
    # The families are independent: their shard-bound sample jobs run concurrently.
    with ThreadPoolExecutor(max_workers=3) as pool:
        bill, arr, opp = pool.map(lambda a: envelope_work_batches(a[0](spark, sf), a[1], a[2], sent, finish=a[3]), [
            (billing_rows, BILL_ORDER, "cur_batch", _complete_billing(spark, sf)),
            (arr_rows, ["account_id"], "salesforce_batch", _tagged_crm),
            (opp_rows, ["opportunity_id"], "salesforce_batch", _tagged_crm)])
    return bill.withColumn("data_type", F.lit("aws_cur")).unionByName(
        arr.withColumn("data_type", F.lit("salesforce_arr"))).unionByName(
        opp.withColumn("data_type", F.lit("salesforce_opportunity")))


def _landed_envelopes(spark, sf) -> str:
    return landing._once(spark, sf, "work-envelopes",
                         lambda path: work_envelopes(spark, sf).select("value").write.option("compression", "gzip").text(path))


ENV_EXTRA = {
    "env": ("""
SELECT 'cur_batch' AS message_type, cast((rn - 1) // 1000 + 1 AS bigint) AS batch_number,
       cast(ceil(n / 1000.0) AS bigint) AS total_batches, cast((rn - 1) % 1000 AS integer) AS record_index,
       data_type, account_id, NULL::varchar AS opportunity_id, obs_correlation_id, reject_reason
FROM (SELECT *, row_number() OVER (ORDER BY account_id, service, resource_id, cost, usage_amount, usage_type,
                                            billing_period) AS rn, count(*) OVER () AS n FROM billing_r)
UNION ALL
SELECT 'salesforce_batch', NULL, NULL, cast((row_number() OVER (ORDER BY account_id) - 1) % 100 AS integer),
       data_type, account_id, NULL, obs_correlation_id, reject_reason FROM arr_r
UNION ALL
SELECT 'salesforce_batch', NULL, NULL, cast((row_number() OVER (ORDER BY opportunity_id) - 1) % 100 AS integer),
       data_type, account_id, opportunity_id, obs_correlation_id, reject_reason FROM opp_r""",
            ["billing_r", "arr_r", "opp_r"]),
}


@register("scan_batch_envelopes", Q.compose("""
SELECT message_type, cast(batch_number AS varchar) AS batch_number, cast(total_batches AS varchar) AS total_batches,
       record_index, data_type, account_id, opportunity_id, obs_correlation_id FROM env""", "env", extra=ENV_EXTRA))
def q_scan_batch_envelopes(spark, sf):
    """Round trip of the work messages. CRM messages carry no batch numbers (NULL);
    batch numbers are rendered as text so NULLs compare alike in any engine."""
    msgs = spark.read.text(_landed_envelopes(spark, sf))
    recs = scan_batch_envelopes(msgs)
    return recs.select("message_type", F.col("batch_number").cast("string").alias("batch_number"),
                       F.col("total_batches").cast("string").alias("total_batches"), "record_index",
                       record_field("data_type"), record_field("account_id"), record_field("opportunity_id"), record_field("obs_correlation_id"))


@register("envelope_summary", Q.compose("""
SELECT message_type, count(*) AS total_records, count(*) FILTER (WHERE reject_reason IS NULL) AS processed_records,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS failed_records FROM env GROUP BY message_type""",
                                        "env", extra=ENV_EXTRA))
def q_envelope_summary(spark, sf):
    recs = scan_batch_envelopes(spark.read.text(_landed_envelopes(spark, sf)))
    return agg.ingest_summary(val.validate_scanned_records(recs), by="message_type")


@register("envelope_work_batches", Q.compose("""
SELECT 'cur_batch' AS message_type, 'aws_cur' AS data_type, cast((rn - 1) // 1000 + 1 AS bigint) AS batch_number,
       count(*) AS record_count FROM (SELECT row_number() OVER () AS rn FROM billing_tag) GROUP BY 3
UNION ALL
SELECT 'salesforce_batch', 'salesforce_arr', cast((rn - 1) // 100 + 1 AS bigint), count(*)
FROM (SELECT row_number() OVER () AS rn FROM arr_tag) GROUP BY 3
UNION ALL
SELECT 'salesforce_batch', 'salesforce_opportunity', cast((rn - 1) // 100 + 1 AS bigint), count(*)
FROM (SELECT row_number() OVER () AS rn FROM opp_tag) GROUP BY 3""", "billing_tag", "arr_tag", "opp_tag"))
def q_envelope_work_batches(spark, sf):
    env = work_envelopes(spark, sf)
    return env.select(F.get_json_object("value", "$.type").alias("message_type"), "data_type", "batch_number",
                      F.col("record_count").cast("bigint").alias("record_count"))


DELIVERED_TEXT = ["account_id", "opportunity_id", "line_item_id", "service", "stage", "obs_correlation_id",
                  "schema_version"]
# Line item ids repeat in the given tables: more fields make the order total.
ITEM_ORDER = ["line_item_id", "resource_id", "account_id", "billing_period", "cost", "usage_amount"]
NUMBERED = {"numbered": ("""
SELECT *, cast((rn - 1) // 1000 + 1 AS bigint) AS batch_number, cast(ceil(n / 1000.0) AS bigint) AS total_batches,
       cast((rn - 1) % 1000 AS integer) AS record_index
FROM (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY line_item_id, resource_id, account_id, billing_period,
                                                               cost, usage_amount) AS rn, count(*) OVER () AS n
                     FROM billing_val WHERE reject_reason IS NULL)
      UNION ALL BY NAME
      SELECT * FROM (SELECT *, row_number() OVER (ORDER BY account_id) AS rn, count(*) OVER () AS n
                     FROM arr_val WHERE reject_reason IS NULL)
      UNION ALL BY NAME
      SELECT * FROM (SELECT *, row_number() OVER (ORDER BY opportunity_id) AS rn, count(*) OVER () AS n
                     FROM opp_val WHERE reject_reason IS NULL))""", ["billing_val", "arr_val", "opp_val"])}


TAGS = ("obs_correlation_id", "obs_ingest_timestamp", "obs_data_version", "obs_lineage")


def valid_families(spark, sf) -> list[tuple]:
    """(family, valid records of it, order, what completes them): the columns that vary, line item ids kept."""
    from ledgerlake.plans.registry import arr_records, opportunity_records
    bills = project_billing(billing_raw(spark, sf), CTX, keep=["identity/LineItemId"]).withColumnRenamed(
        "identity/LineItemId", "line_item_id").transform(val.validate_records)
    # written once: as a filter on the fly, all rules would run ahead of the other work, and for the numbering's sample again
    bills = materialized(bills.drop(*billing_stamps(CTX)), "validated")
    bills, arr, opp = (val.split_valid_quarantine(d)[0] for d in (bills, arr_records(spark, sf), opportunity_records(spark, sf)))
    return [("aws_cur", bills, ITEM_ORDER, _complete_billing(spark, sf)),
            ("salesforce_arr", arr.drop(*TAGS, "schema_version"), ["account_id"], _tagged_crm),
            ("salesforce_opportunity", opp.drop(*TAGS, "schema_version"), ["opportunity_id"], _tagged_crm)]


@register("envelope_delivery_batches", Q.compose(f"""
SELECT data_type, batch_number, total_batches, '{CTX.customer_id}' AS customer_id, record_index,
       {', '.join(DELIVERED_TEXT)}, cost, arr, amount FROM numbered""", "numbered", extra=NUMBERED))
def q_envelope_delivery_batches(spark, sf):
    """Collector POST bodies of <= 1000 valid records, one flush per family, opened again."""
    out = None
    for fam, valid, order, complete in valid_families(spark, sf):
        env = envelope_delivery_batches(valid.drop(val.WARNINGS), order, CTX.customer_id, finish=complete)
        env = env.withColumn("data_type", F.lit(fam))
        out = env if out is None else out.unionByName(env)
    # the bodies themselves, record by record: place, identity and a digest of all fields
    # (a body is parsed before its records are dealt out, not again for each of them; a batch is
    # never empty, and the outer explode spares a filter that would build and parse all bodies first)
    body = F.from_json("value", "customer_id string, data array<map<string,string>>")
    rec = out.select("data_type", "batch_number", "total_batches", body.alias("b")).select(
        "data_type", "batch_number", "total_batches", F.col("b.customer_id").alias("customer_id"),
        F.posexplode_outer("b.data").alias("record_index", "r"))
    return rec.select("data_type", "batch_number", "total_batches", "customer_id", "record_index",
                      *[F.col("r").getItem(c).alias(c) for c in DELIVERED_TEXT],
                      *[F.col("r").getItem(c).cast("double").alias(c) for c in ("cost", "arr", "amount")])


OUTCOMES = {**NUMBERED, "sent": ("""
SELECT n.*, coalesce(o.outcome, 'pending') AS outcome FROM numbered n LEFT JOIN (
  SELECT batch_no, CASE WHEN bool_or(delivery_class = 'delivered') THEN 'delivered'
            WHEN bool_or(delivery_class = 'non_retryable') OR count(*) FILTER (WHERE delivery_class = 'retryable') >= 3
            THEN 'dead_letter' ELSE 'pending' END AS outcome
  FROM dlog GROUP BY batch_no) o ON o.batch_no = n.batch_number""", ["numbered", "dlog"])}


def sent_records(spark, sf) -> DataFrame:
    """Valid records of all families in their delivery batches, with the outcome that
    the delivery log gives each batch."""
    from ledgerlake.operators.delivery import deliver_batches, split_dead_letters
    from ledgerlake.operators.ordering import assign_batches, union_families
    from ledgerlake.plans.registry import delivery_log
    families = [flat(complete(assign_batches(valid, 1000, order))) for _, valid, order, complete in valid_families(spark, sf)]
    records = union_families(*families).withColumnRenamed("batch_number", "batch_no")
    return deliver_batches(records, split_dead_letters(delivery_log(spark, sf)))


@register("delivery_summary", Q.compose("""
SELECT data_type, count(*) AS total_records, count(*) FILTER (WHERE outcome = 'delivered') AS delivered,
       count(*) FILTER (WHERE outcome = 'dead_letter') AS dead_lettered,
       count(*) FILTER (WHERE outcome = 'pending') AS pending FROM sent GROUP BY data_type""", "sent", extra=OUTCOMES))
def q_delivery_summary(spark, sf):
    """Delivered and dead-lettered counts per family."""
    from ledgerlake.operators.delivery import delivery_summary
    return delivery_summary(sent_records(spark, sf))


DEAD_TEXT = ["data_type", "account_id", "opportunity_id", "line_item_id", "service", "resource_id", "usage_type",
             "billing_period", "cost_category", "stage", "source", "schema_version", "obs_correlation_id",
             "obs_data_version", "lineage_data_owner"]


@register("envelope_dead_letters", Q.compose(f"""
SELECT cast((dn - 1) // 10 + 1 AS bigint) AS batch_number, cast((dn - 1) % 10 AS integer) AS record_index,
       '{CTX.customer_id}' AS customer_id, {', '.join(DEAD_TEXT)}, cost, usage_amount, arr, amount
FROM (SELECT *, row_number() OVER (ORDER BY data_type NULLS FIRST, line_item_id NULLS FIRST, resource_id NULLS FIRST,
                                            account_id NULLS FIRST, billing_period NULLS FIRST, cost NULLS FIRST,
                                            usage_amount NULLS FIRST, opportunity_id NULLS FIRST) AS dn
      FROM sent WHERE outcome = 'dead_letter')""", "sent", extra=OUTCOMES))
def q_envelope_dead_letters(spark, sf):
    """Records of undelivered batches, whole, in dead-letter chunks of 10, opened again."""
    dead = sent_records(spark, sf).where("outcome = 'dead_letter'").drop("outcome", "batch_no", "total_batches")
    env = envelope_dead_letters(dead, ["data_type", *ITEM_ORDER, "opportunity_id"], CTX.ingest_iso,
                                CTX.customer_id, CTX.ingest_iso)
    body = F.from_json("value", "customer_id string, records array<map<string,string>>")
    rec = env.select("batch_number", body.alias("b")).select(
        "batch_number", F.col("b.customer_id").alias("customer_id"), F.posexplode_outer("b.records").alias("record_index", "r"))
    return rec.select("batch_number", "record_index", "customer_id", *[F.col("r").getItem(c).alias(c) for c in DEAD_TEXT],
                      *[F.col("r").getItem(c).cast("double").alias(c) for c in ("cost", "usage_amount", "arr", "amount")])


# ---------------------------------------------------------------- failed records
@register("write_failed_records", Q.compose(f"""
SELECT *, '{CTX.as_of_iso}' AS failed_date FROM all_full WHERE reject_reason IS NOT NULL""", "all_full"))
def q_write_failed_records(spark, sf):
    """Rejected records with every column, written twice: the second run replaces the first."""
    _, quarantine = val.split_valid_quarantine(flat(all_records(spark, sf)))
    path = scratch_path(spark, "failed-records")
    write_failed_records(quarantine, path, CTX)
    write_failed_records(quarantine, path, CTX)
    schema = T.StructType([*quarantine.schema.fields, T.StructField("failed_date", T.StringType())])
    return spark.read.schema(schema).option("basePath", path).json(path).drop("run")


# ---------------------------------------------------------------- checks on raw JSON records
@register("check_required_fields", Q.compose("""
SELECT account_id, CASE WHEN arr IS NULL THEN 'missing:arr' WHEN arr < 0 THEN 'arr_negative' END AS reject_reason
FROM arr_all""", "arr_all"))
def q_check_required_fields(spark, sf):
    """ARR records serialised the way a JSON writer that drops NULLs does: a NULL
    ``arr`` becomes an absent key, caught by the registry's required fields."""
    recs = tag_records(project_accounts(accounts_src(spark, sf), CTX), CTX, stamp_version=True)
    as_map = recs.select(F.from_json(F.to_json(F.struct(*recs.columns)), "map<string,string>").alias("record"))
    checked = val.validate_raw_records(as_map)
    return checked.select(record_field("account_id"), val.REASON)


# ---------------------------------------------------------------- arrival events
EVENTS_SQL = r"""
WITH o AS (
  SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS prio,
         CASE o_orderstatus WHEN 'F' THEN 'billing-exports' WHEN 'O' THEN 'Billing_Exports' ELSE 'bx' END AS bucket,
         'aws-cur/year=' || strftime(o_orderdate, '%Y') || '/month=' || strftime(o_orderdate, '%m') || '/day=' ||
         strftime(o_orderdate, '%d') || '/cost-report-' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS key
  FROM orders),
chk AS (SELECT *, CASE WHEN NOT regexp_matches(bucket, '^[a-z0-9][a-z0-9\.\-]{1,61}[a-z0-9]$') THEN 'invalid_bucket'
                       WHEN length(key) > 1024 THEN 'invalid_key' END AS bucket_reason FROM o),
s3 AS (
  SELECT o.o_orderkey AS event_id,
         cast(row_number() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_linenumber, k) - 1 AS integer) AS record_index,
         'billing_file' AS kind, o.bucket, k AS key, NULL::varchar AS body,
         CASE WHEN NOT regexp_matches(o.bucket, '^[a-z0-9][a-z0-9\.\-]{1,61}[a-z0-9]$') THEN 'invalid_bucket'
              WHEN length(k) > 1024 THEN 'invalid_key' END AS reason
  FROM o JOIN (SELECT *, 'aws-cur/' || strftime(l_shipdate, '%Y-%m-%d') || '/li-' || cast(l_orderkey AS varchar) ||
                         '-' || cast(l_linenumber AS varchar) || '.csv' AS k FROM lineitem) l
    ON l.l_orderkey = o.o_orderkey
  WHERE o.prio NOT IN ('1', '2', '3'))
SELECT event_id, record_index, kind, bucket, key, body, reason, reason IS NULL AS ok FROM (
  SELECT o_orderkey AS event_id, 0 AS record_index, 'billing_file' AS kind, bucket, key, NULL::varchar AS body,
         bucket_reason AS reason FROM chk WHERE prio = '1'
  UNION ALL
  SELECT o_orderkey, 0, 'crm_sync', NULL, NULL, NULL, NULL FROM o WHERE prio = '2'
  UNION ALL
  SELECT o_orderkey, 0, 'queue_message', NULL, NULL, 'order-' || cast(o_orderkey AS varchar), NULL FROM o WHERE prio = '3'
  UNION ALL
  SELECT * FROM s3
  UNION ALL
  SELECT o_orderkey, 0, 'unsupported', NULL, NULL, NULL, 'unsupported_event' FROM o
  WHERE prio NOT IN ('1', '2', '3') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))"""


@register("parse_arrival_events", EVENTS_SQL)
def q_parse_arrival_events(spark, sf):
    events = spark.read.parquet(landing.land_arrival_events(spark, sf))
    return parse_arrival_events(events, "value", id_col="event_id").select(
        "event_id", F.col("record_index").cast("int").alias("record_index"), "kind", "bucket", "key", "body",
        "reason", "ok")


# ---------------------------------------------------------------- masking
@register("mask_sensitive_fields", """
SELECT c_custkey, c_name AS username,
       CASE WHEN c_acctbal > 5000 THEN '********' END AS Password,
       CASE WHEN c_nationkey <> 0 THEN '********' END AS api_token,
       c_mktsegment AS settings_region,
       CASE WHEN c_acctbal <> 0 THEN '********' END AS settings_secret_key,
       CASE WHEN c_name <> '' THEN '********' END AS tag_token, c_mktsegment AS tag_label,
       CASE WHEN c_custkey <> 0 THEN '********' END AS map_password, cast(c_nationkey AS varchar) AS map_port,
       '********' AS map_secret
FROM customer""")
def q_mask_sensitive_fields(spark, sf):
    """Configuration-like nested records built from customers, masked by field name."""
    cust = table(spark, sf, "customer")
    rec = cust.select(
        "c_custkey", F.col("c_name").alias("username"),
        F.when(F.col("c_acctbal") > 5000, F.concat("c_name", F.lit("-pw"))).otherwise(F.lit("")).alias("Password"),
        F.col("c_nationkey").alias("api_token"),
        F.struct(F.col("c_mktsegment").alias("region"), F.col("c_acctbal").alias("secret_key")).alias("settings"),
        F.array(F.struct(F.col("c_name").alias("token"), F.col("c_mktsegment").alias("label"))).alias("tags"),
        F.create_map(F.lit("db_password"), F.col("c_custkey"), F.lit("port"), F.col("c_nationkey")).alias("numbers"),
        F.create_map(F.lit("Secret"), F.struct(F.col("c_name").alias("v"))).alias("structs"))
    m = mask_sensitive_fields(rec)
    first = F.get("tags", 0)
    return m.select("c_custkey", "username", "Password", "api_token",
                    F.col("settings.region").alias("settings_region"),
                    F.col("settings.secret_key").alias("settings_secret_key"),
                    first["token"].alias("tag_token"), first["label"].alias("tag_label"),
                    m["numbers"]["db_password"].alias("map_password"), m["numbers"]["port"].alias("map_port"),
                    m["structs"]["Secret"].alias("map_secret"))


# ---------------------------------------------------------------- streaming
@register("stream_billing_files", Q.compose(f"""
SELECT {BILLING_OUT_SQL}, cost_category, {TAG_OUT_SQL}, warnings FROM billing_val WHERE reject_reason IS NULL""",
                                            "billing_val"))
def q_stream_billing_files(spark, sf):
    """Each landed export file is picked up once by a file stream and ingested."""
    landing_dir = landing.land_billing_csv(spark, sf)
    sink, quarantine, ckpt = (scratch_path(spark, n) for n in ("stream-sink", "stream-quarantine", "stream-ckpt"))
    stream_billing_files(spark, landing_dir, account_map(spark, sf), sink, quarantine, ckpt, CTX)
    return flat(spark.read.parquet(sink)).select(*BILLING_OUT, "cost_category", *TAG_OUT, val.WARNINGS)


@register("stream_batch_envelopes", Q.compose("""
SELECT message_type, data_type, account_id, opportunity_id, reject_reason FROM env""", "env", extra=ENV_EXTRA))
def q_stream_batch_envelopes(spark, sf):
    sink, ckpt = scratch_path(spark, "env-sink"), scratch_path(spark, "env-ckpt")
    stream_batch_envelopes(spark, _landed_envelopes(spark, sf), sink, ckpt)
    out = spark.read.parquet(sink)
    return out.select("message_type", record_field("data_type"), record_field("account_id"), record_field("opportunity_id"), val.REASON)
