"""Registered queries over documents of unknown shape, stateful streams, write-time counts,
run dates, and the extract source and envelope sink."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ledgerlake.functions.documents import BAD_JSON, lookup_json, mask_json_columns
from ledgerlake.operators import validate as val
from ledgerlake.operators.enrich import tag_records
from ledgerlake.operators.observed import ingest_observed, landing_observed
from ledgerlake.operators.ordering import union_families
from ledgerlake.operators.project import project_accounts, project_billing, project_opportunities
from ledgerlake.operators.registry import registry_rules, registry_versions, validate_by_registry
from ledgerlake.plans import sql as Q
from ledgerlake.plans.pipelines import land_daily_costs, transform_billing
from ledgerlake.plans.registry import (BILLING_OUT, BILLING_OUT_SQL, CTX, PAGE, TAG_OUT, TAG_OUT_SQL, account_map, accounts_src, all_records, flat,
                                       opportunities_src, register)
from ledgerlake.plans.registry_files import _responses as cost_responses
from ledgerlake.schemas import REGISTRY
from ledgerlake.session import open_writers, scratch_path
from ledgerlake.sinks.envelope_stream import read_envelopes, stream_envelopes
from ledgerlake.sinks.files import write_partitioned_csv
from ledgerlake.sources import billing as bsrc
from ledgerlake.sources import crm, landing
from ledgerlake.sources.adapters import adapter, billing_raw
from ledgerlake.sources.pages import read_pages, write_pages
from ledgerlake.streaming.stateful import OUTCOMES, stream_arrivals, stream_work_messages


# ---------------------------------------------------------------- documents of unknown shape
@register("mask_json_documents", Q.compose("""
SELECT id, CASE WHEN id % 97 <> 0 THEN
         '{"auth":{"Password":' || CASE WHEN id % 4 = 2 THEN '"********"' ELSE 'null' END || ',"user":"' || user || '"},"note":null,"order":' || id
         || ',"sinks":[{"api_token":' || CASE WHEN id % 3 = 0 THEN 'null' ELSE '"********"' END || ',"url":"' || url
         || '"},[{"client_secret":' || CASE WHEN id % 7 = 0 THEN 'null' ELSE '"********"' END || ',"retries":' || id % 5
         || '}]],"tokens":' || CASE WHEN id % 5 = 0 THEN '"********"' ELSE 'null' END || '}' END AS document, id % 97 = 0 AS bad_json
FROM (SELECT id, split_part(split_part(document, '"user":"', 2), '"', 1) AS user,
             split_part(split_part(document, '"url":"', 2), '"', 1) AS url FROM v_config_documents)""", "v_config_documents"))
def q_mask_json_documents(spark, sf):
    """JSON texts masked by the names of their fields, at whatever depth these are."""
    docs = adapter(spark, sf, "v_config_documents").select("id", "document")
    return mask_json_columns(docs, ["document"]).withColumnRenamed(BAD_JSON, "bad_json")


@register("lookup_dot_path", Q.compose("""
SELECT id, path, CASE WHEN json_valid(document) THEN coalesce(cast(json_extract(document, '$.' || path) AS varchar), '"n/a"')
                      ELSE '"n/a"' END AS value FROM v_config_documents""", "v_config_documents"))
def q_lookup_dot_path(spark, sf):
    """The value at a path that each row names, with a default where the document has none."""
    docs = adapter(spark, sf, "v_config_documents")
    return docs.select("id", "path", lookup_json(F.col("document"), F.col("path"), '"n/a"').alias("value"))


# ---------------------------------------------------------------- streams with state
def announced_exports(spark, sf) -> tuple[str, str]:
    """(event log, root of the objects): the landed billing export, each file announced
    by a notification that names it twice, then directly, then by a notification
    with an old event time; three files of the log, in this order."""
    folder = landing.land_billing_csv(spark, sf)
    root, _, bucket = folder.rpartition("/")
    names = spark.read.text(folder).select(F.col("_metadata.file_name").alias("key")).distinct()
    files = names.select("key", F.abs(F.xxhash64("key")).alias("event_id"))
    record = F.struct(F.lit("aws:s3").alias("eventSource"), F.struct(
        F.struct(F.lit(bucket).alias("name")).alias("bucket"), F.struct("key").alias("object")).alias("s3"))
    notice = F.to_json(F.struct(F.array(record, record).alias("Records")))
    direct = F.to_json(F.struct(F.lit("cur").alias("action"), F.lit(bucket).alias("bucket"), "key"))
    log = scratch_path(spark, "announcements")
    for text, at in ((notice, "2001-08-01 06:00:00"), (direct, "2001-08-01 07:00:00"), (notice, "2000-01-01 00:00:00")):
        files.select("event_id", F.lit(at).cast("timestamp").alias("event_time"), text.alias("value")).write.mode("append").parquet(log)
    return log, root


@register("stream_arrivals", Q.compose(f"""
SELECT {BILLING_OUT_SQL}, cost_category, {TAG_OUT_SQL}, warnings FROM billing_val WHERE reject_reason IS NULL""", "billing_val"))
def q_stream_arrivals(spark, sf):
    """Each announced export file is ingested once, though it is announced five times."""
    log, root = announced_exports(spark, sf)
    sink, quarantine, ledger, ckpt = (scratch_path(spark, f"arrivals-{n}") for n in ("sink", "quarantine", "ledger", "ckpt"))
    stream_arrivals(spark, log, root, account_map(spark, sf), sink, quarantine, ledger, ckpt, CTX, files_per_trigger=4)
    return flat(spark.read.parquet(sink)).select(*BILLING_OUT, "cost_category", *TAG_OUT, val.WARNINGS)


def land_receives(spark, sf) -> str:
    """The delivery log as receives of work messages (three events a message), in files by time."""
    log = adapter(spark, sf, "v_delivery_log").select(
        F.col("batch_no").alias("message_id"), F.col("ts").alias("received_at"), "status_code")
    low, high = log.agg(F.min("received_at"), F.max("received_at")).first()
    path, parts = scratch_path(spark, "receives"), 3
    step = (high - low) / parts if low is not None else None
    for k in range(parts):
        some = log
        if low is not None:
            some = log.where((F.col("received_at") >= low + k * step) & ((F.col("received_at") < low + (k + 1) * step) if k < parts - 1 else F.lit(True)))
        some.write.mode("append").parquet(path)
    return path


@register("stream_work_messages", Q.compose("""
SELECT message_id, CASE WHEN first_ok IS NOT NULL THEN 'done' WHEN receives >= 3 THEN 'dead_letter' ELSE 'expired' END AS outcome,
       cast(coalesce(first_ok, least(receives, 3)) AS integer) AS receives
FROM (SELECT batch_no AS message_id, min(nth) FILTER (ok AND nth <= 3) AS first_ok, count(*) AS receives, min(ts) AS first_at
      FROM (SELECT *, status_code BETWEEN 200 AND 299 AS ok, row_number() OVER (PARTITION BY batch_no ORDER BY ts) AS nth
            FROM v_delivery_log WHERE status_code <> 429) GROUP BY batch_no)
WHERE first_ok IS NOT NULL OR receives >= 3
   OR first_at + INTERVAL 14 DAY < (SELECT max(ts) FROM v_delivery_log) - INTERVAL 1 HOUR""", "v_delivery_log"))
def q_stream_work_messages(spark, sf):
    """What became of every work message: done, dead-lettered after three receives, expired."""
    sink, ckpt = scratch_path(spark, "messages-sink"), scratch_path(spark, "messages-ckpt")
    stream_work_messages(spark, land_receives(spark, sf), sink, ckpt, files_per_trigger=4)
    return spark.read.schema(OUTCOMES).parquet(sink).select("message_id", "outcome", "receives")


# ---------------------------------------------------------------- the registry as data
@register("validate_by_registry", Q.compose("SELECT * FROM all_val", "all_val"))
def q_validate_by_registry(spark, sf):
    """All families validated by the registry's rows instead of compiled branches."""
    versions, rules = registry_versions(spark), registry_rules(spark)
    bill = tag_records(transform_billing(billing_raw(spark, sf), account_map(spark, sf), CTX), CTX)
    arr = tag_records(project_accounts(crm.scan_accounts(accounts_src(spark, sf)), CTX), CTX, stamp_version=True)
    opp = tag_records(project_opportunities(crm.scan_opportunities(opportunities_src(spark, sf), CTX.as_of), CTX), CTX, stamp_version=True)
    checked = union_families(*[validate_by_registry(f, versions, rules) for f in (bill, arr, opp)])
    return flat(checked).select("data_type", "account_id", "opportunity_id", val.REASON, val.WARNINGS)


# ---------------------------------------------------------------- run dates in one job
RUN_DATES = 30


@register("scan_opportunities_runs", Q.compose(f"""
SELECT as_of, Id, StageName, CloseDate AS close_date FROM v_opportunities,
       (SELECT cast(DATE '{CTX.as_of_iso}' - cast(n AS integer) AS date) AS as_of FROM range({RUN_DATES}) r(n))
WHERE CloseDate >= as_of - 180""", "v_opportunities"))
def q_scan_opportunities_runs(spark, sf):
    """What the recent-opportunities extract returns on each of thirty run dates."""
    runs = spark.range(RUN_DATES).select(F.date_sub(F.lit(CTX.as_of), F.col("id").cast("int")).alias("as_of"))
    found = crm.scan_opportunities_for_runs(opportunities_src(spark, sf), runs)
    return found.select("as_of", "Id", "StageName", F.col("CloseDate").alias("close_date"))


# ---------------------------------------------------------------- extract source
@register("paged_extract_source", Q.compose("""
SELECT Id, Name, AccountId, Amount, CloseDate AS close_date, IsClosed FROM v_opportunities
WHERE Id > 'OPP000000000001000' AND CloseDate >= DATE '1995-01-01' AND IsWon""", "v_opportunities"))
def q_paged_extract_source(spark, sf):
    """The opportunity extract landed as keyset pages and read as a partitioned source, its
    filters pushed into the pages."""
    src = opportunities_src(spark, sf)
    path = write_pages(src, scratch_path(spark, "pages"), PAGE, pages_per_chunk=2)
    found = read_pages(spark, path, src.schema).where(
        "Id > 'OPP000000000001000' AND CloseDate >= DATE '1995-01-01' AND IsWon = true")
    return found.select("Id", "Name", "AccountId", "Amount", F.col("CloseDate").alias("close_date"), "IsClosed")


# ---------------------------------------------------------------- envelope sink with commits
@register("stream_envelope_sink", Q.compose("""
SELECT line_item_id, account_id, cost, usage_type FROM billing""", "billing"))
def q_stream_envelope_sink(spark, sf):
    """All billing records delivered in envelopes by a committing sink, in several micro-batches, and
    read back from the committed envelopes."""
    rows = project_billing(billing_raw(spark, sf), CTX, keep=["identity/LineItemId"]).withColumnRenamed("identity/LineItemId", "line_item_id")
    landed, sink, ckpt = (scratch_path(spark, f"records-{n}") for n in ("landed", "sink", "ckpt"))
    rows.select(F.to_json(F.struct("line_item_id", "account_id", "cost", "usage_type"), {"ignoreNullFields": "false"}).alias("value")).write.text(landed)
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 4).text(landed)
    stream_envelopes(stream, sink, ckpt, CTX.customer_id)
    body = F.from_json("value", "data array<struct<line_item_id string, account_id string, cost double, usage_type string>>")
    return read_envelopes(spark, sink).select(F.explode(body["data"]).alias("r")).select("r.*")


# ---------------------------------------------------------------- counts taken while writing
@register("ingest_observed", Q.compose("""
SELECT data_type, count(*) AS total_records, count(*) FILTER (WHERE reject_reason IS NULL) AS processed_records,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS failed_records FROM all_val GROUP BY data_type""", "all_val"))
def q_ingest_observed(spark, sf):
    """Records of every family written once, their summary counted by the writing tasks."""
    target = scratch_path(spark, "ingested")
    families = [*REGISTRY, None]
    with open_writers(spark, len(families)):  # no sort of all whole records by family
        return ingest_observed(all_records(spark, sf), lambda d: d.write.option("compression", "zstd").partitionBy("data_type").parquet(target), families)


OBSERVED_WINDOW = (_dt.date(2001, 7, 1), _dt.date(2001, 8, 1))


@register("landing_observed", Q.compose(f"""
SELECT cost_date, count(*) AS record_count FROM daily
WHERE cost_date >= '{OBSERVED_WINDOW[0]}' AND cost_date < '{OBSERVED_WINDOW[1]}' GROUP BY cost_date""", "daily"))
def q_landing_observed(spark, sf):
    """A month of daily costs landed, the records of each day counted by the writing tasks."""
    path = scratch_path(spark, "observed")
    landed = land_daily_costs(cost_responses(spark, sf), None, CTX, OBSERVED_WINDOW)
    return landing_observed(landed, lambda d: write_partitioned_csv(d, path), OBSERVED_WINDOW)


# ---------------------------------------------------------------- refused files
@register("check_required_columns", Q.compose("""
SELECT 'month-' || billing_period AS file, CASE WHEN missing = '' THEN NULL ELSE missing END AS missing FROM (
  SELECT DISTINCT billing_period, CASE right(billing_period, 2) WHEN '01' THEN 'lineItem/UnblendedCost'
         WHEN '02' THEN 'lineItem/UnblendedCost,lineItem/UsageAccountId' WHEN '03' THEN 'lineItem/UsageAccountId' ELSE '' END AS missing
  FROM v_billing_raw)""", "v_billing_raw"))
def q_check_required_columns(spark, sf):
    """Which monthly exports the required-columns gate refuses, with the columns they lack (three
    months of each year are landed without some)."""
    folder = landing.land_monthly_exports(spark, sf)
    checked = bsrc.required_columns_report(spark, folder)
    month = F.regexp_extract("file", r"folder=(month-[0-9-]+)/", 1)
    return checked.groupBy(month.alias("file")).agg(F.max(F.array_join("missing", ",")).alias("missing")).select(
        "file", F.nullif("missing", F.lit("")).alias("missing"))
