"""Land driver-derived inputs in their source formats (CSV exports, Parquet
exports, cost-response JSON, queue messages, arrival events).

The reference reads files and messages that arrive from outside; these
writers produce the same shapes from the driver tables so the real scans run
over them. Files go to a fresh folder under the shared checkpoint folder and
are written once per session and input directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import open_writers, scratch_path
from ledgerlake.sources.adapters import BILLING_RAW_NAMES, billing_raw, table

_LANDED: dict[tuple[str, str, str], str] = {}
GROUPS_PER_RESPONSE = 1000  # target groups per response document (pages spread by hash)
DOCS_PER_FILE = 1000
MONTHS_OPEN = 120  # months of responses that one task writes without sorting them


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = scratch_path(spark, name)
        write(path)
        _LANDED[key] = path
    return _LANDED[key]


def land_extract(spark: SparkSession, sf_dir: str, view: str) -> str:
    """A CRM extract (adapter view) landed as a Parquet table, as an extract job would."""
    from ledgerlake.sources.adapters import adapter
    return _once(spark, sf_dir, f"extract-{view}", lambda path: adapter(spark, sf_dir, view).write.parquet(path))


ROWS_PER_EXPORT = 100_000  # an export file is one scan task where cells may hold newlines


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export lines with one cell too many (an unquoted comma), from first line items
    of every hundredth order."""
    raw = billing_raw(spark, sf_dir).filter(F.col("`identity/LineItemId`").endswith("00-1"))
    cells = [F.concat(F.col(f"`{c}`"), F.lit(",x")) if c == "lineItem/ResourceId" else F.col(f"`{c}`")
             for c in raw.columns]
    return raw.select(F.concat_ws(",", *cells).alias("line"))


def _write_malformed(spark: SparkSession, sf_dir: str, path: str, compression: str = "none") -> None:
    """As CSV files of bounded length under the export's own header; a separator that no
    cell holds keeps Spark from quoting the lines."""
    header = ",".join(BILLING_RAW_NAMES.values())
    (malformed_lines(spark, sf_dir).withColumnRenamed("line", header)
     .write.mode("append").option("maxRecordsPerFile", ROWS_PER_EXPORT).option("compression", compression).option("header", "true").option("sep", "\u0001").csv(path))


def land_billing_csv(spark: SparkSession, sf_dir: str) -> str:
    """The billing export as gzipped header CSV files of bounded length (a file whose cells may hold
    newlines is one task in any case), some lines malformed."""
    def write(path):
        (billing_raw(spark, sf_dir).write.option("maxRecordsPerFile", ROWS_PER_EXPORT).option("compression", "gzip")
         .option("header", "true").option("escape", '"').csv(path))
        _write_malformed(spark, sf_dir, path, "gzip")
    return _once(spark, sf_dir, "billing-csv", write)


def land_monthly_exports(spark: SparkSession, sf_dir: str) -> str:
    """Billing exports by month (``month-<yyyy-MM>/``), as CSV files of four layouts: those of January,
    February and March lack a required column or two."""
    cost, account = "lineItem/UnblendedCost", "lineItem/UsageAccountId"
    gone = {"01": [cost], "02": [cost, account], "03": [account]}

    def write(path):
        raw = billing_raw(spark, sf_dir)
        month = F.substring("`bill/BillingPeriod`", -2, 2)
        some = {k: raw.where(month == k).drop(*v) for k, v in gone.items()}
        some["rest"] = raw.where(~month.isin(list(gone)))
        for rows in some.values():
            rows = rows.withColumn("folder", F.concat(F.lit("month-"), F.col("`bill/BillingPeriod`")))
            (rows.hint("rebalance", "folder").write.mode("append").option("maxRecordsPerFile", ROWS_PER_EXPORT)
             .option("header", "true").option("escape", '"').partitionBy("folder").csv(path))
    return _once(spark, sf_dir, "billing-months", write)


def land_billing_parquet(spark: SparkSession, sf_dir: str) -> str:
    def write(path):
        billing_raw(spark, sf_dir).write.parquet(path)
    return _once(spark, sf_dir, "billing-parquet", write)


def land_billing_mixed(spark: SparkSession, sf_dir: str) -> list[str]:
    """Open line items and malformed lines as CSV, final ones as Parquet, in one folder."""
    def write(path):
        raw = billing_raw(spark, sf_dir)
        is_open = F.col("`lineItem/UsageType`").endswith("O")
        raw.filter(is_open).write.option("header", "true").option("escape", '"').csv(path + "/open")
        raw.filter(~is_open).write.parquet(path + "/final")
        _write_malformed(spark, sf_dir, path + "/open")
    path = _once(spark, sf_dir, "billing-mixed", write)
    csv_files = spark.read.text(path + "/open").inputFiles()
    pq_files = spark.read.parquet(path + "/final").inputFiles()
    return sorted(csv_files) + sorted(pq_files)


def land_cost_responses(spark: SparkSession, sf_dir: str, daily: DataFrame) -> str:
    """Daily cost rows -> response documents ``{ResultsByTime: [{TimePeriod, Groups}]}``.

    One document per (day, page), landed under ``cost_month=<yyyy-MM>/`` so that a window
    reads its months only (folders of one day would be many tiny files); Spark splits a large
    month over tasks, and a file holds at most ``DOCS_PER_FILE`` documents. Each day gets ``ceil(groups / 1000)`` pages
    (from a one-row-per-day count, joined behind the size check) and a group
    goes to the page its key hashes to, so a document holds about 1000 groups
    however many accounts a day has. The aggregate runs once.
    """
    from ledgerlake.operators.joins import lookup_side
    from ledgerlake.session import materialized

    def write(path):
        rows = materialized(daily, "daily")
        pages = rows.groupBy("cost_date").agg(
            F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / GROUPS_PER_RESPONSE)).alias("_pages"))
        groups = rows.join(lookup_side(pages), "cost_date").select(
            "cost_date",
            F.pmod(F.xxhash64("service", "account_id"), F.col("_pages")).alias("page"),
            F.struct("service", "account_id", "amount").alias("g"))
        # bare values are shuffled; a document takes its nested form in the task that writes it
        docs = groups.groupBy("cost_date", "page").agg(F.collect_list("g").alias("_g")).select(
            F.substring("cost_date", 1, 7).alias("cost_month"), "cost_date", "_g").hint("rebalance", "cost_month")
        nested = F.transform("_g", lambda g: F.struct(
            F.array(g["service"], g["account_id"]).alias("Keys"),
            F.struct(F.struct(g["amount"].alias("Amount"), F.lit("USD").alias("Unit")).alias("UnblendedCost")).alias("Metrics")))
        period = F.struct(F.col("cost_date").alias("Start"),
                          F.date_format(F.date_add(F.to_date("cost_date"), 1), "yyyy-MM-dd").alias("End"))
        out = docs.select("cost_month", F.to_json(F.struct(F.array(F.struct(period.alias("TimePeriod"), nested.alias("Groups")))
                                                           .alias("ResultsByTime"))).alias("value"))
        with open_writers(spark, MONTHS_OPEN):
            (out.write.option("compression", "gzip").option("maxRecordsPerFile", DOCS_PER_FILE)
             .partitionBy("cost_month").text(path))
    return _once(spark, sf_dir, "cost-responses", write)


def arrival_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival events derived from orders and their line items.

    Priority 1 orders become direct billing actions, priority 2 CRM actions,
    priority 3 queue deliveries; the rest are object-created notifications
    with one record per line item. Bucket names follow the order status
    (one of them invalid on purpose, as real traffic can be).
    """
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    day = F.col("o_orderdate")
    bucket = (F.when(F.col("o_orderstatus") == "F", F.lit("billing-exports"))
              .when(F.col("o_orderstatus") == "O", F.lit("Billing_Exports")).otherwise(F.lit("bx")))
    key = F.format_string("aws-cur/year=%s/month=%s/day=%s/cost-report-%s.csv",
                          F.date_format(day, "yyyy"), F.date_format(day, "MM"), F.date_format(day, "dd"),
                          F.date_format(day, "yyyyMMdd"))
    prio = F.substring("o_orderpriority", 1, 1)
    items = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", F.format_string("aws-cur/%s/li-%d-%d.csv", F.date_format("l_shipdate", "yyyy-MM-dd"),
                                        "l_orderkey", "l_linenumber").alias("k")))).alias("items"))
    j = orders.join(items, orders.o_orderkey == items.l_orderkey, "left")
    s3_records = F.transform(F.coalesce(F.col("items"), F.array()), lambda it: F.struct(
        F.lit("aws:s3").alias("eventSource"),
        F.struct(F.struct(bucket.alias("name")).alias("bucket"),
                 F.struct(it["k"].alias("key")).alias("object")).alias("s3")))
    sqs = F.array(F.struct(F.lit("aws:sqs").alias("eventSource"),
                           F.format_string("order-%d", "o_orderkey").alias("body")))
    text = (F.when(prio == "1", F.to_json(F.struct(F.lit("cur").alias("action"), bucket.alias("bucket"),
                                                   key.alias("key"))))
            .when(prio == "2", F.to_json(F.struct(F.lit("salesforce").alias("action"))))
            .when(prio == "3", F.to_json(F.struct(sqs.alias("Records"))))
            .otherwise(F.to_json(F.struct(s3_records.alias("Records")))))
    return j.select(F.col("o_orderkey").alias("event_id"), text.alias("value"))


def land_arrival_events(spark: SparkSession, sf_dir: str) -> str:
    """The arrival events landed as an event-log table ``(event_id, value)``,
    as a queue or notification archive would hold them."""
    return _once(spark, sf_dir, "arrival-events",
                 lambda path: arrival_events(spark, sf_dir).write.parquet(path))
