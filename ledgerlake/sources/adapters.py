"""Adapters: source-shaped views over the driver tables.

The reference's inputs come from live APIs that are not in the repository, so
the record sources are rebuilt as views over the TPC-H-like driver tables. One
SQL text per view serves both engines: Spark formats the ``{table}``
placeholders with DataFrames (no global temp views), the DuckDB oracle with
plain view names. Each view grows with the tables it reads.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

ADAPTER_SQL: dict[str, str] = {
    # CRM accounts: 'Customer' unless the nation key is a multiple of 5; some ARR null / negative.
    "v_accounts": """
SELECT 'ACC' || lpad(cast(c_custkey AS string), 15, '0') AS Id, c_name AS Name, c_mktsegment AS Industry,
       CASE WHEN c_nationkey % 5 = 0 THEN 'Prospect' ELSE 'Customer' END AS Type,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS Arr
FROM {customer}""",
    # CRM opportunities: some ids too short, some amounts null or negative.
    "v_opportunities": """
SELECT 'OPP' || lpad(cast(o_orderkey AS string), CASE WHEN o_orderkey % 17 = 0 THEN 9 ELSE 15 END, '0') AS Id,
       'Order ' || cast(o_orderkey AS string) AS Name, 'ACC' || lpad(cast(o_custkey AS string), 15, '0') AS AccountId,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -o_totalprice ELSE o_totalprice END AS Amount,
       CASE o_orderstatus WHEN 'O' THEN 'Prospecting' WHEN 'F' THEN 'Closed Won' ELSE 'Closed Lost' END AS StageName,
       cast(o_orderdate AS date) AS CloseDate, o_orderpriority AS Type,
       cast(substr(o_orderpriority, 1, 1) AS int) * 20.0E0 AS Probability,
       o_orderstatus <> 'O' AS IsClosed, o_orderstatus = 'F' AS IsWon
FROM {orders}""",
    # Billing usage rows: 'n/a' costs, sub-cent costs, blank usage, credits, malformed account ids.
    "v_billing_raw": """
SELECT 'li-' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) AS line_item_id,
       CASE l_suppkey % 5 WHEN 0 THEN '123456789012' WHEN 1 THEN '234567890123' WHEN 2 THEN '345678901234'
            WHEN 3 THEN lpad(cast(l_suppkey AS string), 12, '0') ELSE 'short-' || cast(l_suppkey AS string) END AS account_id,
       'svc-' || cast(l_partkey % 20 AS string) AS product_code, 'i-' || cast(l_partkey AS string) AS resource_id,
       'Use:' || l_returnflag || l_linestatus AS usage_type,
       CASE WHEN l_linenumber = 7 THEN 'n/a'
            WHEN l_linenumber = 5 THEN '0.00' || lpad(cast(cast(l_quantity AS int) AS string), 2, '0') WHEN l_returnflag = 'R' THEN cast(-l_extendedprice AS string)
            ELSE cast(l_extendedprice AS string) END AS unblended_cost,
       CASE WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN '' ELSE cast(l_quantity AS string) END AS usage_amount,
       substr(cast(l_shipdate AS string), 1, 7) AS billing_period, l_shipdate AS usage_start
FROM {lineitem}""",
    # The three-entry account map.
    "v_account_map": """
SELECT * FROM (VALUES ('123456789012','production'),('234567890123','staging'),('345678901234','development'))
  AS m(account_id, cost_category)""",
    # Account-map items from a key-value store: one per supplier, business unit from the
    # nation, some incomplete, and repeated keys where the last item (highest seq) wins.
    "v_account_items": """
SELECT CASE WHEN s_suppkey % 10 = 0 THEN '123456789012' ELSE lpad(cast(s_suppkey AS string), 12, '0') END AS account_id,
       CASE WHEN s_nationkey % 6 = 0 THEN NULL ELSE lower(n_name) END AS business_unit,
       s_suppkey AS seq
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    # Configuration-like JSON documents, one per order: nested lists, sensitive keys with true and
    # false values, a null; every 97th is not JSON. Keys are sorted; each row
    # asks for one path. (Doubled braces are literal ones.)
    "v_config_documents": """
SELECT o_orderkey AS id,
       '{{"auth":{{"Password":' || CASE o_orderkey % 4 WHEN 0 THEN '""' WHEN 1 THEN 'null' WHEN 2 THEN '"p-' || cast(o_custkey AS string) || '"' ELSE '0' END
       || ',"user":"' || o_orderpriority || '"}},"note":null,"order":' || cast(o_orderkey AS string)
       || ',"sinks":[{{"api_token":' || CASE WHEN o_orderkey % 3 = 0 THEN 'false' ELSE '"t' || cast(o_custkey AS string) || '"' END
       || ',"url":"https://h' || cast(o_custkey AS string) || '/[{{"}},[{{"client_secret":' || CASE WHEN o_orderkey % 7 = 0 THEN '{{}}' ELSE '{{"a":[1]}}' END
       || ',"retries":' || cast(o_orderkey % 5 AS string) || '}}]],"tokens":' || CASE WHEN o_orderkey % 5 = 0 THEN '[1]' ELSE '[]' END
       || CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE '}}' END AS document,
       CASE o_orderkey % 8 WHEN 0 THEN 'auth.user' WHEN 1 THEN 'auth.Password' WHEN 2 THEN 'auth.nobody' WHEN 3 THEN 'note'
            WHEN 4 THEN 'sinks' WHEN 5 THEN 'order' WHEN 6 THEN 'order.line' ELSE 'auth' END AS path
FROM {orders}""",
    # Delivery outcome log: one row per POST attempt; three consecutive events form a batch.
    "v_delivery_log": """
SELECT event_id, user_id % 8 AS sink_id, ts, cast(floor(event_id / 3) AS bigint) AS batch_no,
       CASE event_type WHEN 'signup' THEN 429 WHEN 'error' THEN 503
            WHEN 'purchase' THEN (CASE WHEN event_id % 2 = 0 THEN 400 ELSE 403 END)
            WHEN 'click' THEN (CASE WHEN event_id % 3 = 0 THEN 418 ELSE 200 END) ELSE 202 END AS status_code,
       event_id % 3 + 1 AS attempt,
       CASE WHEN event_type = 'signup' AND event_id % 4 = 0 THEN cast(floor(value) AS int) END AS retry_after
FROM {events}""",
}

# Billing adapter column -> raw slash-named billing column.
BILLING_RAW_NAMES = {
    "line_item_id": "identity/LineItemId",
    "account_id": "lineItem/UsageAccountId",
    "product_code": "lineItem/ProductCode",
    "resource_id": "lineItem/ResourceId",
    "usage_type": "lineItem/UsageType",
    "unblended_cost": "lineItem/UnblendedCost",
    "usage_amount": "lineItem/UsageAmount",
    "billing_period": "bill/BillingPeriod",
    "usage_start": "lineItem/UsageStartDate",
}


# Row-heavy tables whose rows feed per-row work (parsing, hashing, JSON).
FACT_TABLES = ("lineitem", "orders")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one partition per core of the session.

    A Parquet row group is never split, so a large single-row-group file
    scans as one busy task and every per-row expression after it runs on one
    core. Such a scan is round-robin repartitioned over the session's cores.
    A large input already has many more splits than cores and is returned
    unchanged, so this adds no shuffle at scale. Filters and column pruning
    still reach the scan through the repartition.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if name in FACT_TABLES else df


def _referenced(sql: str) -> list[str]:
    return [t for t in TABLES if "{" + t + "}" in sql]


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = ADAPTER_SQL[name]
    frames = {t: table(spark, sf_dir, t) for t in _referenced(sql)}
    return spark.sql(sql, **frames)


def duck_sql(name: str) -> str:
    """The same view text for DuckDB, where the driver tables are plain views."""
    sql = ADAPTER_SQL[name]
    return sql.format(**{t: t for t in _referenced(sql)})


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named adapter views, for oracle SQL."""
    return "WITH " + ",\n".join(f"{n} AS ({duck_sql(n)})" for n in names) + "\n"


def billing_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw billing rows with slash-named string columns (all text, as in a CSV export)."""
    df = adapter(spark, sf_dir, "v_billing_raw")
    return df.select([F.col(k).cast("string").alias(v) for k, v in BILLING_RAW_NAMES.items()])


BILLING_RAW_DUCK = ", ".join(
    f'cast({k} AS varchar) AS "{v}"' for k, v in BILLING_RAW_NAMES.items())
