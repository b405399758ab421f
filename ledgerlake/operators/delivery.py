"""Delivery-log analysis: outcome classes, retry plans, dead letters, breaker trips.

The reference sends batches over HTTP with retries and a circuit breaker. Here
the network loop is not rebuilt; its decisions are computed from a log of
delivery attempts so they can be audited at any volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.ordering import SHARD, sharded
from ledgerlake.session import materialized

DELIVERED, RATE_LIMITED, RETRYABLE, NON_RETRYABLE = "delivered", "rate_limited", "retryable", "non_retryable"

# FIXED VALUES: retry policy of the sender and the CRM client.
MAX_ATTEMPTS = 3
DEFAULT_RETRY_AFTER = 5
CRM_BACKOFF_BASE = 5
BREAKER_THRESHOLD = 5


def classify_delivery(status: Column) -> Column:
    """2xx delivered; 429 rate limited; >=500 retryable; 400/401/403 non-retryable;
    any other answer retryable."""
    return (F.when((status >= 200) & (status < 300), F.lit(DELIVERED))
            .when(status == 429, F.lit(RATE_LIMITED))
            .when(status >= 500, F.lit(RETRYABLE))
            .when(status.isin(400, 401, 403), F.lit(NON_RETRYABLE))
            .otherwise(F.lit(RETRYABLE)))


def plan_retry_delay(df: DataFrame, status_col: str = "status_code", attempt_col: str = "attempt",
                     retry_after_col: str = "retry_after") -> DataFrame:
    """Next step after each answer.

    * rate limited: wait ``Retry-After`` (default 5 s), the attempt count is not
      increased (the reference loops forever on repeated 429s);
    * retryable: wait ``2^attempt`` s; after the third failure the batch is
      dead-lettered;
    * non-retryable: dead-lettered at once; delivered: done.
    ``crm_wait_seconds`` is the CRM client's back-off ``2^(attempt-1) * 5`` s,
    which gives up after the third attempt.
    """
    cls = classify_delivery(F.col(status_col))
    attempt = F.col(attempt_col)
    wait = (F.when(cls == RATE_LIMITED, F.coalesce(F.col(retry_after_col), F.lit(DEFAULT_RETRY_AFTER))
                   .cast("double"))
            .when(cls == RETRYABLE, F.pow(F.lit(2.0), attempt)))
    action = (F.when(cls == DELIVERED, F.lit("done"))
              .when(cls == RATE_LIMITED, F.lit("retry"))
              .when(cls == NON_RETRYABLE, F.lit("dead_letter"))
              .when(attempt >= MAX_ATTEMPTS, F.lit("dead_letter"))
              .otherwise(F.lit("retry")))
    next_attempt = (F.when(cls == RATE_LIMITED, attempt)
                    .when((cls == RETRYABLE) & (attempt < MAX_ATTEMPTS), attempt + 1))
    crm_wait = F.when(attempt < MAX_ATTEMPTS,
                      F.pow(F.lit(2.0), attempt - 1) * CRM_BACKOFF_BASE)
    return df.withColumns({
        "delivery_class": cls, "next_action": action, "wait_seconds": wait,
        "next_attempt": next_attempt, "crm_wait_seconds": crm_wait,
    })


def split_dead_letters(log: DataFrame, batch_col: str = "batch_no",
                       status_col: str = "status_code") -> DataFrame:
    """Per batch: delivered if any 2xx; dead-lettered after a non-retryable answer
    or ``MAX_ATTEMPTS`` retryable failures; otherwise still pending."""
    cls = classify_delivery(F.col(status_col))
    per_batch = log.groupBy(batch_col).agg(
        F.bool_or(cls == DELIVERED).alias("delivered"),
        F.count_if(cls == RETRYABLE).alias("retryable_failures"),
        F.bool_or(cls == NON_RETRYABLE).alias("non_retryable"),
        F.count_if(cls == RATE_LIMITED).alias("rate_limited"),
        F.count(F.lit(1)).alias("attempts"),
    )
    return per_batch.withColumn(
        "outcome",
        F.when(F.col("delivered"), F.lit("delivered"))
         .when(F.col("non_retryable") | (F.col("retryable_failures") >= MAX_ATTEMPTS), F.lit("dead_letter"))
         .otherwise(F.lit("pending")))


def failure_run_trips(log: DataFrame, sink_col: str = "sink_id", ts_col: str = "ts",
                      id_col: str = "event_id", status_col: str = "status_code",
                      threshold: int = BREAKER_THRESHOLD, shards: int | None = None) -> DataFrame:
    """Rows where a sink's breaker trips: the ``threshold``-th failure since the last
    success (or since the start). Rate-limited answers neither count nor reset.

    Skew-safe form of a per-sink running count: the log is range-partitioned on
    (sink, ts, id) into balanced, contiguous shards; running counts are taken inside
    (shard, sink) groups, whose size is bounded by a shard, and written once for both
    the summary and the trips; the failures a sink carries into a shard from earlier shards come from a per-(shard, sink)
    summary. Only the first sink of a shard can carry anything in, so the
    carry table has at most one row per shard and is broadcast.
    """
    cls = classify_delivery(F.col(status_col))
    ev = log.filter(cls != RATE_LIMITED).withColumns({
        "_succ": (cls == DELIVERED).cast("int"), "_fail": (cls != DELIVERED).cast("int")})
    sh = sharded(ev.select(sink_col, ts_col, id_col, status_col, "_succ", "_fail"), [sink_col, ts_col, id_col], shards)

    w = Window.partitionBy(SHARD, sink_col).orderBy(ts_col, id_col)
    run = Window.partitionBy(SHARD, sink_col, "_seg").orderBy(ts_col, id_col)
    local = materialized(
        sh.withColumn("_seg", F.sum("_succ").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_since", F.sum("_fail").over(run.rowsBetween(Window.unboundedPreceding, 0))), "failure-runs")

    # Per (shard, sink): did a success occur, and failures after the last one.
    summary = local.groupBy(SHARD, sink_col).agg(
        (F.max("_seg") > 0).alias("_has_succ"),
        F.max_by("_since", F.struct(ts_col, id_col)).alias("_trailing"))
    ws = Window.partitionBy(sink_col).orderBy(SHARD)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    cum_before = F.coalesce(F.sum("_trailing").over(before), F.lit(0))
    carry = (summary.withColumn("_cum_before", cum_before)
             .withColumn("_base", F.coalesce(
                 F.last(F.when(F.col("_has_succ"), F.col("_cum_before")),
                        ignorenulls=True).over(before), F.lit(0)))
             .select(SHARD, sink_col, (F.col("_cum_before") - F.col("_base")).alias("_carry"))
             .filter(F.col("_carry") > 0))

    counted = local.join(F.broadcast(carry), [SHARD, sink_col], "left").withColumn(
        "failures_since_success",
        F.col("_since") + F.when(F.col("_seg") == 0, F.coalesce(F.col("_carry"), F.lit(0))).otherwise(0))
    trips = counted.filter((F.col("_fail") == 1) & (F.col("failures_since_success") == threshold))
    return trips.select(sink_col, id_col, ts_col, status_col, "failures_since_success")


def deliver_batches(batches: DataFrame, outcomes: DataFrame, batch_col: str = "batch_no") -> DataFrame:
    """Each numbered record (``batch_col``) with its batch's ``outcome`` from
    ``split_dead_letters``; a batch that the log does not mention is ``pending``.
    Many records meet one outcome row, so a large batch splits on the records' side."""
    known = outcomes.select(F.col(batch_col).alias("_batch"), "outcome")
    return (batches.join(known, batches[batch_col] == known["_batch"], "left").drop("_batch")
            .withColumn("outcome", F.coalesce("outcome", F.lit("pending"))))


def delivery_summary(delivered: DataFrame, by: str = "data_type") -> DataFrame:
    """Records per group that were delivered, dead-lettered, or are still pending."""
    return delivered.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("outcome") == "delivered").alias("delivered"),
        F.count_if(F.col("outcome") == "dead_letter").alias("dead_lettered"),
        F.count_if(F.col("outcome") == "pending").alias("pending"))


def trips_per_sink(trips: DataFrame, sink_col: str = "sink_id") -> DataFrame:
    return trips.groupBy(sink_col).agg(F.count(F.lit(1)).alias("trips"))
