"""Arrival events: object-created notifications, queue deliveries, direct actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import ARRIVAL_EVENT

# FIXED VALUES: bucket-name rule and key-length limit applied to arrival events.
BUCKET_NAME = r"\A[a-z0-9][a-z0-9\.\-]{1,61}[a-z0-9]\z"
MAX_KEY_LENGTH = 1024
DIRECT_ACTIONS = ("salesforce", "cur")


def _check(bucket: Column, key: Column) -> Column:
    return (F.when(bucket.isNull(), F.lit("missing:bucket"))
            .when(key.isNull(), F.lit("missing:key"))
            .when(~bucket.rlike(BUCKET_NAME), F.lit("invalid_bucket"))
            .when(F.length(key) > MAX_KEY_LENGTH, F.lit("invalid_key")))


def _item(kind: Column, bucket: Column, key: Column, body: Column, reason: Column) -> Column:
    s = "string"
    return F.struct(kind.cast(s).alias("kind"), bucket.cast(s).alias("bucket"), key.cast(s).alias("key"),
                    body.cast(s).alias("body"), reason.cast(s).alias("reason"))


def parse_arrival_events(events: DataFrame, column: str = "value", id_col: str | None = None,
                         keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON event text -> one row per contained record, in one parse and one explode.

    Direct actions (``{"action": ...}``) give one row; notification events give
    one row per entry of ``Records`` (all of them, not only the first);
    anything else gives one ``unsupported`` row. Columns: ``event_id`` (if
    given), the columns named in ``keep``, ``record_index``, ``kind`` (crm_sync | billing_file | queue_message |
    unsupported), ``bucket``, ``key``, ``body``, ``reason``, ``ok``.
    """
    kept = [F.col(id_col).alias("event_id")] if id_col else []
    kept += [F.col(c) for c in keep]
    e = F.from_json(F.col(column), ARRIVAL_EVENT)
    action, records = e["action"], F.coalesce(e["Records"], F.array())
    null = F.lit(None)

    direct = F.array(_item(
        F.when(action == "salesforce", F.lit("crm_sync")).otherwise(F.lit("billing_file")),
        F.when(action == "cur", e["bucket"]), F.when(action == "cur", e["key"]), null,
        F.when(action == "cur", _check(e["bucket"], e["key"]))))

    def per_record(r):
        src, bucket, key = r["eventSource"], r["s3"]["bucket"]["name"], r["s3"]["object"]["key"]
        return _item(
            F.when(src == "aws:s3", F.lit("billing_file")).when(src == "aws:sqs", F.lit("queue_message"))
             .otherwise(F.lit("unsupported")),
            bucket, key, r["body"],
            F.when(src == "aws:s3", _check(bucket, key))
             .when(src == "aws:sqs", F.when(r["body"].isNull(), F.lit("missing:body")))
             .otherwise(F.lit("unsupported_event")))

    unsupported = F.array(_item(F.lit("unsupported"), null, null, null, F.lit("unsupported_event")))
    items = (F.when(F.coalesce(action.isin(*DIRECT_ACTIONS), F.lit(False)), direct)
             .when(F.size(records) > 0, F.transform(records, per_record))
             .otherwise(unsupported))
    out = events.select(*kept, F.posexplode(items).alias("record_index", "r"))
    return out.select(*(["event_id"] if id_col else []), *keep, "record_index", "r.*").withColumn(
        "ok", F.col("reason").isNull())
