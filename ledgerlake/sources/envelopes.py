"""Work / dead-letter envelopes (JSON text) -> records, with visible failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import ENVELOPE

WORK_TYPES = ("salesforce_batch", "cur_batch")


def scan_batch_envelopes(messages: DataFrame, column: str = "value") -> DataFrame:
    """Message bodies -> one row per record, in one parse and one explode.

    Columns: envelope type / batch fields, ``record_index``, ``record``
    (``map<string,string>`` of the raw JSON record) and ``reject_reason`` for
    message-level failures: an unparsable body (``unparsable_message``) or an
    unknown type (``unknown_message_type``) yields one quarantine row holding
    the body instead of being dropped. An envelope with no records yields nothing.
    """
    body = F.col(column)
    m = F.from_json(body, ENVELOPE)
    # the keys tell more than the parse does: a body with a bare NaN, say, is no JSON
    reason = (F.when(F.json_object_keys("_body").isNull(), F.lit("unparsable_message"))
              .when(~F.coalesce(F.col("m.type").isin(*WORK_TYPES), F.lit(False)), F.lit("unknown_message_type")))
    # the fields of a message stand by themselves before its records are dealt out: else every
    # record would carry all records of its message through the explode
    parsed = messages.select(m.alias("m"), body.alias("_body")).select(
        F.col("m.type").alias("message_type"), F.col("m.timestamp").alias("message_timestamp"),
        F.col("m.batch_number").alias("batch_number"), F.col("m.total_batches").alias("total_batches"),
        F.col("m.records").alias("_records"), reason.alias("reject_reason"), "_body")
    items = F.when(F.col("reject_reason").isNull(), F.col("_records")).otherwise(
        F.array(F.create_map(F.lit("body"), F.col("_body"))))
    exploded = parsed.select("message_type", "message_timestamp", "batch_number", "total_batches",
                             F.posexplode(items).alias("record_index", "record"), "reject_reason")
    return exploded.withColumn("record_index",
                               F.when(F.col("reject_reason").isNull(), F.col("record_index")))


def record_field(name: str, dtype: str = "string"):
    """A typed field of a raw record (NULL when the key is absent)."""
    v = F.try_element_at(F.col("record"), F.lit(name))
    return (v if dtype == "string" else v.try_cast(dtype)).alias(name)
