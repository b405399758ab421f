"""Bounded JSON envelopes around batches of records.

Records are numbered in a total order and cut into contiguous batches of at
most N (``assign_batches``). Plain columns travel through the numbering and to the task that
gathers a batch; only there is each record completed (``finish``) and serialised, once, to
compact JSON text, so that the text of a record is never sorted, shuffled or stored. A
``groupBy`` whose groups hold at most N (row number, text) pairs gathers a batch, and
the envelope is the sorted texts joined inside the envelope's own fields. Record
order inside an envelope follows the batch order.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.ordering import assign_batches

JSON_OPTS = {"ignoreNullFields": "false"}

# FIXED VALUES: batch sizes of the reference's messages.
DELIVERY_BATCH = 1000      # records per collector POST
CRM_WORK_BATCH = 100       # records per CRM work message
BILLING_WORK_BATCH = 1000  # records per billing work message
DEAD_LETTER_CHUNK = 10     # records per dead-letter message

# A gathering task holds about this many records: their batches stay in its hash table.
RECORDS_PER_TASK = 50_000
BATCHES_PER_TASK = 64

Finish = Callable[[DataFrame], DataFrame]


def record_json(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """The whole record as a JSON object text, NULL fields kept."""
    cols = [c for c in df.columns if c not in exclude]
    return F.to_json(F.struct(*[F.col(c) for c in cols]), JSON_OPTS)


def batched_records(df: DataFrame, size: int, order: Sequence[str],
                    shards: int | None = None, finish: Finish | None = None) -> DataFrame:
    """One row per batch: ``batch_number``, ``total_batches``, ``record_count`` and
    ``records_json`` (the batch's records as a JSON array text, in order).

    ``finish`` completes the numbered rows, one row for each (a lookup, constants, tags), and may
    change no column of ``order``: what it adds is neither sorted nor shuffled. It
    must keep the columns ``_batch``, ``_batches`` and ``_nth``, which are no part of a record.
    """
    numbered = assign_batches(df, size, order, shards, keep_row_number=True).withColumnsRenamed(
        {"batch_number": "_batch", "total_batches": "_batches", "row_number": "_nth"})
    placed = numbered.repartition(_gathering_tasks(numbered, size), "_batch", "_batches")
    records = placed if finish is None else finish(placed)
    texts = records.select("_batch", "_batches", "_nth", record_json(records, ("_batch", "_batches", "_nth")).alias("_json"))
    grouped = texts.groupBy("_batch", "_batches").agg(
        F.sort_array(F.collect_list(F.struct("_nth", "_json"))).alias("_items"))
    return grouped.select(
        F.col("_batch").alias("batch_number"), F.col("_batches").alias("total_batches"),
        F.size("_items").cast("long").alias("record_count"),
        F.concat(F.lit("["), F.array_join(F.transform("_items", lambda x: x["_json"]), ","),
                 F.lit("]")).alias("records_json"))


def _gathering_tasks(numbered: DataFrame, size: int) -> int:
    """So many that a task gathers a bounded number of batches and records (the numbered rows lie in
    a written table: counting them reads one narrow column), and no fewer than cores."""
    rows = numbered.count()
    batches = math.ceil(rows / size)
    cores = numbered.sparkSession.sparkContext.defaultParallelism
    return max(1, min(cores, batches), math.ceil(rows / RECORDS_PER_TASK), math.ceil(batches / (16 * BATCHES_PER_TASK)))


def _envelope(fields: list[tuple[str, Column | str | None]]) -> Column:
    """A JSON object text from (name, value) pairs: Python constants are rendered
    once on the driver, Columns are JSON texts (records) or integers."""
    parts: list[Column] = []
    for i, (name, value) in enumerate(fields):
        prefix = ("{" if i == 0 else ",") + json.dumps(name) + ":"
        if isinstance(value, Column):
            parts += [F.lit(prefix), value.cast("string")]
        else:
            parts.append(F.lit(prefix + json.dumps(value)))
    return F.concat(*parts, F.lit("}"))


def envelope_delivery_batches(df: DataFrame, order: Sequence[str], customer_id: str,
                              size: int = DELIVERY_BATCH, shards: int | None = None,
                              finish: Finish | None = None) -> DataFrame:
    """``{customer_id, data: [<= size records]}`` per batch (collector POST bodies)."""
    b = batched_records(df, size, order, shards, finish)
    body = _envelope([("customer_id", customer_id), ("data", F.col("records_json"))])
    return b.select("batch_number", "total_batches", "record_count", body.alias("value"))


def envelope_work_batches(df: DataFrame, order: Sequence[str], kind: str, sent_at: str,
                          size: int | None = None, numbered: bool | None = None,
                          shards: int | None = None, finish: Finish | None = None) -> DataFrame:
    """Work messages: CRM ``{type, records <= 100, timestamp}``; billing
    ``{type, records <= 1000, timestamp, batch_number, total_batches}``."""
    billing = kind == "cur_batch"
    size = size or (BILLING_WORK_BATCH if billing else CRM_WORK_BATCH)
    numbered = billing if numbered is None else numbered
    b = batched_records(df, size, order, shards, finish)
    fields = [("type", kind), ("records", F.col("records_json")), ("timestamp", sent_at)]
    if numbered:
        fields += [("batch_number", F.col("batch_number")), ("total_batches", F.col("total_batches"))]
    return b.select("batch_number", "total_batches", "record_count", _envelope(fields).alias("value"))


def envelope_dead_letters(df: DataFrame, order: Sequence[str], sent_at: str,
                          customer_id: str | None = None, failed_at: str | None = None,
                          size: int = DEAD_LETTER_CHUNK, shards: int | None = None,
                          finish: Finish | None = None) -> DataFrame:
    """Dead-letter chunks ``{records <= 10, timestamp[, customer_id, failed_timestamp]}``."""
    b = batched_records(df, size, order, shards, finish)
    fields = [("records", F.col("records_json")), ("timestamp", sent_at)]
    if customer_id is not None:
        fields += [("customer_id", customer_id), ("failed_timestamp", failed_at)]
    return b.select("batch_number", "total_batches", "record_count", _envelope(fields).alias("value"))
