"""Structured Streaming jobs: each landed file or message file is processed once.

The reference triggers ingestion twice per landed file (object notification
plus a direct call). Here a file stream with a checkpoint replaces both: the
source log records every file it has handed to a micro-batch, so a rerun over
the same folder finds nothing new. ``trigger(availableNow=True)`` drains what
is there and stops, which suits a scheduled run; a continuous deployment uses
``processingTime`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.validate import validate_scanned_records
from ledgerlake.params import DEFAULT_CONTEXT, RunContext
from ledgerlake.plans.pipelines import ingest_billing
from ledgerlake.sources.billing import BILLING_FILES, empty_files, readable_files, scan_by_format
from ledgerlake.sources.envelopes import scan_batch_envelopes


def _run(query_builder, checkpoint: str, available_now: bool = True):
    writer = query_builder.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    q.awaitTermination()
    return q


def stream_billing_files(spark: SparkSession, landing: str, account_map: DataFrame,
                         sink: str, quarantine: str, checkpoint: str,
                         ctx: RunContext = DEFAULT_CONTEXT, max_files_per_trigger: int = 1000):
    """Billing CSV and Parquet files of any layout -> validated Parquet.

    The stream is the list of new ``.csv`` / ``.csv.gz`` / ``.parquet`` files (names only, at most
    ``max_files_per_trigger`` per micro-batch); each micro-batch reads its files by
    format and header, so columns are matched by name whatever their order. Valid
    rows go to ``sink``, rejected and malformed rows to ``quarantine/rejected``, files that
    cannot be read (empty, required column missing) with their reason to
    ``quarantine/files``, each under ``batch_id=<n>`` (the partition column; -1 for files
    without a byte).
    """
    files = (spark.readStream.format("binaryFile")
             .schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", BILLING_FILES)
             .option("maxFilesPerTrigger", max_files_per_trigger).load(landing).select("path"))

    def batch(df: DataFrame, batch_id: int):
        # Each micro-batch owns its ``batch_id=<n>`` folders and overwrites them: a
        # batch replayed after a failure replaces its own output (idempotent),
        # so together with the source log every file lands exactly once.
        part = f"batch_id={batch_id}"
        paths = [r["path"] for r in df.collect()]  # bounded by max_files_per_trigger
        readable, unreadable = readable_files(df.sparkSession, paths)
        if readable:
            raw = scan_by_format(df.sparkSession, readable)
            # each filter reads the files by itself: keeping all whole rows for the second one would
            # take more disk than the exports and the sink together
            rows = ingest_billing(raw, account_map, ctx)
            (rows.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw_line")
             .write.mode("overwrite").option("compression", "zstd").parquet(f"{sink}/{part}"))
            (rows.filter(F.col("reject_reason").isNotNull())
             .write.mode("overwrite").option("compression", "zstd").parquet(f"{quarantine}/rejected/{part}"))
        if unreadable:
            df.sparkSession.createDataFrame(sorted(unreadable.items()), "path string, reason string").write.mode(
                "overwrite").parquet(f"{quarantine}/files/{part}")

    query = _run(files.writeStream.foreachBatch(batch), checkpoint)
    # files without a byte make no rows in any source: listed as of the end of the run
    if empty := empty_files(spark, landing):
        spark.createDataFrame([(f, "Empty file") for f in sorted(empty)], "path string, reason string").write.mode(
            "overwrite").parquet(f"{quarantine}/files/batch_id=-1")
    return query


def stream_batch_envelopes(spark: SparkSession, landing: str, sink: str, checkpoint: str):
    """Work-message files (one JSON message per line) -> validated raw records.

    Output columns: message fields, ``record`` (raw map), ``reject_reason``,
    ``warnings``; written append-only to Parquet by the file sink, which is
    exactly-once together with the checkpoint.
    """
    messages = spark.readStream.text(landing)
    out = validate_scanned_records(scan_batch_envelopes(messages))
    return _run(out.writeStream.format("parquet").option("compression", "zstd").option("path", sink).outputMode("append"), checkpoint)
