"""A streaming sink of JSON envelopes that commits whole micro-batches.

Every task writes its envelopes (``{"customer_id", "data": [<= size records]}``, one a line) to a
file of its own below ``data/`` and reports it in its commit message. When all tasks are
done, ``commit`` writes one manifest ``_commits/<batch>.json`` that lists the files; readers open
listed files only. So a failed task leaves no half batch (its batch has no manifest, and
``abort`` removes what was reported), and a replayed batch finds its manifest, keeps it and
removes its new files: nothing is delivered twice.

Files are opened through pyarrow's file systems, so ``path`` is a folder that driver and
executors share, or an object store. The manifest of a batch names one file per task.

Edges: a task without records writes nothing; null records are left out; an empty batch has a
manifest without files; a reader of a sink without batches gets no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ledgerlake.session import share_package
from ledgerlake.sinks.envelopes import DELIVERY_BATCH
from ledgerlake.sources.pages import open_folder

NAME = "envelope_sink"
COMMITS = "_commits"


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its file (None without records), envelopes and records."""
    file: str | None
    envelopes: int
    records: int


class EnvelopeWriter(DataSourceStreamArrowWriter):
    def __init__(self, options):
        self.path, self.customer = options["path"], options["customer_id"]
        self.size = int(options.get("size", DELIVERY_BATCH))

    def _folders(self):
        system, root = open_folder(self.path)
        for folder in ("data", COMMITS):
            system.create_dir(f"{root}/{folder}", recursive=True)
        return system, root

    def _envelope(self, records: list[str]) -> bytes:
        return f'{{"customer_id":{json.dumps(self.customer)},"data":[{",".join(records)}]}}\n'.encode()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = self._folders()
        name, out, held, envelopes, records = f"{uuid.uuid4().hex}.jsonl", None, [], 0, 0
        try:
            for batch in iterator:
                for value in batch.column("value"):
                    if not value.is_valid:
                        continue
                    held.append(value.as_py())
                    if len(held) == self.size:
                        out = out or system.open_output_stream(f"{root}/data/{name}")
                        out.write(self._envelope(held))
                        envelopes, records, held = envelopes + 1, records + len(held), []
            if held:
                out = out or system.open_output_stream(f"{root}/data/{name}")
                out.write(self._envelope(held))
                envelopes, records = envelopes + 1, records + len(held)
        finally:
            if out is not None:
                out.close()
        return Written(name if out is not None else None, envelopes, records)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        from pyarrow import fs
        system, root = self._folders()
        manifest = f"{root}/{COMMITS}/{batchId}.json"
        if system.get_file_info(manifest).type != fs.FileType.NotFound:
            self._remove(messages)  # a replay: the batch is already delivered
            return
        listed = {"batch": batchId, "files": [m.file for m in messages if m and m.file],
                  "envelopes": sum(m.envelopes for m in messages if m), "records": sum(m.records for m in messages if m)}
        fresh = f"{root}/{COMMITS}/.{batchId}-{uuid.uuid4().hex}"
        with system.open_output_stream(fresh) as out:
            out.write(json.dumps(listed).encode())
        system.move(fresh, manifest)  # whole or not at all

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._remove(messages)

    def _remove(self, messages: list[Written | None]) -> None:
        system, root = self._folders()
        for m in messages:
            if m and m.file:
                system.delete_file(f"{root}/data/{m.file}")


class EnvelopeSink(DataSource):
    """``writeStream.format("envelope_sink").option("path", ...).option("customer_id", ...)``"""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return "value string"

    def streamWriter(self, schema: StructType, overwrite: bool) -> EnvelopeWriter:
        if schema.fieldNames() != ["value"]:
            raise ValueError("the sink takes one text column named value: records as JSON")
        return EnvelopeWriter(self.options)


def stream_envelopes(records: DataFrame, path: str, checkpoint: str, customer_id: str, size: int = DELIVERY_BATCH):
    """Deliver a stream of records (``value``: JSON text) in envelopes until its input is drained."""
    spark = records.sparkSession
    share_package(spark)
    spark.dataSource.register(EnvelopeSink)
    query = (records.select("value").writeStream.format(NAME).option("path", path).option("customer_id", customer_id)
             .option("size", size).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return query


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """(batch, files, envelopes, records) of every committed micro-batch."""
    layout = "batch long, files array<string>, envelopes long, records long"
    return spark.read.schema(layout).option("pathGlobFilter", "*.json").json(f"{path}/{COMMITS}")


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """The committed envelopes: (batch, value). Files no manifest lists are not part of the sink;
    the lists are joined to the file names on Spark."""
    listed = manifests(spark, path).select("batch", F.explode("files").alias("file"))
    lines = spark.read.schema("value string").text(f"{path}/data").select("value", F.col("_metadata.file_name").alias("file"))
    return lines.join(listed, "file").select("batch", "value")
