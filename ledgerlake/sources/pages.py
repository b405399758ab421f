"""A paged CRM extract as a Spark data source.

An extract job saves each keyset page (``Id > last ORDER BY Id LIMIT n``) as one JSON line
``{"page", "first_id", "last_id", "records": [...]}``, many pages to a chunk
(``chunk=<n>/``), beside a small index of the chunks' key ranges. The source reads chunks in
parallel: a partition is a contiguous key range. Pushed filters prune chunks by the index, then
pages by their ends, then records, before anything reaches Spark.

Files are opened through pyarrow's file systems, so paths are those of a shared folder or
an object store. Only the index (one row per chunk) is read on the driver.

Edges: pages of one key only, empty pages and an extract without rows are read as they are; a
filter on any column that is not pushed is applied by Spark; a null never passes a pushed comparison; keys compare as
UTF-8 text, as in Spark. A record's absent field is null, an unknown one is ignored.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith)
from pyspark.sql.types import StructType

from ledgerlake.operators.ordering import assign_batches
from ledgerlake.session import share_package

NAME = "paged_extract"
INDEX = "_index"
PAGES_PER_CHUNK = 50
BATCH_ROWS = 4096


def open_folder(path: str):
    """(pyarrow file system, path there) of a folder as Spark names it."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def write_pages(extract: DataFrame, path: str, page_size: int, key: str = "Id",
                pages_per_chunk: int = PAGES_PER_CHUNK) -> str:
    """Land an extract as pages in key order, with their index. A page is gathered from at most
    ``page_size`` rows; rows without a key are no part of a keyset extract."""
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in extract.columns]), {"ignoreNullFields": "false"})
    rows = extract.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), record.alias("_json"))
    numbered = assign_batches(rows, page_size, ["_key"], keep_row_number=True)
    pages = numbered.groupBy("batch_number").agg(
        F.min("_key").alias("first_id"), F.max("_key").alias("last_id"),
        F.array_sort(F.collect_list(F.struct("row_number", "_json"))).alias("items"))
    head = F.to_json(F.struct(F.col("batch_number").alias("page"), "first_id", "last_id"))
    line = F.concat(F.expr("left(h, length(h) - 1)"), F.lit(',"records":['),
                    F.array_join(F.transform("items", lambda x: x["_json"]), ","), F.lit("]}"))
    chunk = F.expr(f"(batch_number - 1) div {int(pages_per_chunk)}").cast("long")
    (pages.withColumn("h", head).select(chunk.alias("chunk"), "batch_number", line.alias("value"))
     .repartition("chunk").sortWithinPartitions("chunk", "batch_number").drop("batch_number")
     .write.partitionBy("chunk").text(path))
    # the chunk is in the file's path (an extract without rows has no chunk folder at all)
    saved = extract.sparkSession.read.schema("value string").text(path).select(
        "value", F.regexp_extract("_metadata.file_path", r"/chunk=(\d+)/", 1).cast("long").alias("chunk"))
    ends = F.from_json("value", "page long, first_id string, last_id string")
    (saved.select("chunk", ends.alias("e")).groupBy("chunk").agg(F.min("e.first_id").alias("first_id"), F.max("e.last_id").alias("last_id"),
                                                                 F.count(F.lit(1)).alias("pages"))
     .write.parquet(f"{path}/{INDEX}"))
    return path


class KeyRange(InputPartition):
    """A chunk of pages."""

    def __init__(self, chunk: int):
        super().__init__(chunk)


_TESTS = {
    EqualTo: lambda v, x: v == x, GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x,
    LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x, In: lambda v, x: v in x,
    StringStartsWith: lambda v, x: v.startswith(x), IsNotNull: lambda v, x: True,
}


def may_hold(test: type, value, first: str, last: str) -> bool:
    """Whether a key range can hold a key that passes a test."""
    if test is EqualTo:
        return first <= value <= last
    if test is In:
        return any(first <= x <= last for x in value)
    if test in (GreaterThan, GreaterThanOrEqual):
        return last > value or (test is GreaterThanOrEqual and last == value)
    if test in (LessThan, LessThanOrEqual):
        return first < value or (test is LessThanOrEqual and first == value)
    if test is StringStartsWith:
        return first[:len(value)] <= value <= last[:len(value)]
    return True


class PageReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.schema, self.path, self.key = schema, options["path"], options.get("key", "Id")
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]):
        """Take comparisons of text, dates, booleans and whole numbers; the rest stays Spark's
        (floating point has NaN, where Spark's order differs)."""
        kinds = {f.name: f.dataType.typeName() for f in self.schema}
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            exact = kinds.get(name) in ("string", "date", "boolean", "integer", "long")
            value = getattr(f, "value", None)
            known = type(f) in _TESTS and (type(f) is IsNotNull or value is not None) and not (type(f) is In and None in value)
            if exact and known:
                self.tests.append((name, type(f), value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        import pyarrow.parquet as pq
        system, root = open_folder(self.path)
        chunks = pq.read_table(f"{root}/{INDEX}", filesystem=system).to_pylist()
        kept = [c["chunk"] for c in sorted(chunks, key=lambda c: c["chunk"]) if self._may_hold(c)]
        return [KeyRange(c) for c in kept] or [KeyRange(-1)]

    def _may_hold(self, ends: dict) -> bool:
        return all(may_hold(t, v, ends["first_id"], ends["last_id"]) for n, t, v in self.tests if n == self.key)

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema
        if partition.value < 0:
            return
        system, root = open_folder(self.path)
        target, held = to_arrow_schema(self.schema), []
        kinds = {f.name: f.dataType.typeName() for f in self.schema}
        dates = [n for n, k in kinds.items() if k == "date"]
        floats = [n for n, k in kinds.items() if k in ("double", "float")]
        files = system.get_file_info(fs.FileSelector(f"{root}/chunk={partition.value}"))
        for info in sorted(files, key=lambda i: i.path):
            if not info.is_file or not info.base_name.startswith("part-"):
                continue
            with system.open_input_stream(info.path, compression="detect") as raw:
                for line in _lines(raw):
                    page = json.loads(line)
                    if not self._may_hold(page):
                        continue
                    for record in page["records"]:
                        for d in dates:
                            if record.get(d) is not None:
                                record[d] = _dt.date.fromisoformat(record[d][:10])
                        for d in floats:
                            if isinstance(record.get(d), str):  # NaN and infinities are text in JSON
                                record[d] = float(record[d])
                        if all(record.get(n) is not None and _TESTS[t](record[n], v) for n, t, v in self.tests):
                            held.append(record)
                    if len(held) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(held, schema=target)
                        held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=target)


def _lines(stream) -> Iterator[bytes]:
    """Lines of a byte stream, one page at a time."""
    rest = b""
    while block := stream.read(1 << 20):
        *lines, rest = (rest + block).split(b"\n")
        yield from (x for x in lines if x)
    if rest:
        yield rest


class PagedExtract(DataSource):
    """``spark.read.format("paged_extract").schema(...).option("path", ...).load()``"""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        raise ValueError("give the extract's schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return PageReader(schema, self.options)


def read_pages(spark: SparkSession, path: str, schema: StructType | str, key: str = "Id") -> DataFrame:
    """The rows of a landed extract. Filter pushdown into Python sources is a setting: it is made
    in a session of its own, the caller's stays as it is."""
    share_package(spark)
    own = spark.newSession()
    own.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    own.dataSource.register(PagedExtract)
    return own.read.format(NAME).schema(schema).option("path", path).option("key", key).load()
