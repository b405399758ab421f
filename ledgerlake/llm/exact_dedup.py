"""Exact deduplication as a stream with disk-backed keyed state.

A file stream reads the table; a streaming aggregation keyed by the digest of the
normalised text keeps, without expiry and in RocksDB, the smallest stable id with
its content locator (file and row) and the group's size. Its checkpoint lies in the shared folder, so a
later run over the same stream goes on where it stopped. Every micro-batch writes its
changed keys to a table of its own (rewritten if the batch is repeated).

Digest hits are then checked on full bytes: the texts of groups with several rows
are joined by digest to the text at the locator and compared whole. Rows that differ
(a digest collision) are grouped by their whole text instead. A group with a large share of all
rows is dealt to many tasks in these joins.

Edges: null counts as empty; null ids come last in the order of ids, and equal ids are told
apart by the locator, so exactly one row of a group stays; texts are compared
whole at any length; an empty table gives an empty result; only ``doc_id`` and
``text`` are read, whatever the other columns are called.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import scratch, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOT, SALTS = 1000, 64  # a group is hot from one in HOT of all rows on


def normalised(col: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(col), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, normalised text, digest, length and order (null ids last, then id, file, row)."""
    rows = docs.select("doc_id", normalised().alias("norm"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.row_index").alias("at"))
    return rows.select("doc_id", "norm", digest(F.col("norm")).alias("digest"), F.octet_length("norm").alias("n"),
                       F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "file", "at").alias("place"))


def pattern_of(path: str) -> str:
    """A pattern that matches the path alone: with one, the source takes a table of one file, too."""
    bare = path.rstrip("/")
    plain = re.sub(r"([\[\]{}*?\\])", r"\\\1", bare)
    return plain if plain != bare else f"{bare[:-1]}[{bare[-1]}]"


def run_stream(spark: SparkSession, path: str, state: str, table: str, digest=sha256, files_per_batch: int | None = None) -> None:
    """Bring the state in ``state`` and the table of changed keys up to date with
    the files below ``path``."""
    own = spark.newSession()  # the caller's settings stay as they are
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # many small stores: no room is claimed ahead for their logs
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    reader = own.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    keys = (_keyed(reader.parquet(pattern_of(path)), digest).groupBy("digest", "n")
            .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size")))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    query = (keys.writeStream.outputMode("update").option("checkpointLocation", state)
             .trigger(availableNow=True).foreachBatch(keep).start())
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _met(rows: DataFrame, groups: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows joined to the one row of their group. The rows of a hot group are dealt to ``SALTS``
    tasks, each with a copy of the group's row."""
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(hot, ["digest", "n"], "left").withColumn("_salt", salt).drop("_hot")
    right = groups.join(hot, ["digest", "n"], "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, ["digest", "n", "_salt"]).drop("_salt")


def exact_dedup(spark: SparkSession, path: str, state: str | None = None, digest=sha256,
                files_per_batch: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row below ``path``."""
    folder = state or scratch(spark, "exact-dedup")
    table = f"{folder}/keys"
    run_stream(spark, path, f"{folder}/state", table, digest, files_per_batch)
    docs = spark.read.parquet(path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    changes = spark.read.schema(f"digest string, n int, first struct<unknown:boolean,doc_id:{kind},file:string,at:bigint>, "
                                "size long, batch long").parquet(table)
    keys = changes.groupBy("digest", "n").agg(F.min("first").alias("first"), F.max("size").alias("size"))
    several = F.col("size") > 1
    keys = written(keys, "dedup-groups")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # at most HOT groups can hold such a share of all rows
    hot = F.broadcast(keys.where((F.col("size") > 1) & (F.col("size") * HOT >= total)).select("digest", "n", F.lit(True).alias("_hot")))
    rows = written(_met(_keyed(docs, digest), keys, hot).select(
        "doc_id", "digest", "n", "place", "first", "size", F.when(several, F.col("norm")).alias("norm"),
        F.when(~several, sha256(F.col("norm"))).alias("hash")), "dedup-rows")
    groups = rows.where(several)
    firsts = groups.where("place = first").select("digest", "n", F.col("norm").alias("first_norm"))
    checked = written(_met(groups, firsts, hot).select(
        "doc_id", "digest", "n", "place", "first", "size", sha256(F.col("norm")).alias("hash"),
        (F.col("norm") == F.col("first_norm")).alias("same"),
        F.when(F.col("norm") != F.col("first_norm"), F.col("norm")).alias("norm")), "dedup-checked")

    def result(df: DataFrame) -> DataFrame:
        return df.select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("size").cast("long").alias("group_size"),
                         (F.col("place") == F.col("first")).alias("kept"), F.col("hash").alias("text_sha256"))

    singles = result(rows.where(~several))
    collided = checked.where(~F.col("same")).select("digest", "n").distinct()
    if collided.isEmpty():
        return singles.unionByName(result(checked))
    # collisions: the rows equal to the first keep it, the others group by whole text
    clean = checked.join(collided, ["digest", "n"], "left_anti")
    dirty = checked.join(collided, ["digest", "n"])
    equal = dirty.where("same").drop("size")
    sizes = equal.groupBy("digest", "n").agg(F.count(F.lit(1)).alias("size"))
    other = dirty.where(~F.col("same")).drop("size", "first")
    by_text = other.groupBy("digest", "n", "norm").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    return (singles.unionByName(result(clean)).unionByName(result(equal.join(sizes, ["digest", "n"])))
            .unionByName(result(other.join(by_text, ["digest", "n", "norm"]))))
