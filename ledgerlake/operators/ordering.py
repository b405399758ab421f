"""Global numbering, batching and family unions without a single-partition step.

A global ``row_number()`` over an un-partitioned window moves every row into one
task. Here Spark's range partitioning cuts the rows into contiguous, sorted key ranges,
and the result is pinned by writing it once to the shared folder: the bounds are
sampled anew each time such an exchange runs, so only a written table gives every
consumer, and every re-run of a lost task, the same ranges. A row's position in its range
is kept with it; range sizes (one row per range) become offsets. There is one path for
every size.

The order is made total by a hash of the whole row behind the given keys, so that a hot
key spreads over ranges and batch membership is deterministic; rows equal in every
column are interchangeable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import materialized

SHARD = "_shard"
POS = "_pos"


def _row_hash(df: DataFrame):
    """A hash of all columns (maps, which cannot be hashed, as their entries)."""
    cols = [F.map_entries(F.col(f"`{f.name}`")) if f.dataType.typeName() == "map" else F.col(f"`{f.name}`")
            for f in df.schema.fields]
    return F.xxhash64(*cols)


def sharded(df: DataFrame, order: Sequence[str], shards: int | None = None) -> DataFrame:
    """``df`` in contiguous ranges of ``order``, written once: adds ``_shard`` (range
    number) and ``_pos`` (0-based position inside the range)."""
    n = shards or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = [*order, "_tie"]
    part = (df.withColumn("_tie", _row_hash(df)).repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_tie"))
    pid = F.spark_partition_id()
    return materialized(part.withColumns({
        SHARD: pid, POS: F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)}), "ranges")


def shard_offsets(ranges: DataFrame) -> DataFrame:
    """Per range: rows before it (``_offset``) and the grand total (``_total``).
    One row per range, so the un-partitioned windows here are bounded."""
    counts = ranges.groupBy(SHARD).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(SHARD).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        SHARD,
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )


def number_rows(df: DataFrame, order: Sequence[str], out: str = "row_number",
                shards: int | None = None, keep_total: str | None = None) -> DataFrame:
    """Append the global 1-based position in ``order`` (a distributed row_number);
    ties are ordered by a hash of the row."""
    ranges = sharded(df, order, shards)
    # one row per range: its size is the partition count, a setting
    numbered = ranges.join(F.broadcast(shard_offsets(ranges)), SHARD).withColumn(
        out, F.col("_offset") + F.col(POS) + 1)
    if keep_total:
        numbered = numbered.withColumnRenamed("_total", keep_total)
    return numbered.drop(SHARD, POS, "_offset", "_total")


def assign_batches(df: DataFrame, size: int, order: Sequence[str],
                   shards: int | None = None, keep_row_number: bool = False) -> DataFrame:
    """Contiguous slices of ``size`` rows in ``order``: ``batch_number`` (1-based)
    and ``total_batches``; the last batch may be short."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    numbered = number_rows(df, order, "_rn", shards, keep_total="_rows")
    out = numbered.withColumns({
        "batch_number": F.floor((F.col("_rn") - 1) / size).cast("long") + 1,
        "total_batches": F.ceil(F.col("_rows") / size).cast("long"),
    }).drop("_rows")
    return out.withColumnRenamed("_rn", "row_number") if keep_row_number else out.drop("_rn")


def union_families(*frames: DataFrame) -> DataFrame:
    """Record families into one frame, columns matched by name, absent ones NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def route_by_volume(counts: DataFrame, threshold: int = 5000, count_col: str = "records") -> DataFrame:
    """``count > threshold`` -> 'work_batches' (fan-out), else 'direct'."""
    return counts.withColumn(
        "route", F.when(F.col(count_col) > threshold, F.lit("work_batches")).otherwise(F.lit("direct")))
