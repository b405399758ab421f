"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows get gapless global numbers 0..n-1 (hash buckets of the row's identity, then
a number inside the bucket: the same whatever the file layout). A keyed Feistel
network over the next power of four permutes the numbers; results outside
0..n-1 walk the cycle until they fall inside, so it is a bijection on 0..n-1. Then
shard = position mod shards and slot = position div shards: both can be computed
from a row's number alone, and ``row_at`` gives the number back. The law that
holds is ``rows``: shard sizes differ by one row at most, slots are gapless.

Edges: a null text has no bytes (size 16, checksum 0); null and repeated ids are
numbered by id, text hash and checksum, so only fully equal rows tie, and those
are interchangeable; an empty table gives an empty result; more shards than rows
leaves shards empty; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ship_package, splitmix, text_or_empty, written

BUCKETS = 16_384
ROUNDS = 6


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round_keys(seed: int) -> np.ndarray:
    return splitmix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    + np.uint64(seed & (2**64 - 1)))


def _network(x: np.ndarray, half: int, keys: np.ndarray, forward: bool) -> np.ndarray:
    h, mask = np.uint64(half), np.uint64((1 << half) - 1)
    left, right = x >> h, x & mask
    for k in (keys if forward else keys[::-1]):
        if forward:
            left, right = right, left ^ (splitmix(right ^ k) & mask)
        else:
            left, right = right ^ (splitmix(left ^ k) & mask), left
    return (left << h) | right


def permute(numbers: np.ndarray, n: int, seed: int, forward: bool = True) -> np.ndarray:
    """Position of each row number (or, backwards, the number at each position)."""
    with np.errstate(over="ignore"):
        keys, half = _round_keys(seed), _half_bits(n)
        out = _network(numbers.astype(np.uint64), half, keys, forward)
        outside = np.flatnonzero(out >= n)
        while len(outside):  # cycle walking
            out[outside] = _network(out[outside], half, keys, forward)
            outside = outside[out[outside] >= n]
    return out.astype(np.int64)


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The global row number that sits in a slot of a shard."""
    return int(permute(np.array([slot * shards + shard]), n, seed, forward=False)[0])


def numbered(docs: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, int]:
    """Slim rows (doc_id, size, text_crc32, row_number) and their count. One scan
    of the texts; the per-bucket counts (a fixed number of rows) go through the
    driver to become offsets."""
    spark = docs.sparkSession
    text = text_or_empty()
    slim = written(docs.select(
        "doc_id", (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64("doc_id", "text").alias("_key"))
        .withColumn("_bucket", F.pmod(F.xxhash64("_key", "text_crc32"), F.lit(buckets)).cast("int")), "shard-rows")
    per = sorted((r[0], r[1]) for r in slim.groupBy("_bucket").count().collect())
    total, starts = 0, []
    for b, c in per:
        starts.append((b, total))
        total += c
    offsets = spark.createDataFrame(starts, "_bucket int, _start long")
    inside = Window.partitionBy("_bucket").orderBy("_key", "doc_id", "text_crc32", "size")
    rows = (slim.join(F.broadcast(offsets), "_bucket")
            .withColumn("row_number", F.col("_start") + F.row_number().over(inside) - 1))
    return rows.select("doc_id", "size", "text_crc32", "row_number"), total


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 20240229) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number)."""
    ship_package(docs.sparkSession)
    rows, n = numbered(docs)

    @F.arrow_udf("long")
    def position(number: pa.Array) -> pa.Array:
        from ledgerlake.llm.sharding import permute as place
        return pa.array(place(number.to_numpy(zero_copy_only=False), n, seed))

    at = F.col("_at")
    return rows.withColumn("_at", position("row_number")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.pmod(at, F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"_at div {int(shards)}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_number")
