"""SimHash near-duplicates by one-wildcard variants of fingerprint halves.

Fingerprints within two bits differ by at most one bit in one of their two 32-bit
halves. Each distinct fingerprint is indexed under 64 keys: each half with one of its
bits left out. Two halves that differ by one bit at most share a key, so equality of
keys finds every pair; the whole distance is then verified.

No all-pairs output: equal fingerprints are one node. A key of two nodes is one pair
to verify; keys of up to ``PAIRS`` nodes are joined on the key; the nodes of larger
keys are linked exactly by their 65 neighbours within one bit: two fingerprints share
such a neighbour if and only if they are within two bits, and at most 65 distinct ones do, so each
neighbour links its fingerprints to their smallest one. Components come from
alternating star contraction on the links, with every round written to the shared
folder.

Edges: null and empty texts have fingerprint zero and are linked like any other; a text
with fewer words than the shingle is one shingle; repeated rows share a fingerprint; null ids
never name a component unless all of its ids are null; an empty table gives an empty
result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import quoted, ship_package, written

SHINGLE = 3
SEED = 42
PAIRS = 24
_BLOCK = 1 << 16


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """64-bit SimHash: bit set where over half of the shingles' hashes set it."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) < width:
        return hashed(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = len(words) - width + 1
    starts = (np.concatenate([[0], ends[:n - 1]])).tolist()
    stops = (ends[width - 1:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        h = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts[i:i + _BLOCK], stops[i:i + _BLOCK])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` plus ``fp`` (the fingerprint as a signed 64-bit number)."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerlake.llm import simhash
        for b in batches:
            texts = b.column("_bytes")
            fp = np.fromiter((simhash.fingerprint(t.as_py() or b"", width) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(fp.view(np.int64))], [*columns, "fp"])

    rows = docs.select(*columns, F.col("text").cast("binary").alias("_bytes"))
    carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    return rows.mapInArrow(run, f"{carried}, fp long")


def _variants(nodes: DataFrame) -> DataFrame:
    """64 keys per fingerprint: (bit left out, its half without that bit) as one long."""
    half = F.when(F.col("bit") >= 32, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    rows = nodes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")).withColumn("half", half)
    gone = F.expr("half & ~shiftleft(1L, bit % 32)")
    return rows.select("fp", (F.col("bit") * F.lit(1 << 32) + gone).alias("key"))


def _near(a: str, b: str, bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints that leave components as all pairs
    within two bits would."""
    # 64 keys come from each row: spread the rows before, however few bytes they are; by a key
    # that the aggregate below doesn't have, or the planner would take the exchange out
    nodes = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    sizes = written(_variants(nodes).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "simhash-keys")
    two = sizes.where("n = 2").select("a", "b").where(_near("a", "b", 2))
    members = written(_variants(nodes).join(sizes.where("n > 2").select("key", "n"), "key"), "simhash-members")
    some = members.where(F.col("n") <= PAIRS)
    pairs = (some.select("key", F.col("fp").alias("a")).join(some.select("key", F.col("fp").alias("b")), "key")
             .where(F.col("a") < F.col("b")).where(_near("a", "b", 2)).select("a", "b"))
    many = members.where(F.col("n") > PAIRS).select("fp").distinct()
    around = many.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("bit")).select(
        "fp", F.expr("CASE WHEN bit = 64 THEN fp ELSE fp ^ shiftleft(1L, bit) END").alias("point"))
    stars = (around.groupBy("point").agg(F.collect_list("fp").alias("all"))  # 65 fingerprints at most
             .where(F.size("all") > 1)
             .select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where(F.col("a") < F.col("b")))
    return two.unionByName(pairs).unionByName(stars).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): alternating large-star and small-star contraction until nothing
    changes; roots are the smallest nodes. Nodes without links are absent."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc-0")
    mark = None
    for k in range(1, rounds + 1):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(below.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), f"cc-{k}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(now)
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, max_bits: int = 2) -> DataFrame:
    """(doc_id, identity, fp, root, component_id) for every row; identity hashes the
    row's id and text, root is the smallest fingerprint of the component."""
    if max_bits != 2:
        raise ValueError("the two-half index is exact for two bits")
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("identity"), "text")
    rows = written(fingerprints(keyed, width, ("doc_id", "identity")), "simhash-rows")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(nodes.select("fp")))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left") \
        .select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = written(named, "simhash-named")
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rows.join(named.select("fp", "root").join(ids, "root"), "fp") \
        .select("doc_id", "identity", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component: that with the component's id (of several
    such rows, the one with the smallest identity; of equal ones, any)."""
    found = near_duplicates(docs, width, max_bits)
    # null-free join keys: the identity and the id as text
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    kept = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
            .agg(F.min(F.struct("identity", name.alias("name"))).alias("k"))
            .select(F.col("k.identity").alias("k1"), F.col("k.name").alias("k2")).distinct())
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("d"),
                       F.xxhash64("doc_id", "text").alias("k1"), name.alias("k2"))
    equal = Window.partitionBy("k1", "k2").orderBy(F.lit(0))
    return (rows.join(kept, ["k1", "k2"]).withColumn("nth", F.row_number().over(equal)).where("nth = 1")
            .select(*[F.col("d").getField(c).alias(c) for c in docs.columns]))
