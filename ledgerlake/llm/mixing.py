"""Mixing sources to target weights with an exact splitting tree.

1. Every document belongs to one of ``blocks`` blocks of its source, by a hash of
   its identity; block sizes (words) are pre-aggregated, so a source with a third
   of all rows is ``blocks`` rows here.
2. Targets share ``total_ratio`` times all words by weight; a source stops at
   ``max_epochs`` times its size and its excess is reshared.
3. Each source's blocks are put in a keyed permutation per epoch and taken until
   the target is covered: that many blocks are the source's quota. The last block
   is taken in part. Documents are taken whole: the one at the target is taken or
   left, whichever misses the target by less. Only where both would miss by more than ``NEAR`` of
   the target (a source of few documents, a very long one) it is cut after its first words.
4. A splitting tree halves the output shards again and again and draws how many
   blocks of each source go left from the multivariate hypergeometric
   distribution (left total fixed), down to one shard: shards get equal numbers of
   blocks, and quotas are met exactly. The vectors have one entry per source, and
   every node has its own seed, so reruns agree.
5. A shard takes the next blocks of each source's permutation (disjoint ranges) and
   shuffles their documents locally by a keyed order.

Edges: a null text has size 0; a null source is a source of its own, last in order;
documents of size 0 take 0 words; repeated rows and ids are rows of their own
(equal ones are interchangeable); an empty table gives an empty plan. Columns other
than ``doc_id``, ``source`` and ``text`` don't matter and may have any name. The number of
sources is a configuration-sized list: above ``MAX_SOURCES`` the operator raises.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import quoted, ship_package, word_count, written

MAX_SOURCES = 100_000
BLOCKS = 1024
SHARDS = 64
NEAR = 0.01


def targets_for(sizes: Sequence[int], weights: Sequence[float], total: float, max_epochs: float) -> list[float]:
    """Share ``total`` by weight; what is above ``max_epochs`` x size is reshared."""
    cap = [max_epochs * s for s in sizes]
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / w > cap[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = float(cap[i])
            open_.discard(i)
        left = float(total) - sum(out[i] for i in range(len(sizes)) if i not in open_)
    return out


def splitting_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards, sources) block counts: rows sum to equal numbers (at most one
    apart), columns to ``quotas``."""
    out = np.zeros((shards, len(quotas)), np.int64)
    todo = [(0, shards, np.asarray(quotas, np.int64))]
    while todo:
        lo, hi, have = todo.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid, total = (lo + hi) // 2, int(have.sum())
        # shard k of the whole gets floor((k+1)T/S) - floor(kT/S) blocks
        whole = int(np.sum(quotas))
        left_total = whole * mid // shards - whole * lo // shards
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        left = rng.multivariate_hypergeometric(have, min(left_total, total), method="marginals") \
            if total else np.zeros_like(have)
        todo += [(lo, mid, left), (mid, hi, have - left)]
    return out


def _identity(seed: int) -> Column:
    return F.xxhash64("doc_id", "text", F.lit(seed))


def _order(*cols, seed: int) -> Column:
    return F.xxhash64(*cols, F.lit(seed))


def mix_plan(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), total_ratio: float = 1.5,
             max_epochs: int = 2, shards: int = SHARDS, blocks: int = BLOCKS, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, identity, size, source_size, target, taken and
    ``pieces`` (array of epoch, shard, words, place: the parts the mix takes)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                               _identity(seed).alias("identity"), F.monotonically_increasing_id().alias("row"))
                   .withColumn("block", F.pmod(_order("identity", seed=seed + 1), F.lit(blocks)).cast("int")), "mix-rows")
    blocks_of = written(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    per_source = blocks_of.groupBy("source").agg(F.sum("words").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: a mix weighs a configured list of sources")
    per_source.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [int(r[1]) for r in per_source]
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    targets = targets_for(sizes, weight, total_ratio * sum(sizes), max_epochs)
    words = [min(round(t), max_epochs * s) for t, s in zip(targets, sizes)]
    table = spark.createDataFrame(
        [(i, r[0], s, t, w) for i, (r, s, t, w) in enumerate(zip(per_source, sizes, targets, words))],
        "source_no int, source string, source_size long, target double, to_take long")

    # blocks in permuted order, epoch after epoch, until the target is covered
    known = (F.broadcast(table), F.col("source").eqNullSafe(F.col("_s")))
    numbered = blocks_of.withColumnRenamed("source", "_s").join(*known).select("source_no", "block", "words", "source_size", "to_take")
    permuted = Window.partitionBy("source_no", "epoch").orderBy(_order("block", "epoch", seed=seed + 2), "block")
    sequence = (numbered.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(int(max_epochs) - 1))))
                .withColumn("before", F.sum("words").over(permuted) - F.col("words"))
                .withColumn("quota", F.greatest(F.lit(0), F.least(F.col("source_size"), F.col("to_take") - F.col("epoch") * F.col("source_size"))))
                .withColumn("take", F.greatest(F.lit(0), F.least(F.col("words"), F.col("quota") - F.col("before"))))
                .where("take > 0")
                .withColumn("place", F.row_number().over(
                    Window.partitionBy("source_no").orderBy("epoch", _order("block", "epoch", seed=seed + 2), "block")) - 1)
                .select("source_no", "block", "epoch", "words", "take", "place"))
    sequence = written(sequence, "mix-sequence")
    quota = dict(sequence.groupBy("source_no").count().collect())
    tree = splitting_tree(np.array([quota.get(i, 0) for i in range(len(sizes))], np.int64), shards, seed)
    cuts = spark.createDataFrame([(i, c) for i, c in enumerate(np.cumsum(tree, axis=0).T.tolist())],
                                 "source_no int, cuts array<long>")
    drawn = (sequence.join(F.broadcast(cuts), "source_no")
             .withColumn("shard", F.size(F.filter("cuts", lambda c: c <= F.col("place"))))
             .drop("cuts", "place"))

    # documents of the drawn blocks; only a source's last block needs an order inside
    sized = rows.withColumnRenamed("source", "_s").join(*known).drop("_s", "source")
    docs_in = sized.drop("to_take")
    drawn_docs = sized.select("row", "source_no", "block", "identity", "size", "to_take").join(drawn, ["source_no", "block"])
    whole = drawn_docs.where("take = words").withColumn("part", F.col("size"))
    inside = Window.partitionBy("source_no", "block", "epoch").orderBy(_order("identity", "epoch", seed=seed + 3), "identity", "size", "row")
    # the document at the target is taken or left whole, whichever misses by less; it is cut
    # only where either would miss by more than NEAR of the source's words
    left, over = F.col("take") - F.col("_before"), F.col("_before") + F.col("size") - F.col("take")
    whole_or_none = F.when(over <= left, F.col("size")).otherwise(F.lit(0))
    cut = (drawn_docs.where("take < words").withColumn("_before", F.sum("size").over(inside) - F.col("size"))
           .withColumn("part", F.when(over <= 0, F.col("size")).when(left <= 0, F.lit(0))
                       .when(F.least(over, left) <= NEAR * F.col("to_take"), whole_or_none).otherwise(left))
           .drop("_before"))
    pieces = (whole.unionByName(cut).where("part > 0")
              .groupBy("row").agg(F.sum("part").alias("taken"), F.sort_array(F.collect_list(F.struct(
                  "epoch", "shard", F.col("part").alias("words"),
                  _order("identity", "epoch", seed=seed + 4).alias("place")))).alias("pieces")))
    return (docs_in.join(pieces, "row", "left")
            .select("doc_id", "identity", F.col("size").cast("long"), F.col("source_size").cast("long"), "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "pieces"))


def emit_mix(docs: DataFrame, plan: DataFrame, seed: int = 17, placed: bool = True) -> DataFrame:
    """The mixed rows: every column of ``docs`` once per piece, and where ``placed``
    its mix_shard and mix_place. Texts are whole but for a piece of fewer words than its document (see
    ``mix_plan``): that is cut behind them, white space kept, and ``n_chars`` follows the text.
    Rows with equal id and text are matched one to one. Clashing names are safe:
    the source columns travel in one struct."""
    names = docs.columns
    cols = F.struct(*[quoted(c) for c in names]).alias("d")
    same = Window.partitionBy("id", "identity").orderBy(F.lit(0))
    left = docs.select(cols, F.col("doc_id").alias("id"), _identity(seed).alias("identity")) \
        .withColumn("nth", F.row_number().over(same))
    right = plan.select(F.col("doc_id").alias("id"), "identity", "size", "pieces") \
        .withColumn("nth", F.row_number().over(same)).where("pieces is not null")
    right = right.select(F.col("id").alias("id2"), F.col("identity").alias("identity2"), F.col("nth").alias("nth2"),
                         "size", F.explode("pieces").alias("p"))
    rows = left.join(right, F.col("id").eqNullSafe(F.col("id2")) & (F.col("identity") == F.col("identity2"))
                     & (F.col("nth") == F.col("nth2")))
    spaced = F.regexp_extract_all(F.col("d.text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    short = F.array_join(F.slice(spaced, F.lit(1), F.col("p.words").cast("int")), "")
    text = F.when(F.col("p.words") >= F.col("size"), F.col("d.text")).otherwise(short)
    rows = rows.withColumn("text2", text)
    out = []
    for c in names:
        if c == "text":
            out.append(F.col("text2").alias("text"))
        elif c == "n_chars":
            out.append(F.when(F.col("p.words") >= F.col("size"), F.col("d.n_chars"))
                       .otherwise(F.length("text2")).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col("d").getField(c).alias(c))
    if placed:
        out += [F.col("p.shard").alias("mix_shard"), F.col("p.place").alias("mix_place")]
    return rows.select(*out)


def write_mix(mixed: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write mixed rows shard by shard, each shuffled locally by its keyed order."""
    (mixed.repartition(shards, "mix_shard").sortWithinPartitions("mix_shard", "mix_place")
     .write.partitionBy("mix_shard").parquet(path))
