"""Hashed n-gram indicators of whole texts and the labelled sample to fit on.

A text's features are the distinct n-grams of its words: each word, each pair of
neighbouring words, each word's first 4 and 6 and last 3 bytes, and one repeat
indicator: the tenths of word pairs that occurred in the text before. On request also
whether a word start occurs twice or four times at least. Each is
hashed to ``1 << BITS`` dimensions. A feature is present or absent; ids, labels,
languages and sources never enter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import (LOWER, buffers, chunks, ship_package, splitmix, text_or_empty, word_hashes,
                                   word_spans)

BITS = 20
SAMPLE = 6_000
_MASK = np.uint64((1 << BITS) - 1)
_TWICE, _FOUR = 0x5A5A5, 0xA5A5A  # a word start's slot, moved for its repeats
_SALTS = splitmix(np.arange(1, 8, dtype=np.uint64))


def _slot(h: np.ndarray, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (splitmix(h ^ _SALTS[kind]) & _MASK).astype(np.int64)


def present(raw: np.ndarray, offsets: np.ndarray, lower: bool, keep: np.ndarray | None = None, repeats: bool = False):
    """(text, feature) pairs, distinct and sorted, of a run of texts. ``keep`` is
    a table of the features that matter; others are left out before sorting.
    ``repeats`` adds whether word starts occur again."""
    if lower:
        raw = LOWER[raw]
    starts, ends, first = word_spans(raw, offsets)
    n_texts, n = len(offsets) - 1, len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(n_texts), np.diff(first))
    words = word_hashes(raw, starts, ends)
    lens = ends - starts
    with np.errstate(over="ignore"):
        pairs = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    found = [(owner, _slot(words, 0)), (owner[inner], _slot(pairs[inner], 1))]
    for kind, size, tail in ((2, 4, False), (3, 6, False), (4, 3, True)):
        long = np.flatnonzero(lens > size)
        at = ends[long] - size if tail else starts[long]
        h = np.zeros(len(long), np.uint64)
        for k in range(size):
            h = (h << np.uint64(8)) | raw[at + k]
        slot = _slot(h, kind)
        found.append((owner[long], slot))
        if repeats and not tail:
            if keep is None:
                at = np.arange(len(slot))
            else:
                at = np.flatnonzero(keep[slot ^ _TWICE] | keep[slot ^ _FOUR])
            both, times = np.unique((owner[long][at].astype(np.int64) << BITS) | slot[at], return_counts=True)
            for least, move in ((2, _TWICE), (4, _FOUR)):
                again = both[times >= least]
                found.append((again >> BITS, (again & ((1 << BITS) - 1)) ^ move))
    # repeat indicator: word pairs that came before in the same text, in tenths
    total = np.bincount(owner[inner], minlength=n_texts)
    code = splitmix(pairs[inner]) >> np.uint64(24)
    distinct = np.unique((owner[inner].astype(np.uint64) << np.uint64(40)) | code)
    different = np.bincount((distinct >> np.uint64(40)).astype(np.int64), minlength=n_texts)
    some = np.flatnonzero(total)
    tenths = ((total[some] - different[some]) * 10 // total[some]).astype(np.uint64)
    found.append((some, _slot(tenths, 5)))
    text = np.concatenate([a for a, _ in found])
    feature = np.concatenate([b for _, b in found])
    if keep is not None:
        at = np.flatnonzero(keep[feature])
        text, feature = text[at], feature[at]
    both = np.unique((text.astype(np.int64) << BITS) | feature)
    return both >> BITS, both & ((1 << BITS) - 1)


def held_out():
    """True where crc32 of the id as text leaves remainder 1 by 3 (null id: as '')."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3)) == F.lit(1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, lower: bool, bound: int = SAMPLE,
                    repeats: bool = False):
    """(labels, indptr, features) of at most ``bound`` labelled rows that are not
    held out: those with the smallest id hashes, found by a hash threshold first,
    so that the ordering sees about ``bound`` rows. They are few by construction
    and broadcast, so only their texts are shuffled. Null labels and ids are left out; of
    several labels of one id the smallest counts, of several texts the one with the
    smallest hash: no more than ``bound`` rows reach the driver."""
    spark = docs.sparkSession
    ship_package(spark)
    usable = (labels.where(~held_out()).where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
              .withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 40))))
    have = usable.count()
    share = 1.0 if have <= bound else min(1.0, 1.2 * bound / have)
    chosen = usable.where(F.col("h") < F.lit(int(share * (1 << 40)))).orderBy("h", "doc_id").limit(bound)
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen.select("doc_id", "y")), "doc_id") \
        .groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")) \
        .select("doc_id", "y", F.col("t.text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerlake.llm import features
        for b in batches:
            raw, offsets = buffers(b.column("text"))
            for i, j in chunks(offsets):
                text, feature = features.present(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lower, None, repeats)
                cuts = np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(feature.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), b.column("y").slice(i, j - i), lists],
                                                 ["doc_id", "y", "f"])

    got = texts.select(F.col("doc_id").cast("string").alias("doc_id"), "y", "text") \
        .mapInArrow(run, "doc_id string, y int, f array<int>").toArrow()
    return _matrix(got)


def _matrix(got: pa.Table, least: int = 3):
    """The sample as (labels, indptr, features), in the order of the ids; features of
    fewer than ``least`` texts are left out (most are, and no fit uses them)."""
    many = np.zeros(1 << BITS, np.int32)
    parts = []
    for b in got.to_batches():
        lists = b.column("f")
        flat, cuts = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        many += np.bincount(flat[cuts[0]:cuts[-1]], minlength=1 << BITS).astype(np.int32)
        ids, y = b.column("doc_id").to_pylist(), b.column("y").to_pylist()
        parts += [(ids[k], y[k], flat[cuts[k]:cuts[k + 1]]) for k in range(b.num_rows)]
    parts.sort(key=lambda p: (p[0], len(p[2]), int(p[2].sum(dtype=np.int64))))
    kept = [f[many[f] >= least] for _, _, f in parts]
    indptr = np.concatenate([[0], np.cumsum([len(f) for f in kept])]).astype(np.int64)
    feature = np.concatenate(kept) if kept else np.zeros(0, np.int32)
    return np.array([y for _, y, _ in parts], np.int64), indptr, feature


def score_texts(docs: DataFrame, columns: list[str], score_run, out: str) -> DataFrame:
    """Whole texts scored in Arrow batches: ``score_run(raw, offsets)`` gives the
    output columns of a run of texts; ``columns`` are carried along."""
    ship_package(docs.sparkSession)
    names = [f.split()[0] for f in out.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = buffers(b.column("_text"))
            parts = [score_run(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in chunks(offsets)]
            cols = [pa.array(np.concatenate([p[k] for p in parts])) if parts else pa.array([]) for k in range(len(names))]
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), *cols], [*columns, *names])

    rows = docs.select(*columns, text_or_empty().alias("_text"))
    carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    return rows.mapInArrow(run, f"{carried}, {out}")
