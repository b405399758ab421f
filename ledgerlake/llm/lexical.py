"""Ranked lexical search in the manner of LEMP: documents by the length of their impact
vectors, buckets pruned by Cauchy-Schwarz, a coordinate bound inside, exact integers for
the survivors.

A document's vector has one coordinate per query term t it holds: its impact
x(t) = (1000000000 tf) div (1000 tf + 20 m), with m = 100 - 50 + ((50 n N) div L). An
item's vector holds the weight w(t) of each of its terms. Their product is the
score. Both sides are scaled by sqrt(w) (x' = x sqrt(w), q' = sqrt(w)), which leaves
products as they are and evens out the lengths.

1. One pass over the texts keeps, of each document, its number of terms and the counts of
   the terms that items ask for. N, L and the document frequencies are counted from that.
2. Vectors get their impacts and length and are written by *round*: the longest 4,096
   documents, then 16 times as many, and so on (whole length classes).
3. Rounds run from long to short. Each task sorts its vectors into buckets of nearly equal
   length. For an item with a threshold (the lowest of its best k so far: of earlier
   rounds, or of the task itself), a bucket is skipped if |q'| times its
   greatest length stays below it. Inside a bucket the item's heaviest coordinates are
   looked up until the rest of q' times the greatest length stays below the threshold: a document without any
   of them cannot reach it. Of the others, sum over those coordinates plus
   |rest of q'| times |rest of x'| must reach it. Survivors are scored exactly in 64-bit integers.
4. The best k of each item are merged after each round and give the next thresholds.

Bounds are floating point with a slack, and only a bound below the threshold drops a document,
so equal scores at rank k are kept and ordered by document id. Items are taken in
blocks of ``BLOCK_TERMS`` terms (a stated query set against all rows); a block's
vocabulary is broadcast, which bounds it.

Edges: null and empty texts hold no term, and are neither counted in N nor returned; items
without terms, or whose terms no document holds, return nothing; rows of the benchmark with the same
id are one item with the terms of all; null item ids are one item; repeated
document rows are ranked each on its own, null document ids after the others; texts of any
length are read whole; empty tables give an empty result; columns other than ``doc_id``,
``item_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import LOWER, buffers, chunks, same_words, scratch, ship_package, word_hashes, word_spans, written

#: Bytes that end a term: ASCII without digits and letters. All others are term bytes.
GAPS = np.zeros(256, dtype=bool)
GAPS[:128] = True
GAPS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BLOCK_TERMS = 200_000
FIRST_ROUND = 4096
ROUND_GROWTH = 16
CLASSES = 8  # length classes per power of two
POSTINGS = 1 << 21  # postings that a task searches at a time
SLACK = 1 + 1e-9


class Vocabulary:
    """Sorted distinct terms of a block and their lookup by bytes."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        data = [t.encode("utf-8") for t in terms]
        self.raw = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        self.starts, self.ends = ends - np.fromiter(map(len, data), np.int64, len(data)), ends
        left = np.arange(len(data))
        hashes = word_hashes(self.raw, self.starts, self.ends)
        self.layers = []  # one, unless two terms share a hash
        while len(left):
            h, first = np.unique(hashes[left], return_index=True)
            self.layers.append((h, left[first]))
            left = np.delete(left, first)

    def find(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word number, term number) of the words that are terms."""
        hashes = word_hashes(raw, starts, ends)
        words, found = [], []
        for h, number in self.layers:
            at = np.minimum(np.searchsorted(h, hashes), len(h) - 1)
            w = np.flatnonzero(h[at] == hashes)
            t = number[at[w]]
            same = ends[w] - starts[w] == self.ends[t] - self.starts[t]
            w, t = w[same], t[same]
            same = same_words(raw, starts[w], ends[w], self.raw, self.starts[t])
            words.append(w[same])
            found.append(t[same])
        return np.concatenate(words or [np.zeros(0, np.int64)]), np.concatenate(found or [np.zeros(0, np.int64)])


def term_counts(col: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, pa.ListArray, pa.ListArray]:
    """Per text: its number of terms, the numbers of the vocabulary's terms in it and how
    often each occurs."""
    raw, offsets = buffers(col)
    n, keys, counts = [], [], []
    size = max(1, len(vocabulary.terms))
    for i, j in chunks(offsets):
        part = LOWER[raw[offsets[i]:offsets[j]]]
        starts, ends, first = word_spans(part, offsets[i:j + 1] - offsets[i], GAPS)
        n.append(np.diff(first))
        words, terms = vocabulary.find(part, starts, ends)
        doc = np.searchsorted(first, words, side="right") - 1 + i
        k, c = np.unique(doc * size + terms, return_counts=True)
        keys.append(k)
        counts.append(c)
    keys = np.concatenate(keys or [np.zeros(0, np.int64)])
    upto = np.searchsorted(keys, np.arange(len(offsets)) * size).astype(np.int32)
    return (np.concatenate(n or [np.zeros(0, np.int64)]),
            pa.ListArray.from_arrays(pa.array(upto), pa.array((keys % size).astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(upto), pa.array(np.concatenate(counts or [np.zeros(0, np.int64)]).astype(np.int32))))


def flat(col: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets from 0) of a list column without nulls."""
    off = col.offsets.to_numpy()
    return col.values.to_numpy()[off[0]:off[-1]], (off - off[0]).astype(np.int64)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impacts of terms that occur tf times in documents of n terms (64-bit integers)."""
    m = 50 + (50 * n * n_docs) // max(n_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Search:
    """Items of a block against vectors, with the best k of each item so far."""

    def __init__(self, items: list[list[int]], weights: np.ndarray, k: int, floor: np.ndarray):
        self.k, self.weights = k, weights
        self.root = np.sqrt(weights.astype(np.float64))
        # heaviest coordinates first
        self.items = [np.array(sorted(t, key=lambda x: (-weights[x], x)), np.int64) for t in items]
        self.rest = []  # per item: length of q' without its first f coordinates, f = 0 .. number of terms
        for t in self.items:
            self.rest.append(np.sqrt(np.append(np.cumsum(weights[t][::-1].astype(np.float64))[::-1], 0.0)))
        self.length = np.array([r[0] for r in self.rest])
        self.floor = floor.copy()  # no document below it is among the best k
        self.best: list[list[tuple]] = [[] for _ in items]
        self.scored = 0

    def add(self, ids: pa.Array, terms: np.ndarray, values: np.ndarray, offsets: np.ndarray, norm: np.ndarray) -> None:
        """Search a run of vectors: CSR rows of (term, impact) with their lengths."""
        order = np.argsort(-norm, kind="stable")
        classes = np.floor(np.log2(np.maximum(norm[order], 1e-300)) * CLASSES)
        edges = np.flatnonzero(np.diff(classes)) + 1
        tie = np.empty(len(ids), np.int64)
        tie[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        for rows in np.split(order, edges):
            active = np.flatnonzero(self.length * norm[rows[0]] * SLACK >= self.floor)
            if len(active):
                self._bucket(ids, tie, rows, terms, values, offsets, norm, active)

    def _bucket(self, ids, tie, rows, terms, values, offsets, norm, active) -> None:
        lens = offsets[rows + 1] - offsets[rows]
        local = np.repeat(np.arange(len(rows)), lens)
        first = np.cumsum(lens) - lens
        at = np.arange(len(local)) + np.repeat(offsets[rows] - first, lens)
        t, x = terms[at], values[at]
        by_term = np.argsort(t, kind="stable")
        heads = np.searchsorted(t[by_term], np.arange(len(self.weights) + 1))
        square = norm[rows] ** 2
        longest = norm[rows[0]]
        dense = np.zeros(len(self.weights), np.int64)
        for q in active.tolist():
            item, rest, floor = self.items[q], self.rest[q], self.floor[q]
            focus = int(np.searchsorted(-(rest * longest * SLACK), -floor, side="right")) if floor > 0 else len(item)
            lists = [by_term[heads[f]:heads[f + 1]] for f in item[:focus]]
            if not any(map(len, lists)):
                continue
            partial, taken = np.zeros(len(rows)), np.zeros(len(rows))
            for f, p in zip(item[:focus].tolist(), lists):
                v = x[p] * self.root[f]
                partial[local[p]] += v * self.root[f]
                taken[local[p]] += v * v
            bound = partial + rest[focus] * np.sqrt(np.maximum(square * SLACK - taken, 0))
            alive = np.flatnonzero((partial > 0) & (bound * SLACK >= floor))
            if not len(alive):
                continue
            dense[item] = self.weights[item]
            score = self._exact(alive, first, lens, t, x, dense)
            dense[item] = 0
            self.scored += len(alive)
            good = (score >= max(floor, 1))
            self._keep(q, ids, tie, rows[alive[good]], score[good])

    @staticmethod
    def _exact(alive, first, lens, t, x, dense) -> np.ndarray:
        n = lens[alive]
        begin = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(first[alive] - begin, n)
        return np.add.reduceat(dense[t[at]] * x[at], begin)

    def _keep(self, q, ids, tie, rows, score) -> None:
        if not len(rows):
            return
        top = np.lexsort((tie[rows], -score))[:self.k]
        new = zip(score[top].tolist(), ids.take(pa.array(rows[top])).to_pylist())
        both = self.best[q] + [(-s, i is None, i) for s, i in new]
        both.sort(key=lambda e: (e[0], e[1], 0 if e[1] else e[2]))
        self.best[q] = both[:self.k]
        if len(self.best[q]) == self.k:
            self.floor[q] = max(self.floor[q], -self.best[q][-1][0])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): distinct terms of each item, items without any left out."""
    text = F.translate(F.col("text"), UPPER, SMALL)
    words = items.select("item_id", F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))).alias("term"))
    return words.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _counts(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, tf) of every document that holds a term at all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerlake.llm import lexical
        for b in batches:
            n, terms, tf = lexical.term_counts(b.column("text"), vocabulary.value)
            out = pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), terms, tf], ["doc_id", "n", "terms", "tf"])
            yield out.filter(pa.array(n > 0))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tf array<int>")


def _vectors(counted: DataFrame, weights, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, terms, impacts, norm, class) of the documents that hold a query term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerlake.llm import lexical
        w = weights.value.astype(np.float64)
        for b in batches:
            terms, off = lexical.flat(b.column("terms"))
            tf, _ = lexical.flat(b.column("tf"))
            x = lexical.impacts(tf.astype(np.int64), np.repeat(b.column("n").to_numpy(), np.diff(off)), n_docs, n_terms)
            norm = np.sqrt(np.add.reduceat(np.append(w[terms] * x * x, 0.0), off[:-1])) if len(off) > 1 else np.zeros(0)
            kind = np.floor(np.log2(np.maximum(norm, 1e-300)) * lexical.CLASSES).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("terms"),
                 pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(x.astype(np.int32))),
                 pa.array(norm), pa.array(kind)], ["doc_id", "terms", "impacts", "norm", "class"])

    kind = counted.schema["doc_id"].dataType.simpleString()
    return counted.where(F.size("terms") > 0).select("doc_id", "n", "terms", "tf").mapInArrow(
        run, f"doc_id {kind}, terms array<int>, impacts array<int>, norm double, class int")


def rounds_of(classes: list[tuple[int, int]]) -> dict[int, int]:
    """Round of each length class from (class, documents): longest first, each round up to
    16 times the one before, whole classes."""
    out, held, limit, number = {}, 0, FIRST_ROUND, 0
    for c, n in sorted(classes, reverse=True):
        if held and held + n > limit:
            number, held, limit = number + 1, 0, limit * ROUND_GROWTH
        out[c] = number
        held += n
    return out


def _searched(vectors: DataFrame, shared, floor: list[int], k: int, doc_kind: str) -> DataFrame:
    """(item, doc_id, score): per task the best k of each item that reach its threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerlake.llm import lexical
        items, weights = shared.value
        search = lexical.Search(items, weights, k, np.array(floor, np.int64))
        held, size = [], 0

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            terms, off = lexical.flat(t["terms"].combine_chunks())
            x, _ = lexical.flat(t["impacts"].combine_chunks())
            ids = t["doc_id"].combine_chunks()
            search.add(ids, terms, x.astype(np.int64), off, t["norm"].to_numpy())

        for b in batches:
            held.append(b)
            size += len(b.column("terms").values)
            if size >= lexical.POSTINGS:
                flush()
                held, size = [], 0
        if held:
            flush()
        rows = [(q, e[2], -e[0]) for q, best in enumerate(search.best) for e in best]
        if rows:
            q, ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids, id_type), pa.array(scores, pa.int64())],
                                             ["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(vectors.schema["doc_id"].dataType)
    return vectors.select("doc_id", "terms", "impacts", "norm").mapInArrow(run, f"item int, doc_id {doc_kind}, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: list[tuple], k: int) -> DataFrame | None:
    """(item, doc_id, score, rank) for a block of (item number, terms)."""
    spark = docs.sparkSession
    terms = sorted({t for _, ts in items for t in ts})
    number = {t: i for i, t in enumerate(terms)}
    counted = written(_counts(docs, spark.sparkContext.broadcast(Vocabulary(terms))), "lexical-counts")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # at most one row per term
    weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(terms))], np.int64)
    vectors = _vectors(counted, spark.sparkContext.broadcast(weights), n_docs, n_terms)
    classes = [tuple(r) for r in vectors.groupBy("class").count().collect()]  # classes of length: at most some hundreds
    if not classes:
        return None
    rounds = rounds_of(classes)
    place = F.element_at(F.create_map(*[F.lit(v) for kv in rounds.items() for v in kv]), F.col("class"))
    path = scratch(spark, "lexical-vectors")
    vectors.withColumn("round", place).write.partitionBy("round").parquet(path)
    shared = spark.sparkContext.broadcast(([[number[t] for t in ts] for _, ts in items], weights))
    kind = docs.schema["doc_id"].dataType.simpleString()
    best, floor = None, [0] * len(items)
    for r in range(max(rounds.values()) + 1):
        found = _searched(spark.read.parquet(f"{path}/round={r}"), shared, floor, k, kind)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = written(_best(found, k), f"lexical-best-{r}")
        for q, s in best.where(F.col("rank") == k).select("item", "score").collect():  # one row per item of the block
            floor[q] = s
    return best


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    spark = docs.sparkSession
    ship_package(spark)
    asked = written(item_terms(items), "lexical-items")
    total = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_terms))
    out = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id").collect()
        found = _search_block(docs, [(i, r.terms) for i, r in enumerate(block)], k) if block else None
        if found is None:
            continue
        kind = items.schema["item_id"].dataType
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)],
                                      f"item int, item_id {kind.simpleString()}")
        part = found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is not None:
        return out
    return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, "
                                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
