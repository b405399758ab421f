"""Removal of byte strings that an earlier document holds, by suffix sorting of shards.

A byte is removed if a ``length``-byte string over it also starts in a document with a
smaller id. Equal strings must meet in one shard wherever their documents are:

1. Texts are dealt into packs by a hash of the row. Packs grow with the square root of the
   input (4 MB for a few GB, 256 MB for 100 TB), since blocks between packs and shards
   grow with the product of their numbers; a task needs about ten times its pack. The smallest
   hash of the ``ANCHOR``-byte strings inside a window of ``length`` bytes is the window's
   anchor: equal windows have equal anchors. Neighbouring windows with one anchor form
   a segment (at most ``2 * length - ANCHOR`` bytes).
2. Each pack sends its distinct anchors; those of one document only can't repeat, and
   their segments need no sorting.
3. Each pack sends its distinct remaining segments, each with its smallest document,
   to the shard of its anchor: a passage in a third of all documents arrives once per
   pack. Equal segments of several packs are collapsed.
4. Each shard hashes the windows of its segments, and sorts the suffixes of those stretches
   whose windows may repeat by external induced sorting with common prefixes
   (``induced.py``; queues, text and orders go to disk when a shard is large). Suffixes
   with ``length`` common bytes form a group; its smallest document goes back to the
   packs whose segments lie in it.
5. Each pack marks the windows that an earlier document holds, joins the marked
   stretches and cuts them out.

Packs, anchors and segments travel as packed arrays, so that shuffles have few rows; the
packs' exchange is the same one in steps 2, 3 and 5.

Edges: null and empty texts have no bytes; texts shorter than ``length`` stay; a null
id counts as larger than any other, and rows of one id (or null) never cut each other;
texts of any length are handled whole, white space and control bytes are bytes like others
(bytes that no UTF-8 text holds raise);
an empty table gives an empty result; other columns don't matter. Ids must be integers.
"""

from __future__ import annotations

import hashlib
import math
import tempfile
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import chunks, ship_package, splitmix
from ledgerlake.llm.induced import SPILL, ordered_suffixes, stored

ANCHOR = 16
LEAST_PACK, MOST_PACK = 4 << 20, 256 << 20
MOST_BUCKETS, MOST_SHARDS = 65_536, 16_384
PIECE = 1 << 16
NOBODY = np.iinfo(np.int64).max
_SEPARATOR, _POSITION = 0xFE, np.uint64((1 << 20) - 1)


def _hashes(raw: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from every position on."""
    step, h, width = np.uint64(0x9E3779B97F4A7C15), raw.astype(np.uint64) + np.uint64(1), 1
    power, left = step, length
    with np.errstate(over="ignore"):
        out, done = None, 0
        while left:
            if left & 1:  # append this width to what is hashed already
                if out is None:
                    out = h
                else:
                    n = len(h) - done
                    out = out[:n] * power + h[done:done + n]
                done += width
            left >>= 1
            if left:
                h = h[:len(h) - width] * power + h[width:]
                power = power * power
                width *= 2
        return splitmix(out[:len(raw) - length + 1])


def segments(raw: np.ndarray, offsets: np.ndarray, length: int):
    """(anchor, document, start, windows) of every segment of a run of texts."""
    span = length - ANCHOR + 1
    found = []
    # pieces of whole texts, or parts of a long one that overlap by length - 1 bytes
    i, n = 0, len(offsets) - 1
    while i < n:
        lo = int(offsets[i])
        j = max(i + 1, int(np.searchsorted(offsets, lo + PIECE, "right")) - 1)
        hi = int(offsets[j])
        for a in range(lo, max(lo + 1, hi - length + 1), PIECE if j == i + 1 else hi - lo + 1):
            b = min(hi, a + PIECE + length - 1) if j == i + 1 else hi
            part = raw[a:b]
            if len(part) < length:
                continue
            h = _hashes(part, ANCHOR)
            key = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
            low, width = key, 1
            while width * 2 <= span:
                low = np.minimum(low[:len(low) - width], low[width:])
                width *= 2
            if width < span:
                low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
            local = offsets[i:j + 1] - a
            ends = np.clip(local[1:], 0, len(part))
            begins = np.clip(local[:-1], 0, len(part))
            border = np.zeros(len(low) + 1, bool)  # where a run of windows may not go on
            valid = np.ones(len(low), bool)
            for s, e in zip(begins.tolist(), ends.tolist()):
                valid[max(s, e - length + 1):e] = False
                border[min(s, len(low))] = True
            # a run goes on up to the next change of anchor, text or validity
            cut = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | border[1:-1] | (valid[1:] != valid[:-1])]))
            stop = np.append(cut[1:], len(low))
            cut, stop = cut[valid[cut]], stop[valid[cut]]
            if not len(cut):
                continue
            at = (low[cut] & _POSITION).astype(np.int64)  # the anchor's position
            doc = np.searchsorted(local, cut, "right") - 1
            found.append((h[at] >> np.uint64(16), doc + i, cut + a, stop - cut))
        i = j
    if not found:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z, z
    return tuple(np.concatenate(c) for c in zip(*found))


def _read_pack(table: pa.Table):
    """(rows, ids, bytes, offsets) of a pack, in an order that only the rows decide."""
    ids = [NOBODY if x is None else int(x) for x in table.column("doc_id").to_pylist()]
    texts = [t or b"" for t in table.column("data").to_pylist()]
    order = sorted(range(len(ids)), key=lambda k: (ids[k], texts[k]))
    offsets = np.concatenate([[0], np.cumsum([len(texts[k]) for k in order])]).astype(np.int64)
    return order, np.array([ids[k] for k in order], np.int64), b"".join(texts[k] for k in order), offsets


def _six(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    first = np.cumsum(size) - size
    return np.repeat(start - first, size) + np.arange(int(size.sum()))


def _slice_by(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]])) if len(order) else []
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        yield int(bucket[order[a]]), order[a:b]


def pack_anchors(table: pa.Table, length: int, buckets: int):
    """Per bucket the pack's distinct anchors: (bucket, anchors, 1 where two rows of the
    pack hold it)."""
    _, _, data, offsets = _read_pack(table)
    anchor, doc, _, _ = segments(np.frombuffer(data, np.uint8), offsets, length)
    if not len(anchor):  # no text of the pack is as long as a window
        return
    order = np.lexsort((doc, anchor))
    anchor, doc = anchor[order], doc[order]
    first = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(anchor)) - 1
    own, several = anchor[at], (doc[at] != doc[last]).astype(np.uint8)
    for bucket, k in _slice_by((own % np.uint64(buckets)).astype(np.int64)):
        yield bucket, _six(own[k]), several[k].tobytes()


def repeated_anchors(packs: list[int], anchors: list[bytes], several: list[bytes]):
    """Per pack the anchors of a bucket that two packs, or two rows of one, hold."""
    h = [_from_six(a) for a in anchors]
    owner = np.repeat(np.arange(len(h)), [len(x) for x in h])
    every = np.concatenate(h)
    twice = np.concatenate([np.frombuffer(s, np.uint8) for s in several])
    order = np.argsort(every, kind="stable")
    s = every[order]
    start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, int)
    size = np.diff(np.append(start, len(s)))
    good = (size > 1) | (np.maximum.reduceat(twice[order], start) > 0) if len(s) else np.zeros(0, bool)
    keep = order[np.repeat(good, size)]
    for k, rows in _slice_by(owner[keep]):
        yield packs[k], _six(every[keep[rows]])


def _repeats(table: pa.Table, known: list[bytes], length: int):
    """The pack's segments with a repeated anchor, their distinct strings in order."""
    rows, ids, data, offsets = _read_pack(table)
    anchor, doc, start, windows = segments(np.frombuffer(data, np.uint8), offsets, length)
    wanted = np.sort(np.concatenate([_from_six(b) for b in known])) if known else np.zeros(0, np.uint64)
    if len(wanted):
        at = np.searchsorted(wanted, anchor)
        keep = np.flatnonzero(wanted[np.minimum(at, len(wanted) - 1)] == anchor)
    else:
        keep = np.zeros(0, np.int64)
    anchor, doc, start, windows = anchor[keep], doc[keep], start[keep], windows[keep]
    number: dict[bytes, int] = {}
    which = np.fromiter((number.setdefault(data[a:b], len(number)) for a, b in
                         zip(start.tolist(), (start + windows + length - 1).tolist())), np.int64, len(start))
    least = np.full(len(number), NOBODY, np.int64)
    np.minimum.at(least, which, ids[doc])
    place = np.zeros(len(number), np.uint64)
    place[which] = anchor
    return rows, ids, data, offsets, (doc, start, windows, which), list(number), least, place


def pack_segments(table: pa.Table, known: list[bytes], length: int, shards: int):
    """(shard, segment numbers, lengths, smallest documents, packed bytes, anchors) of a pack."""
    *_, strings, least, place = _repeats(table, known, length)
    for shard, k in _slice_by((splitmix(place) % np.uint64(shards)).astype(np.int64)):
        k = np.array(sorted(k.tolist(), key=strings.__getitem__))  # alike side by side: they pack better
        picked = [strings[x] for x in k]
        yield (shard, k.astype(np.uint32).tobytes(), np.fromiter(map(len, picked), np.uint16, len(k)).tobytes(),
               least[k].tobytes(), pa.compress(b"".join(picked), "zstd", asbytes=True), _six(place[k]))


class Shard:
    """Distinct segments of one shard, and which pack's segment is which."""

    KNOWN = 2_000_000

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.file = tempfile.SpooledTemporaryFile(max_size=SPILL)  # the text, on disk when large
        self.refs: list[tuple] = []
        self.count = 0
        self.docs = np.zeros(0, np.int64)
        self.lens, self.anchors = array("H"), array("Q")

    def add(self, pack: int, numbers: bytes, lens: bytes, docs: bytes, data: bytes, anchors: bytes) -> None:
        n = np.frombuffer(lens, np.uint16).astype(np.int64)
        ends = np.cumsum(n)
        data = pa.decompress(data, int(ends[-1]) if len(n) else 0, "zstd", asbytes=True)
        ids = np.empty(len(n), np.int64)
        for k, (a, b, anchor) in enumerate(zip((ends - n).tolist(), ends.tolist(), _from_six(anchors).tolist())):
            s = data[a:b]
            at = self.number.get(s)
            if at is None:
                at = self.count
                self.count += 1
                self.file.write(s)
                self.file.write(b"\xfd")
                self.lens.append(b - a)
                self.anchors.append(anchor)
                if len(self.number) < self.KNOWN:  # beyond, copies are sorted with the rest
                    self.number[s] = at
            ids[k] = at
        least = np.frombuffer(docs, np.int64)
        if self.count > len(self.docs):
            grown = np.full(max(self.count, 2 * len(self.docs)), NOBODY, np.int64)
            grown[:len(self.docs)] = self.docs
            self.docs = grown
        np.minimum.at(self.docs, ids, least)
        self.refs.append((pack, np.frombuffer(numbers, np.uint32), ids, least))

    def _alone(self) -> np.ndarray:
        """Which segments are the only ones with their anchor in this shard (all
        segments of an anchor are in it)."""
        _, which, times = np.unique(np.frombuffer(self.anchors, np.uint64), return_inverse=True, return_counts=True)
        return times[which] == 1

    def _repeating(self, raw: np.ndarray, begin: np.ndarray, windows: np.ndarray, some: np.ndarray, length: int):
        """Per segment of ``some`` the first window whose hash another window of them has,
        and the number of windows from it to the last such one (0: there is none)."""
        n = windows[some]
        base = np.concatenate([[0], np.cumsum(n)])
        hashes = stored(np.zeros(int(base[-1]), np.uint64))
        for a, b in chunks(np.concatenate([[0], np.cumsum(n + length)])):
            part = raw[_ranges(begin[some[a:b]], n[a:b] + length - 1)]
            if (part > 0xFD).any():
                raise ValueError("text is not UTF-8")
            every = np.concatenate([_hashes(part[c:c + PIECE + length - 1], length)  # small arrays stay in the cache
                                    for c in range(0, len(part) - length + 1, PIECE)])
            first = np.cumsum(n[a:b] + length - 1) - n[a:b] - length + 1
            hashes[base[a]:base[b]] = every[_ranges(first, n[a:b])]
        again = stored(np.zeros(len(hashes), bool))
        part = 1 << 22
        parts = np.uint64(1 + len(hashes) // part)
        for k in range(int(parts)):  # the hashes are sorted part by part
            at = np.concatenate([np.flatnonzero(hashes[c:c + part] % parts == np.uint64(k)) + c
                                 for c in range(0, len(hashes) + 1, part)])
            at = at[np.argsort(hashes[at])]
            h = hashes[at]
            alike = np.flatnonzero(h[1:] == h[:-1])
            again[at[alike]] = True
            again[at[alike + 1]] = True
        first, last = np.zeros(len(some), np.int64), np.full(len(some), -1, np.int64)
        for a, b in chunks(base):
            at = np.flatnonzero(again[base[a]:base[b]]) + base[a]
            own = np.searchsorted(base, at, "right") - 1
            new = np.concatenate([[True], own[1:] != own[:-1]])[:len(own)]
            first[own[new]] = (at - base[own])[new]
            np.maximum.at(last, own, at - base[own])
        return first, last - first + 1

    def results(self, length: int):
        """(pack, segment numbers, run lengths, smallest document of each run) where some
        window has an earlier document than the pack's own; runs are of windows in order."""
        self.number = {}
        lens = np.array(self.lens, np.int64)
        begin = np.concatenate([[0], np.cumsum(lens + 1)])
        total = int(begin[-1])
        self.file.seek(0)
        if total < SPILL:
            raw = np.frombuffer(self.file.read(), np.uint8)
        else:
            self.file.rollover()
            raw = np.memmap(self.file._file, np.uint8, "r", shape=(total,))
        docs = self.docs[:self.count]
        windows = lens - length + 1
        # a segment that is its anchor's only one has nothing to be compared with, nor has a
        # window whose hash no other has; what is sorted of a segment reaches from the
        # first to the last of its windows that may repeat
        sorted_ = np.flatnonzero(~self._alone())
        offset, held = self._repeating(raw, begin, windows, sorted_, length)
        sorted_, offset, held = (x[held > 0] for x in (sorted_, offset, held))
        place = np.concatenate([[0], np.cumsum(held + length)])
        size = int(place[-1])
        text = stored(np.zeros(size + 1, np.uint8))  # ends with the smallest symbol, 0
        for a, b in chunks(place):
            part = raw[_ranges(begin[sorted_[a:b]] + offset[a:b], held[a:b] + length)]
            part[place[a + 1:b + 1] - place[a] - 1] = 0xFD
            np.add(part, 1, out=text[place[a]:place[b]])
        # the smallest document per window; segments lie one after the other
        base = np.concatenate([[0], np.cumsum(windows)])
        best = stored(np.repeat(docs, windows))
        owner_of = stored(np.repeat(np.arange(len(sorted_), dtype=np.int32), held + length))
        at_window = base[sorted_] + offset

        def slot(pos):
            """Index into ``best`` of suffixes that start a window, else -1."""
            own = owner_of[np.minimum(pos, size - 1)]
            inside = pos - place[own]
            return np.where((pos < size) & (inside < held[own]), at_window[own] + inside, -1)

        same: dict[int, int] = {}
        long_runs = []
        for pos, low, run in (ordered_suffixes(text, min(length + 8, 250)) if size else ()):
            head = 0
            n = len(pos)
            while head < n:  # blocks that end between groups
                tail = min(n, head + (1 << 20))
                while tail < n and low[tail] >= length:
                    tail += 1
                p, l, r = pos[head:tail], low[head:tail], run[head:tail]
                head = tail
                group = np.cumsum(np.asarray(l) < length)
                at = slot(np.asarray(p))
                ok = np.flatnonzero(at >= 0)
                at, group, r = at[ok], group[ok], np.asarray(r)[ok]
                if not len(at):
                    continue
                cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
                least = np.minimum.reduceat(best[at], cut)
                best[at] = np.repeat(least, np.diff(np.append(cut, len(at))))
                flat = np.flatnonzero(r >= length)  # one symbol only: L and S of it belong together
                for c, x in zip(text[np.asarray(p)[ok][flat]].tolist(), at[flat].tolist()):
                    same[c] = min(same.get(c, NOBODY), int(best[x]))
                    long_runs.append((c, x))
        for c, x in long_runs:
            best[x] = same[c]
        for pack, numbers, ids, least in self.refs:
            if not len(ids):
                continue
            n = windows[ids]
            first = np.cumsum(n) - n
            values = best[np.repeat(base[ids] - first, n) + np.arange(int(n.sum()))]
            news = np.minimum.reduceat(values, first) < least
            if news.any():
                keep = np.flatnonzero(news)
                values, n = values[np.repeat(news, n)], n[keep]
                # runs of one document: (windows, document) pairs
                begins = np.zeros(len(values), bool)
                begins[np.cumsum(n) - n] = True
                begins[1:] |= values[1:] != values[:-1]
                at = np.flatnonzero(begins)
                yield (pack, numbers[keep].tobytes(), np.diff(np.append(at, len(values))).astype(np.uint16).tobytes(),
                       values[at].tobytes())


def cut_pack(table: pa.Table, known: list[bytes], results: list[tuple[bytes, bytes, bytes]], length: int):
    """Per row of the pack: (row, spans as (start, end) pairs, bytes)."""
    rows, ids, data, offsets, (doc, start, windows, which), strings, least, _ = _repeats(table, known, length)
    raw = np.frombuffer(data, np.uint8)
    size = np.array([len(s) - length + 1 for s in strings], np.int64)
    base = np.concatenate([[0], np.cumsum(size)])
    best = np.repeat(least, size)
    for numbers, counts, values in results:
        k = np.frombuffer(numbers, np.uint32).astype(np.int64)
        n = size[k]
        first = np.cumsum(n) - n
        best[np.repeat(base[k] - first, n) + np.arange(int(n.sum()))] = np.repeat(
            np.frombuffer(values, np.int64), np.frombuffer(counts, np.uint16))
    begins = np.zeros(len(raw) + length + 1, bool)
    for a in range(0, len(start), 1 << 15):  # segments in blocks: their windows are many
        n = windows[a:a + (1 << 15)]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        marked = best[np.repeat(base[which[a:a + (1 << 15)]], n) + within] < np.repeat(ids[doc[a:a + (1 << 15)]], n)
        begins[(np.repeat(start[a:a + (1 << 15)], n) + within)[marked]] = True
    # a byte goes if a marked window begins at it or at one of the length - 1 before it
    gone, width = begins, 1
    while width * 2 <= length:
        gone = gone.copy()
        gone[width:] |= gone[:-width].copy()
        width *= 2
    if width < length:
        gone = gone.copy()
        gone[length - width:] |= gone[:-(length - width)].copy()
    gone = gone[:len(raw)]
    for k, row in enumerate(rows):
        a, b = offsets[k], offsets[k + 1]
        g = gone[a:b]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).view(np.int8)))
        yield row, edge.reshape(-1, 2), raw[a:b], g


def _packed(docs: DataFrame, packs: int) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"),
                       F.pmod(F.xxhash64("doc_id", "text"), F.lit(packs)).cast("int").alias("pack"))


def pack_size(total: int) -> int:
    """Bytes of a pack for this many bytes of text."""
    return int(min(MOST_PACK, max(LEAST_PACK, 25 * math.sqrt(total))))


def remove_repeats(docs: DataFrame, length: int = 50, pack_bytes: int | None = None, spans: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row; with ``spans``
    also ``removed`` (array of start, end) and ``kept`` (the remaining bytes)."""
    if length <= ANCHOR:
        raise ValueError(f"length must exceed {ANCHOR}")
    if docs.schema["doc_id"].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError("doc_id must be an integer")
    spark = docs.sparkSession
    ship_package(spark)
    total = docs.agg(F.sum(F.octet_length(F.coalesce(F.col("text"), F.lit("")))).alias("n")).first().n or 0
    packs = max(1, math.ceil(total / (pack_bytes or pack_size(total))))
    packed = _packed(docs, packs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        from ledgerlake.llm import suffix_dedup as s
        got = list(s.pack_anchors(table, length, min(packs, s.MOST_BUCKETS)))
        return pa.table({"bucket": pa.array([g[0] for g in got], pa.int32()),
                         "pack": pa.array([key[0].as_py()] * len(got), pa.int32()),
                         "anchors": pa.array([g[1] for g in got], pa.binary()), "several": pa.array([g[2] for g in got], pa.binary())})

    def repeated(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        from ledgerlake.llm import suffix_dedup as s
        got = list(s.repeated_anchors(*(table.column(c).to_pylist() for c in ("pack", "anchors", "several"))))
        return pa.table({"pack": pa.array([g[0] for g in got], pa.int32()), "known": pa.array([g[1] for g in got], pa.binary())})

    def to_shards(key: tuple[pa.Scalar, ...], table: pa.Table, known: pa.Table) -> pa.Table:
        from ledgerlake.llm import suffix_dedup as s
        got = list(s.pack_segments(table, known.column("known").to_pylist(), length, min(packs, s.MOST_SHARDS)))
        return pa.table({"shard": pa.array([g[0] for g in got], pa.int32()),
                         "pack": pa.array([key[0].as_py()] * len(got), pa.int32()),
                         **{c: pa.array([g[k] for g in got], pa.binary()) for k, c in
                            enumerate(("numbers", "lens", "docs", "data", "anchors"), 1)}})

    def sort_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerlake.llm import suffix_dedup as s
        shard, now = None, None

        def flush():
            for g in shard.results(length):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0]], pa.int32()), *(pa.array([x], pa.binary()) for x in g[1:])],
                    ["pack", "numbers", "counts", "docs"])
        for b in batches:  # sorted by shard
            for k in range(b.num_rows):
                row = [b.column(c)[k].as_py() for c in ("shard", "pack", "numbers", "lens", "docs", "data", "anchors")]
                if row[0] != now:
                    if shard is not None:
                        yield from flush()
                    now, shard = row[0], s.Shard()
                shard.add(*row[1:])
        if shard is not None:
            yield from flush()

    def cut(key: tuple[pa.Scalar, ...], table: pa.Table, aux: pa.Table) -> pa.Table:
        from ledgerlake.llm import suffix_dedup as s
        known = [x for x in aux.column("known").to_pylist() if x is not None]
        results = [r for r in zip(*(aux.column(c).to_pylist() for c in ("numbers", "counts", "docs"))) if r[0] is not None]
        out: dict[str, list] = {c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept")}
        ids = table.column("doc_id").to_pylist()
        for row, edge, raw, gone in s.cut_pack(table, known, results, length):
            kept = raw[~gone].tobytes() if len(edge) else raw.tobytes()
            for c, v in zip(out, (ids[row], len(raw), int((edge[:, 1] - edge[:, 0]).sum()), len(edge), hashlib.sha256(kept).hexdigest(),
                                  edge.tolist() if spans else None, kept if spans else None)):
                out[c].append(v)
        kinds = dict(zip(out, (table.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.string(),
                               pa.list_(pa.list_(pa.int64())), pa.binary())))
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items() if spans or c not in ("removed", "kept")})

    by_pack = packed.groupBy("pack")
    known = (by_pack.applyInArrow(anchors, "bucket int, pack int, anchors binary, several binary")
             .groupBy("bucket").applyInArrow(repeated, "pack int, known binary"))
    pieces = by_pack.cogroup(known.groupBy("pack")).applyInArrow(
        to_shards, "shard int, pack int, numbers binary, lens binary, docs binary, data binary, anchors binary")
    results = (pieces.repartition(min(packs, MOST_SHARDS), "shard").sortWithinPartitions("shard")
               .mapInArrow(sort_shard, "pack int, numbers binary, counts binary, docs binary"))
    null = F.lit(None).cast("binary")
    aux = known.select("pack", "known", null.alias("numbers"), null.alias("counts"), null.alias("docs")).unionByName(
        results.select("pack", null.alias("known"), "numbers", "counts", "docs"))
    more = ", removed array<array<long>>, kept binary" if spans else ""
    return by_pack.cogroup(aux.groupBy("pack")).applyInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{more}")
