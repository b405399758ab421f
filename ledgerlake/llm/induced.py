"""Suffix order and common prefixes of one shard by external induced sorting.

A shard is a text of symbols with a smallest last symbol. S* suffixes (those smaller
than their successor, after a larger symbol) are ordered by recursion: S* substrings
are named in order and the string of names is sorted the same way. Then all L suffixes
are induced from them in ascending order, and all S suffixes from those in descending
order: a priority queue holds tuples (first symbol, position, common prefix, run of the first
symbol); the smallest is popped and pushes the tuple of the suffix one symbol
longer. Equal first symbols leave in the order they came.

Common prefixes travel with the tuples: two suffixes pushed one after the other to the
same symbol share one symbol more than the least common prefix met between their
parents. Where L meets S below the same symbol, the prefix is the shorter run.

Tuples are popped and pushed in blocks. The queue keeps sorted runs, merged as they
pile up; runs, the text and the ordered suffixes go to unnamed files as soon as they
exceed ``SPILL`` bytes, like Spark's own spills: they live within one task attempt, nothing else
reads them, and a lost executor's task starts again from its input.

Order and prefixes are exact up to ``cap`` symbols; suffixes that agree that far may
come in any order.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

SPILL = 64 << 20
BLOCK = 1 << 16
_BASE = 1 << 21  # names that are sorted in memory, where the recursion ends


def stored(a: np.ndarray) -> np.ndarray:
    """``a``, mapped from an unnamed file if it is large."""
    if a.nbytes < SPILL:
        return a
    f = tempfile.TemporaryFile()
    m = np.memmap(f, a.dtype, "w+", shape=a.shape)
    m[:] = a
    m.flush()
    return m


class Runs:
    """External priority queue: sorted runs of (key, position, prefix, run), oldest first;
    equal keys leave in the order they were pushed."""

    def __init__(self):
        self.runs: list[list] = []  # [arrays, first unread]

    def push(self, key, *columns) -> None:
        if not len(key):
            return
        order = np.argsort(key, kind="stable")
        self.runs.append([tuple(c[order] for c in (key, *columns)), 0])
        while len(self.runs) > 1 and self._left(-2) <= 2 * self._left(-1):
            newer, older = self.runs.pop(), self.runs.pop()
            both = [np.concatenate([a[older[1]:], b[newer[1]:]]) for a, b in zip(older[0], newer[0])]
            order = np.argsort(both[0], kind="stable")
            self.runs.append([tuple(stored(c[order]) for c in both), 0])

    def _left(self, k: int) -> int:
        return len(self.runs[k][0][0]) - self.runs[k][1]

    def least(self):
        self.runs = [r for r in self.runs if r[1] < len(r[0][0])]
        return min((r[0][0][r[1]] for r in self.runs), default=None)

    def bound(self, ahead: int):
        """A key below which each run holds at most ``ahead`` unread tuples."""
        return min((r[0][0][r[1] + ahead] for r in self.runs if r[1] + ahead < len(r[0][0])), default=None)

    def below(self, bound, take: bool):
        """All tuples with a key below ``bound`` (None: all), in order."""
        parts = []
        for r in self.runs:
            end = len(r[0][0]) if bound is None else max(r[1], int(np.searchsorted(r[0][0], bound, "left")))
            parts.append([c[r[1]:end] for c in r[0]])
            if take:
                r[1] = end
        if not parts:
            return None
        out = [np.concatenate(c) for c in zip(*parts)]
        order = np.argsort(out[0], kind="stable")
        return [c[order] for c in out]

    def some_of(self, key, most: int):
        """Up to ``most`` of the oldest tuples with this key."""
        parts, n = [], 0
        for r in self.runs:
            end = r[1] + int(np.searchsorted(r[0][0][r[1]:r[1] + most - n], key, "right"))
            if end > r[1]:
                parts.append([c[r[1]:end] for c in r[0]])
                n += end - r[1]
                r[1] = end
            if n >= most or end < len(r[0][0]) and r[0][0][end] == key:
                break  # newer runs only after this one's are all read
        return [np.concatenate(c) for c in zip(*parts)] if parts else None


def _narrow(pos: np.ndarray, n: int) -> np.ndarray:
    return pos.astype(np.int32 if n < 1 << 31 else np.int64)


def _types(t: np.ndarray):
    """(is S, run length capped at 255) of every position; the last symbol is S."""
    n = len(t)
    change = np.flatnonzero(t[1:] != t[:-1])
    ends = np.append(change, n - 1)
    starts = np.concatenate([[0], ends[:-1] + 1])
    lens = ends - starts + 1
    smaller = np.append(t[change] < t[change + 1], True)
    run = np.repeat(ends, lens) - np.arange(n) + 1
    return np.repeat(smaller, lens), np.minimum(run, 255).astype(np.uint8)


def _least_between(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(low[a:b]) for pairs with a < b."""
    if not len(a):
        return np.zeros(0, low.dtype)
    ext = np.append(low, low.dtype.type(255))
    return np.minimum.reduceat(ext, np.stack([a, b], 1).ravel())[::2]


def _induce(t: np.ndarray, down: bool, seeds, keep_prefix: bool, out) -> None:
    """Induce L suffixes from seeds (S*, ascending) or, ``down``, S suffixes from seeds (all
    L, descending; symbols compare in reverse). ``seeds`` are (position, prefix with
    the seed before, run), in scan order. ``out`` receives arrays (position, prefix, run)."""
    top = int(t.max())
    # keys that ascend in scan order; narrow ones sort by radix
    kind = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64
    key_of = (lambda p: kind(top) - t[p].astype(kind)) if down else (lambda p: t[p].astype(kind))
    queue = Runs()
    s_pos, s_low, s_run = seeds
    at, n_seeds = 0, len(s_pos)
    block = BLOCK if keep_prefix else max(512, int(2 * len(t) ** 0.5))
    ever = np.zeros(top + 1, bool) if keep_prefix else None
    since = np.zeros(top + 1, np.uint8)  # least prefix since the last push in this bucket
    here = np.zeros(top + 1, bool)

    def pushes(pos, key, strict):
        """Which scanned suffixes have a predecessor to induce, and its key."""
        prior = np.maximum(pos - 1, 0)
        d = key_of(prior)
        return (pos > 0) & ((d > key) if strict else (d >= key)), d

    def scan(c, pos, low, run, strict):
        """One block of bucket ``c`` in scan order."""
        which, d = pushes(pos, c, strict)
        w = np.flatnonzero(which)
        if not keep_prefix:
            queue.push(d[w], pos[w] - 1, np.zeros(len(w), np.uint8), np.zeros(len(w), np.uint8))
            return
        least_all = low.min()
        if len(w):
            dw = d[w]
            order = np.argsort(dw, kind="stable")
            ds, idx = dw[order], w[order]
            first = np.concatenate([[True], ds[1:] != ds[:-1]])
            a = np.where(first, 0, np.concatenate([[0], idx[:-1] + 1]))
            least = _least_between(low, a, idx + 1).astype(np.int16)
            f = np.flatnonzero(first)
            df = ds[f]
            least[f] = np.where(here[df], np.minimum(least[f], since[df]), 0)
            prefix = np.minimum(least + 1, 255)
            prefix[f] = np.where(here[df] | ever[df], prefix[f], 0)
            last = np.concatenate([ds[1:] != ds[:-1], [True]])
            tail = np.minimum.accumulate(low[::-1])[::-1]
            end = idx[last] + 1
            rest = np.where(end < len(low), tail[np.minimum(end, len(low) - 1)], 255)
            np.minimum(since, least_all, out=since)
            since[ds[last]] = rest
            here[ds[last]] = True
            ever[ds[last]] = True
            runs = np.where(ds == c, np.minimum(run[idx].astype(np.int16) + 1, 255), 1)
            queue.push(ds, pos[idx] - 1, prefix.astype(np.uint8), runs.astype(np.uint8))
        else:
            np.minimum(since, least_all, out=since)

    while True:
        q = queue.least()
        s = key_of(s_pos[at:at + 1])[0] if at < n_seeds else None
        if q is None and s is None:
            return
        c = min(x for x in (q, s) if x is not None)
        if not keep_prefix:  # many symbols: pop a range of them while nothing falls back into it
            bounds = [queue.bound(block), key_of(s_pos[at + block:at + block + 1])[0] if at + block < n_seeds else None]
            bound = min((b for b in bounds if b is not None), default=None)
            if bound is None or bound > c:
                items = queue.below(bound, False)
                ahead = min(n_seeds, at + block + 1)
                k = np.asarray(key_of(s_pos[at:ahead]))
                m = len(k) if bound is None else int(np.searchsorted(k, bound, "left"))
                if bound is None and at + m < n_seeds:
                    bound = k[-1]
                    m = int(np.searchsorted(k, bound, "left"))
                    items = queue.below(bound, False)
                qk = items[0] if items else np.zeros(0, np.int64)
                qp = items[1] if items else np.zeros(0, np.int64)
                keys = np.concatenate([qk, k[:m]])
                pos = np.concatenate([qp, s_pos[at:at + m]])
                strict = np.zeros(len(pos), bool)
                strict[len(qk):] = True
                order = np.argsort(keys, kind="stable")  # induced before seeds of the same symbol
                keys, pos, strict = keys[order], pos[order], strict[order]
                prior = np.maximum(pos - 1, 0)
                d = key_of(prior)
                go = (pos > 0) & np.where(strict, d > keys, d >= keys)
                back = d[go] if bound is None else d[go & (d < bound)]
                # nothing may fall among symbols popped here: cut before the first that receives
                limit = int(back.min()) if len(back) else None
                if limit is None or limit > c:
                    if limit is not None:
                        cut = int(np.searchsorted(keys, limit, "left"))
                        keys, pos, strict, d, go, bound = keys[:cut], pos[:cut], strict[:cut], d[:cut], go[:cut], limit
                    queue.below(bound, True)
                    at += int(strict.sum())
                    z = np.zeros(len(pos), np.uint8)
                    out(pos[~strict], z[~strict], z[~strict])
                    w = np.flatnonzero(go)
                    queue.push(d[w], pos[w] - 1, z[:len(w)], z[:len(w)])
                    continue
        # one symbol: what is in the queue, in blocks, then its seeds
        here[:] = False
        since[:] = 255
        last_run = None
        while (items := queue.some_of(c, block)) is not None:
            _, pos, low, run = items
            if last_run is None:
                low = low.copy()
                low[0] = 0  # another symbol came before
            out(pos, items[2], run)
            last_run = run[-1]
            scan(c, pos, low, run, False)
        while at < n_seeds:
            part = slice(at, min(n_seeds, at + block))
            k = key_of(s_pos[part])
            m = int(np.searchsorted(k, c, "right"))
            if not m:
                break
            pos, low, run = s_pos[at:at + m], s_low[at:at + m].copy(), s_run[at:at + m]
            if last_run is not None:
                low[0] = min(int(last_run), int(run[0])) if last_run != -1 else low[0]
            else:
                low[0] = 0
            last_run = -1  # later blocks continue among seeds
            scan(c, np.asarray(pos), low, np.asarray(run), True)
            at += m
            if m < len(k):
                break


class _Collected:
    """Arrays of (position, prefix, run) in the order they come, stored in parts."""

    def __init__(self):
        self.parts: list = []
        self.open: list = []
        self.size = 0

    def __call__(self, pos, low, run):
        if len(pos):
            self.open.append((pos, low, run))
            self.size += len(pos)
            if self.size > 1 << 20:
                self._close()

    def _close(self):
        if self.open:
            self.parts.append(tuple(stored(np.concatenate(c)) for c in zip(*self.open)))
            self.open, self.size = [], 0

    def whole(self):
        self._close()
        if not self.parts:
            return np.zeros(0, np.int32), np.zeros(0, np.uint8), np.zeros(0, np.uint8)
        return tuple(stored(np.concatenate(c)) for c in zip(*self.parts))


def _name(t: np.ndarray, stars: np.ndarray, cap: int) -> np.ndarray:
    """Rank of every S* substring among the distinct ones (agreement on ``cap`` symbols counts
    as equal); a proper prefix of another comes after it."""
    n, width = len(t), t.dtype.itemsize
    per = 8 // width
    ends = np.append(stars[1:], n - 1)  # inclusive
    lens = np.minimum(ends - stars + 1, cap)
    words = []
    pad = np.uint64(np.iinfo(t.dtype).max)
    for first in range(0, int(lens.max()), per):
        word = np.zeros(len(stars), np.uint64)
        for j in range(first, first + per):
            inside = j < lens
            symbol = np.where(inside, t[np.minimum(stars + j, n - 1)].astype(np.uint64), pad)
            word = (word << np.uint64(8 * width)) | symbol if width < 8 else symbol
        words.append(word)
        if first and not (lens > first + per).any():
            break
    # the last words differ only among long substrings: sort by the first, refine ties
    order = np.lexsort(words[::-1]) if len(words) > 1 else np.argsort(words[0], kind="stable")
    new = np.zeros(len(stars), bool)
    for w in words:
        s = w[order]
        new[1:] |= s[1:] != s[:-1]
    new[1:] |= lens[order][1:] != lens[order][:-1]
    names = np.empty(len(stars), np.int64)
    names[order] = np.cumsum(new)
    return names


def _small_order(t: np.ndarray, cap: int) -> np.ndarray:
    """Suffix order (to ``cap`` names) of a string that fits in memory, by prefix
    doubling; only suffixes that still tie are sorted again."""
    n = len(t)
    order = np.argsort(t, kind="stable")
    s = t[order]
    start = np.concatenate([[True], s[1:] != s[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))  # place of the group's first
    k = 1
    while k < min(cap, n):
        at = np.flatnonzero(~(start & np.append(start[1:], True)))  # places in groups of several
        if not len(at):
            break
        who = order[at]
        second = np.where(who + k < n, rank[np.minimum(who + k, n - 1)], -1)
        group = rank[who]
        by = np.lexsort((second, group))
        who, second, group = who[by], second[by], group[by]
        order[at] = who
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        start[at] = new
        rank[who] = np.maximum.accumulate(np.where(new, at, 0))
        k *= 2
    return order


def _star_order(t: np.ndarray, is_s: np.ndarray, cap: int) -> np.ndarray:
    """S* positions in suffix order (to ``cap`` symbols)."""
    stars = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    names = _name(t, stars, cap)
    if int(names.max()) + 1 == len(names):
        return _narrow(stars[np.argsort(names)], len(t))
    return _narrow(stars[_order(names.astype(np.uint32), max(2, cap // 2 + 1))], len(t))


def _order(t: np.ndarray, cap: int) -> np.ndarray:
    """Suffix order of a string of names (recursion)."""
    n = len(t)
    if n <= _BASE:
        return _small_order(t, cap)
    is_s, run = _types(t)
    stars = _star_order(t, is_s, cap)
    none = np.zeros(len(stars), np.uint8)
    larger = _Collected()
    _induce(t, False, (stars, none, none), False, larger)
    l_pos = larger.whole()[0]
    none = np.zeros(len(l_pos), np.uint8)
    smaller = _Collected()
    _induce(t, True, (np.ascontiguousarray(l_pos[::-1]), none, none), False, smaller)
    s_pos = smaller.whole()[0][::-1]
    key = np.concatenate([t[l_pos], t[s_pos], t[n - 1:]])
    both = np.concatenate([l_pos, s_pos, [n - 1]])
    kind = np.concatenate([np.zeros(len(l_pos), np.uint8), np.ones(len(s_pos) + 1, np.uint8)])
    return both[np.lexsort((kind, key))]


def _common(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of suffix pairs, up to ``cap``."""
    n = len(t)
    out = np.zeros(len(a), np.uint8)
    live = np.arange(len(a))
    for j in range(cap):
        same = t[np.minimum(a[live] + j, n - 1)] == t[np.minimum(b[live] + j, n - 1)]
        same &= (a[live] + j < n) & (b[live] + j < n)
        live = live[same]
        if not len(live):
            break
        out[live] = j + 1
    return out


def ordered_suffixes(t: np.ndarray, cap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Two sequences of (position, common prefix with the one before, run): the L
    suffixes ascending, then the S suffixes descending (but the last symbol). ``t``
    ends with its only zero."""
    if cap > 250:
        raise ValueError("prefixes are kept in a byte")
    is_s, run = _types(t)
    stars = _star_order(t, is_s, cap)
    low = np.concatenate([[0], _common(t, stars[:-1], stars[1:], cap)]).astype(np.uint8)
    larger = _Collected()
    _induce(t, False, (stored(stars), low, run[stars]), True, larger)
    l_pos, l_low, l_run = larger.whole()
    yield l_pos, l_low, l_run
    down_low = np.concatenate([[0], l_low[:0:-1]]).astype(np.uint8) if len(l_low) else l_low
    smaller = _Collected()
    _induce(t, True, (stored(np.ascontiguousarray(l_pos[::-1])), down_low, np.ascontiguousarray(l_run[::-1])), True, smaller)
    yield smaller.whole()
