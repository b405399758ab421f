"""Benchmark decontamination: character grams, counts by diagonal, exact edit verification.

Texts and items become words (A-Z lowered, other ASCII but letters and digits is a
separator) joined with single spaces. An item counts as held if its edit distance to some
part of the text is at most ``k``, that is ``1 - similarity`` times its length.

Every gram of ``q`` characters that an item and a text share is a hit on a diagonal (place
in the text minus place in the item). An alignment within ``k`` edits stays on diagonals
at most ``k`` apart, so all its hits lie in three neighbouring stripes of ``k / 2``
diagonals. Three stripes whose hits cover at least ``need`` places of the item are a
candidate. ``q``, ``need`` and the places are derived per item from ``k`` and the item's characters
and words: of simulated passages with exactly ``k`` edits, thrown at random places, spread as
typos over the words, one in every stretch of ``length / k`` characters, or one every
``length / k`` characters, a share of ``RECALL`` must reach ``need``, by way of each. The longest grams that
can are taken, and of these as few of the rarest as reach ``LEAST_HITS``; how rare a gram is, is told by the first 10,000
characters of a sample of ``SAMPLE`` items (that decides which grams are looked up, not what is found). Grams are exact,
and the folded counters only overcount.

Candidates are verified exactly: pieces of up to 64 characters are compared with their
parts of the stripes, many candidates at once; a candidate goes only when its pieces' edits
add up to more than ``k``. For the others the smallest edit distance of the whole item to any
part of the stretch decides.

Item grams are broadcast in blocks of at most ``BLOCK_KEYS`` slots, one pass over the
texts per block, so any number of items is covered with a fixed bound.

Edges: null and empty texts and items match nothing, so do items without words; items
shorter than ``MIN_WORDS`` words match whole words only, within the same distance; repeated items and
rows are reported each; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import buffers, chunks, lower_table, ship_package

RECALL, TRIALS, LONGEST_GRAM = 0.975, 400, 7
BLOCK_KEYS, SLOTS = 1_000_000, 8  # slots of the gram table for each character of an item
MIN_WORDS = 6
CHUNK, PIECE, LANES, LEAST_HITS, STRIPES = 1 << 20, 64, 1 << 13, 6, 3
SEGMENT, MOST_HITS = 1 << 16, 1 << 22
SAMPLE = 2000  # items that tell how common a gram is


def _plain_table() -> np.ndarray:
    t = lower_table()
    for b in range(128):
        if not chr(b).isalnum():
            t[b] = 0x20
    return t


PLAIN = _plain_table()


def plain_words(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(PLAIN.tobytes()).split()


def allowed_edits(length: int, similarity: float) -> int:
    return int((1 - similarity) * length + 1e-9)


def surviving(length: int, borders: np.ndarray, k: int) -> list[np.ndarray]:
    """Which characters stay untouched in ``TRIALS`` simulated passages with ``k`` edits, by
    way of editing: at random, one a word, one a stretch, one every so many characters."""
    rng = np.random.default_rng([length, k])
    out = []
    draw = rng.random((TRIALS, length))
    random_places = np.argsort(draw, 1)[:, :k]
    out.append(random_places)
    starts, ends = borders
    words = np.argsort(rng.random((TRIALS, len(starts))), 1)[:, :k]
    typos = starts[words] + (rng.random(words.shape) * (ends - starts)[words]).astype(np.int64)
    out.append(np.concatenate([typos, random_places[:, :k - typos.shape[1]]], 1) if k > typos.shape[1] else typos)
    out.append(((np.arange(k) + rng.random((TRIALS, k))) * (length / max(k, 1))).astype(np.int64))
    out.append(((np.arange(k) + rng.random((TRIALS, 1))) * (length / max(k, 1))).astype(np.int64))
    masks = []
    for places in out:
        kept = np.ones((TRIALS, length), np.int32)
        np.put_along_axis(kept, np.minimum(places, length - 1), 0, 1)
        masks.append(kept)
    return masks


def gram_rule(body: bytes, k: int, counts: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[int, int, np.ndarray]:
    """(q, need, places): the longest grams of which passages with ``k`` edits keep enough, as few
    of the item's rarest as do, and how many of those such passages keep."""
    length = len(body)
    raw = np.frombuffer(body, np.uint8)
    space = np.flatnonzero(raw == 0x20)
    borders = np.append(0, space + 1), np.append(space, length)
    sums = [np.concatenate([np.zeros((TRIALS, 1), np.int32), np.cumsum(m, 1, dtype=np.int32)], 1)
            for m in surviving(length, borders, k)]
    worst = int((1 - RECALL) * TRIALS)  # so many of the trials may keep fewer

    def kept(w: np.ndarray) -> np.ndarray:
        return np.partition(w, worst, axis=0)[worst]

    for q in range(min(LONGEST_GRAM, length), 0, -1):
        whole = [s[:, q:] - s[:, :length - q + 1] == q for s in sums]
        every = length - q + 1
        least = min(LEAST_HITS, every)
        if q > 1 and min(int(kept(w.sum(1))) for w in whole) < least:
            continue
        rare = np.argsort(frequency(grams(raw, q), counts[q]), kind="stable")
        need = np.min([kept(np.cumsum(w[:, rare], 1, dtype=np.int32)) for w in whole], axis=0)  # of the first 1, 2, ... places
        enough = np.flatnonzero(need >= least)
        m = int(enough[0]) + 1 if len(enough) else every
        return q, max(1, int(need[m - 1])), np.sort(rare[:m])


def gram_counts(bodies: Sequence[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length, how often the items hold each gram: common grams find little."""
    out = {}
    for q in range(1, LONGEST_GRAM + 1):
        out[q] = np.unique(np.concatenate([np.zeros(0, np.uint64), *(grams(np.frombuffer(b, np.uint8), q) for b in bodies)]),
                           return_counts=True)
    return out


def frequency(gram: np.ndarray, counts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, n = counts
    if not len(known):
        return np.zeros(len(gram), np.int64)
    at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
    return np.where(known[at] == gram, n[at], 0)


def grams(raw: np.ndarray, q: int) -> np.ndarray:
    """The ``q`` <= 8 bytes at each place as one integer."""
    if len(raw) < q:
        return np.zeros(0, np.uint64)
    out, have = raw.astype(np.uint64), 1
    while have < q:
        step = min(have, q - have)
        out = out[:-step] | out[step:] << np.uint64(8 * step)
        have += step
    return out


def hashed(gram: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int32)


class GramTable:
    """Grams of all items with the same ``q``, found by slot without a search."""

    def __init__(self, q: int, members: list[int], bodies: list[bytes], places: list[np.ndarray]):
        self.q = q
        gram = np.concatenate([grams(np.frombuffer(bodies[k], np.uint8), q)[places[k]] for k in members])
        item = np.repeat(members, [len(places[k]) for k in members])
        place = np.concatenate([places[k] for k in members])
        self.bits = min(22, max(12, (len(gram) * SLOTS).bit_length()))
        slot = hashed(gram, self.bits)
        order = np.argsort(slot, kind="stable")
        self.gram, self.item, self.place = gram[order], item[order].astype(np.int32), place[order].astype(np.int32)
        self.held = np.bincount(slot, minlength=1 << self.bits) > 0
        self.first = np.append(0, np.cumsum(np.bincount(slot, minlength=1 << self.bits))).astype(np.int32)

    def expected(self, raw: np.ndarray) -> int:
        """At most how many hits ``raw`` has."""
        slot = hashed(grams(raw, self.q), self.bits)
        return int((self.first[1:][slot] - self.first[slot]).sum(dtype=np.int64))

    def hits(self, raw: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``raw``, item, place in the item) of every shared gram inside one
        ``text`` (given per byte)."""
        gram = grams(raw, self.q)
        slot = hashed(gram, self.bits)
        at = np.flatnonzero(self.held[slot])
        at = at[text[at] == text[at + self.q - 1]]
        slot = slot[at]
        begin = self.first[slot]
        n = self.first[1:][slot] - begin
        total = np.cumsum(n, dtype=np.int32)
        row = np.repeat(begin - (total - n), n) + np.arange(int(total[-1]) if len(total) else 0, dtype=np.int32)
        at = np.repeat(at.astype(np.int32), n)
        same = self.gram[row] == gram[at]
        at, row = at[same], row[same]
        return at, self.item[row], self.place[row]


class ItemIndex:
    """Grams of a block of items, and the pieces that verify candidates."""

    def __init__(self, items: Sequence[tuple[object, str]], similarity: float, counts: dict[int, tuple[np.ndarray, np.ndarray]] | None = None):
        self.similarity = similarity
        self.items = [(i, b" ".join(w), len(w)) for i, t in items if (w := plain_words(t or ""))]
        bodies = [body for _, body, _ in self.items]
        self.edits = np.array([allowed_edits(len(b), similarity) for b in bodies], np.int64)
        self.length = np.array([len(b) for b in bodies], np.int64)
        counts = gram_counts(bodies) if counts is None else counts
        rules = [gram_rule(b, int(k), counts) for b, k in zip(bodies, self.edits)]
        self.need = np.array([need for _, need, _ in rules], np.int64)
        self.width = np.maximum(1, -(-self.edits // 2))
        self.shift = -(-self.length // self.width) * self.width  # no diagonal of a text is negative
        self.tables = [GramTable(q, [k for k, r in enumerate(rules) if r[0] == q], bodies, [r[2] for r in rules]) for q in sorted({r[0] for r in rules})]
        pieces, self.first_piece = [], [0]
        for k, body in enumerate(bodies):
            cuts = np.linspace(0, len(body), -(-len(body) // PIECE) + 1).astype(int)
            pieces += [(k, a, b) for a, b in zip(cuts, cuts[1:])]
            self.first_piece.append(len(pieces))
        self.first_piece = np.array(self.first_piece)
        self.piece_at = np.array([a for _, a, _ in pieces], np.int64)
        self.piece_len = np.array([b - a for _, a, b in pieces], np.int64)
        self.masks = np.zeros((len(pieces), 256), np.uint64)
        for p, (k, a, b) in enumerate(pieces):
            for j, c in enumerate(bodies[k][a:b]):
                self.masks[p, c] |= np.uint64(1 << j)


def edit_distance_within(item: bytes, stretch: bytes) -> tuple[int, int]:
    """(smallest edit distance of ``item`` to any part of ``stretch``, its end): Myers'
    bit-vector recurrence on one big integer per column."""
    m = len(item)
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    get = masks.get
    for j, c in enumerate(stretch, 1):
        eq = get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = (down | ~(xh | up)) & full
        mh = up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        up = (mh | ~(xv | ph)) & full
        down = ph & xv
        if score < best:
            best, end = score, j
    return best, end


def candidates(raw: np.ndarray, offsets: np.ndarray, index: ItemIndex) -> tuple[np.ndarray, ...]:
    """(text, item, first diagonal, last + 1) of the runs of stripes that hit enough places
    of the item, in order; up to ``STRIPES`` runs that follow each other are one.

    Long texts are searched in segments that overlap by more than any passage is long, and
    texts with very many hits (of repetitive items) a few at a time, so that memory stays
    bounded whatever the texts hold."""
    reach = int(2 * (index.length + index.edits + STRIPES * index.width).max(initial=1))
    size = max(SEGMENT, 4 * reach)
    owner, begins, ends = [], [], []
    for t, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        at = list(range(a, max(a + 1, b - reach), size - reach))
        owner += [t] * len(at)
        begins += at
        ends += [min(b, x + size) for x in at]
    owner, begins, ends = np.array(owner, np.int64), np.array(begins, np.int64), np.array(ends, np.int64)
    if len(owner) > len(offsets) - 1:
        raw = np.concatenate([raw[a:b] for a, b in zip(begins.tolist(), ends.tolist())])
    cuts = np.append(0, np.cumsum(ends - begins))
    found, todo = [], [(0, len(owner))]
    while todo:
        i, j = todo.pop()
        part = raw[cuts[i]:cuts[j]]
        if j - i > 1 and max((t.expected(part) for t in index.tables), default=0) > MOST_HITS:
            todo += [((i + j) // 2, j), (i, (i + j) // 2)]
            continue
        text, item, first, last = _candidates(part, cuts[i:j + 1] - cuts[i], index)
        move = begins[i + text] - (cuts[i + text] - cuts[i])
        found.append(np.stack([owner[i + text], item, first + move, last + move], 1))
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    return tuple(np.unique(rows, axis=0).T) if len(rows) else (np.zeros(0, np.int64),) * 4


def _candidates(raw: np.ndarray, offsets: np.ndarray, index: ItemIndex) -> tuple[np.ndarray, ...]:
    """``candidates`` of a few texts."""
    texts = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    within = np.arange(len(raw), dtype=np.int32) - offsets[:-1].astype(np.int32)[texts]
    part, shift = 1 / index.width, index.shift.astype(np.int32)
    found = []
    for table in index.tables:
        at, item, place = table.hits(raw, texts)
        if not len(at):
            continue
        text = texts[at]
        stripe = ((within[at] - place + shift[item] + 0.5) * part[item]).astype(np.int32)  # + 0.5: safe from rounding
        size = 1 << max(12, (2 * len(at)).bit_length())
        base = (np.arange(len(index.items)) * 0x9E3779B1 & (size - 1)).astype(np.int32)
        apart = (np.arange(len(offsets)) * 0x85EBCA6B & (size - 1)).astype(np.int32)
        slot = (base[item] + apart[text] + stripe) & np.int32(size - 1)
        counts = np.bincount(slot, minlength=size).astype(np.int32)
        counts = np.append(counts, counts[:STRIPES - 1])
        run = sum(counts[j:size + j] for j in range(STRIPES))  # by its first stripe
        need = index.need.astype(np.int32)
        needed = need[item]
        enough = [run[slot - back] >= needed for back in range(STRIPES)]
        some = np.flatnonzero(np.logical_or.reduce(enough))
        if not len(some):
            continue
        text, item, stripe, place = text[some], item[some], stripe[some], place[some]
        enough = [e[some] for e in enough]
        count, span, depth = len(index.items), int(stripe.max()) + STRIPES + 1, int(place.max()) + 1
        exact = (len(offsets) * count * span * depth).bit_length() < 63
        key = (text.astype(np.int64) * count + item) * span + stripe + STRIPES
        if not exact:
            names, key = np.unique(np.concatenate([key - back for back in range(STRIPES)]), return_inverse=True)
        keys = []
        for back, some in enumerate(enough):
            own = key[some] - back if exact else key[back * len(place):(back + 1) * len(place)][some]
            keys.append(own * depth + place[some])
        pairs = np.sort(np.concatenate(keys))
        pairs = pairs[np.diff(pairs, prepend=-1) != 0] // depth
        edge = np.flatnonzero(np.diff(pairs, prepend=-1))
        hits = np.diff(np.append(edge, len(pairs)))
        key = pairs[edge] if exact else names[pairs[edge]]
        key = key[hits >= need[key // span % count]]
        starts = np.diff(key, prepend=-2) != 1
        nth = np.arange(len(key)) - np.maximum.accumulate(np.where(starts, np.arange(len(key)), 0))
        head = np.flatnonzero(nth % STRIPES == 0)
        more = np.diff(np.append(head, len(key))) - 1
        owner, stripe = np.divmod(key[head], span)
        text, item = np.divmod(owner, count)
        begin = offsets[text] + (stripe - STRIPES) * index.width[item] - index.shift[item]
        found.append(np.stack([text, item, begin, begin + (STRIPES + more) * index.width[item]], 1))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    rows = np.concatenate(found)
    return tuple(rows[np.lexsort(rows.T[::-1])].T)


def plausible(raw: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray, index: ItemIndex) -> np.ndarray:
    """Which candidates may be within the allowed edits: piece by piece, the smallest edits
    of each in its part of the stripes add up to no more. ``begin`` and ``end``: the
    diagonals; ``low`` and ``high``: the text."""
    edits = np.zeros(len(item), np.int64)
    left = np.arange(len(item))
    nth = 0
    while len(left):
        k = item[left]
        piece = index.first_piece[k] + nth
        size = index.piece_len[piece]
        start = begin[left] + index.piece_at[piece]
        stop = np.minimum(end[left] + index.piece_at[piece] + size, high[left])
        edits[left] += piece_edits(raw, np.maximum(start, low[left]), stop, piece, size, index.masks.reshape(-1))
        nth += 1
        left = left[(edits[left] <= index.edits[k]) & (nth < np.diff(index.first_piece)[k])]
    return edits <= index.edits[item]


def piece_edits(raw: np.ndarray, start: np.ndarray, stop: np.ndarray, piece: np.ndarray, size: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Smallest edit distance of each piece to any part of its stretch: the recurrence of
    ``edit_distance_within`` on many stretches at once."""
    out = size.copy()
    one = np.uint64(1)
    by_length = np.argsort(stop - start, kind="stable")
    for some in np.array_split(by_length, max(1, -(-len(by_length) // LANES))):
        place, z, base = start[some].copy(), stop[some], piece[some] * 256
        top = (size[some] - 1).astype(np.uint64)
        score = size[some].astype(np.int64)
        best = score.copy()
        up, down = np.full(len(some), ~np.uint64(0)), np.zeros(len(some), np.uint64)
        sure = int((z - place).min(initial=1 << 40))
        with np.errstate(over="ignore"):
            for step in range(int((z - place).max(initial=0))):
                code = raw[place] if step < sure else np.where(place < z, raw[np.minimum(place, len(raw) - 1)], 0)
                eq = masks[base + code]
                diagonal = (((eq & up) + up) ^ up) | eq | down
                plus, minus = down | ~(diagonal | up), diagonal & up
                score += ((plus >> top) & one).view(np.int64)
                score -= ((minus >> top) & one).view(np.int64)
                np.minimum(best, score, out=best)
                plus <<= one
                minus <<= one
                up, down = minus | ~(diagonal | plus), plus & diagonal
                place += 1
        out[some] = best
    return out


def whole_words_within(item: bytes, stretch: bytes, limit: int) -> tuple[int, int]:
    """(smallest edit distance of ``item`` to a run of whole words of ``stretch``, its end), as
    far as it is within ``limit``."""
    best, end = len(item) + 1, 0
    starts = [p for p in range(len(stretch)) if stretch[p] != 0x20 and (p == 0 or stretch[p - 1] == 0x20)]
    for a in starts:
        row = list(range(len(item) + 1))
        for j, c in enumerate(stretch[a:a + len(item) + limit], a + 1):
            new = [row[0] + 1]
            for i, x in enumerate(item, 1):
                new.append(min(new[-1] + 1, row[i] + 1, row[i - 1] + (x != c)))
            row = new
            if row[-1] < best and c != 0x20 and (j == len(stretch) or stretch[j] == 0x20):
                best, end = row[-1], j
    return best, end


def joined(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as words with single spaces, and their offsets."""
    plain = PLAIN[raw]
    keep = np.ones(len(plain), bool)
    keep[1:] = (plain[1:] != 0x20) | (plain[:-1] != 0x20)
    return plain[keep], np.append(0, np.cumsum(keep))[offsets]


def scan(raw: np.ndarray, offsets: np.ndarray, index: ItemIndex, known: dict) -> list[tuple[int, int, int, int, int]]:
    """(text, item position in the index, edits, first word, last word + 1) of every
    verified passage of a run of texts; one per item and stretch."""
    raw, offsets = joined(raw, offsets)
    text, item, begin, reach = candidates(raw, offsets, index)
    if not len(text):
        return []
    some = plausible(raw, item, begin, reach, offsets[text], offsets[text + 1], index)
    starts = raw != 0x20  # where words start
    starts[1:] &= raw[:-1] == 0x20
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    starts[inner] = raw[inner] != 0x20
    words = np.append(0, np.cumsum(starts))
    out, done = [], {}
    for t, k, at, past in zip(*(x[some].tolist() for x in (text, item, begin, reach))):
        _, body, n = index.items[k]
        limit = int(index.edits[k])
        low, high = int(offsets[t]), int(offsets[t + 1])
        a = max(low, at, done.get((t, k), 0))
        z = min(high, past + len(body))
        if z <= a:
            continue
        if n < MIN_WORDS:
            while a > low and raw[a - 1] != 0x20:
                a -= 1
            while z < high and raw[z] != 0x20:
                z += 1
        stretch = raw[a:z].tobytes()
        if (verdict := known.get((k, stretch))) is None:
            verdict = edit_distance_within(body, stretch)
            if n < MIN_WORDS and verdict[0] <= limit:
                verdict = whole_words_within(body, stretch, limit)
            if len(known) > 50_000:
                known.clear()
            known[(k, stretch)] = verdict
        edits, end = verdict
        if edits <= limit:
            done[(t, k)] = a + end
            first = int(words[a] - words[low]) - bool(a > low and raw[a - 1] != 0x20 and raw[a] != 0x20)
            last = first + len(stretch.split())
            out.append((t, k, edits, first, last))
    return out


def _blocks(benchmark: DataFrame, similarity: float) -> Iterator[ItemIndex]:
    """Indexes of blocks of items, each within the bound on its slots."""
    rows = benchmark.select(F.col("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = max(1, math.ceil(size * SLOTS / BLOCK_KEYS))
    sample = rows.select(F.substring("text", 1, 10_000).alias("text")).orderBy(F.xxhash64("text"), "text").limit(SAMPLE).collect()
    counts = gram_counts([b" ".join(plain_words(r.text)) for r in sample])
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        if part:
            index = ItemIndex([(r.item_id, r.text) for r in part], similarity, counts)
            if index.items:
                yield index


def find_contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(doc_id, item_id, edits, similarity, first_word, last_word) of every passage of
    every text that holds an item; nothing for clean texts."""
    spark = docs.sparkSession
    ship_package(spark)
    kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {kind}, item_id {item_kind}, edits int, similarity double, first_word int, last_word int"
    out = spark.createDataFrame([], schema)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for index in _blocks(benchmark, similarity):
        out = out.unionByName(rows.mapInArrow(_hit_rows(spark.sparkContext.broadcast(index)), schema))
    return out


def _hit_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerlake.llm import decontamination as d
        index, known = shared.value, {}
        for b in batches:
            raw, offsets = buffers(b.column("text"))
            for i, j in chunks(offsets, CHUNK):
                hits = d.scan(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], index, known)
                if hits:
                    items = [index.items[h[1]] for h in hits]
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(pa.array([i + h[0] for h in hits])), pa.array([x[0] for x in items]),
                         pa.array([h[2] for h in hits], pa.int32()),
                         pa.array([1 - h[2] / len(x[1]) for h, x in zip(hits, items)]),
                         pa.array([h[3] for h in hits], pa.int32()), pa.array([h[4] for h in hits], pa.int32())],
                        ["doc_id", "item_id", "edits", "similarity", "first_word", "last_word"])
    return run


def _holds(shared):
    @F.arrow_udf("boolean")
    def holds(col: pa.Array) -> pa.Array:
        from ledgerlake.llm import decontamination as d
        raw, offsets = buffers(col)
        hit, known = np.zeros(len(offsets) - 1, bool), {}
        for i, j in chunks(offsets, CHUNK):
            for h in d.scan(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], shared.value, known):
                hit[i + h[0]] = True
        return pa.array(hit)
    return holds


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``docs`` without the rows that hold a passage of an item. No shuffle."""
    ship_package(docs.sparkSession)
    for index in _blocks(benchmark, similarity):
        docs = docs.where(~_holds(docs.sparkSession.sparkContext.broadcast(index))("text"))
    return docs
