"""Packing of documents into training sequences by order-preserving dynamic programming.

Documents keep the order of their table. The tokens of a run of documents (each document's
ids, then an end mark) form one line, which is cut into windows of at most ``window``
tokens. A cut may fall at the end of a document (free), at the end of a sentence or
line (``SENTENCE`` tokens of penalty) or, where no such place is near, inside a sentence
(``INSIDE``). A window of l tokens is padded by ``window - l``, or not at all if l is a
power of two (one below ``SHORT`` is made at the end of a line only). With g(i) = cost(i) + i, the best cut before place j is

    cost(j) = penalty(j) + min(min of g over places in [j - window, j) + window - j,
                               min of cost(j - p) over powers of two p)

The first minimum slides with j: a monotone queue gives it in amortised constant time; the
places at a power of two before j are found for all j at once.

Runs are ended by ``RUN_TOKENS`` tokens or the end of the input partition, so a task
holds one run (or one longer document) whatever the size of the partition; nothing is
shuffled. Inside the last window of a run every place is a candidate, so that its rest can
be cut into powers of two instead of being padded.

Ids are those of the ``tokenizers`` library for the whole text. White space separates the
vocabulary's pre-tokens and is dropped, so each distinct word of a batch is encoded once by the library
and looked up afterwards; words are compared by their bytes, a hash only groups them.

Edges: null and empty texts consist of the end mark alone; texts of any length are packed whole; repeated
rows and ids are packed each on its own; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are ignored. Sequence numbers are unique, not gapless:
partition number times 2^33 plus the sequence's number in its partition, so that a repeated
task gives the same numbers.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import buffers, chunks, same_words, ship_package, word_hashes, word_spans
from ledgerlake.llm.token_count import byte_symbols

WINDOW = 2048
END = 1
SENTENCE = 4
INSIDE = 16
SHORT = 256
RUN_TOKENS = 1 << 19
REMEMBERED = 1 << 21
CHUNK = 1 << 22

# The normalizer and pre-tokenizer that the plain path of WordIds stands for.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

#: Bytes of plain words: printable ASCII without the apostrophe, and the letters U+00C0 to
#: U+00FF (lead byte C3; without the signs U+00D7 and U+00F7).
PLAIN = bytes([b for b in range(33, 127) if b != 39] + [0xC3] + [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])
_PARTS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|\\n|[!-/:-@\\[-`{-~]+")
#: Byte-level stand-ins of the Latin-1 letters.
_SHOWN = {c: "".join(byte_symbols()[b] for b in chr(c).encode("utf-8")) for c in range(0xC0, 0x100)}


def powers(window: int) -> list[int]:
    return [1 << k for k in range(window.bit_length()) if 1 << k <= window]


def padding(length: int, window: int = WINDOW) -> int:
    """Padding of a sequence: up to the window, none at a power of two."""
    return 0 if length & (length - 1) == 0 else window - length


def choose_cuts(at: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Indexes into the ascending places ``at`` (from 0 to the line's length) where the
    cheapest windows begin and end. Neighbouring places lie at most ``window`` apart."""
    n = len(at)
    tail = int(np.searchsorted(at, at[-1] - window))
    js, befores = [], []
    for p in powers(window):
        here = np.arange(tail if p < SHORT else 0, n)  # short sequences only end a line
        found = np.searchsorted(at, at[here] - p)
        hit = np.flatnonzero(at[np.minimum(found, n - 1)] == at[here] - p)
        js.append(here[hit])
        befores.append(found[hit])
    order = np.argsort(np.concatenate(js), kind="stable")
    before = np.concatenate(befores)[order].tolist()
    upto = np.searchsorted(np.concatenate(js)[order], np.arange(1, n + 1)).tolist()
    place, fee = at.tolist(), penalty.tolist()
    cost, came, g = [0] * n, [0] * n, [0] * n
    queue = deque([0])
    old, last, push, pop = queue.popleft, queue.pop, queue.append, upto[0]
    for j in range(1, n):
        x = place[j]
        while place[queue[0]] < x - window:
            old()
        i = queue[0]
        best = g[i] + window - x
        while pop < upto[j]:
            k = before[pop]
            pop += 1
            if cost[k] < best:
                best, i = cost[k], k
        came[j] = i
        cost[j] = best = best + fee[j]
        g[j] = best = best + x
        while queue and g[queue[-1]] > best:
            last()
        push(j)
    cuts, j = [n - 1], n - 1
    while j:
        j = came[j]
        cuts.append(j)
    return cuts[::-1]


def places(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Candidate places with their penalties: document ends, sentence ends, every place of
    the last window, and one window after any place that has no candidate
    close below that (repeated across stretches without any)."""
    def merge(*parts):
        out = np.sort(np.concatenate([*parts, [0, total]]), kind="stable")
        return out[np.append(True, out[1:] != out[:-1])]

    at = merge(doc_ends, sentence_ends, np.arange(max(0, total - window), total))
    fresh, close = at, INSIDE
    while len(fresh):
        far = fresh + window
        far = far[far < total]
        below = at[np.searchsorted(at, far, side="right") - 1]
        fresh, close = far[far - below > close], window // 16
        at = merge(at, fresh) if len(fresh) else at
    fee = np.full(len(at), INSIDE, np.int64)
    fee[np.searchsorted(at, sentence_ends)] = SENTENCE
    fee[np.searchsorted(at, doc_ends)] = 0
    fee[0] = fee[-1] = 0
    return at, fee


def check_vocabulary(path: str) -> str:
    """The vocabulary file's text. Words may be encoded one by one only if white space
    ends every pre-token and is dropped."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = steps[0]
    dropped = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") \
        and r"[^\s" in split.get("pattern", {}).get("Regex", "")
    joins = [t for t in spec.get("added_tokens", []) if t.get("lstrip") or t.get("rstrip") or t.get("single_word")]
    if not dropped or joins or spec.get("post_processor") or spec.get("truncation") or spec.get("padding"):
        raise ValueError("only vocabularies whose pre-tokens end at white space and drop it are supported")
    return text


class WordIds:
    """Ids of words, encoded once by the library and remembered (bounded) per worker."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        spec = json.loads(vocabulary)
        self.library = Tokenizer.from_str(vocabulary)
        self.simple = spec["pre_tokenizer"] == PRE_TOKENIZER and spec["normalizer"] == NORMALIZER
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.parts: dict[str, list[int]] = {}
        self.forget()

    def encoded(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word. A word of ASCII characters and Latin-1 letters needs no general
        normalisation: it is lowered, cut into its pre-tokens here, and the library's merge model
        gives the ids of each. All other words go through the whole library."""
        plain = [self.simple and not w.translate(None, PLAIN) for w in words]
        if any(t in b"\n".join(words) for t in self.special):
            plain = [p and not any(t in w for t in self.special) for w, p in zip(words, plain)]
        text = b"\n".join([*(w for w, p in zip(words, plain) if p), b""]).decode("utf-8").lower()
        if len(self.parts) > REMEMBERED // 4:
            self.parts.clear()
        parts, model, out, word = self.parts, self.library.model.tokenize, [], []
        for part in _PARTS.findall(text):
            if part == "\n":
                out.append(word)
                word = []
                continue
            ids = parts.get(part)
            if ids is None:
                ids = parts[part] = [t.id for t in model(part if part.isascii() else part.translate(_SHOWN))]
            word = word + ids if word else ids
        if len(out) < len(words):
            rest = [w.decode("utf-8", "replace") for w, p in zip(words, plain) if not p]
            others = iter([e.ids for e in self.library.encode_batch_fast(rest, add_special_tokens=False)])
            simple = iter(out)
            out = [next(simple) if p else next(others) for p in plain]
        return out

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted, with the word's number beside
        self.number = np.zeros(0, np.int64)
        self.text = _Grown(np.uint8)  # words' bytes
        self.begin = _Grown(np.int64)
        self.length = _Grown(np.int64)
        self.ids = _Grown(np.uint32)
        self.first = _Grown(np.int64)
        self.count = _Grown(np.int64)

    def _add(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words, encoded anew."""
        lists = self.encoded(words)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        lens = np.fromiter(map(len, words), np.int64, len(words))
        base = self.first.size
        self.first.add(self.ids.size + np.cumsum(counts) - counts)
        self.ids.add(np.fromiter(chain.from_iterable(lists), np.uint32, int(counts.sum())))
        self.count.add(counts)
        self.begin.add(self.text.size + np.cumsum(lens) - lens)
        self.text.add(np.frombuffer(b"".join(words), np.uint8))
        self.length.add(lens)
        return base + np.arange(len(words))

    def of(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first id in ``ids``, number of ids) of every word of ``raw``. Hashes group
        equal words and find known ones; bytes are compared, and words that only share
        a hash are encoded by themselves."""
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        every, one, group = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) + len(every) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.hashes, every)
        known = np.zeros(len(every), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == every[inside]
        numbers = np.zeros(len(every), np.int64)
        numbers[known] = self.number[at[known]]
        data, (b, e) = raw.tobytes(), (starts[one[~known]], ends[one[~known]])
        numbers[~known] = fresh = self._add([data[x:y] for x, y in zip(b.tolist(), e.tolist())])
        self.hashes = np.insert(self.hashes, at[~known], every[~known])
        self.number = np.insert(self.number, at[~known], fresh)
        word = numbers[group]
        same = ends - starts == self.length.all[word]
        same[same] = same_words(raw, starts[same], ends[same], self.text.all, self.begin.all[word[same]])
        if not same.all():
            odd = np.flatnonzero(~same)
            word[odd] = self._add([data[x:y] for x, y in zip(starts[odd].tolist(), ends[odd].tolist())])
        return self.first.all[word], self.count.all[word]


class _Grown:
    """An array that grows by doubling."""

    def __init__(self, kind):
        self.all, self.size = np.zeros(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.all):
            grown = np.zeros(max(need, 2 * len(self.all)), self.all.dtype)
            grown[:self.size] = self.all[:self.size]
            self.all = grown
        self.all[self.size:need] = values
        self.size = need


_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?"]] = True
_WIDE_STOPS = [s.encode("utf-8") for s in "。！？"]


def _ends_sentence(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words that end in a full stop, exclamation or question mark, or before a line break."""
    out = _STOPS[raw[ends - 1]]
    long = np.flatnonzero(ends - starts >= 3)
    for stop in _WIDE_STOPS:
        out[long] |= np.all([raw[ends[long] - 3 + k] == stop[k] for k in range(3)], axis=0)
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    after = np.append(starts[1:], len(raw))
    return out | (breaks[after] > breaks[ends])


def token_lines(raw: np.ndarray, offsets: np.ndarray, words: WordIds, end: int = END) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, document ends, sentence ends) of a run of texts as one line."""
    starts, ends, first = word_spans(raw, offsets)
    slot, count = words.of(raw, starts, ends)
    docs = len(offsets) - 1
    doc_of = np.repeat(np.arange(docs), np.diff(first))
    upto = np.concatenate([[0], np.cumsum(count)])
    begin = upto[:-1] + doc_of  # one end mark after each earlier document
    line = np.full(int(upto[-1]) + docs, end, np.uint32)
    shift = np.arange(int(upto[-1]))
    line[shift + np.repeat(doc_of, count)] = words.ids.all[shift + np.repeat(slot - upto[:-1], count)]
    doc_ends = upto[first[1:]] + np.arange(1, docs + 1)
    inside = (begin + count)[_ends_sentence(raw, starts, ends)] if len(starts) else np.zeros(0, np.int64)
    return line, doc_ends, inside


def pack_line(line: np.ndarray, doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Pieces of a run: ``doc`` (its number), ``start`` in the document, ``begin`` in the line,
    ``length``, ``sequence`` (from 0) and ``offset`` there."""
    at, fee = places(len(line), doc_ends, sentence_ends, window)
    cuts = at[choose_cuts(at, fee, window)]
    doc_starts = np.concatenate([[0], doc_ends[:-1]])
    begin = np.unique(np.concatenate([cuts[:-1], doc_starts]))
    doc = np.searchsorted(doc_starts, begin, side="right") - 1
    seq = np.searchsorted(cuts, begin, side="right") - 1
    return {"doc": doc, "start": begin - doc_starts[doc], "begin": begin,
            "length": np.diff(np.append(begin, len(line))), "sequence": seq, "offset": begin - cuts[seq]}


_WORDS: dict[str, WordIds] = {}


def words_for(key: str, vocabulary) -> WordIds:
    """The worker's words for a vocabulary, kept across tasks."""
    if key not in _WORDS:
        _WORDS[key] = WordIds(vocabulary())
    return _WORDS[key]


class _Run:
    """Lines of the documents that wait for the run's end."""

    def __init__(self):
        self.ids, self.lines, self.doc_ends, self.sentence_ends, self.tokens = [], [], [], [], 0

    def add(self, ids: pa.Array, line: np.ndarray, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> None:
        self.ids.append(ids)
        self.lines.append(line)
        self.doc_ends.append(doc_ends + self.tokens)
        self.sentence_ends.append(sentence_ends + self.tokens)
        self.tokens += len(line)

    def pieces(self, window: int, first: int, with_ids: bool) -> tuple[pa.RecordBatch, int]:
        line, doc_ends = np.concatenate(self.lines), np.concatenate(self.doc_ends)
        p = pack_line(line, doc_ends, np.concatenate(self.sentence_ends), window)
        names = pa.chunked_array(self.ids).combine_chunks()
        data = memoryview(line.astype("<u4").tobytes())
        stops = p["begin"] + p["length"]
        crc = np.fromiter((zlib.crc32(data[4 * a:4 * b]) for a, b in zip(p["begin"].tolist(), stops.tolist())),
                          np.int64, len(stops))
        sizes = np.diff(np.concatenate([[0], doc_ends]))
        cols = {"doc_id": names.take(pa.array(p["doc"])), "start": pa.array(p["start"]), "length": pa.array(p["length"]),
                "ids_crc32": pa.array(crc), "doc_tokens": pa.array(sizes[p["doc"]]),
                "sequence_id": pa.array(p["sequence"] + first), "offset": pa.array(p["offset"])}
        if with_ids:
            cols["ids"] = pa.ListArray.from_arrays(pa.array(np.append(p["begin"], len(line)).astype(np.int32)),
                                                   pa.array(line.astype(np.int32)))
        return pa.RecordBatch.from_pydict(cols), first + int(p["sequence"][-1]) + 1


def pack_documents(docs: DataFrame, vocabulary_path: str, window: int = WINDOW, end: int = END,
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset),
    with ``ids`` (array<int>) on request. The vocabulary (bounded by its file) is read on
    the driver and broadcast."""
    if window < 2 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(check_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from ledgerlake.llm import packing
        words = packing.words_for(vocabulary_path, lambda: shared.value)
        number = TaskContext.get().partitionId() << 33
        held = packing._Run()
        for b in batches:
            raw, offsets = packing.buffers(b.column("text"))
            for i, j in packing.chunks(offsets, packing.CHUNK):
                part = raw[offsets[i]:offsets[j]]
                held.add(b.column("doc_id").slice(i, j - i),
                         *packing.token_lines(part, offsets[i:j + 1] - offsets[i], words, end))
                if held.tokens >= packing.RUN_TOKENS:
                    out, number = held.pieces(window, number, with_ids)
                    held = packing._Run()
                    yield out
        if held.tokens:
            yield held.pieces(window, number, with_ids)[0]

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    tail = ", ids array<int>" if with_ids else ""
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                f"sequence_id long, offset long{tail}")


def sequences(pieces: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """The sequences of ``pack_documents(..., with_ids=True)``: (sequence_id, ids padded to the
    window or a power of two, length without padding, doc_ids and lengths of the pieces). At most ``window``
    tokens meet in a group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    one = pieces.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("length"))
    whole = F.flatten(F.transform("p", lambda x: x.getField("ids")))
    exact = F.bit_count("length") == 1
    fill = F.when(exact, F.lit(0)).otherwise(F.lit(window) - F.col("length")).cast("int")
    return one.select("sequence_id", F.concat(whole, F.array_repeat(F.lit(pad), fill)).alias("ids"), "length",
                      F.transform("p", lambda x: x.getField("doc_id")).alias("doc_ids"),
                      F.transform("p", lambda x: x.getField("length")).alias("lengths"))
