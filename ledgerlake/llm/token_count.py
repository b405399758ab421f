"""Token counts of a byte-level BPE vocabulary without emitting identifiers.

Every pre-token starts as one symbol per byte in a doubly linked list; a heap
holds the adjacent pairs that the vocabulary merges, by (rank, position). The
lowest is popped, merged if it still stands, and its new neighbours are pushed.
The count is initial symbols minus merges. Counts of short pre-token groups are
remembered per worker (bounded), since words repeat.

Edges: null and empty texts have 0 tokens; texts of any length are handled whole
(n log n in the longest pre-token); rows are never dropped or merged, so repeated
rows and ids give one result row each; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ship_package

# The pre-token pattern of the byte-level pre-tokenizer. White space is
# spelt out, since engines differ on the control characters 0x1C-0x1F.
_WS = r"\t-\r \x85\xa0  -     　"
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _WS + r"\p{L}\p{N}]+|[" + _WS + r"]+(?![^" + _WS
             + r"])|[" + _WS + r"]+")

REMEMBERED = 250_000
LONGEST_REMEMBERED = 48


def byte_symbols() -> list[str]:
    """Printable stand-in for each byte: itself where Latin-1 prints it, else the
    next code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """Merge ranks and special strings of a ``tokenizers`` JSON file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError("only byte-level BPE files without normalizer and prefix space are supported")
    return {"pairs": pairs, "special": [t["content"] for t in spec.get("added_tokens", [])]}


class PairMerger:
    """Counts tokens of texts for one vocabulary."""

    def __init__(self, vocabulary: dict):
        self.ranks = {p: r for r, p in enumerate(vocabulary["pairs"])}
        self.symbols = byte_symbols()
        self.pre = regex.compile(PRE_TOKEN)
        special = sorted(vocabulary["special"], key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.special_strings = special
        self.after_space = _Remembered(self)

    def merged(self, data: bytes) -> int:
        """Tokens of one pre-token."""
        ranks, sym = self.ranks, [self.symbols[b] for b in data]
        n = len(sym)
        if n < 2:
            return n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i = heapq.heappop(heap)
            left, j = sym[i], after[i]
            if left is None or j >= n or ranks.get((left, sym[j])) != rank:
                continue  # one side has been merged meanwhile
            joined = sym[i] = left + sym[j]
            sym[j] = None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((joined, sym[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := ranks.get((sym[h], joined))) is not None:
                heapq.heappush(heap, (r, h))
        return n - merges

    def plain(self, text: str) -> int:
        return sum(self.merged(p.encode("utf-8")) for p in self.pre.findall(text))

    def ordinary(self, text: str) -> int:
        """A text without special strings. A space that a non-space follows always
        starts a pre-token, so the text is cut there and the pieces looked up."""
        pieces = text.split(" ")
        first = pieces[0]
        try:
            return (self.plain(first) if first else 0) + sum(map(self.after_space.__getitem__, pieces[1:]))
        except _Irregular:
            return self.plain(text)

    def count(self, text: str) -> int:
        if self.special is None or not any(s in text for s in self.special_strings):
            return self.ordinary(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.ordinary, parts))


class _Irregular(Exception):
    """A run of spaces, or white space after a space: cut by the pattern alone."""


class _Remembered(dict):
    def __init__(self, merger: PairMerger):
        super().__init__()
        self.merger = merger

    def __missing__(self, piece: str) -> int:
        if not piece or piece[0].isspace():
            raise _Irregular
        n = self.merger.plain(" " + piece)
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n


_MERGERS: dict[str, PairMerger] = {}


def merger_for(key: str, vocabulary) -> PairMerger:
    """The worker's merger for a vocabulary, kept across tasks."""
    if key not in _MERGERS:
        _MERGERS[key] = PairMerger(vocabulary())
    return _MERGERS[key]


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``. The
    vocabulary (bounded by its file) is read on the driver and broadcast."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(load_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerlake.llm import token_count
        merger = token_count.merger_for(vocabulary_path, lambda: shared.value)
        for b in batches:
            texts = b.column("text")
            counts = pa.array((merger.count(t.as_py() or "") for t in texts), pa.int64(), size=len(texts))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), counts],
                                             ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
