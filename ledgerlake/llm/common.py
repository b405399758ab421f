"""Helpers shared by the operators: Arrow text buffers, shared scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import ensure_checkpoint_dir

#: Whitespace of every contract here: the ASCII bytes 0x20 and 0x09-0x0D.
SPACE_BYTES = np.zeros(256, dtype=bool)
SPACE_BYTES[[0x20, *range(0x09, 0x0E)]] = True

CHUNK_BYTES = 1 << 21


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per SparkContext, so that Python
    workers can import it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-"), "ledgerlake_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("ledgerlake", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._ledgerlake_shipped = True


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back: cuts
    the lineage, and every later reader sees the same rows."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty. The
    bytes start at the first row's text, so offsets[0] is 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of whole texts with at most ``limit`` bytes, or one longer text."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def splitmix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (public-domain splitmix64 constants), wrapping."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z and leaves the rest."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_table()
_WORD_POW = None
_WORD_BYTE = None


def word_spans(raw: np.ndarray, offsets: np.ndarray,
               gaps: np.ndarray = SPACE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the words of a run of texts: byte spans of maximal
    runs without a byte of ``gaps`` that never cross texts, and per text the index of its
    first word (length texts + 1)."""
    inside = np.zeros(len(raw) + 1, dtype=bool)
    np.logical_not(gaps[raw], out=inside[:-1])
    border = np.zeros(len(raw) + 1, dtype=bool)
    border[offsets] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | border))
    ends = np.flatnonzero(before & (~inside | border))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes (order-sensitive, mixed)."""
    global _WORD_POW, _WORD_BYTE
    if _WORD_POW is None:
        r = np.random.default_rng(7)
        _WORD_BYTE = r.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        _WORD_POW = r.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    at = np.arange(int(lens.sum()), dtype=np.int64)
    first = np.cumsum(lens) - lens
    within = at - np.repeat(first, lens)
    with np.errstate(over="ignore"):
        body = raw[np.repeat(starts, lens) + within]
        parts = _WORD_BYTE[body] * _WORD_POW[within & 4095]
        return splitmix(np.add.reduceat(parts, first) + lens.astype(np.uint64))


def same_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray,
               o_starts: np.ndarray) -> np.ndarray:
    """Per word of ``raw``: whether the word of equal length at ``o_starts`` in ``other``
    has the same bytes (words are not empty)."""
    if not len(starts):
        return np.zeros(0, bool)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    at = np.arange(int(lens.sum()), dtype=np.int64)
    return np.logical_and.reduceat(raw[at + np.repeat(starts - first, lens)] == other[at + np.repeat(o_starts - first, lens)],
                                   first)


def word_counts(col: pa.Array) -> pa.Array:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in each text; null counts as empty."""
    raw, offsets = buffers(col)
    out = np.zeros(len(offsets) - 1, np.int64)
    for i, j in chunks(offsets, 1 << 23):
        part = raw[offsets[i]:offsets[j]]
        _, _, first = word_spans(part, offsets[i:j + 1] - offsets[i])
        out[i:j] = np.diff(first)
    return pa.array(out)


def word_count(col: Column) -> Column:
    """``word_counts`` as a column function (Arrow batches)."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("long")
    def count(text: pa.Array) -> pa.Array:
        return word_counts(text)
    return count(col)
