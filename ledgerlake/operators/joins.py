"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup side is broadcast only when it provably has at most this many rows
# (two short strings per row: a few tens of MB at the bound).
MAX_BROADCAST_ROWS = 500_000


# ... and no more than this many bytes of values, so that wide rows don't pass by their number.
MAX_BROADCAST_BYTES = 64 << 20


def has_at_most(df: DataFrame, n: int, most_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``n`` rows and their text at most ``most_bytes``. One partial and final
    aggregate: a task sends one row, whatever ``df`` holds (``limit(n + 1)`` would bring n + 1
    rows of every task to a single one)."""
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        size = F.octet_length(c if f.dataType.typeName() in ("string", "binary") else
                              F.to_json(F.struct(c)) if f.dataType.typeName() in ("struct", "array", "map") else c.cast("string"))
        width = width + F.coalesce(size, F.lit(0)).cast("long")
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= n and size <= most_bytes


def lookup_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The right side of a lookup join: broadcast when small, else left to a shuffle join.

    Beyond the bound the join runs as a sort-merge join; AQE's skew-join split
    (on by default) then splits a hot key's partition on the streamed side.
    """
    return F.broadcast(df) if has_at_most(df, max_rows) else df
