"""Conversation repair: cheapest edits by Four-Russians block tables.

``damage`` applies the stated faults to a table of turns; ``repair`` finds, for each
conversation, the cheapest edits after which its roles read ``(s?(ua)+)?``. Keep costs 0,
Rerole (to user or assistant) 1, Delete 2 (required for blank and duplicate rows), Insert
(an empty user or assistant row) 5; a truncated row that stays costs 5 more.

Method. Four places in the pattern (start, after s, after u, after a) give a cost vector:
what the rest of the conversation costs from each place. A row maps the vector after it to
the one before it. Less their least entry, only a few vectors ever occur, so the map of
every block of ``BLOCK`` row symbols on every such vector is computed once: the vector
before the block and what its least entry grew by. A conversation is read backward block
by block with one lookup each; the vectors at the block ends are remembered. Then it is
traced forward: each block is expanded backward from the vector at its end, and at every row the
first letter in ASCII order (D, I, K, R) that keeps the least cost is taken. From a given
place each letter leads to one place only, so this gives the least audit among the cheapest.

On Spark:

1. Turns are range-partitioned by (conversation, turn, role, text), sorted and written as
   *pieces*: runs of one conversation of at most ``PIECE_ROWS`` rows and ``PIECE_BYTES``
   (or one longer row). A hot conversation is many pieces in many ranges.
2. First occurrences of (conversation, role, text) are a partial aggregate; they are
   brought back by piece, never by their own (hot) key.
3. Per piece, one letter a row goes to the conversation's group: a byte per row, as much
   as its audit, which is one value of the result.
4. The edits go back to the pieces, which write their repaired lines. A conversation of several
   pieces is hashed as a stream of its pieces in order: SHA-256 is a chain, but only a
   batch of pieces is in memory.

Edges: null roles and texts are one space (so the text is blank, the role neither s, u nor
a); a null conversation id is a conversation, a null turn comes first; rows with
equal turns are ordered by role and text (their first 64 characters, then their MD5); equal rows are duplicates of
their first; conversations without rows have zeros, an empty audit and the hash of the empty string; an empty
table gives an empty result; columns other than conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ship_package, written

BLOCK = 4
PIECE_ROWS = 4096
PIECE_BYTES = 1 << 20

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAR = 1 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
#: Place after a user or assistant row that is rewritten or inserted, and that row's letter.
NEXT = (USER, USER, ASSISTANT, USER)
WRITTEN = ("u", "u", "a", "u")
#: Place after a kept row of role s, u, a (none for other roles).
KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
#: Symbols: 0 must go; 1 + role stays at no cost; 5 + role stays truncated.
SYMBOLS = 9


def inserted(v: tuple[int, ...]) -> tuple[int, ...]:
    """Costs when rows may be inserted first."""
    out = list(v)
    for _ in range(2):  # a user and an assistant row at most
        out = [min(out[s], INSERT + out[NEXT[s]]) for s in range(4)]
    return tuple(min(x, FAR) for x in out)


END = inserted((0, FAR, FAR, 0))


def stays(symbol: int, place: int) -> tuple[int, int]:
    """(cost, place after) of keeping a row."""
    to = KEPT[(symbol - 1) % 4].get(place) if symbol else None
    return (FAR, place) if to is None else (KEEP + TRUNCATED * (symbol >= 5), to)


def rewritten(symbol: int, place: int) -> tuple[int, int]:
    return (FAR if not symbol else REROLE + TRUNCATED * (symbol >= 5)), NEXT[place]


def before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row from the costs after it."""
    out = []
    for s in range(4):
        k, ks = stays(symbol, s)
        r, rs = rewritten(symbol, s)
        out.append(min(DELETE + after[s], k + after[ks], r + after[rs], FAR))
    return inserted(tuple(out))


class Tables:
    """Normalised vectors, the map of every block on them, and traced blocks."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [self._low(END)[0]]
        known = {self.vectors[0]: 0}
        step, grow = [], []
        for v in self.vectors:  # grows while it is read
            row, up = [], []
            for s in range(SYMBOLS):
                low, least = self._low(before(s, v))
                if low not in known:
                    known[low] = len(self.vectors)
                    self.vectors.append(low)
                row.append(known[low])
                up.append(least)
            step.append(row)
            grow.append(up)
        one, up = np.array(step, np.int32).T, np.array(grow, np.int64).T  # [symbol, vector]
        self.step, self.grow = one, up
        whole, more = one, up
        for _ in range(block - 1):  # a symbol in front of each block so far
            more = (more[None] + up[:, whole]).reshape(-1, up.shape[1])
            whole = one[:, whole].reshape(-1, one.shape[1])
        self.whole, self.more = whole.tolist(), more.tolist()
        self.traced: dict[tuple, tuple] = {}

    @staticmethod
    def _low(v: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
        least = min(v)
        return tuple(x if x >= FAR else x - least for x in v), least

    def trace(self, symbols: tuple[int, ...], vector: int, place: int) -> tuple[tuple[str, ...], int]:
        """Edits of the rows of a block from a place, given the vector after it: per row
        U/A for each row inserted before, then k, d, u or a. With the place after."""
        key = (symbols, vector, place)
        if key in self.traced:
            return self.traced[key]
        costs = [self.vectors[vector]]
        for s in reversed(symbols):
            costs.append(before(s, costs[-1]))
        costs.reverse()
        edits, at = [], place
        for k, s in enumerate(symbols):
            done = ""
            while True:
                now, after = costs[k], costs[k + 1]
                kc, ks = stays(s, at)
                if DELETE + after[at] == now[at]:
                    done += "d"
                elif INSERT + now[NEXT[at]] == now[at]:
                    done += WRITTEN[at].upper()
                    at = NEXT[at]
                    continue
                elif kc + after[ks] == now[at]:
                    done, at = done + "k", ks
                else:
                    done, at = done + WRITTEN[at], NEXT[at]
                break
            edits.append(done)
        self.traced[key] = tuple(edits), at
        return self.traced[key]

    def edits(self, symbols: np.ndarray) -> tuple[int, list[str]]:
        """(cost, edits of each row); rows inserted at the end follow the last row's letter."""
        n, size = len(symbols), self.block
        head = n % size  # a shorter first block
        parts = symbols[head:].reshape(-1, size).astype(np.int64)
        codes = (parts @ (SYMBOLS ** np.arange(size - 1, -1, -1))).tolist()
        vector, cost, after = 0, 0, []
        for c in reversed(codes):
            after.append(vector)
            cost += self.more[c][vector]
            vector = self.whole[c][vector]
        first = vector
        for s in symbols[:head][::-1].tolist():
            cost += int(self.grow[s, vector])
            vector = int(self.step[s, vector])
        cost += self.vectors[vector][START]
        place, out = START, []
        if head:
            done, place = self.trace(tuple(symbols[:head].tolist()), first, place)
            out += done
        for part, v in zip(parts.tolist(), reversed(after)):
            done, place = self.trace(tuple(part), v, place)
            out += done
        while END[place]:
            out[-1] += WRITTEN[place].upper()
            place = NEXT[place]
        return cost, out


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


AUDIT = str.maketrans("UAkdua", "IIKDRR")
#: Pairs of adjacent roles (s, u, a, other as 0-3) that are legal.
LEGAL = np.zeros((4, 4), bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True


def repaired(pieces: list[dict]) -> dict:
    """Totals and edits of a conversation from its pieces in order: each has ``classes`` (a letter per row), ``firsts``
    (positions of rows that are the first of their kind) and its turns' figures."""
    letters = [np.frombuffer(p["classes"].encode("ascii"), np.uint8) - 97 for p in pieces]
    fresh = np.zeros(sum(map(len, letters)), bool)
    edges = np.concatenate([[0], np.cumsum([len(x) for x in letters])])
    for p, at in zip(pieces, edges):
        fresh[np.asarray(p["firsts"] or [], np.int64) + at] = True
    whole = np.concatenate(letters)
    role, fault = whole % 4, whole // 4
    blank = fault == 2
    duplicate = ~blank & ~fresh
    stay = ~blank & fresh
    truncated = stay & (fault == 1)
    cost, edits = tables().edits(np.where(stay, 1 + role + 4 * truncated, 0))
    turns = [p for p in pieces if p["low"] is not None]
    gaps = 0
    if turns:
        apart = sum(p["kinds"] for p in turns) - sum(a["high"] == b["low"] for a, b in zip(turns, turns[1:]))
        gaps = max(p["high"] for p in turns) - min(p["low"] for p in turns) + 1 - apart
    return {"gaps": gaps, "blank": int(blank.sum()), "duplicate": int(duplicate.sum()), "truncated": int(truncated.sum()),
            "illegal": int((~LEGAL[role[:-1], role[1:]]).sum()), "cost": cost, "audit": "".join(edits).translate(AUDIT),
            "pieces": [{"piece": p["piece"], "edits": edits[a:b]} for p, a, b in zip(pieces, edges, edges[1:])]}


def _or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy) after the stated faults: by crc32 of ``conv_id:turn``
    modulo 20, 0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 sets its role to user."""
    kind = F.crc32(F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn")))) % 20
    text = _or_space(F.col("text"))
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(_or_space(F.col("role"))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        kind.alias("_kind"),
    ).where("_kind <> 0").select("conv_id", "turn", "role", "text",
                                 F.explode(F.sequence(F.lit(0), (F.col("_kind") == 3).cast("int"))).alias("copy"))


def _key() -> Column:
    """A conversation's name without nulls."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))


def cut_pieces(keys: pa.Array, sizes: np.ndarray, last: tuple) -> tuple[np.ndarray, np.ndarray, tuple]:
    """(piece number, position in it) of sorted rows; ``last`` is the state that the batch
    before left: (key, piece, rows, bytes)."""
    key, piece, rows, held = last
    n = len(keys)
    change = np.ones(n, bool)
    if n > 1:
        change[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    change[0] = keys[0].as_py() != key
    number, pos = np.zeros(n, np.int64), np.zeros(n, np.int32)
    for i, (new, size) in enumerate(zip(change.tolist(), sizes.tolist())):
        if new or rows >= PIECE_ROWS or (rows and held + size > PIECE_BYTES):
            piece, rows, held = piece + 1, 0, 0
        number[i], pos[i] = piece, rows
        rows, held = rows + 1, held + size
    return number, pos, (keys[n - 1].as_py(), piece, rows, held)


def in_pieces(rows: DataFrame) -> DataFrame:
    """Rows sorted inside their conversations and cut into pieces: (piece, pos, key, turn,
    role, text). Written once, since range bounds are sampled anew by every run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from ledgerlake.llm import conversations
        base = TaskContext.get().partitionId() << 33
        last = (None, -1, 0, 0)
        for b in batches:
            if not b.num_rows:
                continue
            number, pos, last = conversations.cut_pieces(b.column("key"), b.column("size").to_numpy(), last)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number + base), pa.array(pos), *(b.column(c) for c in ("key", "turn", "role", "text"))],
                ["piece", "pos", "key", "turn", "role", "text"])

    order = ["key", F.col("turn").asc_nulls_first(), "_r", "_t", "_m"]
    rows = rows.withColumns({"key": _key(), "turn": F.col("turn").cast("long"), "_r": F.substring("role", 1, 64),
                             "_t": F.substring("text", 1, 64),
                             "_m": F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")),
                             "size": F.octet_length("text") + F.octet_length("role")})
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(rows.select("key", "turn", "role", "text", "size").mapInArrow(
        run, "piece long, pos int, key string, turn long, role string, text string"), "conversation-pieces")


def _classed(rows: DataFrame) -> DataFrame:
    """(piece, pos, key, turn, letter, kind): a letter for role and fault, a digest of role and text."""
    role = F.substring("role", 1, 1)
    role = F.when(role == "s", 0).when(role == "u", 1).when(role == "a", 2).otherwise(3)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    closed = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, 2).when(closed, 0).otherwise(1)
    return rows.select("piece", "pos", "key", "turn", F.char(role + fault * 4 + 97).alias("letter"),
                       F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("kind"))


PLAN = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "pieces array<struct<piece: long, edits: array<string>>>")


def plans(rows: DataFrame) -> DataFrame:
    """One row per conversation that has rows: totals, audit and the edits of its pieces."""
    slim = _classed(rows)
    firsts = (slim.groupBy("key", "kind").agg(F.min(F.struct("piece", "pos")).alias("f"))
              .groupBy(F.col("f.piece").alias("piece")).agg(F.collect_list("f.pos").alias("firsts")))
    sorted_rows = F.array_sort(F.collect_list(F.struct("pos", "letter")))
    pieces = slim.groupBy("piece").agg(
        F.first("key").alias("key"), F.array_join(F.transform(sorted_rows, lambda x: x.getField("letter")), "").alias("classes"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).alias("kinds"))
    # little data, much work a row: a fixed number of tasks, which AQE doesn't merge
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = (pieces.join(firsts, "piece", "left").repartition(spread, "key")
             .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("piece", "classes", "low", "high", "kinds", "firsts"))).alias("all")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerlake.llm import conversations
        for b in batches:
            done = [{"key": k.as_py(), **conversations.repaired(a.as_py())} for k, a in zip(b.column("key"), b.column("all"))]
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(PLAN))
    return written(whole.mapInArrow(run, PLAN), "conversation-plans")


def repaired_lines(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(piece, pos, lines): repaired lines of every row that leaves any, joined by newlines."""
    edits = planned.select(F.explode("pieces").alias("p")).select("p.*")
    todo = rows.join(edits, "piece").withColumn("e", F.element_at("edits", F.col("pos") + 1))
    own = (F.when(F.col("e").contains("k"), F.concat("role", F.lit(":"), "text"))
           .when(F.col("e").contains("u"), F.concat(F.lit("user:"), "text"))
           .when(F.col("e").contains("a"), F.concat(F.lit("assistant:"), "text")))

    def extra(letters: Column) -> Column:
        """Inserted rows in front of or behind a row (null if there are none)."""
        rows = F.regexp_replace(F.regexp_replace(letters, "U", "user:\n"), "A", "assistant:\n")
        return F.when(letters != "", F.regexp_replace(rows, r"\n\z", ""))

    parts = F.regexp_replace("e", "[kdua]", ".")
    lines = F.concat_ws("\n", extra(F.substring_index(parts, ".", 1)), own, extra(F.substring_index(parts, ".", -1)))
    some = own.isNotNull() | F.col("e").rlike("[UA]")
    return todo.where(some).select("piece", "pos", lines.alias("lines"))


def hashes(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(key, repaired_sha256) of the conversations whose repair leaves any line."""
    line = F.array_sort(F.collect_list(F.struct("pos", "lines")))
    texts = repaired_lines(rows, planned).groupBy("piece").agg(
        F.array_join(F.transform(line, lambda x: x.getField("lines")), "\n").alias("body"))
    owners = planned.select("key", F.size("pieces").alias("of"), F.explode("pieces.piece").alias("piece"))
    bodies = texts.join(owners, "piece")
    one = bodies.where("of = 1").select("key", F.sha2("body", 256).alias("repaired_sha256"))
    many = bodies.where("of > 1").select("key", "piece", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        key, chain = None, None
        for b in batches:
            for k, body in zip(b.column("key").to_pylist(), b.column("body")):
                data = body.as_buffer()
                if k == key:
                    chain.update(b"\n")
                    chain.update(data)
                    continue
                if chain is not None:
                    yield pa.RecordBatch.from_pydict({"key": [key], "repaired_sha256": [chain.hexdigest()]})
                key, chain = k, hashlib.sha256(data)
        if chain is not None:
            yield pa.RecordBatch.from_pydict({"key": [key], "repaired_sha256": [chain.hexdigest()]})

    chained = many.repartition("key").sortWithinPartitions("key", "piece").mapInArrow(run, "key string, repaired_sha256 string")
    return one.unionByName(chained)


def repair(damaged: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``ids``: what was wrong in ``damaged``, the cheapest edits
    and the hash of the repaired conversation."""
    ship_package(damaged.sparkSession)
    rows = in_pieces(damaged)
    planned = plans(rows)
    found = ids.select("conv_id").distinct().withColumn("key", _key()).join(planned.drop("pieces"), "key", "left") \
        .join(hashes(rows, planned), "key", "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
