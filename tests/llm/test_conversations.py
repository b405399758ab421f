"""Conversation repair: block tables against plain search, whole results against a plain program."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import conversations as cv

PATTERN = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows):
    """Least (cost, audit) by trying all edits: rows are (role letter, must go, truncated)."""
    @lru_cache(maxsize=None)
    def best(i, tail, inserted):
        """(cost, letters) from row i; tail: what the pattern needs to know of the roles so far."""
        options = []
        if i == len(rows):
            if tail in ("", "a"):
                options.append((0, ""))
        else:
            role, gone, cut = rows[i]
            c, a = best(i + 1, tail, 0)
            options.append((c + 2, "D" + a))
            if not gone:
                for letter, price, to in (("K", 0, role), ("R", 1, "u"), ("R", 1, "a")):
                    if legal(tail, to):
                        c, a = best(i + 1, to, 0)
                        options.append((c + price + 5 * cut, letter + a))
        if inserted < 2:
            for to in "ua":
                if legal(tail, to):
                    c, a = best(i, to, inserted + 1)
                    options.append((c + 5, "I" + a))
        return min(options, default=(10**9, ""))

    def legal(tail, role):
        return (tail, role) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}

    return best(0, "", 0)


def symbols(rows):
    return np.array([0 if gone else 1 + "suao".index(r) + 4 * cut for r, gone, cut in rows], np.int64)


ROW = st.tuples(st.sampled_from("suao"), st.booleans(), st.booleans())


@settings(max_examples=400, deadline=None)
@given(st.lists(ROW, max_size=14))
def test_edits_are_cheapest_and_least(rows):
    cost, edits = cv.tables().edits(symbols(rows)) if rows else (0, [])
    assert (cost, "".join(edits).translate(cv.AUDIT)) == cheapest(tuple(rows))


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_block_length_changes_nothing(size):
    r = random.Random(size)
    other = cv.Tables(size)
    for _ in range(150):
        rows = [(r.choice("suao"), r.random() < 0.2, r.random() < 0.2) for _ in range(r.randrange(1, 40))]
        assert other.edits(symbols(rows)) == cv.tables().edits(symbols(rows))


def test_blocks_equal_single_steps():
    t = cv.tables()
    r = np.random.default_rng(1)
    for _ in range(200):
        block, v = r.integers(0, cv.SYMBOLS, cv.BLOCK), int(r.integers(0, len(t.vectors)))
        costs = t.vectors[v]
        for s in block[::-1].tolist():
            costs = cv.before(s, costs)
        code = int(block @ (cv.SYMBOLS ** np.arange(cv.BLOCK - 1, -1, -1)))
        low, least = t._low(costs)
        assert t.vectors[t.whole[code][v]] == low and t.more[code][v] == least


def damaged(turns):
    out = []
    for conv, turn, role, text in turns:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain(turns):
    """Expected result rows by conversation id."""
    rows, out = damaged(turns), {}
    for conv in {t[0] for t in turns}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, facts, lines = set(), [], []
        blank = duplicate = truncated = 0
        for _, _, role, text in mine:
            visible = re.sub(r"[\x20\x09-\x0D]", "", text)
            gone = cut = False
            if not visible:
                blank, gone = blank + 1, True
            elif (role, text) in seen:
                duplicate, gone = duplicate + 1, True
            elif visible[-1] not in ".!?":
                truncated, cut = truncated + 1, True
            seen.add((role, text))
            facts.append((role[:1] if role[:1] in ("s", "u", "a") else "o", gone, cut))
        cost, audit = cheapest(tuple(facts)) if len(facts) < 200 else (None, None)
        at, last = 0, None
        for letter in audit or "":
            role, text = (mine[at][2], mine[at][3]) if at < len(mine) else (None, None)
            new = "user" if last in (None, "s", "a") else "assistant"
            if letter == "I":
                lines.append(f"{new}:")
                last = new[0]
                continue
            at += 1
            if letter == "D":
                continue
            lines.append(f"{role}:{text}" if letter == "K" else f"{new}:{text}")
            last = lines[-1][0]
        if audit is not None:
            assert PATTERN.match("".join(line[0] for line in lines))
        turns_seen = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns_seen) - min(turns_seen) + 1 - len(set(turns_seen)) if turns_seen else 0
        initials = [r[2][:1] for r in mine]
        illegal = sum((a, b) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest() if audit is not None else None)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, key string, piece int, pos string"


def found(spark, turns):
    df = spark.createDataFrame([(*t, "k", 1, "p") for t in turns], SCHEMA)
    rows = cv.repair(cv.damage(df), df.select("conv_id")).collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}


def invented(seed, conversations, longest):
    r = random.Random(seed)
    texts = ["Yes.", "no", "", " \n", "What?\t", "Well, é!", "x" * 300, None, "user:", "Yes.", "a\nb. c"]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "sys"]
    out = []
    for c in range(conversations):
        turn = r.randrange(-2, 3)
        for _ in range(r.randrange(longest)):
            turn += r.choice([0, 1, 1, 1, 3])
            out.append((c, None if r.random() < 0.05 else turn, r.choices(roles, [5, 5, 1, 1, 1, 1, 1, 1])[0], r.choice(texts)))
    return out


def test_whole_results_equal_the_plain_program(spark):
    turns = invented(4, 120, 12)
    turns += [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]
    turns += [(1000, t, "user", "Only one turn here.") for t in range(3)]
    random.Random(9).shuffle(turns)
    assert found(spark, turns) == plain(turns)


def test_pieces_change_nothing(spark, monkeypatch):
    """Conversations that are cut into many pieces, by rows and by bytes."""
    turns = invented(6, 12, 90)
    expected = plain(turns)
    df = spark.createDataFrame([(*t, "k", 1, "p") for t in turns], SCHEMA).repartition(5)
    for rows, size in ((3, 1 << 20), (4096, 40)):
        rows_in = cv.damage(df)
        with monkeypatch.context() as m:
            m.setattr(cv, "PIECE_ROWS", rows)
            m.setattr(cv, "PIECE_BYTES", size)
            number, _, last = cv.cut_pieces(__import__("pyarrow").array(["a"] * 10 + ["b"]), np.full(11, 5), (None, -1, 0, 0))
            assert number[-1] == last[1] and len(set(number.tolist())) >= 3
        got = {r.conv_id: tuple(r)[1:] for r in cut_small(spark, rows_in, df, rows, size)}
        assert got == expected


def cut_small(spark, rows_in, df, rows, size):
    """``repair`` with small pieces: the pieces are re-cut from the sorted table, as workers don't see patches."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    sorted_rows = cv.in_pieces(rows_in)
    w = Window.partitionBy("piece").orderBy("pos")
    if rows < 100:
        cut = F.expr(f"pos div {rows}")
    else:
        cut = F.floor((F.sum(F.octet_length("text")).over(w) - F.octet_length("text")) / size)
    small = sorted_rows.withColumn("c", cut.cast("long"))
    inner = Window.partitionBy("piece", "c").orderBy("pos")
    small = small.withColumn("pos", (F.row_number().over(inner) - 1).cast("int")) \
        .withColumn("piece", F.col("piece") * 100_000 + F.col("c")).drop("c")
    planned = cv.plans(small)
    out = df.select("conv_id").distinct().withColumn("key", cv._key()).join(planned.drop("pieces"), "key", "left") \
        .join(cv.hashes(small, planned), "key", "left")
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))).collect()


def test_empty_table(spark):
    assert found(spark, []) == {}


def test_a_long_conversation(spark):
    """One conversation that is several pieces by itself."""
    turns = [(7, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(9000)]
    rows = damaged(turns)
    got = found(spark, turns)[7]
    cost, edits = cv.tables().edits(np.array([0 if not re.search(r"[^\x20\x09-\x0D]", r[3]) or k and r == rows[k - 1] else
                                              1 + "suao".index(r[2][0]) + 4 * (r[3][-1] != ".") for k, r in enumerate(rows)]))
    assert got[5] == cost and got[6] == "".join(edits).translate(cv.AUDIT) and len(got[6]) >= len(rows)
    lines = list(itertools.chain.from_iterable(
        [{"U": "user:", "A": "assistant:"}[x] if x in "UA" else
         f"{r[2] if x == 'k' else {'u': 'user', 'a': 'assistant'}[x]}:{r[3]}" for x in e if x != "d"] for r, e in zip(rows, edits)))
    assert got[7] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
