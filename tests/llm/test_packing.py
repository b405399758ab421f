"""Packing: ids against the library, cuts against a plain dynamic program, coverage."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm import packing

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
EDGE = ["", None, " ", "Hello World. It's  fine!\nNew line", "a<|endoftext|>b <|startoftext|>", "\x1c a\x1f b\x85c d　e",
        "ÀÉ ñ ΑΣ ΣΑΣ. İ", "é ́x", "。好！ 你好。", "x" * 9000, "word " * 5000, "A.b.C. " * 900, "😀 😀😀", "don't DON'T we'll", "\x01 a\x01b \x01\x01 c\x01",
        "Straße ÀÖØÞ×÷ÿ ß1²3 a1b22c ~!@#$%^&*()_+`{}[]|\\:;<>,./? x_y-z", "<|endoftext|>. É<|x|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def words():
    return packing.WordIds(packing.check_vocabulary(PATH))


def whole(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def lined(words, texts):
    raw, offsets = packing.buffers(pa.array(texts, pa.string()))
    return packing.token_lines(raw, offsets, words)


def test_ids_match_library_on_edges(library, words):
    line, doc_ends, _ = lined(words, EDGE)
    expected = [whole(library, t) for t in EDGE]
    assert line.tolist() == sum(expected, [])
    assert doc_ends.tolist() == np.cumsum([len(x) for x in expected]).tolist()


_SHARED = []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\xa0　ab'sñÉ×Σ1<|>.!\x01"), st.characters(codec="utf-8")),
                        max_size=40), max_size=4))
def test_ids_match_library_on_any_text(texts):
    if not _SHARED:
        _SHARED.extend([Tokenizer.from_file(PATH), packing.WordIds(packing.check_vocabulary(PATH))])
    lib, own = _SHARED
    assert lined(own, texts)[0].tolist() == sum((whole(lib, t) for t in texts), [])


def test_words_with_equal_hashes_are_told_apart(library, words, monkeypatch):
    monkeypatch.setattr(packing, "word_hashes", lambda raw, starts, ends: np.zeros(len(starts), np.uint64))
    assert lined(words, ["ab cd ab ef", "gh ab"])[0].tolist() == whole(library, "ab cd ab ef") + whole(library, "gh ab")


def test_remembered_words_are_bounded(library, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    own = packing.WordIds(packing.check_vocabulary(PATH))
    for text in ("one two", "three four", "five six seven eight nine", "one two"):
        assert lined(own, [text])[0].tolist() == whole(library, text)
        assert len(own.hashes) <= 5


def plain_cost(at, fee, window):
    cost = [0] + [None] * (len(at) - 1)
    for j in range(1, len(at)):
        cost[j] = fee[j] + min(cost[i] + packing.padding(at[j] - at[i], window)
                               for i in range(j) if at[j] - at[i] <= window)
    return cost[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.sampled_from([0, 3, 9])), min_size=1, max_size=40))
def test_cuts_cost_as_little_as_the_plain_program(steps):
    at = np.cumsum([0, *(s for s, _ in steps)])
    fee = np.array([0, *(f for _, f in steps)])
    fee[-1] = 0
    with pytest.MonkeyPatch.context() as m:
        m.setattr(packing, "SHORT", 1)
        cuts = packing.choose_cuts(at, fee, 16)
    assert cuts[0] == 0 and cuts[-1] == len(at) - 1
    lengths = np.diff(at[cuts])
    assert lengths.min() > 0 and lengths.max() <= 16
    assert sum(packing.padding(int(x), 16) for x in lengths) + fee[cuts].sum() == plain_cost(at.tolist(), fee.tolist(), 16)


def test_places_leave_no_gap_wider_than_a_window():
    at, fee = packing.places(100_000, np.array([10, 100_000]), np.array([5, 40, 70_000]), 64)
    assert np.diff(at).max() <= 64 and at[0] == 0 and at[-1] == 100_000
    assert fee[np.searchsorted(at, 10)] == 0 and fee[np.searchsorted(at, 40)] == packing.SENTENCE


SCHEMA = "doc_id long, text string, lang string, sequence_id string, ids int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", 1) for i, t in rows], SCHEMA)


def check(pieces, texts, library, window):
    """Every id of every document in exactly one piece, sequences gapless."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for k, rows in by_doc.items():
        ids = whole(library, texts[k])
        rows.sort(key=lambda r: r.start)
        assert [r.start for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))]
        assert sum(r.length for r in rows) == len(ids) and {r.doc_tokens for r in rows} == {len(ids)}
        for r in rows:
            part = np.array(ids[r.start:r.start + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
    for rows in by_seq.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))]
        assert sum(r.length for r in rows) <= window


def test_operator_packs_every_id_once(spark, library):
    texts = dict(enumerate(EDGE))
    docs = frame(spark, texts.items()).repartition(3)
    pieces = packing.pack_documents(docs, PATH, 64).collect()
    check(pieces, texts, library, 64)


def test_runs_end_at_their_bound(spark, library):
    line, doc_ends, sent = np.arange(5000, dtype=np.uint32), np.array([100, 5000]), np.array([50, 700, 900])
    p = packing.pack_line(line, doc_ends, sent, 256)
    assert p["length"].sum() == 5000 and p["doc"].tolist().count(0) >= 1
    assert packing.pack_documents(frame(spark, []), PATH).collect() == []


def test_repeated_ids_and_sequences(spark, library):
    rows = [(1, "one two three."), (1, "one two three."), (None, "four"), (None, None)]
    pieces = packing.pack_documents(frame(spark, rows).coalesce(1), PATH, 16, with_ids=True)
    assert pieces.count() == 4
    packed = packing.sequences(pieces, 16).collect()
    flat = [i for r in sorted(packed, key=lambda r: r.sequence_id) for i in r.ids[:r.length]]
    assert flat == sum((whole(library, t) for _, t in rows), [])
    assert all(len(r.ids) in (1, 2, 4, 8, 16) for r in packed)


def test_little_padding_on_the_given_documents(spark):
    pieces = packing.pack_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH)
    sizes = [r[0] for r in pieces.groupBy("sequence_id").sum("length").select("sum(length)").collect()]
    assert sum(packing.padding(s) for s in sizes) < 0.005 * sum(sizes)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        packing.check_vocabulary(str(public_tokenizers.path("byte_bpe_50k.json")))
