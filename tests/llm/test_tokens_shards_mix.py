"""Token counts, Feistel shards and source mixing."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm import mixing, sharding, token_count

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
EDGE = ["", None, " ", "  a", "a  b", "a \n\n b", "a \xa0 b", "it's  we'll\tx1 22", "x<|endoftext|>y <|endoftext|>",
        "ñandú ciónñ\r\n", "\x1c a\x1f b", "aaaa" * 3000, " " * 500, "a b\n", "​ 　x", "😀 😀😀"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def merger():
    return token_count.PairMerger(token_count.load_vocabulary(PATH))


def test_counts_match_library_on_edges(library, merger):
    for t in EDGE:
        assert merger.count(t or "") == len(library.encode(t or "", add_special_tokens=False).ids), repr(t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\xa0　ab'sñ1<|>"), st.characters(codec="utf-8")), max_size=60))
def test_counts_match_library_on_any_text(text):
    lib, own = _pair()
    assert own.count(text) == len(lib.encode(text, add_special_tokens=False).ids)


_PAIR = []


def _pair():
    if not _PAIR:
        _PAIR.append((Tokenizer.from_file(PATH), token_count.PairMerger(token_count.load_vocabulary(PATH))))
    return _PAIR[0]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "x") for i, t, s in rows], SCHEMA)


def test_count_operator(spark, library):
    rows = [(i, t, "a") for i, t in enumerate(EDGE)] + [(None, "dup", "a"), (None, "dup", "a")]
    out = token_count.count_tokens(docs(spark, rows), PATH, limit=100).collect()
    assert len(out) == len(rows)
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in out) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in out)
    assert token_count.count_tokens(docs(spark, []), PATH).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 40, 1000, 4097])
def test_permutation_is_a_bijection_with_inverse(n):
    at = sharding.permute(np.arange(n), n, 5)
    assert sorted(at) == list(range(n))
    assert (sharding.permute(at, n, 5, forward=False) == np.arange(n)).all()


def test_shards(spark):
    import zlib
    rows = [(i % 90, f"text {i % 50}" if i % 7 else None, "a") for i in range(203)] + [(None, "z", "a")] * 3
    out = sharding.shard_documents(docs(spark, rows), shards=8).collect()
    assert len(out) == len(rows)
    per = defaultdict(list)
    for r in out:
        per[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
        assert sharding.row_at(r.shard, r.slot, len(rows), 8, 20240229) == r.row_number
    sizes = [len(v) for v in per.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    again = sharding.shard_documents(docs(spark, rows[::-1]).repartition(5), shards=8).collect()
    key = lambda x: sorted((str(r.doc_id), r.text_crc32, r.shard, r.slot) for r in x)
    assert key(out) == key(again)
    assert sharding.shard_documents(docs(spark, []), shards=8).count() == 0


def test_targets_reshare_what_is_above_two_epochs():
    assert mixing.targets_for([10, 100, 100], [3, 1, 2], 315, 2) == pytest.approx([20, 98.3333333, 196.6666667])
    assert mixing.targets_for([0, 100], [3, 1], 150, 2) == pytest.approx([0, 150])


def test_tree_meets_quotas_exactly():
    quotas = np.array([0, 5, 100, 33])
    tree = mixing.splitting_tree(quotas, 7, 1)
    assert (tree.sum(0) == quotas).all() and tree.min() >= 0
    assert tree.sum(1).max() - tree.sum(1).min() <= 1
    assert (tree == mixing.splitting_tree(quotas, 7, 1)).all()


def test_mix(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 40))) if i % 11 else None, None if i % 9 == 0 else "é" if i % 3 else "hot")
            for i in range(400)] + [(7, "same row", "hot")] * 4 + [(None, "no id", "zz")] * 2
    df = docs(spark, rows)
    plan = mixing.mix_plan(df, shards=8, blocks=16)
    out = plan.collect()
    assert len(out) == len(rows)
    size = Counter()
    for i, t, s in rows:
        size[s] += len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, mixing.targets_for([size[s] for s in order], [[3, 1, 2][k % 3] for k in range(len(order))], 1.5 * sum(size.values()), 2)))
    assert all(0 <= r.taken <= 2 * r.size for r in out)
    by = Counter()
    for r in out:
        by[r.target] += r.taken
        assert r.taken == sum(p.words for p in r.pieces or [])
    for s in order:
        if want[s]:
            words = sum(round(want[x]) for x in order if want[x] == want[s])
            assert abs(by[want[s]] - words) <= 1 + mixing.NEAR * words
    again = mixing.mix_plan(df.repartition(3), shards=8, blocks=16).collect()
    key = lambda x: sorted((str(r.doc_id), r.size, r.taken, str(r.pieces)) for r in x)
    assert key(out) == key(again)
    mixed = mixing.emit_mix(df, plan)
    assert mixed.columns == [*df.columns, "mix_shard", "mix_place"]
    got = mixed.collect()
    assert sum(len((r.text or "").split()) for r in got) == sum(r.taken for r in out)
    per = Counter(r.mix_shard for r in got)
    assert set(per) <= set(range(8))
    assert mixing.mix_plan(docs(spark, [])).count() == 0


def test_mixed_texts_are_whole_where_that_comes_near(spark):
    """Sources of many documents: every mixed text is an input text, white space and all. A
    source of one document can only be cut: at a word's end, the rest as it was."""
    rng = np.random.default_rng(3)
    rows = [(i, "\n\n".join(f"w{k}  x" for k in range(int(rng.integers(1, 30)))), "abc"[i % 3]) for i in range(1500)]
    rows += [(9000 + k, "a\n\nb   c d e f g " + "h " * k, f"one{k}") for k in range(3)]
    df = docs(spark, rows)
    mixed = mixing.emit_mix(df, mixing.mix_plan(df, shards=4, blocks=16)).collect()
    texts = {t for _, t, _ in rows}
    cut = [r for r in mixed if r.text not in texts]
    assert all(r.doc_id >= 9000 for r in cut) and len(cut) <= 3
    for r in cut:
        whole = dict((i, t) for i, t, _ in rows)[r.doc_id]
        assert whole.startswith(r.text) and whole[len(r.text)].isspace() and r.n_chars == len(r.text)


def test_mix_is_written_by_shards_in_their_order(spark, tmp_path):
    df = docs(spark, [(i, "w " * (i % 7 + 1), "ab"[i % 2]) for i in range(200)])
    mixed = mixing.emit_mix(df, mixing.mix_plan(df, shards=4, blocks=16))
    mixing.write_mix(mixed, str(tmp_path / "mix"), shards=4)
    back = spark.read.parquet(str(tmp_path / "mix"))
    rows = lambda d: Counter((r.doc_id, r.text, r.mix_shard, r.mix_place) for r in d.collect())
    assert rows(back) == rows(mixed)
    for folder in (tmp_path / "mix").glob("mix_shard=*"):
        files = sorted(folder.glob("*.parquet"))
        assert len(files) == 1
        places = [r.mix_place for r in spark.read.parquet(str(files[0])).coalesce(1).collect()]
        assert places == sorted(places)
