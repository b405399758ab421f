"""WARC revisits, SimHash near-dedup, exact dedup, suffix dedup, pipeline."""

import gzip
import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from ledgerlake.llm import exact_dedup as ed
from ledgerlake.llm import induced, queries, simhash, suffix_dedup, warc
from ledgerlake.llm.mixing import NEAR
from ledgerlake.llm.common import scratch
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp int, root string, `a.b` int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), 1, "r", 2) for i, t in rows], SCHEMA)


# ---------------------------------------------------------------- WARC
def test_warc_round_trip(spark):
    long = "<p>" + "x" * 200 + "\r\n\r\nWARC/1.1\r\n" + "é" * 50
    rows = [(5, "u5", long), (2, "u2", long), (9, "a\r\nb", long), (9, None, long), (1, "u", "short"), (3, "u", "short"),
            (4, "u", None), (7, "u", ""), (8, "u", "y" * 100), (6, "u", "y" * 100), (None, "u", "y" * 100),
            (None, "u", "z" * 300), (2, "u", long), (11, "u", "w" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, digest string, bytes int")
    path = scratch(spark, "warc-test")
    got = Counter(tuple(r) for r in warc.archive_pages(pages, path).collect())
    first = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= 100:
            first[h] = min(p, first.get(h, p))
    want = Counter()
    for p, _, h in rows:
        data = (h or "").encode()
        origin = first.get(h)
        again = origin is not None and (p is None or p > origin)
        want[(p, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", origin if again else None)] += 1
    assert got == want
    empty = warc.archive_pages(pages.limit(0), scratch(spark, "warc-empty"))
    assert empty.count() == 0


def test_warc_ids_of_any_text(spark):
    """Ids are escaped; pages move to their archives without a shuffle of payloads."""
    long = "z" * 150
    ids = ["null", None, "a b", "a>b", "%3E", "é/+", "", "<urn:null>", "k\r\nv"]
    pages = spark.createDataFrame([(i, "u", f"{long}{k // 3}") for k, i in enumerate(ids)], "page_id string, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.archive_pages(pages, scratch(spark, "warc-ids")).collect()}
    for k, i in enumerate(ids):
        least = min(x for x in ids[k // 3 * 3:k // 3 * 3 + 3] if x is not None)
        assert got[i] == (("response", None) if i == least else ("revisit", least)), i
    assert "Exchange hashpartitioning" not in warc.records(pages)._jdf.queryExecution().executedPlan().toString()


def test_archive_is_warc(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "b" * 150), (2, "http://c/", "b" * 150)], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), f"file://{tmp_path}/w")
    data = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("*.gz")))
    assert data.count(b"WARC/1.1\r\nWARC-Type: ") == 2 and b"WARC-Refers-To: <urn:page:1>" in data
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(data[:-1])))


# ---------------------------------------------------------------- SimHash
def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[j:j + 3]) for j in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(v >> b & 1 for v in h) * 2 > len(h))


def brute_components(values):
    """Least index reachable over distances of at most two bits."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    v = np.array(values, np.uint64)
    for a in range(len(v)):
        for b in np.flatnonzero(np.bitwise_count(v[a + 1:] ^ v[a]) <= 2) + a + 1:
            x, y = find(a), find(int(b))
            root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(v))]


def test_fingerprints():
    for t in ["", None, "one", "Two Words", "a b c", "A  b\tc d e f", "é É ñ x", "same same same same", "w " * 70000]:
        assert simhash.fingerprint((t or "").encode()) == brute_fingerprint(t)


def test_links_keep_components(spark):
    r = random.Random(5)
    values = {0, (1 << 64) - 1}
    for _ in range(40):
        base = r.getrandbits(64)
        values.add(base)
        for _ in range(r.choice([0, 1, 3, 60])):  # crowds above PAIRS, chains of steps
            step = base
            for _ in range(r.choice([1, 2, 3])):
                step ^= 1 << r.randrange(64)
            values.add(step)
            if r.random() < 0.5:
                base = step
    hub = r.getrandbits(64)
    values |= {hub ^ (1 << a) ^ (1 << b) for a in range(0, 64, 2) for b in range(1, 30, 3)}
    values = sorted(values, key=lambda v: v - (1 << 64) if v >> 63 else v)
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    found = {x.node: x.root for x in simhash.components(simhash.links(nodes)).collect()}
    signed = [x.fp for x in nodes.collect()]
    want = brute_components(values)
    assert all(found.get(s, s) == signed[w] for s, w in zip(signed, want))


def test_near_duplicates(spark):
    r = random.Random(2)
    say = lambda n: " ".join(r.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(r.randrange(50)) for _ in range(n))
    rows = []
    for i in range(120):
        rows.append((i * 3 + 1, say(r.choice([0, 1, 2, 5, 300]))))
        if i % 5 == 0:
            w = rows[-1][1].split() or ["x"]
            w[-1] = "changed"
            rows.append((i * 3, " ".join(w)))
            rows.append((i * 3 + 2, rows[-2][1]))
    rows += [(None, rows[0][1]), (None, "nobody else"), (900, None), (901, ""), (902, "  \n"), (4, rows[1][1]), (4, rows[1][1])]
    d = docs(spark, rows)
    out = simhash.near_duplicates(d).collect()
    assert len(out) == len(rows)
    values = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(values)
    least = defaultdict(list)
    for (i, _), c in zip(rows, comp):
        least[c].append(i)
    name = {c: min((i for i in ids if i is not None), default=None) for c, ids in least.items()}
    want = Counter((i, v - (1 << 64) if v >> 63 else v, name[c]) for (i, _), v, c in zip(rows, values, comp))
    assert Counter((x.doc_id, x.fp, x.component_id) for x in out) == want
    kept = simhash.drop_near_duplicates(d)
    assert kept.columns == d.columns
    assert Counter(x.doc_id for x in kept.collect()) == Counter(name.values())
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.drop_near_duplicates(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- exact dedup
def write(df, tmp_path, name):
    path = f"file://{tmp_path}/{name}.parquet"
    df.write.parquet(path)
    return path


def brute_exact(rows):
    import re
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        stays = True
        for i in sorted(ids, key=lambda x: (x is None, x or 0)):
            out[(i, keep, len(ids), stays, hashlib.sha256(t.encode()).hexdigest())] += 1
            stays = False
    return out


def test_exact_dedup(spark, tmp_path):
    rows = [(i, f"text  {i % 17}\n x" if i % 3 else f"text {i % 17} x") for i in range(200, 0, -1)]
    rows += [(300, None), (301, ""), (302, " "), (303, "\t\n"), (None, "text 1 x"), (None, "alone"), (5, "text 5 x"), (5, "text 5 x"),
             (400, "long " * 100_000), (401, "long\t" * 100_000), (402, "\xa0"), (403, "É"), (404, "é")]
    path = write(docs(spark, rows).repartition(6), tmp_path, "docs")
    want = brute_exact(rows)
    assert Counter(tuple(r) for r in ed.exact_dedup(spark, path).collect()) == want
    assert Counter(tuple(r) for r in ed.exact_dedup(spark, path, files_per_batch=2).collect()) == want
    # a digest that collides all the time: whole texts decide
    from pyspark.sql import functions as F
    weak = lambda c: F.pmod(F.octet_length(c), F.lit(2)).cast("string")
    got = Counter(tuple(r) for r in ed.exact_dedup(spark, path, digest=weak).collect())
    assert got == want
    empty = write(docs(spark, []), tmp_path, "empty")
    assert ed.exact_dedup(spark, empty).count() == 0


def test_exact_dedup_of_a_hot_group(spark, tmp_path):
    """A third of all rows are copies; every group counts as hot, or none."""
    rows = [(i, "the same  text" if i % 3 == 0 else f"text {i % 40}") for i in range(900, 0, -1)]
    path = write(docs(spark, rows).repartition(5), tmp_path, "hot")
    want = brute_exact(rows)
    for hot in (3, 1000, 10**9):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(ed, "HOT", hot)
            assert Counter(tuple(r) for r in ed.exact_dedup(spark, path).collect()) == want


def test_exact_dedup_takes_any_path(spark, tmp_path):
    rows = [(1, "a"), (2, "a"), (3, "b")]
    assert ed.pattern_of("/a/b/") == "/a/[b]" and ed.pattern_of("/a/b*") == "/a/b\\*"
    plain = tmp_path / "plain"
    docs(spark, rows).write.parquet(str(plain))
    assert sorted((r.doc_id, r.keep_id) for r in ed.exact_dedup(spark, f"{plain}/").collect()) == [(1, 1), (2, 1), (3, 3)]


def test_exact_dedup_goes_on_with_new_files(spark, tmp_path):
    one, two = [(10, "a b"), (11, "c")], [(3, "a  b"), (12, "c"), (13, "d")]
    path = write(docs(spark, one), tmp_path, "grow")
    state = f"file://{tmp_path}/state"
    assert Counter(tuple(r) for r in ed.exact_dedup(spark, path, state).collect()) == brute_exact(one)
    docs(spark, two).write.mode("append").parquet(path)
    assert Counter(tuple(r) for r in ed.exact_dedup(spark, path, state).collect()) == brute_exact(one + two)


# ---------------------------------------------------------------- suffix dedup
def test_induced_order_and_prefixes(monkeypatch):
    monkeypatch.setattr(induced, "_BASE", 8)
    monkeypatch.setattr(induced, "SPILL", 256)  # runs and texts go to files
    monkeypatch.setattr(induced, "BLOCK", 16)
    rng = np.random.default_rng(0)
    for trial in range(150):
        t = np.append(rng.integers(1, 1 + rng.integers(1, 5), rng.integers(2, 300)), 0).astype(np.uint8)
        if trial % 3 == 0:
            t = np.append(np.tile(rng.integers(1, 4, rng.integers(1, 9)), 30), 0).astype(np.uint8)
        b, cap = t.tobytes(), 60
        order = sorted(range(len(t)), key=lambda i: b[i:])
        is_s, _ = induced._types(t)
        sides = [[i for i in order if not is_s[i]], [i for i in order if is_s[i] and i != len(t) - 1][::-1]]
        for (pos, low, _), want in zip(induced.ordered_suffixes(t, cap), sides):
            assert sorted(pos) == sorted(want) and [b[i:i + cap] for i in pos] == [b[i:i + cap] for i in want]
            for k in range(1, len(pos)):
                x, y = b[pos[k - 1]:pos[k - 1] + cap], b[pos[k]:pos[k] + cap]
                assert min(low[k], cap) == next((j for j in range(min(len(x), len(y))) if x[j] != y[j]), min(len(x), len(y)))


def brute_suffix(rows, n):
    first = {}
    key = lambda d: float("inf") if d is None else d
    for d, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - n + 1):
            w = b[p:p + n]
            first[w] = min(first.get(w, float("inf")), key(d))
    out = Counter()
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if first[b[p:p + n]] < key(d):
                gone[p:p + n] = b"\1" * n
        spans = sum(1 for k, x in enumerate(gone) if x and (k == 0 or not gone[k - 1]))
        out[(d, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, x in zip(b, gone) if not x)).hexdigest())] += 1
    return out


def test_suffix_dedup(spark, monkeypatch):
    r = random.Random(1)
    passages = ["".join(r.choice("abcdé ") for _ in range(r.randint(40, 200))) for _ in range(8)]
    passages += [" " * 120, "a" * 90, "ab" * 60, "x" * 49, "y" * 50, "\x00" * 70]
    rows = []
    for i in range(150):
        parts = [r.choice(passages) if r.random() < .4 else "".join(r.choice("abcdefg ñ\n") for _ in range(r.randint(0, 90)))
                 for _ in range(r.randint(0, 6))]
        rows.append((r.randint(0, 120) if r.random() < .95 else None, "".join(parts) if i % 13 else None))
    rows += [(500 + i, rows[3][1]) for i in range(20)]
    d = docs(spark, rows)
    want = brute_suffix(rows, 50)
    assert sum(k[2] * n for k, n in want.items()) > 5000
    assert Counter(tuple(x) for x in suffix_dedup.remove_repeats(d, 50, pack_bytes=3000).collect()) == want
    assert Counter(tuple(x) for x in suffix_dedup.remove_repeats(d, 50).collect()) == want
    full = suffix_dedup.remove_repeats(d, 50, pack_bytes=9000, spans=True).collect()
    texts = {t.encode() for _, t in rows if t}
    for x in full:
        assert hashlib.sha256(x.kept).hexdigest() == x.kept_sha256 and sum(b - a for a, b in x.removed) == x.n_removed
        assert x.removed or bytes(x.kept) in texts or not x.kept
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0


@pytest.mark.parametrize("rows", [
    [(1, "abc"), (2, "abd")], [(1, None), (2, ""), (None, None)], [(1, "x" * 49), (2, "x" * 49)],
    [(1, "ab"), (2, None), (3, "word " * 30), (4, "word " * 30), (5, "z")]])
def test_suffix_dedup_of_short_texts(spark, rows):
    """Packs of short, null and empty texts, alone and beside a pack of long ones."""
    want = brute_suffix(rows, 50)
    for pack_bytes in (None, 4):  # one pack; nearly one for each row
        assert Counter(tuple(x) for x in suffix_dedup.remove_repeats(docs(spark, rows), 50, pack_bytes).collect()) == want


def test_segments_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 400)
    r = random.Random(0)
    texts = ["".join(r.choice("abc") for _ in range(n)).encode() for n in (0, 49, 50, 51, 3000, 10, 700, 0, 399, 449, 450)]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    anchor, doc, start, windows = suffix_dedup.segments(raw, offsets, 50)
    seen = Counter((int(d), int(p)) for d, s, n in zip(doc, start, windows) for p in range(s, s + n))
    want = {(k, int(offsets[k]) + p) for k, t in enumerate(texts) for p in range(len(t) - 49)}
    assert set(seen) == want and max(seen.values()) == 1
    of = {}
    for a, s, n in zip(anchor, start, windows):  # equal windows have equal anchors
        for p in range(s, s + n):
            assert of.setdefault(raw[p:p + 50].tobytes(), a) == a


@pytest.mark.parametrize("spill", [induced.SPILL, 256])
def test_shards_sort_only_what_may_repeat(monkeypatch, spill):
    """Anchors in every segment, few repeated windows: the rest isn't sorted, all repeats are found."""
    r = random.Random(2)
    some = lambda n: bytes(r.choice(b"abcdefgh") for _ in range(n))
    phrase = b"zyxwvutsrqponmlk"
    rows = [some(34) + phrase + some(34) for _ in range(300)]
    whole = [some(20) + phrase + some(40) for _ in range(5)]
    rows += [some(7) + w[:60] + some(7) for w in whole] + [some(3) + w[10:] + some(3) for w in whole]
    rows += [b"a" * 70 + some(20), some(9) + b"a" * 55, b"q" * 60]
    sizes, order = [], suffix_dedup.ordered_suffixes

    def sized(text, cap):
        sizes.append(len(text))
        return order(text, cap)
    monkeypatch.setattr(suffix_dedup, "ordered_suffixes", sized)
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    monkeypatch.setattr(induced, "SPILL", spill)
    monkeypatch.setattr(suffix_dedup, "SPILL", spill)  # beyond, text and hashes go to files
    shard = suffix_dedup.Shard()  # every segment is given the one anchor
    for k, text in enumerate(rows):
        shard.add(k, np.array([0], np.uint32).tobytes(), np.array([len(text)], np.uint16).tobytes(), np.array([k], np.int64).tobytes(),
                  suffix_dedup.pa.compress(text, "zstd", asbytes=True), np.array([7], np.uint64).tobytes()[:6])
    least = {}
    for k, text in enumerate(rows):
        for p in range(len(text) - 49):
            least.setdefault(text[p:p + 50], k)
    want = {k: [least[t[p:p + 50]] for p in range(len(t) - 49)] for k, t in enumerate(rows)}
    got = {k: [k] * len(w) for k, w in want.items()}
    for pack, _, counts, docs_ in shard.results(50):
        got[pack] = np.repeat(np.frombuffer(docs_, np.int64), np.frombuffer(counts, np.uint16)).tolist()
    assert got == want and sum(w != [k] * len(w) for k, w in want.items()) == 6
    assert sum(sizes) < sum(map(len, rows)) / 20


# ---------------------------------------------------------------- pipeline, oracles
def test_oracles(spark):
    for t in ("documents", "pages", "benchmark", "conversations"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    for name, sql in queries.ORACLE.items():
        want = duckdb.sql(sql)
        names = sorted(want.columns)
        rows = sorted(want.select(*names).fetchall(), key=str)
        got = sorted((tuple(r) for r in queries.QUERIES[name](spark, SF_SMALL).select(*names).collect()), key=str)
        assert got == rows, name


def test_pipeline(spark):
    from ledgerlake.llm import decontamination, toxicity
    read = lambda t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
    docs_in, lab, bench = read("documents"), read("labels"), read("benchmark")
    # brute force of the filtering stages
    toxic = {r.doc_id for r in toxicity.grade_documents(docs_in, lab).collect() if r.toxic}
    rest = sorted((r.doc_id, r.text) for r in docs_in.collect() if r.doc_id not in toxic)
    comp = brute_components([brute_fingerprint(t) for _, t in rest])
    rest = [x for k, x in enumerate(rest) if comp[k] == k]
    items = [b" ".join(decontamination.plain_words(r.text)) for r in bench.collect()]
    held = [(i, b" ".join(decontamination.plain_words(t))) for i, t in rest]
    clean = {i for i, t in held if not any(x in t for x in items)}
    out = docs_in
    counts = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, out, SF_SMALL)
        assert out.columns == docs_in.columns
        counts.append(out.count())
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert kept <= clean and all(  # what else went holds a near passage
        any(decontamination.edit_distance_within(x, dict(held)[i])[0] <= 0.2 * len(x) for x in items) for i in clean - kept)
    # ... and nothing that stayed does
    assert not any(decontamination.edit_distance_within(x, t)[0] <= decontamination.allowed_edits(len(x), 0.8)
                   for i, t in held if i in kept for x in items)
    mixed = corpus_pipeline.mixing(spark, out, SF_SMALL)
    assert mixed.columns == docs_in.columns
    total = sum(len(r.text.split()) for r in out.collect())
    # documents are whole: every source is within NEAR of its target
    assert abs(sum(len(r.text.split()) for r in mixed.collect()) - 1.5 * total) <= NEAR * 1.5 * total
    result = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert len(result) == mixed.count() and {r.doc_id for r in result} <= kept
    per = Counter(r.shard for r in result)
    assert max(per.values()) - min(per.values()) <= 1


def test_stages_take_edge_tables(spark):
    rows = [(None, None), (1, ""), (1, "w x y z"), (1, "w x y z"), (2, "a b c " * 50), (None, "q r s")]
    for d in (docs(spark, rows), docs(spark, [])):
        out = d
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, out, SF_SMALL)
            assert out.columns == d.columns
        corpus_pipeline.sharding(spark, out, SF_SMALL).collect()
