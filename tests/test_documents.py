"""Masking and lookup in documents whose shape is only in the data."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions import documents as d
from ledgerlake.functions.mask import MASK, SENSITIVE, mask_sensitive_fields


def plain(value):
    """The masking rule in a few lines of plain recursion."""
    if isinstance(value, dict):
        return {k: (MASK if v else None) if any(s in k.lower() for s in SENSITIVE) else plain(v) for k, v in value.items()}
    return [plain(v) for v in value] if isinstance(value, list) else value


def deep(levels):
    return "[" * levels + '{"password":1}' + "]" * levels


TEXTS = ['{"password":"p","a":[{"Token":"x","b":[[{"secret":0},{"my_secret":{"z":1}}]]}],"c":null}', '[1,{"TOKEN":[]},"s"]', '"x"',
         "null", "3", "{}", "[]", '{"k":"[[[{\\"\\\\","v":-0.5,"token":"0","secret":-0.0,"a.token":true,"é":"token"}', '{"token":"","b":false}',
         deep(3), deep(d.LEVELS - 1), deep(40)]


def shown(df):
    return {r.i: (r.j, r[d.BAD_JSON]) for r in df.collect()}


def test_texts_of_any_depth(spark):
    df = spark.createDataFrame(list(enumerate([*TEXTS, None, "", "bad", '{"a":1', '{"password":1,"password":2}'])), "i int, j string")
    got = shown(d.mask_json_columns(df, ["j"]))
    for i, t in enumerate(TEXTS):
        text, bad = got[i]
        assert not bad and json.loads(text) == plain(json.loads(t)), t
    assert got[len(TEXTS)] == (None, False)
    assert all(got[len(TEXTS) + k] == (None, True) for k in range(1, 5))  # nothing unmasked leaks


def test_both_ways_agree(spark):
    """The expression and the helper for very deep documents mask alike."""
    df = spark.createDataFrame(list(enumerate(TEXTS[:-1])), "i int, j string")
    got = shown(d.mask_json_columns(df, ["j"]))
    for i, t in enumerate(TEXTS[:-1]):
        assert json.loads(got[i][0]) == json.loads(d.mask_text(t))
    assert d.mask_text("bad") is None and d.mask_text('{"a":1,"a":2}') is None and d.mask_text(None) is None


def test_too_small_a_depth_raises(spark):
    df = spark.createDataFrame([(0, deep(5))], "i int, j string")
    with pytest.raises(Exception, match="nested deeper than 2"):
        d.mask_json_columns(df, ["j"], depth=2).collect()
    assert json.loads(shown(d.mask_json_columns(df, ["j"], depth=9))[0][0]) == plain(json.loads(deep(5)))


def test_several_columns_and_clashing_names(spark):
    df = spark.createDataFrame([(1, '{"password":1}', "bad", "keep")], "i int, `j.k` string, j string, value string")
    r = d.mask_json_columns(df, ["j.k", "j"]).first()
    assert r["j.k"] == '{"password":"********"}' and r["j"] is None and r[d.BAD_JSON] and r["value"] == "keep"
    assert d.mask_json_columns(df.limit(0), ["j"]).collect() == []


@settings(max_examples=25, deadline=None)
@given(st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-2**31, 2**31), st.text(max_size=5)),
                    lambda inner: st.one_of(st.lists(inner, max_size=3),
                                            st.dictionaries(st.sampled_from(["a", "Token", "x.secret", "b", "pass word", "PASSWORD1"]), inner, max_size=4)),
                    max_leaves=12))
def test_helper_masks_any_document(value):
    assert json.loads(d.mask_text(json.dumps(value))) == plain(value)


def test_lookup_by_a_path_in_a_column(spark):
    doc = '{"a":{"b":null,"c":{"d":5}},"x.y":1,"l":[{"a":1}],"s":"t"}'
    paths = {"a.b": "null", "a.c": '{"d":5}', "a.c.d": "5", "a.q": '"none"', "x.y": '"none"', "a.b.c": '"none"', "": '"none"',
             "l": '[{"a":1}]', "l.a": '"none"', "l.0": '"none"', "s": '"t"', "a.c.d.e": '"none"', "a": '{"b":null,"c":{"d":5}}'}
    df = spark.createDataFrame([(doc, p) for p in paths], "j string, p string")
    got = {r.p: r.v for r in df.select("p", d.lookup_json(F.col("j"), F.col("p"), '"none"').alias("v")).collect()}
    assert got == paths
    odd = spark.createDataFrame([("bad", "a"), (None, "a"), ("[1]", "a"), ("7", "a")], "j string, p string")
    assert {r[0] for r in odd.select(d.lookup_json(F.col("j"), F.col("p"), "0")).collect()} == {"0"}


def test_dotted_field_names_are_names(spark):
    df = spark.sql("SELECT named_struct('api.token', 'x', 'b', named_struct('c.password', '', 'e.f', named_struct('tok.en', 1))) AS s, 1 AS `x.token`")
    r = df.transform(mask_sensitive_fields).first()
    assert r["s"]["api.token"] == MASK and r["s"]["b"]["c.password"] is None and r["s"]["b"]["e.f"]["tok.en"] == 1 and r["x.token"] == MASK
