"""Validation dispatcher: order of checks, key presence, versions, warnings."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import validate as val
from ledgerlake.operators.aggregate import latest_schema_version
from ledgerlake.schemas import latest_version

MAP = "map<string,string>"


def check(spark, records):
    """Validate raw records given as dicts (None values = JSON null, key present)."""
    df = spark.createDataFrame([(r,) for r in records], f"record {MAP}")
    out = val.validate_raw_records(df).collect()
    return [(r[val.REASON], list(r[val.WARNINGS]), r["schema_version"]) for r in out]


BASE = {"timestamp": "2025-04-01T00:00:00", "source": "x"}


def arr(**kw):
    rec = dict(BASE, data_type="salesforce_arr", account_id="001A0000001abcdEAA", account_name="n", arr="1")
    rec.update(kw)
    return rec


@pytest.mark.parametrize("value,reason", [
    ("-1", "arr_negative"), (None, "arr_not_number"), ("abc", "arr_not_number"), ("NaN", None), ("5", None),
])
def test_arr_rule(spark, value, reason):
    assert check(spark, [arr(arr=value)])[0][0] == reason


def opp(**kw):
    rec = dict(BASE, data_type="salesforce_opportunity", opportunity_id="006A0000001abcdEAA",
               account_id="001A0000001abcdEAA", amount="1")
    rec.update(kw)
    return rec


@pytest.mark.parametrize("value,reason", [
    (None, None), ("-1", "amount_negative"), ("7", None), ("x", "amount_not_number"),
])
def test_amount_rule(spark, value, reason):
    assert check(spark, [opp(amount=value)])[0][0] == reason


def test_amount_absent_without_schema_defaults(spark):
    rec = opp(schema_version="v9")
    del rec["amount"]
    assert check(spark, [rec])[0][0] is None  # no registered v9: basic check, absent amount -> 0.0


def test_amount_absent_with_schema_is_missing(spark):
    rec = opp()
    del rec["amount"]
    assert check(spark, [rec])[0][0] == "missing:amount"


def test_normalize_amount(spark):
    df = spark.createDataFrame([(None,), ("7",)], "a string")
    assert [r.x for r in df.select(val.normalize_amount(F.col("a")).alias("x")).collect()] == [0.0, 7.0]


def cur(**kw):
    rec = dict(BASE, data_type="aws_cur", account_id="123456789012", cost="1")
    rec.update(kw)
    return rec


def test_cost_rule(spark):
    res = check(spark, [cur(cost="-3"), cur(cost=None), cur(cost="x")])
    assert res[0][0] is None and res[0][1] == ["negative_cost"]
    assert res[1][0] == "cost_not_number"
    assert res[2][0] == "cost_not_number"


def test_id_format_warnings(spark):
    res = check(spark, [arr(account_id="A" * 16), arr(account_id="A" * 14), cur(account_id="1" * 11)])
    assert res[0] == (None, [], "v2")
    assert res[1][0] is None and res[1][1] == ["account_id_format"]
    assert res[2][0] is None and res[2][1] == ["account_id_format"]


def test_null_account_id_is_quarantined(spark):
    for rec in (arr(account_id=None), cur(account_id=None), opp(account_id=None)):
        assert check(spark, [rec])[0][0] == "account_id_null"


def test_unknown_version_falls_back_to_basic_check(spark):
    rec = arr(schema_version="v9", arr="-1")
    del rec["account_name"]
    res = check(spark, [rec])[0]
    # basic check passes (timestamp, source); the type rule still applies
    assert res[0] == "missing:account_name"
    assert check(spark, [arr(schema_version="v9", arr="-1")])[0][0] == "arr_negative"


def test_missing_version_gets_latest(spark):
    assert check(spark, [arr()])[0][2] == "v2"
    assert check(spark, [arr(schema_version="")])[0][2] == ""  # key present: not overwritten


def test_unknown_data_type(spark):
    ok = check(spark, [dict(BASE, data_type="collector_test")])[0]
    assert ok[0] is None and ok[1] == ["unknown_data_type"]
    rec = dict(BASE, data_type="collector_test")
    del rec["source"]
    assert check(spark, [rec])[0][0] == "missing:source"


def test_missing_data_type(spark):
    assert check(spark, [dict(BASE)])[0][0] == "missing:data_type"


def test_reason_order_first_failure_wins(spark):
    rec = arr(arr="-5")
    del rec["account_name"]
    assert check(spark, [rec])[0][0] == "missing:account_name"


def test_typed_validation_normalizes_amount_and_keeps_rows(spark):
    df = spark.createDataFrame(
        [("o" * 15, "a" * 15, None, "t", "salesforce_opportunity", "s", "v1"),
         ("o" * 15, "a" * 15, -1.0, "t", "salesforce_opportunity", "s", "v1")],
        "opportunity_id string, account_id string, amount double, timestamp string, data_type string, "
        "source string, schema_version string")
    out = val.validate_records(df).collect()
    assert len(out) == 2
    assert out[0].amount == 0.0 and out[0][val.REASON] is None
    assert out[1][val.REASON] == "amount_negative"
    valid, quarantine = val.split_valid_quarantine(val.validate_records(df))
    assert valid.count() + quarantine.count() == df.count()


def test_latest_version_is_lexicographic(spark):
    reg = spark.createDataFrame([("t", "v2"), ("t", "v10"), ("u", "v1")], "data_type string, version string")
    got = {r.data_type: r.latest_version for r in latest_schema_version(reg).collect()}
    assert got == {"t": "v2", "u": "v1"}
    assert latest_version("salesforce_arr") == "v2"
    assert latest_version("nope") is None
