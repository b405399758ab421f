"""Scalar rules: number parsing, paired parse, hashes, timestamps, defaults."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import (correlation_id, data_version, iso_timestamp, paired_float,
                                          python_float)
from ledgerlake.operators.enrich import tag_records
from ledgerlake.operators.project import project_billing


@pytest.mark.parametrize("text,expected", [
    ("1.5", 1.5), (" 1.5 ", 1.5), ("1e3", 1000.0), ("-2", -2.0), ("1_000", 1000.0),
    ("1.0d", None), ("2f", None), ("0x1p3", None), ("", None), ("n/a", None), ("1__0", None),
])
def test_python_float(spark, text, expected):
    row = spark.createDataFrame([(text,)], "v string").select(python_float(F.col("v")).alias("x")).first()
    assert row.x == expected


def test_python_float_specials(spark):
    rows = spark.createDataFrame([("nan",), ("inf",), ("-Infinity",)], "v string").select(
        python_float(F.col("v")).alias("x")).collect()
    import math
    assert math.isnan(rows[0].x) and rows[1].x == math.inf and rows[2].x == -math.inf


@pytest.mark.parametrize("cost,usage,expected", [
    ("1.5", "bad", (0.0, 0.0)),
    ("1.5", "", (0.0, 0.0)),
    (" 1.5 ", "1e3", (1.5, 1000.0)),
    ("1.0d", "1", (0.0, 0.0)),
    ("1_000", "1", (1000.0, 1.0)),
])
def test_paired_parse(spark, cost, usage, expected):
    df = spark.createDataFrame([(cost, usage)], "`lineItem/UnblendedCost` string, `lineItem/UsageAmount` string")
    c, u, failed = paired_float(df, "lineItem/UnblendedCost", "lineItem/UsageAmount")
    row = df.select(c.alias("c"), u.alias("u"), failed.alias("f")).first()
    assert (row.c, row.u) == expected
    assert row.f == (expected == (0.0, 0.0))


def test_paired_parse_absent_usage_column(spark):
    df = spark.createDataFrame([("1.5",)], "`lineItem/UnblendedCost` string")
    c, u, failed = paired_float(df, "lineItem/UnblendedCost", "lineItem/UsageAmount")
    row = df.select(c.alias("c"), u.alias("u"), failed.alias("f")).first()
    assert (row.c, row.u, row.f) == (1.5, 0.0, False)


def test_correlation_of_null_hashes_none(spark):
    row = spark.createDataFrame([(None,)], "account_id string").select(
        correlation_id(F.col("account_id")).alias("h")).first()
    assert row.h == "dc937b59892604f5a86ac96936cd7ff09e25f18ae6b758e8014a24c7fa039e91"
    assert row.h == hashlib.sha256(b"None").hexdigest()


def test_tag_falls_back_to_AccountId_and_skips_without_id(spark):
    df = spark.createDataFrame([("A1", "t", "s")], "AccountId string, timestamp string, source string")
    tagged = tag_records(df).first()
    assert tagged.obs_correlation_id == hashlib.sha256(b"A1").hexdigest()
    bare = tag_records(spark.createDataFrame([("t", "s")], "timestamp string, source string"))
    assert "obs_correlation_id" not in bare.columns
    assert bare.first().obs_data_version == hashlib.md5(b"t-s").hexdigest()


def test_data_version(spark):
    row = spark.createDataFrame([("2025-04-01T00:00:00", "aws")], "t string, s string").select(
        data_version(F.col("t"), F.col("s")).alias("v")).first()
    assert row.v == hashlib.md5(b"2025-04-01T00:00:00-aws").hexdigest()


def test_iso_timestamp_fraction_only_when_nonzero(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 4, 1, 0, 0, 0, 123456),), (dt.datetime(2025, 4, 1),)],
                               "ts timestamp")
    got = [r.x for r in df.select(iso_timestamp(F.col("ts")).alias("x")).collect()]
    assert got == ["2025-04-01T00:00:00.123456", "2025-04-01T00:00:00"]


def test_default_fill_by_layout(spark):
    from ledgerlake.schemas import FULL_BILLING_LAYOUT, LANDED_DAILY_LAYOUT
    full = spark.createDataFrame([tuple("x" for _ in FULL_BILLING_LAYOUT)],
                                 ", ".join(f"`{c}` string" for c in FULL_BILLING_LAYOUT))
    assert project_billing(full).first().billing_period == ""
    landed = spark.createDataFrame([tuple("1" for _ in LANDED_DAILY_LAYOUT)],
                                   ", ".join(f"`{c}` string" for c in LANDED_DAILY_LAYOUT))
    row = project_billing(landed).first()
    assert (row.resource_id, row.usage_type, row.billing_period) == ("", "", "1")


def test_blank_cell_stays_blank(spark):
    df = spark.createDataFrame([("", "1", "1")],
                               "`lineItem/ResourceId` string, `lineItem/UsageAccountId` string, "
                               "`lineItem/UnblendedCost` string")
    assert project_billing(df).first().resource_id == ""
