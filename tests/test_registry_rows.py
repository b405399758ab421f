"""The registry as data: same results as the compiled dispatcher, and rows instead of code."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from ledgerlake.operators import registry as reg
from ledgerlake.operators import validate as val
from ledgerlake.sources import crm

MAP = "map<string,string>"
BASE = {"timestamp": "t", "source": "s"}


def both(spark, records):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], f"i int, record {MAP}")
    out = reg.validate_raw_by_registry(df, reg.registry_versions(spark), reg.registry_rules(spark))
    key = lambda d: {r.i: (r[val.REASON], sorted(r[val.WARNINGS]), r["schema_version"]) for r in d.collect()}
    return key(out), key(val.validate_raw_records(df))


def test_same_results_as_the_compiled_dispatcher(spark):
    records = []
    values = {"account_id": [None, "123456789012", "A" * 16, "x"], "cost": [None, "1", "-2", "x", "NaN", " 1_0 "],
              "arr": [None, "5", "-1", "abc"], "amount": [None, "7", "-1", "x"], "opportunity_id": [None, "o" * 15, "o"]}
    for kind, fields in (("aws_cur", ("account_id", "cost")), ("salesforce_arr", ("account_id", "arr")),
                         ("salesforce_opportunity", ("account_id", "opportunity_id", "amount"))):
        for combo in itertools.product(*(values[f] for f in fields)):
            records.append({**BASE, "data_type": kind, "account_name": "n", **dict(zip(fields, combo))})
    for version in ("v1", "v2", "v9", "", None):
        records += [{**BASE, "data_type": t, "schema_version": version, "account_id": "1" * 12, "cost": "1"} for t in
                    ("aws_cur", "salesforce_arr", "unheard_of", None)]
    whole = {**BASE, "data_type": "salesforce_arr", "account_id": "A" * 15, "account_name": "n", "arr": "1"}
    records += [{k: v for k, v in whole.items() if k != gone} for gone in whole] + [{}, dict(BASE)]
    ours, compiled = both(spark, records)
    assert len(ours) == len(records) and ours == compiled


def test_a_new_version_and_a_new_family_need_rows_only(spark):
    versions = reg.registry_versions(spark).unionByName(spark.createDataFrame(
        [("aws_cur", "v3", ["account_id", "region"], []), ("invoice", "v1", ["number", "total"], [])], reg.VERSIONS))
    rules = reg.registry_rules(spark).unionByName(spark.createDataFrame(
        [("invoice", 0, "total", "number", None, "total_not_number", "reject"), ("invoice", 1, "number", "matches", r"\A[0-9]+\z", "odd_number", "warn")],
        reg.RULES))
    df = spark.createDataFrame([(r,) for r in (
        {"data_type": "aws_cur", "account_id": "1" * 12, "cost": "1"}, {"data_type": "aws_cur", "account_id": "1" * 12, "cost": "1", "region": "r"},
        {"data_type": "invoice", "number": "7", "total": "x"}, {"data_type": "invoice", "number": "a7", "total": "5"})], f"record {MAP}")
    out = [(r[val.REASON], r[val.WARNINGS], r["schema_version"]) for r in reg.validate_raw_by_registry(df, versions, rules).collect()]
    assert out == [("missing:region", [], "v3"), (None, [], "v3"), ("total_not_number", [], "v1"), (None, ["odd_number"], "v1")]


def test_unknown_checks_raise_and_an_empty_registry_checks_the_basics(spark):
    import pytest
    df = spark.createDataFrame([({**BASE, "data_type": "aws_cur"},), ({"data_type": "aws_cur"},)], f"record {MAP}")
    bad = spark.createDataFrame([("aws_cur", 0, "cost", "guess", None, "r", "reject")], reg.RULES)
    with pytest.raises(Exception, match="unknown check"):
        reg.validate_raw_by_registry(df, reg.registry_versions(spark), bad).collect()
    none = reg.validate_raw_by_registry(df, reg.registry_versions(spark).limit(0), reg.registry_rules(spark).limit(0)).collect()
    assert [(r[val.REASON], r[val.WARNINGS]) for r in none] == [(None, ["unknown_data_type"]), ("missing:timestamp", [])]


def test_the_lookup_is_one_join_and_no_row_is_lost(spark):
    df = spark.range(50).select(F.create_map(F.lit("data_type"), F.lit("aws_cur"), F.lit("cost"), F.col("id").cast("string")).alias("record"), "id")
    out = reg.validate_raw_by_registry(df, reg.registry_versions(spark), reg.registry_rules(spark))
    assert out.count() == 50 and set(out.columns) == {"record", "id", val.REASON, val.WARNINGS, "schema_version"}


# ---------------------------------------------------------------- run dates in one job
def test_runs_in_one_job_equal_single_runs(spark):
    day = dt.date(2001, 1, 1)
    rows = [(f"o{i:03d}", day + dt.timedelta(days=(i * 37) % 900 - 100)) for i in range(300)] + [("none", None)]
    src = spark.createDataFrame(rows, "Id string, CloseDate date")
    runs = [day + dt.timedelta(days=n) for n in (0, 1, 29, 30, 31, 200, 5000, -5000)]
    asked = spark.createDataFrame([(r,) for r in [*runs, runs[0], None]], "as_of date")
    joined = crm.scan_opportunities_for_runs(src, asked)
    got = sorted((r.as_of, r.Id) for r in joined.collect())
    want = sorted((run, r.Id) for run in runs for r in crm.scan_opportunities(src, run).collect())
    assert got == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert crm.scan_opportunities_for_runs(src.limit(0), asked).collect() == []
    assert crm.scan_opportunities_for_runs(src, asked.limit(0)).collect() == []
