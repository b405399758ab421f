"""Billing file scans (CSV traps), account maps, checkpoints, envelopes, events."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlake.schemas import FULL_BILLING_LAYOUT, LANDED_DAILY_LAYOUT
from ledgerlake.sources import billing as b
from ledgerlake.sources.account_map import (account_map_default, account_map_or_default, scan_account_map_items,
                                            scan_account_map_json)
from ledgerlake.sources.checkpoint import scan_checkpoint
from ledgerlake.sinks.files import write_checkpoint
from ledgerlake.sources.envelopes import scan_batch_envelopes
from ledgerlake.sources.events import parse_arrival_events

H7 = ",".join(LANDED_DAILY_LAYOUT)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_quoting_newlines_and_escapes(spark, tmp_path):
    body = (H7 + "\n"
            'a,"t, with comma",123456789012,"Svc ""quoted""",1.5,2025-04,1\n'
            'b,"multi\nline",123456789012,S,2,2025-04,1\n')
    p = write(tmp_path / "in" / "f.csv", body)
    rows = b.split_malformed(b.scan_billing_csv(spark, str(tmp_path / "in")))[0].orderBy(
        "`identity/LineItemId`").collect()
    assert rows[0]["identity/TimeInterval"] == "t, with comma"
    assert rows[0]["lineItem/ProductCode"] == 'Svc "quoted"'
    assert rows[1]["identity/TimeInterval"] == "multi\nline"
    assert p


def test_csv_short_and_long_rows_are_quarantined(spark, tmp_path):
    body = H7 + "\n" + "a,t,1,S,1,p,1\n" + "short,t\n" + "long,t,1,S,1,p,1,extra\n"
    write(tmp_path / "in" / "f.csv", body)
    good, bad = b.split_malformed(b.scan_billing_csv(spark, str(tmp_path / "in")))
    assert [r["identity/LineItemId"] for r in good.collect()] == ["a"]
    assert sorted(r[b.MALFORMED].split(",")[0] for r in bad.collect()) == ["long", "short"]
    assert {r.reject_reason for r in bad.collect()} == {"malformed_row"}


def test_csv_blank_is_empty_string(spark, tmp_path):
    write(tmp_path / "in" / "f.csv", H7 + "\n" + "a,,123456789012,S,1,,1\n")
    row = b.scan_billing_csv(spark, str(tmp_path / "in")).first()
    assert row["identity/TimeInterval"] == "" and row["bill/BillingPeriod"] == ""


def test_header_only_and_empty_file(spark, tmp_path):
    write(tmp_path / "h" / "f.csv", H7)
    assert b.scan_billing_csv(spark, str(tmp_path / "h")).count() == 0
    write(tmp_path / "e" / "f.csv", "")
    with pytest.raises(b.BillingFileError):
        b.scan_billing_csv(spark, str(tmp_path / "e"))


def test_required_column_missing_raises_before_reading(spark, tmp_path):
    write(tmp_path / "m" / "f.csv", "identity/LineItemId,lineItem/UsageAccountId\nx,1\n")
    with pytest.raises(b.BillingFileError, match="UnblendedCost"):
        b.scan_billing_csv(spark, str(tmp_path / "m"))
    with pytest.raises(b.BillingFileError):
        b.check_required_columns(["lineItem/UsageAccountId"])


def test_no_file_is_skipped(spark, tmp_path):
    write(tmp_path / "in" / "good.csv", H7 + "\na,t,1,S,1,p,1\n")
    write(tmp_path / "in" / "wrong.csv", "x,y\n1,2\n")
    write(tmp_path / "in" / "empty.csv", "")
    layouts, bad = b.inspect_csv(spark, str(tmp_path / "in"))
    assert list(layouts) == [tuple(LANDED_DAILY_LAYOUT)] and sorted(f.rsplit("/", 1)[1] for f in bad) == ["empty.csv", "wrong.csv"]
    with pytest.raises(b.BillingFileError, match="wrong.csv"):
        b.scan_billing_csv(spark, str(tmp_path / "in"))
    with pytest.raises(b.BillingFileError):
        b.scan_by_format(spark, [])


def test_header_is_the_first_line_only(spark, tmp_path):
    body = H7 + "\na,t,1,S,1,p,1\n" + "0 lineItem/UnblendedCost,t,1,S,2,p,1\n"
    write(tmp_path / "in" / "f.csv", body)
    rows = b.scan_billing_csv(spark, str(tmp_path / "in")).collect()
    assert sorted(r["identity/LineItemId"] for r in rows) == ["0 lineItem/UnblendedCost", "a"]


def test_malformed_rows_are_counted_and_quarantined_once(spark, tmp_path):
    from ledgerlake.params import DEFAULT_CONTEXT
    from ledgerlake.plans.pipelines import ingest_billing
    write(tmp_path / "in" / "f.csv", H7 + "\n" + "a,t,123456789012,S,1,p,1\n" + "short,t\n" + "long,t,1,S,1,p,1,extra\n")
    raw = b.scan_by_format(spark, [str(tmp_path / "in" / "f.csv")])
    good, bad = b.split_malformed(raw)
    assert (raw.count(), good.count(), bad.count()) == (3, 1, 2)
    assert bad.select(b.MALFORMED).count() == 2 and sorted(r[0] for r in bad.select(b.MALFORMED).collect())[0].startswith("long")
    for _ in range(2):  # a second run of the day replaces its own output
        out = ingest_billing(raw, account_map_default(spark), DEFAULT_CONTEXT, quarantine_path=str(tmp_path / "q"))
        assert sorted(str(r.reject_reason) for r in out.collect()) == ["None", "malformed_row", "malformed_row"]
        kept = spark.read.json(str(tmp_path / "q")).collect()
        assert sorted(r.raw_line for r in kept) == ["long,t,1,S,1,p,1,extra", "short,t"]
        assert "account_id" in kept[0].asDict() and str(kept[0].failed_date) == DEFAULT_CONTEXT.as_of_iso


def test_corrupt_checkpoint_raises(spark, tmp_path):
    write(tmp_path / "c" / "checkpoint-1.json" / "part-0.json", "{not json")
    with pytest.raises(Exception):
        scan_checkpoint(spark, str(tmp_path / "c"))


def test_extract_resumes_page_by_page(spark, tmp_path):
    import dataclasses
    from ledgerlake.params import DEFAULT_CONTEXT
    from ledgerlake.plans.pipelines import resume_extract
    src = spark.createDataFrame([(f"{i:03d}",) for i in range(25)], "Id string")
    seen = []
    for k in range(4):
        ctx = dataclasses.replace(DEFAULT_CONTEXT, ingest_ts=dt.datetime(2025, 4, 1, 0, 0, k))
        seen.append([r.Id for r in resume_extract(src, str(tmp_path / "ck"), 10, ctx).orderBy("Id").collect()])
    assert [len(p) for p in seen] == [10, 10, 5, 0] and sum(seen, []) == [f"{i:03d}" for i in range(25)]
    row = scan_checkpoint(spark, str(tmp_path / "ck")).first()
    assert (row.last_id, row.processed_count) == ("024", 25)


def test_bucket_names_take_no_line_break(spark):
    ev = spark.createDataFrame([(1, json.dumps({"action": "cur", "bucket": "abc\n", "key": "k"}))], "id long, value string")
    assert parse_arrival_events(ev, id_col="id").first().reason == "invalid_bucket"


def test_cost_windows_prune_folders(spark, tmp_path):
    from ledgerlake.sources.costs import read_cost_responses, scan_daily_costs
    for day in ("2025-03-31", "2025-04-02"):
        doc = {"ResultsByTime": [{"TimePeriod": {"Start": day, "End": day}, "Groups": [
            {"Keys": ["s", "a"], "Metrics": {"UnblendedCost": {"Amount": "1", "Unit": "USD"}}}]}]}
        write(tmp_path / "r" / f"cost_month={day[:7]}" / "p.json", json.dumps(doc))
    got = scan_daily_costs(read_cost_responses(spark, str(tmp_path / "r")), dt.date(2025, 4, 2), dt.date(2025, 4, 3))
    assert got.count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "cost_month" in plan.split("PartitionFilters")[1].split("]")[0]


def test_a_large_day_is_several_files(spark, tmp_path, monkeypatch):
    from ledgerlake.sinks import files
    monkeypatch.setattr(files, "ROWS_PER_FILE", 100)
    df = spark.range(350).select(F.col("id").alias("v"), F.lit("2025-04-01").alias("cost_date"))
    files.write_partitioned_csv(df, str(tmp_path / "d"))
    assert len(list((tmp_path / "d").rglob("*.csv"))) >= 4
    assert files.read_partitioned_csv(spark, str(tmp_path / "d"), ["v"]).count() == 350


def test_two_layouts_in_one_folder_match_by_name(spark, tmp_path):
    write(tmp_path / "mix" / "daily.csv", H7 + "\nd1,t,123456789012,SvcA,2.5,2025-04,1\n")
    full_vals = {c: "" for c in FULL_BILLING_LAYOUT}
    full_vals.update({"identity/LineItemId": "f1", "lineItem/UsageAccountId": "234567890123",
                      "lineItem/ProductCode": "SvcB", "lineItem/UnblendedCost": "7", "lineItem/UsageAmount": "3"})
    write(tmp_path / "mix" / "full.csv",
          ",".join(FULL_BILLING_LAYOUT) + "\n" + ",".join(full_vals[c] for c in FULL_BILLING_LAYOUT) + "\n")
    rows = {r["identity/LineItemId"]: r for r in b.scan_billing_csv(spark, str(tmp_path / "mix")).collect()}
    assert rows["d1"]["lineItem/ProductCode"] == "SvcA" and rows["d1"]["lineItem/UnblendedCost"] == "2.5"
    assert rows["f1"]["lineItem/ProductCode"] == "SvcB" and rows["f1"]["lineItem/UsageAmount"] == "3"
    assert rows["f1"]["bill/BillingPeriod"] is None  # absent in that layout -> projection default ''


def test_format_dispatch(spark):
    assert b.file_format("a/b.csv") == "csv" and b.file_format("x.parquet") == "parquet"
    with pytest.raises(b.BillingFileError):
        b.file_format("x.CSV")


def test_account_map_items_last_wins_and_skips_incomplete(spark):
    items = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("2", None, 3), (None, "c", 4)],
                                  "account_id string, business_unit string, seq int")
    got = {r.account_id: r.cost_category for r in scan_account_map_items(items).collect()}
    assert got == {"1": "b"}


def test_account_map_fallbacks(spark):
    empty = spark.createDataFrame([], "account_id string, cost_category string")
    default = {r.account_id: r.cost_category for r in account_map_or_default(spark, empty).collect()}
    assert default == {"123456789012": "production", "234567890123": "staging", "345678901234": "development"}
    bad = scan_account_map_json(spark.createDataFrame([("{not json",)], "value string"))
    assert account_map_or_default(spark, bad).count() == 3
    ok = scan_account_map_json(spark.createDataFrame([('{"111111111111": "ml"}',)], "value string"))
    assert [tuple(r) for r in account_map_or_default(spark, ok).collect()] == [("111111111111", "ml")]
    assert account_map_default(spark).count() == 3


def test_checkpoint_roundtrip_newest_wins(spark, tmp_path):
    prefix = str(tmp_path / "ckpt")
    assert scan_checkpoint(spark, prefix) is None
    write_checkpoint(spark, prefix, "q", "A", 2000, dt.datetime(2025, 4, 1, 0, 0, 1))
    write_checkpoint(spark, prefix, "q", "B", 4000, dt.datetime(2025, 4, 1, 0, 0, 2))
    row = scan_checkpoint(spark, prefix).first()
    assert (row.last_id, row.processed_count) == ("B", 4000)


def test_envelope_scan_routes_and_quarantines(spark):
    msgs = spark.createDataFrame([
        (json.dumps({"type": "cur_batch", "records": [{"a": 1, "b": None}, {"a": 2}], "timestamp": "t",
                     "batch_number": 1, "total_batches": 1}),),
        (json.dumps({"type": "other", "records": [{"a": 3}]}),),
        ("{broken",),
        (json.dumps({"type": "salesforce_batch", "records": []}),),
    ], "value string")
    rows = scan_batch_envelopes(msgs).collect()
    good = [r for r in rows if r.reject_reason is None]
    assert [(r.record_index, r.record["a"]) for r in good] == [(0, "1"), (1, "2")]
    assert "b" in good[0].record and good[0].record["b"] is None  # null kept, key present
    assert sorted(r.reject_reason for r in rows if r.reject_reason) == ["unknown_message_type",
                                                                        "unparsable_message"]


def test_arrival_events_all_records_and_checks(spark):
    ev = [
        {"action": "cur", "bucket": "my-bucket", "key": "aws-cur/a.csv"},
        {"action": "cur", "bucket": "Bad_Bucket", "key": "k"},
        {"action": "cur", "bucket": "my-bucket", "key": "k" * 1025},
        {"action": "salesforce"},
        {"Records": [{"eventSource": "aws:s3", "s3": {"bucket": {"name": "b-1"}, "object": {"key": "x"}}},
                     {"eventSource": "aws:s3", "s3": {"bucket": {"name": "b-1"}, "object": {"key": "y"}}}]},
        {"Records": [{"eventSource": "aws:sqs", "body": "{}"}]},
        {"something": 1},
    ]
    df = spark.createDataFrame([(i, json.dumps(e)) for i, e in enumerate(ev)], "id long, value string")
    rows = parse_arrival_events(df, id_col="id").orderBy("event_id", "record_index").collect()
    got = [(r.event_id, r.record_index, r.kind, r.reason) for r in rows]
    assert got == [
        (0, 0, "billing_file", None), (1, 0, "billing_file", "invalid_bucket"),
        (2, 0, "billing_file", "invalid_key"), (3, 0, "crm_sync", None),
        (4, 0, "billing_file", None), (4, 1, "billing_file", None),
        (5, 0, "queue_message", None), (6, 0, "unsupported", "unsupported_event"),
    ]
    assert rows[5].key == "y"


def test_spread_only_few_split_scans(spark, tmp_path):
    """A one-file scan is spread over the cores; rows and pruning are unchanged;
    an input that already has a split per core is returned as is."""
    from ledgerlake.sources.adapters import spread
    cores = spark.sparkContext.defaultParallelism
    path = str(tmp_path / "one")
    spark.range(0, 5000).withColumn("v", F.col("id") * 2).coalesce(1).write.parquet(path)
    one = spark.read.parquet(path)
    assert one.rdd.getNumPartitions() < cores
    spread_df = spread(one)
    assert spread_df.rdd.getNumPartitions() == cores
    assert sorted(r.id for r in spread_df.select("id").collect()) == list(range(5000))
    plan = spread_df.select("id").filter(F.col("id") > 10)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "GreaterThan(id,10)" in plan
    many = spark.range(0, 100, numPartitions=cores * 2)
    assert spread(many) is many


def test_malformed_lines_land_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    from ledgerlake.sources import landing
    from tests.conftest import SF_SMALL
    monkeypatch.setattr(landing, "ROWS_PER_EXPORT", 4)
    landing._write_malformed(spark, SF_SMALL, f"file://{tmp_path}/bad")
    files = [p.read_text().splitlines()[1:] for p in (tmp_path / "bad").glob("*.csv")]
    want = sorted(r.line for r in landing.malformed_lines(spark, SF_SMALL).collect())
    assert sorted(x for f in files for x in f) == want and len(want) > 4
    assert max(len(f) for f in files) <= 4


def test_large_month_of_cost_responses_is_several_files(spark, monkeypatch):
    from ledgerlake.sources import landing
    monkeypatch.setattr(landing, "DOCS_PER_FILE", 5, raising=False)
    daily = spark.createDataFrame([(f"2025-04-{d:02}", f"s{k}", f"{k:012}", "1.5") for d in range(1, 25) for k in range(3)],
                                  "cost_date string, service string, account_id string, amount string")
    path = landing.land_cost_responses(spark, "large-month", daily)
    docs = spark.read.text(path).withColumn("file", F.input_file_name()).collect()
    per_file = {}
    for r in docs:
        per_file.setdefault(r.file, []).append(json.loads(r.value))
    assert max(map(len, per_file.values())) <= 5 and len(docs) == 24
    assert sum(len(t["Groups"]) for f in per_file.values() for d in f for t in d["ResultsByTime"]) == 72


def test_size_check_sends_one_row_a_task(spark):
    """Rows and bytes are counted by a partial aggregate; no task sends rows to a single one."""
    from ledgerlake.operators import joins
    df = spark.range(1000).select("id", F.lit("x" * 100).alias("v"), F.array(F.lit(1)).alias("a.b"), F.lit(None).cast("string").alias("n"))
    assert joins.has_at_most(df, 1000) and not joins.has_at_most(df, 999)
    assert not joins.has_at_most(df, 1000, most_bytes=50_000)
    assert joins.has_at_most(df.limit(0), 0)
    assert "Broadcast" in joins.lookup_side(df, 1000).join(df, "id")._jdf.queryExecution().executedPlan().toString()


def test_extract_resumes_until_a_page_is_empty(spark, tmp_path):
    import glob
    from ledgerlake.plans.pipelines import resume_to_end
    rows = [(f"k{i:03d}", i) for i in range(25)] + [(None, -1)]
    src = spark.createDataFrame(rows, "Id string, v int").repartition(3)
    for size, pages in ((10, 3), (5, 5), (25, 1), (100, 1)):
        out = resume_to_end(src, str(tmp_path / f"c{size}"), size).collect()
        assert sorted(r.Id for r in out) == [f"k{i:03d}" for i in range(25)]
        assert {r.Id: r.page for r in out} == {f"k{i:03d}": i // size + 1 for i in range(25)}
        assert len(glob.glob(str(tmp_path / f"c{size}" / "checkpoint-*"))) == pages  # an empty page saves nothing
    assert resume_to_end(src.limit(0), str(tmp_path / "none"), 5).collect() == []


def test_required_columns_of_a_folder(spark, tmp_path):
    from ledgerlake.sources.billing import required_columns_report
    (tmp_path / "a.csv").write_text('"lineItem/UsageAccountId","lineItem/UnblendedCost"\n1,2\n')
    (tmp_path / "b.csv").write_text("x,lineItem/UnblendedCost\n1,2\n")
    (tmp_path / "c.csv").write_text("\n")
    got = {r.file.rsplit("/", 1)[1]: r.missing for r in required_columns_report(spark, str(tmp_path)).collect()}
    assert got == {"a.csv": [], "b.csv": ["lineItem/UsageAccountId"], "c.csv": ["lineItem/UnblendedCost", "lineItem/UsageAccountId"]}


def test_many_parquet_files_take_a_bounded_number_of_jobs(spark, tmp_path):
    """200 files of two types and two layouts, one corrupt, one without a required column."""
    need = list(b.REQUIRED_BILLING_COLUMNS)
    text = spark.range(100).select(F.col("id").cast("string").alias(need[0]), F.lit("1.5").alias(need[1]))
    number = spark.range(100, 200).select(F.col("id").alias(need[0]), F.lit("2").alias(need[1]), F.lit("x").alias("extra"))
    for name, rows in (("a", text), ("b", number)):
        rows.repartition(100).write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / name))
    spark.range(1).select(F.lit("7").alias(need[0])).coalesce(1).write.parquet(str(tmp_path / "lacks"))
    spark.range(1).select(F.lit("8").alias(need[0]), F.lit(None).cast("string").alias(need[1])).coalesce(1).write.parquet(str(tmp_path / "nulls"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    files = sorted(str(f) for f in tmp_path.glob("*/*.parquet"))
    assert len(files) >= 200
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        good, bad = b.readable_files(spark, files)
        jobs = len(tracker.getJobIdsForGroup("footers"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {f.split("/")[-2] for f in bad} == {"lacks", "bad"} and len(good) == len(files) - 2
    assert jobs < 100, jobs  # some for every fault, none for a good file
    spark.sparkContext.setJobGroup("good", "good")
    try:
        assert b.readable_files(spark, [f for f in files if "/a/" in f]) == (sorted(f for f in files if "/a/" in f), {})
        assert len(tracker.getJobIdsForGroup("good")) <= 6
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rows = b.scan_by_format(spark, good)
    assert rows.count() == 201 and dict(rows.dtypes)[need[0]] == "string"
    with pytest.raises(b.BillingFileError):
        b.scan_by_format(spark, files)
