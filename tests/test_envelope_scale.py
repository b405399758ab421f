"""Plans and results of the steps that many records pass: what is shuffled, parsed and sorted."""

import json
import re

from pyspark.sql import functions as F

from ledgerlake.operators import validate as val
from ledgerlake.session import open_writers
from ledgerlake.sinks.envelopes import batched_records
from ledgerlake.sources.billing import file_format
from ledgerlake.sources.envelopes import scan_batch_envelopes


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_are_completed_and_serialised_after_the_last_shuffle(spark):
    df = spark.range(250).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    b = batched_records(df, 100, ["k"], shards=3, finish=lambda d: d.withColumn("tag", F.concat(F.lit("t"), "v")))
    rows = {r["batch_number"]: r for r in b.collect()}
    assert [rows[n]["record_count"] for n in (1, 2, 3)] == [100, 100, 50]
    assert {r["total_batches"] for r in rows.values()} == {3}
    assert json.loads(rows[2]["records_json"]) == [{"k": k, "v": k % 3, "tag": f"t{k % 3}"} for k in range(100, 200)]
    text = plan(b)
    assert text.index("StructsToJson") < text.index("Exchange hashpartitioning(_batch")


def test_a_message_is_parsed_once_and_its_records_are_not_copied_to_each(spark):
    good = json.dumps({"type": "cur_batch", "records": [{"a": "1"}, {"a": "2"}], "timestamp": "t", "batch_number": 1})
    df = spark.createDataFrame([(good,), ("{",), ('{"type":"x"}',), ('{"type":"cur_batch","records":[{"a":NaN}]}',),
                                ('{"type":"cur_batch","records":[]}',)], "value string").repartition(2)
    scan = scan_batch_envelopes(df)
    got = sorted((r["reject_reason"] or "", r["record_index"] or 0, r["message_type"] or "") for r in scan.collect())
    assert got == [("", 0, "cur_batch"), ("", 1, "cur_batch"), ("unknown_message_type", 0, "x"),
                   ("unparsable_message", 0, ""), ("unparsable_message", 0, "cur_batch")]
    for out in (scan.select("message_type", "record"), val.validate_scanned_records(scan).groupBy("message_type", "reject_reason").count()):
        text = plan(out)
        assert text.count("from_json") == 1
        carried = re.search(r"Generate posexplode.*\), \[([^]]*)\], false", text).group(1)
        assert "records" not in carried and "m#" not in carried


def test_scanned_records_keep_the_reason_of_their_message(spark):
    ok = {"data_type": "salesforce_arr", "account_id": "A" * 15, "account_name": None, "arr": "5", "timestamp": "t", "source": "salesforce"}
    text = [json.dumps({"type": "cur_batch", "records": [ok, {**ok, "arr": "-1"}, {k: v for k, v in ok.items() if k != "account_name"}]}), "no json"]
    out = val.validate_scanned_records(scan_batch_envelopes(spark.createDataFrame([(t,) for t in text], "value string")))
    got = [(r["record_index"], r["reject_reason"], r["warnings"], r["schema_version"]) for r in out.collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r[0])) == [
        (0, None, [], "v2"), (1, "arr_negative", [], "v2"), (2, "missing:account_name", [], "v2"), (None, "unparsable_message", [], None)]
    assert plan(out).count("element_at(record") <= 4  # one lookup expression, not one for each rule


def test_partition_folders_are_written_without_a_sort(spark, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    with open_writers(spark, 3):
        assert spark.conf.get(key) == "3"
        spark.range(10).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(str(tmp_path / "o"))
    assert spark.conf.get(key, None) == before
    assert spark.read.parquet(str(tmp_path / "o")).count() == 10


def test_gzipped_exports_are_csv():
    assert file_format("a/b.csv.gz") == "csv" and file_format("a.csv") == "csv" and file_format("a.parquet") == "parquet"
