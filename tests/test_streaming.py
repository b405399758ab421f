"""Exactly-once file pick-up: a second run over the same folder adds nothing."""

from pyspark.sql import functions as F

from ledgerlake.schemas import LANDED_DAILY_LAYOUT
from ledgerlake.sources.account_map import account_map_default
from ledgerlake.streaming.jobs import stream_batch_envelopes, stream_billing_files

H7 = ",".join(LANDED_DAILY_LAYOUT)


def test_billing_stream_runs_twice_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(H7 + "\nx1,t,123456789012,S,1.5,2025-04,1\nx2,t,999,S,n/a,2025-04,1\nbad,row\n")
    sink, quarantine, ckpt = (str(tmp_path / n) for n in ("sink", "quarantine", "ckpt"))
    args = (spark, str(landing), account_map_default(spark), sink, quarantine, ckpt)
    stream_billing_files(*args)
    first = spark.read.parquet(sink)
    assert first.count() == 2  # both well-formed rows valid (cost parse failure zeroes, never rejects)
    assert {r.cost_category for r in first.collect()} == {"production", "unallocated"}
    bad = spark.read.parquet(quarantine + "/rejected").collect()
    assert [(r.reject_reason, r.raw_line) for r in bad] == [("malformed_row", "bad,row")]
    stream_billing_files(*args)
    assert spark.read.parquet(sink).count() == 2
    (landing / "b.csv").write_text(H7 + "\nx3,t,234567890123,S,2,2025-04,1\n")
    stream_billing_files(*args)
    assert spark.read.parquet(sink).count() == 3


def test_billing_stream_takes_mixed_files_by_name(spark, tmp_path):
    """Reordered headers, Parquet, unreadable and foreign files in one folder."""
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(H7 + "\nx1,t,123456789012,SvcA,1.5,2025-04,1\n")
    turned = list(reversed(LANDED_DAILY_LAYOUT))
    cells = dict(zip(LANDED_DAILY_LAYOUT, ["x2", "t", "234567890123", "SvcB", "2.5", "2025-04", "1"]))
    (landing / "b.csv").write_text(",".join(turned) + "\n" + ",".join(cells[c] for c in turned) + "\n")
    spark.createDataFrame([("x3", "t", "345678901234", "SvcC", "3.5", "2025-04", "1")], LANDED_DAILY_LAYOUT).coalesce(
        1).write.parquet(str(tmp_path / "pq"))
    next((tmp_path / "pq").glob("*.parquet")).rename(landing / "c.parquet")
    (landing / "empty.csv").write_text("")
    (landing / "wrong.csv").write_text("a,b\n1,2\n")
    (landing / "notes.txt").write_text("not a billing file")
    sink, quarantine, ckpt = (str(tmp_path / n) for n in ("sink", "quarantine", "ckpt"))
    stream_billing_files(spark, str(landing), account_map_default(spark), sink, quarantine, ckpt)
    got = sorted((r.account_id, r.service, r.cost, r.cost_category) for r in spark.read.parquet(sink).collect())
    assert got == [("123456789012", "SvcA", 1.5, "production"), ("234567890123", "SvcB", 2.5, "staging"),
                   ("345678901234", "SvcC", 3.5, "development")]
    bad = spark.read.parquet(quarantine + "/files").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in bad) == ["empty.csv", "wrong.csv"]


def test_envelope_stream_runs_twice_once(spark, tmp_path):
    landing = tmp_path / "msgs"
    landing.mkdir()
    rec = ('{"data_type":"aws_cur","account_id":"123456789012","cost":"-2","timestamp":"t","source":"aws",'
           '"schema_version":"v1"}')
    (landing / "m1.json").write_text('{"type":"cur_batch","records":[' + rec + '],"timestamp":"t"}\nnot json\n')
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    stream_batch_envelopes(spark, str(landing), sink, ckpt)
    out = spark.read.parquet(sink)
    rows = out.select("reject_reason", F.array_join("warnings", ",").alias("w")).collect()
    assert sorted((r.reject_reason or "", r.w) for r in rows) == [("", "negative_cost"), ("unparsable_message", "")]
    stream_batch_envelopes(spark, str(landing), sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
