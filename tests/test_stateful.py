"""Streams with keyed state: repeated, late and unusable announcements, redelivered messages,
restarts in mid-stream, and the committing envelope sink."""

import datetime as dt
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.schemas import LANDED_DAILY_LAYOUT
from ledgerlake.sinks import envelope_stream as es
from ledgerlake.sources.account_map import account_map_default
from ledgerlake.streaming import stateful as sf

H7 = ",".join(LANDED_DAILY_LAYOUT)
NOON = dt.datetime(2025, 4, 1, 12)


def announce(spark, log, *events, at=NOON):
    rows = [(i, at, json.dumps(e)) for i, e in enumerate(events)]
    spark.createDataFrame(rows, sf.ARRIVALS).coalesce(1).write.mode("append").parquet(log)


def notice(*keys, bucket="exports"):
    return {"Records": [{"eventSource": "aws:s3", "s3": {"bucket": {"name": bucket}, "object": {"key": k}}} for k in keys]}


def test_objects_are_ingested_once(spark, tmp_path):
    folder = tmp_path / "root" / "exports"
    folder.mkdir(parents=True)
    for n, rows in (("a.csv", "x1,t,123456789012,S,1.5,2025-04,1\nbad,row\n"), ("b.csv", "x2,t,999,S,2,2025-04,1\n"), ("c.csv", "x3,t,234567890123,S,3,2025-04,1\n")):
        (folder / n).write_text(H7 + "\n" + rows)
    (folder / "wrong.csv").write_text("a,b\n1,2\n")
    (folder / "notes.txt").write_text("x")
    log = str(tmp_path / "log")
    sink, quarantine, ledger, ckpt = (str(tmp_path / n) for n in ("sink", "quarantine", "ledger", "ckpt"))
    args = (spark, log, str(tmp_path / "root"), account_map_default(spark), sink, quarantine, ledger, ckpt)
    announce(spark, log, notice("a.csv", "a.csv"), {"action": "cur", "bucket": "exports", "key": "a.csv"}, notice("wrong.csv", "absent.csv", "notes.txt"),
             notice("x.csv", bucket="Bad_Bucket"), {"action": "salesforce"}, {"what": 1})
    sf.stream_arrivals(*args)
    assert [r.account_id for r in spark.read.parquet(sink).collect()] == ["123456789012"]
    assert [r.raw_line for r in spark.read.parquet(quarantine + "/rejected").collect()] == ["bad,row"]
    reasons = {r.path.rsplit("/", 1)[1]: r.reason for r in spark.read.parquet(quarantine + "/files").collect()}
    assert set(reasons) == {"wrong.csv", "absent.csv", "notes.txt"} and reasons["absent.csv"] == "No such object"
    assert [r.reason for r in spark.read.parquet(quarantine + "/announcements").collect()] == ["invalid_bucket"]
    # announced again, far too late, beside a new object whose event time is years old
    announce(spark, log, notice("a.csv", "b.csv"), at=NOON - dt.timedelta(days=900))
    announce(spark, log, {"action": "cur", "bucket": "exports", "key": "c.csv"}, notice("b.csv", "a.csv"), at=NOON + dt.timedelta(days=9))
    sf.stream_arrivals(*args, files_per_trigger=1)
    sf.stream_arrivals(*args)
    assert sorted(r.account_id for r in spark.read.parquet(sink).collect()) == ["123456789012", "234567890123", "999"]
    seen = [r.key for r in spark.read.parquet(ledger).collect()]
    assert sorted(seen) == sorted(set(seen)) and {"a.csv", "b.csv", "c.csv"} <= set(seen)


def receives(spark, log, *rows):
    spark.createDataFrame([(m, NOON + dt.timedelta(seconds=s), c) for m, s, c in rows], sf.RECEIVES).coalesce(1).write.mode("append").parquet(log)


FIRST = [(1, 0, 200), (2, 0, 500), (2, 10, 503), (3, 0, 500), (3, 5, 200), (3, 6, 500), (4, 0, 429), (4, 1, 500), (5, 2, 400), (None, 3, 200)]
SECOND = [(1, 50, 200), (2, 60, 500), (2, 61, 200), (2, 62, 500), (4, 70, 429), (5, 80, 403), (6, 90, 500)]
DAY = 86_400
LATER = [(7, 20 * DAY, 200), (2, 20 * DAY, 500), (8, 10, 200)]  # 8 comes after the watermark has passed it
WANTED = {(1, "done", 1), (2, "dead_letter", 3), (3, "done", 2), (4, "expired", 1), (5, "expired", 2), (6, "expired", 1), (7, "done", 1)}


def outcomes(spark, sink):
    return sorted((r.message_id, r.outcome, r.receives) for r in spark.read.schema(sf.OUTCOMES).parquet(sink).collect())


def test_messages_end_once(spark, tmp_path):
    log, sink, ckpt = (str(tmp_path / n) for n in ("log", "sink", "ckpt"))
    receives(spark, log, *FIRST)
    sf.stream_work_messages(spark, log, sink, ckpt)
    assert outcomes(spark, sink) == [(1, "done", 1), (3, "done", 2)]
    receives(spark, log, *SECOND)  # a restart in mid-stream, the second message's third failure
    sf.stream_work_messages(spark, log, sink, ckpt)
    assert outcomes(spark, sink) == [(1, "done", 1), (2, "dead_letter", 3), (3, "done", 2)]
    receives(spark, log, (7, 20 * DAY, 200))
    sf.stream_work_messages(spark, log, sink, ckpt)  # retention ends for 4, 5 and 6
    receives(spark, log, (8, 10, 200), (2, 20 * DAY, 500))
    sf.stream_work_messages(spark, log, sink, ckpt)
    got = outcomes(spark, sink)
    assert len(got) == len(set(got)) and WANTED <= set(got) and not any(m == 8 for m, _, _ in got)
    expired = {r.message_id: r["at"] for r in spark.read.schema(sf.OUTCOMES).parquet(sink).where("outcome = 'expired'").collect()}
    assert expired[6] == NOON + dt.timedelta(seconds=90 + sf.RETENTION_SECONDS)


def test_one_run_or_many_give_the_same(spark, tmp_path):
    log, sink, ckpt = (str(tmp_path / n) for n in ("log", "sink", "ckpt"))
    for part in (FIRST, SECOND):
        receives(spark, log, *part)
    sf.stream_work_messages(spark, log, sink, ckpt, files_per_trigger=1)
    assert outcomes(spark, sink) == [(1, "done", 1), (2, "dead_letter", 3), (3, "done", 2)]


# ---------------------------------------------------------------- envelope sink
def batch(*values):
    return pa.RecordBatch.from_pydict({"value": pa.array(values, pa.string())})


def records(spark, folder, *numbers):
    spark.createDataFrame([(json.dumps({"n": n}),) for n in numbers], "value string").coalesce(1).write.mode("append").text(folder)


def delivered(spark, path):
    rows = es.read_envelopes(spark, path).select(F.from_json("value", "customer_id string, data array<struct<n: long>>").alias("e")).collect()
    assert {r.e.customer_id for r in rows} <= {"cust"}
    return sorted(x.n for r in rows for x in r.e.data), max((len(r.e.data) for r in rows), default=0)


def test_envelopes_of_a_stream_are_delivered_once(spark, tmp_path):
    src, path, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    records(spark, src, *range(25))
    stream = lambda: spark.readStream.schema("value string").text(src)
    es.stream_envelopes(stream(), path, ckpt, "cust", size=10)
    assert delivered(spark, path) == (list(range(25)), 10)
    es.stream_envelopes(stream(), path, ckpt, "cust", size=10)
    records(spark, src, 100, 101)
    es.stream_envelopes(stream(), path, ckpt, "cust", size=10)
    assert delivered(spark, path)[0] == [*range(25), 100, 101]
    assert es.manifests(spark, path).agg(F.sum("records")).first()[0] == 27


def test_a_failed_task_leaves_no_half_batch(spark, tmp_path):
    src, path, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    records(spark, src, 1, 2, 3)
    records(spark, src, 4)
    stream = spark.readStream.schema("value string").text(src)
    broken = stream.withColumn("value", F.when(F.col("value").contains("4"), F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        es.stream_envelopes(broken, path, ckpt, "cust")
    assert not list((tmp_path / "sink" / es.COMMITS).glob("*.json")) if (tmp_path / "sink").exists() else True
    es.stream_envelopes(stream, path, ckpt, "cust")  # the same batch again, whole
    assert delivered(spark, path)[0] == [1, 2, 3, 4]


def test_a_replayed_batch_delivers_nothing_twice(spark, tmp_path):
    writer = es.EnvelopeWriter({"path": str(tmp_path), "customer_id": "cust", "size": "2"})
    first = [writer.write(iter([batch('{"n":1}', None, '{"n":2}'), batch('{"n":3}')])), writer.write(iter([])), None]
    writer.commit(first, 0)
    assert (first[0].envelopes, first[0].records, first[1].file) == (2, 3, None)
    again = [writer.write(iter([batch('{"n":1}', '{"n":2}', '{"n":3}')]))]
    writer.commit(again, 0)
    lost = [writer.write(iter([batch('{"n":9}')]))]
    writer.abort(lost, 1)
    assert delivered(spark, str(tmp_path)) == ([1, 2, 3], 2)
    assert len(list((tmp_path / "data").iterdir())) == 1
    writer.commit([], 2)
    assert es.manifests(spark, str(tmp_path)).count() == 2
