"""The paged extract source: same rows as the extract, filters pushed, several partitions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import observed
from ledgerlake.operators.validate import REASON
from ledgerlake.sources import pages

SCHEMA = "Id string, Name string, Amount double, CloseDate date, IsClosed boolean, N long, `odd.name` string"
DAY = dt.date(2001, 1, 1)


@pytest.fixture(scope="module")
def extract(spark):
    rows = [(f"k{i:04d}", None if i % 7 == 0 else f"n{i % 5} é\n\"x\"", None if i % 5 == 0 else float("nan") if i % 11 == 0 else i / 3,
             None if i % 13 == 0 else DAY + dt.timedelta(days=i), i % 2 == 0, i, "o") for i in range(500)]
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


@pytest.fixture(scope="module")
def landed(spark, extract, tmp_path_factory):
    return pages.write_pages(extract, str(tmp_path_factory.mktemp("pages") / "x"), 20, pages_per_chunk=4)


def rows(df):
    return sorted(map(str, df.collect()))


def test_same_rows_from_several_partitions(spark, extract, landed):
    read = pages.read_pages(spark, landed, extract.schema)
    assert rows(read) == rows(extract)
    assert read.select(F.spark_partition_id()).distinct().count() == 7  # 25 pages, 4 to a chunk
    assert read.select("N", "`odd.name`").count() == 500


@pytest.mark.parametrize("where", [
    "Id > 'k0123'", "Id >= 'k0123' AND Id < 'k0125'", "Id = 'k0400'", "Id IN ('k0001', 'k0499', 'zz')", "Id LIKE 'k01%'", "Id <= 'k0003'",
    "CloseDate >= DATE '2001-06-01' AND IsClosed = true", "Name IS NOT NULL AND N > 490", "Amount > 100", "Amount = double('nan')",
    "Name IS NULL", "NOT (N > 5)", "N IN (1, 2, NULL)", "Id > 'zzz'", "CloseDate <=> NULL", "N > 3 OR Id = 'k0001'"])
def test_filters_give_what_spark_gives(spark, extract, landed, where):
    assert rows(pages.read_pages(spark, landed, extract.schema).where(where)) == rows(extract.where(where))


def test_filters_are_pushed_and_prune(spark, extract, landed):
    reader = pages.PageReader(extract.schema, {"path": landed})
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull, LessThan
    left = list(reader.pushFilters([GreaterThan(("Id",), "k0470"), LessThan(("Amount",), 3.0), EqualTo(("IsClosed",), True), IsNotNull(("Id",))]))
    assert [type(f) for f in left] == [LessThan]
    parts = reader.partitions()
    assert [p.value for p in parts] == [5, 6]
    got = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(r["Id"] for r in got) == [f"k{i:04d}" for i in range(472, 500, 2)]
    plan = pages.read_pages(spark, landed, extract.schema).where("Id > 'k0470'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan


def test_key_ranges():
    from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual, StringStartsWith
    cases = [(EqualTo, "m", True), (EqualTo, "a", False), (In, ("a", "z"), False), (In, ("a", "n"), True), (GreaterThan, "p", False),
             (GreaterThanOrEqual, "p", True), (GreaterThan, "o", True), (LessThan, "c", False), (LessThanOrEqual, "c", True),
             (StringStartsWith, "c", True), (StringStartsWith, "pp", False), (StringStartsWith, "b", False)]
    for kind, value, held in cases:
        assert pages.may_hold(kind, value, "c", "p") is held, (kind, value)


def test_extracts_without_rows_and_rows_without_keys(spark, extract, tmp_path):
    empty = pages.write_pages(extract.limit(0), str(tmp_path / "none"), 20)
    assert pages.read_pages(spark, empty, extract.schema).collect() == []
    odd = spark.createDataFrame([(None, "x"), ("b", None), ("a", "y")], "Id string, Name string")
    path = pages.write_pages(odd, str(tmp_path / "odd"), 1)
    assert [tuple(r) for r in pages.read_pages(spark, path, "Id string, Name string, New string").orderBy("Id").collect()] == [
        ("a", "y", None), ("b", None, None)]


# ---------------------------------------------------------------- counts taken while writing
def test_counts_while_writing_equal_those_read_again(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("data_type"),
                                  F.when(F.col("id") % 5 == 0, "bad").alias(REASON))
    path = str(tmp_path / "out")
    got = {tuple(r) for r in observed.ingest_observed(df, lambda d: d.write.parquet(path), ["a", "b", "unused", None]).collect()}
    again = spark.read.parquet(path).groupBy("data_type").agg(F.count(F.lit(1)), F.count_if(F.col(REASON).isNull()), F.count_if(F.col(REASON).isNotNull()))
    assert got == {tuple(r) for r in again.collect()} and len(got) == 3
    with pytest.raises(ValueError, match="333 rows"):
        observed.ingest_observed(df, lambda d: d.write.mode("overwrite").parquet(path), ["a", None])


def test_days_are_counted_while_landing(spark, tmp_path):
    days = spark.range(90).select(F.date_format(F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")), "yyyy-MM-dd").alias("cost_date"))
    window = (DAY, DAY + dt.timedelta(days=5))
    got = [tuple(r) for r in observed.landing_observed(days, lambda d: d.write.parquet(str(tmp_path / "d")), window).orderBy("cost_date").collect()]
    assert got == [("2001-01-01", 30), ("2001-01-02", 30), ("2001-01-03", 30)]
    none = observed.landing_observed(days.limit(0), lambda d: d.write.parquet(str(tmp_path / "e")), window)
    assert none.collect() == []


def test_the_input_is_scanned_once(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(100).select(F.lit("a").alias("data_type"), F.lit(None).cast("string").alias(REASON)).write.parquet(src)
    reads = spark.sparkContext.accumulator(0)

    def write(df):
        reads.add(1)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and "CollectMetrics" in plan
        df.write.parquet(str(tmp_path / "dst"))
    observed.ingest_observed(spark.read.parquet(src), write, ["a"])
    assert reads.value == 1
