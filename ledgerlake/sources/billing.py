"""Billing export scans: header CSV and Parquet, one read per layout.

Files with different headers must never be read together: Spark's CSV reader
maps columns by position from the first file's header. Layouts are found by a
distributed scan for first lines, then each layout is read with its own
all-string schema and the results are unioned by name. A file without the required
header is an error, never skipped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import REQUIRED_BILLING_COLUMNS, string_schema

MALFORMED = "_malformed"
SOURCE_FILE = "_source_file"
CSV_SUFFIXES = (".csv", ".csv.gz")
BILLING_FILES = "*.{csv,csv.gz,parquet}"

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',         # "" inside a quoted cell is a literal quote
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
}


class BillingFileError(ValueError):
    """A billing file that cannot be ingested (empty, wrong format, missing columns)."""


def check_required_columns(columns: Iterable[str],
                           required: Iterable[str] = REQUIRED_BILLING_COLUMNS) -> None:
    """Dataset-level gate, evaluated on the header before any job runs."""
    missing = sorted(set(required) - set(columns))
    if missing:
        raise BillingFileError(f"Missing required billing columns: {missing}")


def _split_header(line: str) -> list[str]:
    import csv
    return next(csv.reader([line]))


def inspect_csv(spark: SparkSession, paths: list[str] | str) -> tuple[dict[tuple[str, ...], list[str]], dict[str, str]]:
    """``(layouts, rejected)`` of CSV files: distinct headers -> their files, and the
    files that cannot be read -> why (empty, or a required column is missing).

    The header is the first line of a file, whatever it holds. It is found by one
    distributed text scan: the first row of each file's first split, reduced to one row per
    distinct header before the driver sees it (file names are what Spark's own
    reader keeps there, too). Pass ``columns`` to the scans to skip this pass.
    """
    found = _headers(spark, paths).groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    layouts: dict[tuple[str, ...], list[str]] = {}
    rejected: dict[str, str] = {}
    for row in found:
        columns = tuple(_split_header(row["header"])) if row["header"].strip() else ()
        try:
            check_required_columns(columns)
            layouts.setdefault(columns, []).extend(row["files"])
        except BillingFileError as e:
            rejected.update({f: str(e) for f in row["files"]})
    seen = {_plain(f) for row in found for f in row["files"]}
    rejected.update({f: "Empty CSV file (no header found)" for f in _all_files(spark, paths) if _plain(f) not in seen})
    return layouts, rejected


def required_columns_report(spark: SparkSession, paths: list[str] | str,
                            required: Iterable[str] = REQUIRED_BILLING_COLUMNS) -> DataFrame:
    """(file, header, missing) of every CSV file below ``paths`` that holds a byte: the required columns
    that its header lacks, sorted (an empty list for an accepted file). The headers stay on Spark,
    so that a folder of any number of files can be checked."""
    needed = F.array(*[F.lit(c) for c in sorted(required)])
    cells = F.transform(F.split("header", ","), lambda c: F.btrim(c, F.lit('"')))
    return _headers(spark, paths).select("file", "header", F.array_except(needed, cells).alias("missing"))


def _headers(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(file, header): the first line of each file, by one scan of the first splits' lines."""
    lines = spark.read.text(paths)
    at_start = F.col("_metadata.file_block_start") == 0
    return (lines.select(F.col("_metadata.file_path").alias("file"), at_start.alias("start"), "value",
                         F.monotonically_increasing_id().alias("nth"))
            .where("start").groupBy("file").agg(F.min_by("value", "nth").alias("header")))


def _plain(uri: str) -> str:
    """One spelling for a file's name (``file:///a`` and ``file:/a`` are the same)."""
    scheme, _, rest = uri.rpartition(":")
    return f"{scheme}:/{unquote(rest).lstrip('/')}"


def _all_files(spark: SparkSession, paths: list[str] | str) -> list[str]:
    """Every file below ``paths``, empty ones included (they have no split): names only."""
    return list(spark.read.text(paths).inputFiles())


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Billing files below ``path`` without a byte."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", BILLING_FILES).load(path).select("path")
    filled = {_plain(r["path"]) for r in names.collect()}
    return [f for f in names.inputFiles() if _plain(f) not in filled]


def read_csv_layout(spark: SparkSession, files: list[str] | str, columns: list[str],
                    multi_line: bool = True) -> DataFrame:
    """Read header CSV files sharing one header, all cells as text.

    Malformed rows (too few or too many cells) keep their raw text in
    ``_malformed`` and have no cells; blanks become '' as in Python's csv module.
    With ``multi_line`` quoted cells may hold newlines and a file is one task; turn it
    off where the writer promises there are none, and large files split.
    """
    check_required_columns(columns)
    schema = string_schema(columns).add(MALFORMED, "string")
    df = spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", multi_line).csv(files)
    ok = F.col(MALFORMED).isNull()
    # the raw text also names a cell: Spark refuses to read the corrupt record alone
    cell = F.col(f"`{columns[0]}`")
    raw_text = F.when(~ok, F.concat(F.col(MALFORMED), F.when(F.length(cell) < 0, cell).otherwise(F.lit(""))))
    return df.select(
        *[F.when(ok, F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in columns],
        raw_text.alias(MALFORMED), F.input_file_name().alias(SOURCE_FILE))


def scan_billing_csv(spark: SparkSession, path: list[str] | str, columns: list[str] | None = None,
                     multi_line: bool = True) -> DataFrame:
    """All billing CSV files under ``path`` -> raw string rows, unioned by column name.

    Raises for every file without a header or without a required column; no file is
    skipped. Malformed rows are kept, marked in ``_malformed``.
    """
    if columns is not None:
        return read_csv_layout(spark, path, columns, multi_line)
    layouts, rejected = inspect_csv(spark, path)
    if rejected or not layouts:
        raise BillingFileError(f"Empty or invalid CSV input: {rejected or path}")
    return _union([read_csv_layout(spark, files, list(cols), multi_line) for cols, files in layouts.items()])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def split_malformed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed rows with reason ``malformed_row``)."""
    if MALFORMED not in raw.columns:
        return raw, raw.limit(0).withColumn("reject_reason", F.lit("malformed_row"))
    good = raw.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
    bad = raw.filter(F.col(MALFORMED).isNotNull()).withColumn("reject_reason", F.lit("malformed_row"))
    return good, bad


def scan_billing_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet billing export -> raw rows; the account id is read as text."""
    paths = [path] if isinstance(path, str) else path
    # files of one list may differ in columns (not in types): an absent one is null
    df = spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)
    check_required_columns(df.columns)
    acct = "lineItem/UsageAccountId"
    return df.withColumn(acct, F.col(f"`{acct}`").cast("string")).withColumn(
        SOURCE_FILE, F.input_file_name())


def file_format(key: str) -> str:
    """Suffix dispatch (case-sensitive, like ``str.endswith``); a gzipped CSV export is CSV."""
    if key.endswith(CSV_SUFFIXES):
        return "csv"
    if key.endswith(".parquet"):
        return "parquet"
    raise BillingFileError("Only CSV and Parquet billing files are supported: " + key)


def scan_by_format(spark: SparkSession, files: list[str], multi_line: bool = True) -> DataFrame:
    """Mixed CSV / Parquet files -> one raw DataFrame, columns matched by name.

    Every row of every file is in the result: malformed CSV rows are marked in
    ``_malformed`` (NULL for all others) and leave by ``split_malformed``.
    """
    by_format: dict[str, list[str]] = {}
    for f in files:
        by_format.setdefault(file_format(f), []).append(f)
    frames = []
    if "csv" in by_format:
        frames.append(scan_billing_csv(spark, by_format["csv"], multi_line=multi_line))
    if "parquet" in by_format:
        groups, rejected = parquet_layouts(spark, by_format["parquet"])
        if rejected:
            raise BillingFileError(f"Parquet files that cannot be read: {rejected}")
        frames += [scan_billing_parquet(spark, g).withColumn(MALFORMED, F.lit(None).cast("string")) for g in groups]
    if not frames:
        raise BillingFileError("No billing files given")
    return _union(frames)


def present_files(spark: SparkSession, files: list[str]) -> set[str]:
    """Those of the named files that exist: one listing of each folder they lie in."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    by_folder: dict[str, list[str]] = {}
    for f in files:
        by_folder.setdefault(f.rpartition("/")[0], []).append(f)
    found = set()
    for folder, names in by_folder.items():
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            there = {s.getPath().getName() for s in fs.listStatus(path) if s.isFile()}
            found.update(f for f in names if f.rpartition("/")[2] in there)
    return found


def _first_reason(message: str) -> str:
    """The line of an error that names its condition, else the first."""
    lines = message.splitlines()
    return next((x[x.index("["):] for x in lines if re.search(r"\[[A-Z_.]+\]", x)), lines[0])


def parquet_layouts(spark: SparkSession, files: list[str]) -> tuple[list[list[str]], dict[str, str]]:
    """(groups of Parquet files whose types one read can merge, files that cannot be read with the
    reason). Spark reads the footers of all files in one job; a list that it refuses is halved
    until the faulty files, or those of other types, stand apart."""
    groups, bad, todo = [], {}, [sorted(files)]
    while todo:
        some = todo.pop()
        try:
            columns = spark.read.option("mergeSchema", True).parquet(*some).columns
        except (PySparkException, Py4JJavaError) as e:
            if len(some) == 1:
                bad[some[0]] = _first_reason(str(e))
            else:
                todo += [some[len(some) // 2:], some[:len(some) // 2]]
            continue
        try:
            check_required_columns(columns)
            groups.append(some)
        except BillingFileError as e:  # no file of the list has the column
            bad.update(dict.fromkeys(some, str(e)))
    return groups, bad


def _without_a_column(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """Files of a group that lack a required column: those where one is null in every row are
    looked at by themselves, all others have it."""
    if len(files) < 2:
        return {}
    merged = spark.read.option("mergeSchema", True).parquet(*files)
    held = merged.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *[F.bool_or(F.col(f"`{c}`").isNotNull()).alias(f"c{i}") for i, c in enumerate(REQUIRED_BILLING_COLUMNS)])
    some = held.where(" OR ".join(f"NOT c{i}" for i in range(len(REQUIRED_BILLING_COLUMNS)))).select("file").collect()
    # names come back with their scheme, whichever way they were given: paths tell enough to look
    suspects = {unquote(urlparse(r["file"]).path) for r in some}
    bad = {}
    for f in files:
        if unquote(urlparse(f).path) in suspects:
            try:
                check_required_columns(spark.read.parquet(f).columns)
            except BillingFileError as e:
                bad[f] = str(e)
    return bad


def readable_files(spark: SparkSession, files: list[str]) -> tuple[list[str], dict[str, str]]:
    """Files that the scans accept, and the others with the reason. The number of jobs doesn't grow
    with the number of good files."""
    csv = [f for f in files if f.endswith(CSV_SUFFIXES)]
    layouts, bad = inspect_csv(spark, csv) if csv else ({}, {})
    good = [f for fs in layouts.values() for f in fs]
    parquet = [f for f in files if f.endswith(".parquet")]
    groups, unread = parquet_layouts(spark, parquet) if parquet else ([], {})
    for g in groups:
        unread.update(_without_a_column(spark, g))
        good += [f for f in g if f not in unread]
    return good, {**bad, **unread}


def convert_parquet_to_csv(spark: SparkSession, src: str, dst: str) -> str:
    """Read Parquet, write header CSV (Spark quotes cells that need it)."""
    spark.read.parquet(src).write.mode("overwrite").option("header", "true").option(
        "escape", '"').csv(dst)
    return dst
