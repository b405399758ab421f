"""CRM extracts: projected, filtered, keyset-paged scans of landed tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import lookup_side

ACCOUNT_FIELDS = ("Id", "Name", "Industry", "Type", "Arr")
OPPORTUNITY_FIELDS = ("Id", "Name", "AccountId", "Amount", "StageName", "CloseDate", "Type",
                      "Probability", "IsClosed", "IsWon")
RECENT_DAYS = 180


def filter_customer_accounts(accounts: DataFrame) -> DataFrame:
    """``Type = 'Customer'`` (pushed into the Parquet scan when Type is a stored column)."""
    return accounts.filter(F.col("Type") == "Customer")


def filter_recent_opportunities(opps: DataFrame, as_of: _dt.date, days: int = RECENT_DAYS) -> DataFrame:
    """``CloseDate >= as_of - days`` (no upper bound), like ``LAST_N_DAYS:n``."""
    return opps.filter(F.col("CloseDate") >= F.date_sub(F.lit(as_of), days))


def filter_after_key(df: DataFrame, last_id: str | None, key: str = "Id") -> DataFrame:
    """Keyset continuation ``key > last_id``; no filter on the first page."""
    return df if last_id is None else df.filter(F.col(key) > F.lit(last_id))


def scan_accounts(src: DataFrame) -> DataFrame:
    """``SELECT Id, Name, Industry, Type[, Arr] FROM Account WHERE Type = 'Customer'``."""
    return filter_customer_accounts(src.select([c for c in ACCOUNT_FIELDS if c in src.columns]))


def scan_opportunities(src: DataFrame, as_of: _dt.date, days: int = RECENT_DAYS) -> DataFrame:
    """Opportunities closing within the last ``days`` days of ``as_of``."""
    return filter_recent_opportunities(
        src.select([c for c in OPPORTUNITY_FIELDS if c in src.columns]), as_of, days)


def scan_opportunities_for_runs(src: DataFrame, runs: DataFrame, days: int = RECENT_DAYS,
                                bucket_days: int = 30) -> DataFrame:
    """``scan_opportunities`` for every ``as_of`` of ``runs`` in one job: its rows with their
    ``as_of``. Repeated run dates count once, null ones and null close dates match nothing.

    An interval join: a run asks for all days from ``as_of - days`` to the last day there is. It takes part
    once in every bucket of ``bucket_days`` in that interval, an opportunity in the one of its day, and
    equal buckets meet; only the first bucket of a run holds days before its interval, which a
    comparison then removes. The runs' side (runs x buckets) is looked up behind the size check."""
    rows = src.select([c for c in OPPORTUNITY_FIELDS if c in src.columns]).where("CloseDate IS NOT NULL")
    bucket = F.floor(F.unix_date("CloseDate") / bucket_days)
    last = rows.agg(F.max(bucket)).first()[0]
    if last is None:
        return rows.withColumn("as_of", F.lit(None).cast("date")).limit(0)
    asked = runs.select(F.col("as_of").cast("date").alias("as_of")).where("as_of IS NOT NULL").distinct() \
        .withColumn("_from", F.date_sub("as_of", days))
    first = F.floor(F.unix_date("_from") / bucket_days)
    asked = asked.where(first <= last).withColumn("_bucket", F.explode(F.sequence(first, F.lit(last))))
    side = lookup_side(asked)
    return (rows.withColumn("_bucket", bucket).join(side, "_bucket").where("CloseDate >= _from").drop("_bucket", "_from"))


def sort_by_id(df: DataFrame, key: str = "Id") -> DataFrame:
    return df.orderBy(F.col(key))


def keyset_page(df: DataFrame, page_size: int, last_id: str | None = None, key: str = "Id") -> DataFrame:
    """``WHERE key > last_id ORDER BY key LIMIT page_size`` (plans as TakeOrderedAndProject)."""
    return filter_after_key(df, last_id, key).orderBy(F.col(key)).limit(page_size)


def last_key(page: DataFrame, key: str = "Id") -> str | None:
    """The continuation key of a page (one value to the driver)."""
    row = page.agg(F.max(key).alias("k")).first()
    return row["k"] if row else None
