"""Account id -> business unit maps from their three possible sources.

Every source yields a two-column DataFrame ``(account_id, cost_category)``
with one row per account id, ready for ``map_cost_category``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import DEFAULT_ACCOUNT_MAP


def account_map_default(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DEFAULT_ACCOUNT_MAP), "account_id string, cost_category string")


def scan_account_map_json(df: DataFrame, column: str = "value") -> DataFrame:
    """A JSON object text ``{"<account>": "<unit>", ...}`` per row -> map rows.

    Unparsable text yields no rows (the caller then falls back to the default).
    """
    parsed = df.select(F.from_json(F.col(column), "map<string,string>").alias("m"))
    return parsed.select(F.explode("m").alias("account_id", "cost_category"))


def scan_account_map_items(items: DataFrame, order: str = "seq") -> DataFrame:
    """Key-value items ``{account_id, business_unit}`` -> map; incomplete items are
    skipped and the last item (highest ``order``) wins for a repeated account."""
    complete = items.filter(F.col("account_id").isNotNull() & F.col("business_unit").isNotNull())
    return complete.groupBy("account_id").agg(
        F.max_by("business_unit", order).alias("cost_category"))


def account_map_or_default(spark: SparkSession, mapping: DataFrame | None) -> DataFrame:
    """An empty or absent map falls back to the fixed three-entry default."""
    if mapping is None or mapping.limit(1).count() == 0:
        return account_map_default(spark)
    return mapping
