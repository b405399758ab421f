"""Enrichment: business-unit lookup, correlation tags, lineage, joins on the tag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import correlation_id, data_version, lineage_struct
from ledgerlake.operators.joins import MAX_BROADCAST_ROWS, lookup_side
from ledgerlake.params import DEFAULT_CONTEXT, RunContext
from ledgerlake.schemas import STAMPED_VERSION, UNALLOCATED


def map_cost_category(df: DataFrame, account_map: DataFrame, *, key: str = "account_id",
                      map_key: str = "account_id", map_value: str = "cost_category",
                      out: str = "cost_category",
                      max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left lookup of account id -> business unit, ``'unallocated'`` when unmapped.

    ``account_map`` must hold one row per account id (the map sources in
    ``sources.account_map`` guarantee it). It is broadcast only after a bounded
    row count proves it small; a larger map runs as a sort-merge join where
    AQE splits a hot account's partition.
    """
    m = account_map.select(F.col(map_key).alias("_map_key"), F.col(map_value).alias("_map_value"))
    right = lookup_side(m, max_broadcast_rows)
    joined = df.join(right, df[key] == right["_map_key"], "left")
    return (joined.withColumn(out, F.coalesce(F.col("_map_value"), F.lit(UNALLOCATED)))
            .drop("_map_key", "_map_value"))


def tag_records(df: DataFrame, ctx: RunContext = DEFAULT_CONTEXT,
                stamp_version: bool = False) -> DataFrame:
    """Correlation key, freshness, data version and lineage in one projection.

    The correlation key hashes ``account_id`` (else ``AccountId``); a NULL id
    hashes the text ``None``; without either column no key is added. CRM
    extracts also get ``schema_version = 'v1'``.
    """
    cols = {}
    if "account_id" in df.columns:
        cols["obs_correlation_id"] = correlation_id(F.col("account_id"))
    elif "AccountId" in df.columns:
        cols["obs_correlation_id"] = correlation_id(F.col("AccountId"))
    cols["obs_ingest_timestamp"] = F.lit(ctx.ingest_iso)
    cols["obs_data_version"] = data_version(F.col("timestamp"), F.col("source"))
    cols["obs_lineage"] = lineage_struct(ctx)
    if stamp_version:
        cols["schema_version"] = F.lit(STAMPED_VERSION)
    return df.withColumns(cols)


def join_on_correlation(left: DataFrame, right: DataFrame, how: str = "inner",
                        left_prefix: str = "", right_prefix: str = "") -> DataFrame:
    """Join two tagged families on ``obs_correlation_id``.

    Put the many-side (e.g. opportunities) on the left: for an outer join AQE
    can split a hot key only on the streamed (left) side.
    """
    def prefixed(df, p):
        if not p:
            return df
        return df.select([F.col(c).alias(c if c == "obs_correlation_id" else p + c) for c in df.columns])

    return prefixed(left, left_prefix).join(prefixed(right, right_prefix), "obs_correlation_id", how)


def join_on_crosswalk(left: DataFrame, right: DataFrame, crosswalk: DataFrame, how: str = "inner",
                      left_id: str = "account_id", crm_id: str = "crm_account_id") -> DataFrame:
    """Join families whose ids come from different systems (billing accounts and CRM
    accounts) through a crosswalk ``(account_id, crm_account_id)``: the left rows
    take the CRM account's correlation key, then join on it. Without an
    entry a left row matches nothing. The crosswalk has one row per pair and is only
    broadcast behind the size check; AQE splits a hot account on the left side."""
    pairs = crosswalk.select(F.col(left_id).alias("_left_id"), correlation_id(F.col(crm_id)).alias("_key"))
    side = lookup_side(pairs)
    keyed = (left.drop("obs_correlation_id").join(side, left[left_id] == side["_left_id"],
                                                  "left" if how != "inner" else "inner")
             .drop("_left_id").withColumnRenamed("_key", "obs_correlation_id"))
    return join_on_correlation(keyed, right, how)


def flatten_lineage(df: DataFrame, column: str = "obs_lineage") -> DataFrame:
    """Lineage struct -> three flat columns (for flat sinks and comparisons)."""
    return df.select(
        *[c for c in df.columns if c != column],
        F.col(f"{column}.environment").alias("lineage_environment"),
        F.col(f"{column}.ingest_pipeline_version").alias("lineage_pipeline_version"),
        F.col(f"{column}.data_owner").alias("lineage_data_owner"),
    )
