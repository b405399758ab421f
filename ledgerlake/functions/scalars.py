"""Scalar Column functions (all JVM built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.params import RunContext


def col_or_lit(df: DataFrame, name: str, default=None, dtype: str = "string") -> Column:
    """``record.get(name, default)``: the column when the layout has it, else the literal.

    An existing blank cell stays blank; only an absent column takes the default.
    """
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(default).cast(dtype)


def python_float(c: Column) -> Column:
    """Parse text the way Python's ``float(str)`` does; NULL where Python raises.

    Differences to Spark's cast that are closed here: Java accepts a trailing
    type suffix (``1.0d``/``2f``) and hex literals, Python does not; Python
    accepts single underscores between digits (``1_000``), Java does not.
    Fast path: a plain cast, with the regular expressions evaluated only for
    text that ends in d/f or holds an x (suspect) or an underscore.
    """
    s = c.cast("string")
    t = F.btrim(s, F.lit(" \t\n\r\x0b\x0c"))
    plain = s.try_cast("double")
    last = F.upper(F.substring(t, -1, 1))
    suspect = last.isin("D", "F") | F.lower(t).contains("x")
    java_only = s.rlike(r"[0-9.][dDfF]\s*$") | s.rlike(r"^\s*[+-]?0[xX]")
    underscored = F.regexp_replace(s, r"(?<=[0-9])_(?=[0-9])", "").try_cast("double")
    nothing = F.lit(None).cast("double")
    return (F.when(plain.isNotNull() & ~suspect, plain)
            .when(suspect, F.when(java_only, nothing).otherwise(plain))
            .when(s.contains("_"), underscored)
            .otherwise(nothing))


def as_float(c: Column, dtype: T.DataType) -> Column:
    """``float(value)`` for a column of any type (NULL where Python raises)."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return python_float(c)


def paired_float(df: DataFrame, cost_name: str, usage_name: str):
    """Cost and usage parsed in one try: if either fails both become 0.0.

    Returns ``(cost, usage, parse_failed)``. An absent column parses as the
    default 0 (which succeeds); a blank or NULL cell fails.
    """
    def one(name):
        if name not in df.columns:
            return F.lit(0.0)
        return as_float(F.col(f"`{name}`"), df.schema[name].dataType)

    cost, usage = one(cost_name), one(usage_name)
    ok = cost.isNotNull() & usage.isNotNull()
    zero = F.lit(0.0)
    return (F.when(ok, cost).otherwise(zero), F.when(ok, usage).otherwise(zero), ~ok)


def py_str(c: Column) -> Column:
    """``str(value)`` for hashing: NULL renders as the text ``None``."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def correlation_id(*components: Column) -> Column:
    """sha256 hex of ``"-".join(str(c) for c in components)``."""
    return F.sha2(F.concat_ws("-", *[py_str(c) for c in components]), 256)


def data_version(timestamp: Column, source: Column) -> Column:
    """md5 hex of ``f"{timestamp}-{source}"`` (a time hash, not a content hash)."""
    return F.md5(F.concat(py_str(timestamp), F.lit("-"), py_str(source)))


def iso_timestamp(ts: Column) -> Column:
    """Python ``datetime.isoformat()`` text: the fraction appears only if micros != 0."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(ts.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(micros == "000000", base).otherwise(F.concat(base, F.lit("."), micros)))


def lineage_struct(ctx: RunContext) -> Column:
    return F.struct(
        F.lit(ctx.environment).alias("environment"),
        F.lit(ctx.pipeline_version).alias("ingest_pipeline_version"),
        F.lit(ctx.data_owner).alias("data_owner"),
    )


def fill_schema_version(version: Column, latest: Column) -> Column:
    """Falsy (NULL or empty) version -> latest registered version."""
    return F.coalesce(F.nullif(version, F.lit("")), latest)


def date_parts(d: Column) -> dict[str, Column]:
    """``strftime`` parts used for landing paths and keys."""
    return {
        "year": F.date_format(d, "yyyy"),
        "month": F.date_format(d, "MM"),
        "day": F.date_format(d, "dd"),
        "date": F.date_format(d, "yyyy-MM-dd"),
        "compact": F.date_format(d, "yyyyMMdd"),
        "stamp": F.date_format(d, "yyyyMMddHHmmss"),
    }


def money(c: Column) -> Column:
    """Exact decimal value for order-independent sums, to 12 places: sub-cent costs
    keep their value. NULL for NaN and for amounts of 1e16 or more."""
    return c.try_cast("decimal(28,12)")
