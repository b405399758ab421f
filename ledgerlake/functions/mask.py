"""Mask values whose field name marks them sensitive, at any nesting depth.

The rule: a field whose lower-cased name contains a sensitive word is replaced
by ``'********'`` when its value is truthy (non-empty text or container,
non-zero number, true) and by NULL otherwise; a matching container is replaced
whole. Other structs, arrays and maps are descended. The walk is compiled from
the schema into ``withField`` / ``transform`` / ``transform_values``
expressions, so masking is one projection. A map's keys are data, so any value may turn
out sensitive: maps come back as maps of text (nested values as masked JSON).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES: sensitive name fragments and the mask text.
SENSITIVE = ("password", "token", "security_token", "secret")
MASK = "********"


def is_sensitive(name: str) -> bool:
    low = name.lower()
    return any(s in low for s in SENSITIVE)


def _truthy(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        t = c != ""
    elif isinstance(dtype, T.BooleanType):
        t = c
    elif isinstance(dtype, T.NumericType):
        t = c != 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        t = F.size(c) > 0
    elif isinstance(dtype, T.StructType):
        t = c.isNotNull() & F.lit(len(dtype.fields) > 0)
    else:
        t = c.isNotNull()
    return F.coalesce(t, F.lit(False))


def masked(c: Column, dtype: T.DataType) -> Column:
    return F.when(_truthy(c, dtype), F.lit(MASK)).otherwise(F.lit(None).cast("string"))


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def _exact(name: str) -> str:
    """A field's name as ``withField`` takes it: dots are part of it, not a path."""
    return "`" + name.replace("`", "``") + "`"


def _walk(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        out = c
        for f in dtype.fields:
            if is_sensitive(f.name):
                out = out.withField(_exact(f.name), masked(c.getField(f.name), f.dataType))
            elif _nested(f.dataType):
                out = out.withField(_exact(f.name), _walk(c.getField(f.name), f.dataType))
        return out
    if isinstance(dtype, T.ArrayType) and _nested(dtype.elementType):
        return F.transform(c, lambda x: _walk(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        vt = dtype.valueType
        hit = lambda k: F.lower(k.cast("string")).rlike("|".join(SENSITIVE))
        if isinstance(vt, T.StringType):
            plain = lambda v: v
        elif _nested(vt):
            plain = lambda v: F.to_json(_walk(v, vt))
        else:
            plain = lambda v: v.cast("string")
        # one value type must hold masks and values: a map of text
        return F.transform_values(c, lambda k, v: F.when(hit(k), masked(v, vt)).otherwise(plain(v)))
    return c


def mask_sensitive_fields(df: DataFrame) -> DataFrame:
    """Mask sensitive fields of every column (top level and nested)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(_exact(f.name))
        if is_sensitive(f.name):
            cols.append(masked(c, f.dataType).alias(f.name))
        elif _nested(f.dataType):
            cols.append(_walk(c, f.dataType).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)
