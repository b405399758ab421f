"""Documents whose shape is only in the data: JSON text and VARIANT values.

Masking and lookup by path work on any nesting, row by row, without a schema or a shuffle.
A VARIANT can only be taken apart one level at a time (object -> map of variants, array ->
list of variants), so masking is an expression of as many levels as the deepest document
has; ``json_depth`` measures that with one aggregate. Both container kinds become one list
of (key, value), which a lambda binds to a name, so a level holds the next once and the
expression grows with the depth, not with its power. The analyzer resolves some 20 such
levels within its iterations: documents deeper than ``LEVELS``, if there are any, are masked
by a small Python helper instead, all others stay in the JVM.

Edges: text that is not JSON (or repeats a key inside an object) gives NULL, so nothing
unmasked leaks; ``mask_json_columns`` marks such rows. Null text stays null. Objects come
back with their keys sorted, numbers as JSON writes their value.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.mask import MASK, SENSITIVE
from ledgerlake.session import share_package

_OBJECT, _LIST = "map<string,variant>", "array<variant>"
BAD_JSON = "_bad_json"
LEVELS = 16


def json_depth(text: Column) -> Column:
    """Greatest nesting of objects and lists in a JSON text (0 for a scalar)."""
    bare = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', "")
    marks = F.split(F.regexp_replace(F.translate(F.regexp_replace(bare, r"[^\[\]{}]", ""), "[]", "{}"), "", ""), "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, mark: Column) -> Column:
        now = acc["now"] + F.when(mark == "{", 1).when(mark == "}", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))
    return F.aggregate(marks, zero, step, lambda acc: acc["most"])


def truthy(v: Column) -> Column:
    """Whether a variant is a non-empty text or container, a number other than zero, or true."""
    text = F.to_json(v)
    number = text.rlike(r"^-?[0-9]") & (F.try_variant_get(v, "$", "double") == 0)
    return ~(F.is_variant_null(v) | text.isin("false", '""', "[]", "{}") | F.coalesce(number, F.lit(False)))


def _sensitive(key: Column) -> Column:
    low = F.lower(key)
    hit = F.lit(False)
    for word in SENSITIVE:
        hit = hit | low.contains(word)
    return F.coalesce(hit, F.lit(False))


def _as(v: Column, kind: str) -> Column:
    return v.try_cast(kind)


def masked_variant(v: Column, depth: int) -> Column:
    """``v`` with the values of sensitive keys replaced, down to ``depth`` levels."""
    if depth <= 0:
        return v
    fields, items = _as(v, _OBJECT), _as(v, _LIST)
    no_key = F.lit(None).cast("string")
    entries = F.coalesce(F.map_entries(fields), F.transform(items, lambda x: F.struct(no_key.alias("key"), x.alias("value"))))
    hidden = F.lit(MASK).cast("variant")
    nothing = F.parse_json(F.lit("null"))

    def one(e: Column) -> Column:
        key, value = e["key"], e["value"]
        shown = F.when(_sensitive(key), F.when(truthy(value), hidden).otherwise(nothing)).otherwise(masked_variant(value, depth - 1))
        return F.struct(key.alias("key"), shown.alias("value"))

    def rebuilt(done: Column) -> Column:
        return (F.when(fields.isNotNull(), F.to_variant_object(F.map_from_entries(done)))
                .when(items.isNotNull(), F.to_variant_object(F.transform(done, lambda e: e["value"]))).otherwise(v))

    # a list of one binds the next level to a name, so that it stands in the expression once
    return F.transform(F.array(F.transform(entries, one)), rebuilt)[0]


def deepest(df: DataFrame, columns: Sequence[str]) -> int:
    """Greatest nesting in the JSON text columns: one aggregate over the table."""
    worst = df.agg(*[F.max(json_depth(F.col(f"`{c}`"))) for c in columns]).first()
    return max([d for d in worst if d is not None], default=0)


def mask_text(text: str | None) -> str | None:
    """``masked_variant`` of one JSON text of any depth, without recursion in Python."""
    def once(pairs):
        out = dict(pairs)
        if len(out) < len(pairs):
            raise ValueError("repeated key")
        return dict(sorted(out.items()))

    try:
        root = [json.loads(text, object_pairs_hook=once)] if text is not None else [None]
    except (ValueError, RecursionError):
        return None
    todo = [root]
    while todo:
        box = todo.pop()
        for k, v in list(box.items()) if isinstance(box, dict) else enumerate(box):
            if isinstance(k, str) and any(word in k.lower() for word in SENSITIVE):
                box[k] = MASK if v else None
            elif isinstance(v, (dict, list)):
                todo.append(v)
    return None if text is None else json.dumps(root[0], separators=(",", ":"), ensure_ascii=False)


def _mask_deep(text: Column) -> Column:
    @F.udf("string", useArrow=True)
    def deep(t):
        return mask_text(t)
    return deep(text)


def mask_json_columns(df: DataFrame, columns: Sequence[str], depth: int | None = None) -> DataFrame:
    """Mask the sensitive fields of JSON text columns at any depth. ``depth`` (of the deepest
    document) is measured unless it is given; rows deeper than a given one raise.
    ``_bad_json`` tells rows in which a text was not JSON."""
    known = deepest(df, columns) if depth is None else depth
    if known > LEVELS:
        share_package(df.sparkSession)
    out, bad = {}, F.lit(False)
    for c in columns:
        text = F.col(f"`{c}`")
        value, nested = F.try_parse_json(text), json_depth(text)
        beyond = F.raise_error(F.lit(f"a document in {c} is nested deeper than {known} levels"))
        if known > LEVELS:
            beyond = F.when(nested > known, beyond).otherwise(_mask_deep(F.when(nested > LEVELS, text)))
        shown = F.when(nested <= min(known, LEVELS), F.to_json(masked_variant(value, min(known, LEVELS))))
        out[c] = F.when(text.isNotNull(), shown.when(value.isNotNull(), beyond))
        bad = bad | (text.isNotNull() & value.isNull())
    # flags first: they read the texts before these are replaced
    return df.withColumn(BAD_JSON, bad).withColumns(out)


def lookup(v: Column, path: Column, default: Column) -> Column:
    """The value at a dotted path (``a.b``) of a variant, ``default`` (a variant) where any part
    is absent. The path is a column: each row may ask for another. Only objects are
    entered; a present JSON null is a value and is returned."""
    parts = F.split(path, r"\.")
    absent = F.struct(F.lit(False).alias("found"), F.lit(None).cast("variant").alias("at"))
    start = F.struct(v.isNotNull().alias("found"), v.alias("at"))

    def enter(acc: Column, key: Column) -> Column:
        fields = _as(acc["at"], _OBJECT)
        here = F.coalesce(acc["found"] & F.map_contains_key(fields, key), F.lit(False))
        return F.when(here, F.struct(F.lit(True).alias("found"), F.element_at(fields, key).alias("at"))).otherwise(absent)

    return F.aggregate(parts, start, enter, lambda acc: F.when(acc["found"], acc["at"]).otherwise(default))


def lookup_json(text: Column, path: Column, default: str = "null") -> Column:
    """``lookup`` in a JSON text, as JSON text; ``default`` is JSON too."""
    return F.to_json(lookup(F.try_parse_json(text), path, F.parse_json(F.lit(default))))
