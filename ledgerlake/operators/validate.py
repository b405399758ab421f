"""Validation against the versioned registry, compiled into one projection.

Every rule of the dispatcher becomes a Column: ``reject_reason`` is the first
failing check in the reference's order (NULL when the record passes) and
``warnings`` lists the non-fatal findings. No row is dropped here: the split
into valid and quarantined rows is a filter on ``reject_reason`` so that
``valid + quarantined == input`` always holds.

Key presence matters (a missing key fails, a NULL value may pass). For typed
DataFrames presence is a property of the schema; for raw JSON records (a
``map<string,string>`` column) it is tested per row with ``map_contains_key``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import as_float, fill_schema_version, python_float
from ledgerlake.operators.project import PARSE_FAILED
from ledgerlake.schemas import ARR, BILLING, OPPORTUNITY, REGISTRY, latest_version

REASON = "reject_reason"
WARNINGS = "warnings"
_VERSION, _HAS_SCHEMA = "_v_version", "_v_has_schema"  # staged helper columns
# Every warning the dispatcher can emit (each at most once per record).
WARNING_KINDS = ("account_id_format", "opportunity_id_format", "negative_cost", "unknown_data_type",
                 "unparsable_amount")

# Identifier formats (warnings only). Anchored with \A..\z so a trailing
# newline does not pass (Python's `$` would accept it).
CRM_ID = r"\A[a-zA-Z0-9]{15,18}\z"
CLOUD_ACCOUNT_ID = r"\A[0-9]{12}\z"


class TypedFields:
    """Field access for a typed DataFrame: a field is present iff the column exists."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.names = frozenset(df.columns)

    def present(self, name: str) -> Column:
        return F.lit(name in self.names)

    def value(self, name: str) -> Column:
        return F.col(name) if name in self.names else F.lit(None).cast("string")

    def number(self, name: str) -> Column:
        if name not in self.names:
            return F.lit(None).cast("double")
        return as_float(F.col(name), self.df.schema[name].dataType)


class MapFields:
    """Field access for raw JSON records held as ``map<string,string>``. Every field that a rule may
    ask for is looked up once per row, by ``staged``; the rules read those columns."""

    NAMES = tuple(sorted({"schema_version", "amount", "cost", "account_id", "opportunity_id", "account_name", "arr"}.union(
        *[e["required_fields"] for versions in REGISTRY.values() for e in versions.values()])))

    NUMBERS = ("amount", "arr", "cost")

    def __init__(self, column: str):
        self.m = F.col(column)

    def staged(self, df: DataFrame) -> DataFrame:
        # one lookup expression over the names, not one for each: all rules end up in one generated
        # method, which Java only interprets if it is long
        def each(names, fn):
            return F.transform(F.array(*[F.lit(n) for n in names]), fn)

        looked_up = df.withColumns({
            "_v_fields": each(self.NAMES, lambda n: F.try_element_at(self.m, n)),
            "_v_keys": each(self.NAMES, lambda n: F.coalesce(F.map_contains_key(self.m, n), F.lit(False))),
            "_v_nums": F.transform(each(self.NUMBERS, lambda n: F.try_element_at(self.m, n)), python_float)})
        return looked_up.withColumns({
            **{f"_v_field_{n}": F.get("_v_fields", i) for i, n in enumerate(self.NAMES)},
            **{f"_v_has_{n}": F.get("_v_keys", i) for i, n in enumerate(self.NAMES)},
            **{f"_v_num_{n}": F.get("_v_nums", i) for i, n in enumerate(self.NUMBERS)}})

    def dropped(self, df: DataFrame) -> DataFrame:
        return df.drop("_v_fields", "_v_keys", "_v_nums", *[f"_v_{k}_{n}" for n in self.NAMES for k in ("field", "has", "num")])

    def present(self, name: str) -> Column:
        return F.col(f"_v_has_{name}")

    def value(self, name: str) -> Column:
        return F.col(f"_v_field_{name}")

    def number(self, name: str) -> Column:
        return F.col(f"_v_num_{name}")


def _first(*checks: Column) -> Column:
    return F.coalesce(*checks) if len(checks) > 1 else checks[0]


def _missing(f, name: str) -> Column:
    return F.when(~f.present(name), F.lit(f"missing:{name}"))


def _resolved_version(f) -> tuple[Column, Column]:
    """(version used for lookup, whether a registered schema applies)."""
    dt = f.value("data_type")
    given = F.when(f.present("schema_version"), f.value("schema_version"))
    latest = F.lit(None).cast("string")
    for name in REGISTRY:
        latest = F.when(dt == name, F.lit(latest_version(name))).otherwise(latest)
    version = F.coalesce(fill_schema_version(given, latest), F.lit("v1"))
    has_schema = F.lit(False)
    for name, versions in REGISTRY.items():
        for v in versions:
            has_schema = has_schema | (F.coalesce(dt == name, F.lit(False)) & (version == v))
    return version, has_schema


def _registry_check(f, version: Column, has_schema: Column) -> Column:
    dt = f.value("data_type")
    schema_checks = F.lit(None).cast("string")
    for name, versions in REGISTRY.items():
        for v, entry in versions.items():
            first_missing = _first(*[_missing(f, r) for r in entry["required_fields"]])
            schema_checks = F.when((dt == name) & (version == v), first_missing).otherwise(schema_checks)
    basic = _first(_missing(f, "timestamp"), _missing(f, "source"))
    return F.when(has_schema, schema_checks).otherwise(basic)


def _type_check(f) -> Column:
    dt = f.value("data_type")
    arr = f.number("arr")
    arr_rule = _first(
        _missing(f, "account_id"), _missing(f, "account_name"), _missing(f, "arr"),
        F.when(arr.isNull(), F.lit("arr_not_number")),
        F.when(arr < 0, F.lit("arr_negative")),
        F.when(f.value("account_id").isNull(), F.lit("account_id_null")),
    )
    amount_given = f.present("amount") & f.value("amount").isNotNull()
    amount = f.number("amount")
    opp_rule = _first(
        _missing(f, "opportunity_id"), _missing(f, "account_id"),
        F.when(amount_given & amount.isNull(), F.lit("amount_not_number")),
        F.when(amount_given & (amount < 0), F.lit("amount_negative")),
        F.when(f.value("opportunity_id").isNull(), F.lit("opportunity_id_null")),
        F.when(f.value("account_id").isNull(), F.lit("account_id_null")),
    )
    cost_rule = _first(
        _missing(f, "account_id"), _missing(f, "cost"),
        F.when(f.number("cost").isNull(), F.lit("cost_not_number")),
        F.when(f.value("account_id").isNull(), F.lit("account_id_null")),
    )
    return (F.when(dt == ARR, arr_rule).when(dt == OPPORTUNITY, opp_rule)
            .when(dt == BILLING, cost_rule))


def _warnings(f, extra: list[Column]) -> Column:
    dt = f.value("data_type")
    acct = f.value("account_id")
    known = F.lit(False)
    for name in REGISTRY:
        known = known | F.coalesce(dt == name, F.lit(False))
    items = [
        F.when((dt == ARR) & ~acct.rlike(CRM_ID), F.lit("account_id_format")),
        F.when((dt == OPPORTUNITY) & ~f.value("opportunity_id").rlike(CRM_ID),
               F.lit("opportunity_id_format")),
        F.when((dt == OPPORTUNITY) & ~acct.rlike(CRM_ID), F.lit("account_id_format")),
        F.when((dt == BILLING) & (f.number("cost") < 0), F.lit("negative_cost")),
        F.when((dt == BILLING) & ~acct.rlike(CLOUD_ACCOUNT_ID), F.lit("account_id_format")),
        F.when(~known, F.lit("unknown_data_type")),
        *extra,
    ]
    return F.array_compact(F.array(*items))


def validation_columns(f, extra_warnings: list[Column] | None = None,
                       version: Column | None = None, has_schema: Column | None = None) -> dict[str, Column]:
    """Columns computed by the dispatcher: reason, warnings, resolved version.

    ``version`` / ``has_schema`` may be passed as precomputed columns."""
    if version is None or has_schema is None:
        version, has_schema = _resolved_version(f)
    reason = _first(
        F.when(~f.present("data_type"), F.lit("missing:data_type")),
        _registry_check(f, version, has_schema),
        _type_check(f),
    )
    warnings = F.when(reason.isNull(), _warnings(f, extra_warnings or [])).otherwise(
        F.array().cast("array<string>"))
    filled = F.when(f.present("schema_version"), f.value("schema_version")).otherwise(
        F.when(has_schema, version))
    return {REASON: reason, WARNINGS: warnings, "schema_version": filled}


def validate_records(df: DataFrame) -> DataFrame:
    """Typed records -> same rows plus ``reject_reason`` and ``warnings``.

    Side effects of the reference kept as column rewrites: ``schema_version``
    is filled when absent, and an opportunity's NULL ``amount`` becomes 0.0.
    """
    f = TypedFields(df)
    extra = []
    if PARSE_FAILED in df.columns:
        extra.append(F.when(F.col(PARSE_FAILED), F.lit("unparsable_amount")))
    version, has_schema = _resolved_version(f)
    staged = df.withColumns({_VERSION: version, _HAS_SCHEMA: has_schema})
    cols = validation_columns(f, extra, F.col(_VERSION), F.col(_HAS_SCHEMA))
    if "amount" in df.columns and "data_type" in df.columns:
        cols["amount"] = F.when(
            (F.col("data_type") == OPPORTUNITY) & F.col(REASON).isNull(),
            F.coalesce(f.number("amount"), F.lit(0.0))).otherwise(F.col("amount").cast("double"))
        amount = cols.pop("amount")
        out = staged.withColumns(cols).withColumn("amount", amount)
    else:
        out = staged.withColumns(cols)
    out = out.drop(_VERSION, _HAS_SCHEMA)
    return out.drop(PARSE_FAILED) if PARSE_FAILED in df.columns else out


def validate_raw_records(df: DataFrame, column: str = "record") -> DataFrame:
    """Raw JSON records (``map<string,string>``) -> reason, warnings, filled version.

    The resolved version and the schema flag, read by every registry branch,
    are computed once per row in their own projection.
    """
    f = MapFields(column)
    version, has_schema = _resolved_version(f)
    staged = f.staged(df).withColumns({_VERSION: version, _HAS_SCHEMA: has_schema})
    out = staged.withColumns(validation_columns(f, None, F.col(_VERSION), F.col(_HAS_SCHEMA)))
    return f.dropped(out.drop(_VERSION, _HAS_SCHEMA))


def validate_scanned_records(df: DataFrame, column: str = "record") -> DataFrame:
    """``validate_raw_records`` of the rows of ``scan_batch_envelopes``, those of messages that failed
    included: they keep their ``reject_reason``, without warnings or a version. One pass: splitting
    the rows by a reason that comes from parsing would parse every message anew for each part."""
    failed = F.col("_v_failed")
    checked = validate_raw_records(df.withColumnRenamed(REASON, "_v_failed"), column)
    return checked.withColumns({
        REASON: F.coalesce(failed, F.col(REASON)),
        WARNINGS: F.when(failed.isNull(), F.col(WARNINGS)).otherwise(F.array().cast("array<string>")),
        "schema_version": F.when(failed.isNull(), F.col("schema_version"))}).drop("_v_failed")


def split_valid_quarantine(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their reason). Nothing is dropped silently."""
    valid = validated.filter(F.col(REASON).isNull()).drop(REASON)
    quarantine = validated.filter(F.col(REASON).isNotNull())
    return valid, quarantine


# Row-level flags, exposed for reports (the same rules the dispatcher applies).
def flag_crm_id_format(c: Column) -> Column:
    return ~F.coalesce(c.rlike(CRM_ID), F.lit(False))


def flag_account_id_format(c: Column) -> Column:
    return ~F.coalesce(c.rlike(CLOUD_ACCOUNT_ID), F.lit(False))


def flag_negative_cost(c: Column) -> Column:
    return F.coalesce(c < 0, F.lit(False))


def check_arr(arr: Column) -> Column:
    return F.when(arr.isNull(), F.lit("arr_not_number")).when(arr < 0, F.lit("arr_negative"))


def check_amount(amount_text: Column, present: Column | None = None) -> Column:
    v = python_float(amount_text)
    given = amount_text.isNotNull() if present is None else (present & amount_text.isNotNull())
    return (F.when(given & v.isNull(), F.lit("amount_not_number"))
            .when(given & (v < 0), F.lit("amount_negative")))


def normalize_amount(amount_text: Column) -> Column:
    return F.coalesce(python_float(amount_text), F.lit(0.0))


def check_cost(cost_text: Column) -> Column:
    return F.when(python_float(cost_text).isNull(), F.lit("cost_not_number"))
