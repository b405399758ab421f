"""Validation by a registry that is data: versions and rules are rows of two tables.

``validate.validate_records`` compiles the registry of this package into the plan. Here the
plan is the same whatever the registry holds: its rows are gathered to one row per data
type (versions as a map to their required fields, rules as a list in order), looked up
once per record behind the size check, and applied to the record's key-value map:

* the version is the record's own, else the type's latest (the text maximum);
* of a registered version's required fields the first that the record lacks fails it
  (``array_except(required, map_keys(record))``); other records need a timestamp and a source;
* the type's rules follow in order; the first that fails gives the reason, failed warnings are all listed.

A new version, family or rule needs a row, no code. No row of the input is dropped.

Edges: a rule row with an unknown check raises; of several registry rows for one (type,
version) the greatest list of required fields stands; null and absent values are told apart by
the record's keys; an empty registry leaves the basic check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import fill_schema_version, python_float
from ledgerlake.operators.joins import lookup_side
from ledgerlake.operators.project import PARSE_FAILED
from ledgerlake.operators.validate import CLOUD_ACCOUNT_ID, CRM_ID, REASON, WARNINGS
from ledgerlake.schemas import ARR, BILLING, OPPORTUNITY, REGISTRY

VERSIONS = "data_type string, version string, required_fields array<string>, optional_fields array<string>"
RULES = "data_type string, position int, field string, check string, argument string, reason string, level string"
CHECKS = ("present", "not_null", "number", "number_if_given", "not_negative", "matches")
REJECT, WARN = "reject", "warn"
BASIC = ("timestamp", "source")
_ENTRY = "_registry_entry"


def registry_versions(spark: SparkSession) -> DataFrame:
    """The package's registry as a table."""
    return spark.createDataFrame([(t, v, e["required_fields"], e["optional_fields"])
                                  for t, versions in REGISTRY.items() for v, e in versions.items()], VERSIONS)


def registry_rules(spark: SparkSession) -> DataFrame:
    """The package's type rules as a table, in the order they are applied."""
    def needs(*fields):
        return [(f, "present", None, f"missing:{f}", REJECT) for f in fields]

    def known(*fields):
        return [(f, "not_null", None, f"{f}_null", REJECT) for f in fields]

    def shape(field, pattern):
        return (field, "matches", pattern, f"{field}_format", WARN)

    rules = {
        ARR: [*needs("account_id", "account_name", "arr"), ("arr", "number", None, "arr_not_number", REJECT),
              ("arr", "not_negative", None, "arr_negative", REJECT), *known("account_id"), shape("account_id", CRM_ID)],
        OPPORTUNITY: [*needs("opportunity_id", "account_id"), ("amount", "number_if_given", None, "amount_not_number", REJECT),
                      ("amount", "not_negative", None, "amount_negative", REJECT), *known("opportunity_id", "account_id"),
                      shape("opportunity_id", CRM_ID), shape("account_id", CRM_ID)],
        BILLING: [*needs("account_id", "cost"), ("cost", "number", None, "cost_not_number", REJECT), *known("account_id"),
                  ("cost", "not_negative", None, "negative_cost", WARN), shape("account_id", CLOUD_ACCOUNT_ID)],
    }
    return spark.createDataFrame([(t, i, *r) for t, rows in rules.items() for i, r in enumerate(rows)], RULES)


def registry_entries(versions: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per data type: ``latest`` version, ``required`` (version -> fields), ``rules``."""
    per_version = versions.groupBy("data_type", "version").agg(F.max("required_fields").alias("required_fields"))
    known = per_version.groupBy("data_type").agg(
        F.max("version").alias("latest"), F.map_from_entries(F.collect_list(F.struct("version", "required_fields"))).alias("required"))
    ordered = F.array_sort(F.collect_list(F.struct("position", "field", "check", "argument", "reason", "level")))
    return known.join(rules.groupBy("data_type").agg(ordered.alias("rules")), "data_type", "full")


def _fails(record: Column, rule: Column) -> Column:
    """Whether a rule fails a record (null where it does not apply counts as no)."""
    check = rule["check"]

    def judged(value: Column) -> Column:
        number = python_float(value)
        return (F.when(check == "present", ~F.map_contains_key(record, rule["field"]))
                .when(check == "not_null", value.isNull())
                .when(check == "number", number.isNull())
                .when(check == "number_if_given", value.isNotNull() & number.isNull())
                .when(check == "not_negative", number < 0)
                .when(check == "matches", ~F.rlike(value, rule["argument"]))
                .otherwise(F.raise_error(F.concat(F.lit("unknown check: "), F.coalesce(check, F.lit("null"))))))

    # a list of one binds the value to a name, so that the map is searched once
    failed = F.transform(F.array(F.try_element_at(record, rule["field"])), judged)[0]
    return F.coalesce(failed, F.lit(False))


def apply_registry(df: DataFrame, record: Column, versions: DataFrame, rules: DataFrame) -> DataFrame:
    """``df`` with ``reject_reason``, ``warnings`` and the filled ``schema_version`` of the record
    that ``record`` (a map<string,string> column expression) holds."""
    entries = lookup_side(registry_entries(versions, rules).select(
        F.col("data_type").alias("_type"), F.struct("latest", "required", "rules").alias(_ENTRY)))
    staged = df.withColumn("_record", record)
    staged = staged.withColumn("_dt", F.try_element_at("_record", F.lit("data_type")))
    joined = staged.join(entries, F.col("_dt") == F.col("_type"), "left")
    rec, entry = F.col("_record"), F.col(_ENTRY)
    given = F.try_element_at(rec, F.lit("schema_version"))
    has_given = F.map_contains_key(rec, F.lit("schema_version"))
    version = F.coalesce(fill_schema_version(given, entry["latest"]), F.lit("v1"))
    out = joined.withColumn("_version", version).withColumn("_required", F.try_element_at(entry["required"], F.col("_version")))
    needed = F.coalesce(F.col("_required"), F.array(*[F.lit(b) for b in BASIC]))
    missing = F.get(F.array_except(needed, F.map_keys(rec)), 0)
    every = F.coalesce(entry["rules"], F.array().cast(joined.schema[_ENTRY].dataType["rules"].dataType))
    out = out.withColumn("_failed", F.transform(F.filter(every, lambda r: _fails(rec, r)), lambda r: F.struct(r["reason"], r["level"])))
    first = F.get(F.filter("_failed", lambda r: r["level"] == REJECT), 0)["reason"]
    reason = F.coalesce(F.when(~F.map_contains_key(rec, F.lit("data_type")), F.lit("missing:data_type")),
                        F.when(missing.isNotNull(), F.concat(F.lit("missing:"), missing)), first)
    warned = F.transform(F.filter("_failed", lambda r: r["level"] == WARN), lambda r: r["reason"])
    unknown = F.when(entry.isNull(), F.array(F.lit("unknown_data_type"))).otherwise(F.array().cast("array<string>"))
    out = out.withColumns({
        REASON: reason, "_warned": F.concat(warned, unknown),
        "schema_version": F.when(has_given, given).otherwise(F.when(F.col("_required").isNotNull(), F.col("_version")))})
    out = out.withColumn(WARNINGS, F.when(F.col(REASON).isNull(), F.col("_warned")).otherwise(F.array().cast("array<string>")))
    return out.drop("_record", "_dt", "_type", _ENTRY, "_version", "_required", "_failed", "_warned")


def typed_record(df: DataFrame, fields: set[str] | None = None) -> Column:
    """A typed row as key-value text: its columns (of ``fields``) are keys, nulls stay."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("struct", "array", "map", "variant")
             and (fields is None or f.name in fields)]
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]).cast("array<string>"),
                             F.array(*[F.col(f"`{n}`").cast("string") for n in names]).cast("array<string>"))


def named_fields(versions: DataFrame, rules: DataFrame) -> set[str]:
    """Every field that a registry can ask for (as many as it names, however many records there are)."""
    named = versions.select(F.explode("required_fields").alias("f")).unionByName(rules.select(F.col("field").alias("f"))).distinct()
    return {r.f for r in named.collect()} | {*BASIC, "data_type", "schema_version"}


def validate_by_registry(df: DataFrame, versions: DataFrame, rules: DataFrame) -> DataFrame:
    """Typed records -> same rows plus reason and warnings, like ``validate_records``: an
    absent ``schema_version`` is filled, a valid opportunity's null amount becomes 0.0, amounts
    that could not be parsed are a warning."""
    record = typed_record(df.drop(PARSE_FAILED), named_fields(versions, rules))
    out = apply_registry(df, record, versions, rules)
    if PARSE_FAILED in df.columns:
        lost = F.col(PARSE_FAILED) & F.col(REASON).isNull()
        out = out.withColumn(WARNINGS, F.when(lost, F.concat(WARNINGS, F.array(F.lit("unparsable_amount")))).otherwise(F.col(WARNINGS))) \
            .drop(PARSE_FAILED)
    if "amount" in df.columns and "data_type" in df.columns:
        amount = python_float(F.col("amount").cast("string"))
        out = out.withColumn("amount", F.when((F.col("data_type") == OPPORTUNITY) & F.col(REASON).isNull(),
                                              F.coalesce(amount, F.lit(0.0))).otherwise(F.col("amount").cast("double")))
    return out


def validate_raw_by_registry(df: DataFrame, versions: DataFrame, rules: DataFrame, column: str = "record") -> DataFrame:
    """Raw JSON records (``map<string,string>``) -> reason, warnings, filled version."""
    return apply_registry(df, F.col(f"`{column}`"), versions, rules)
