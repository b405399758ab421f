"""Record-family StructTypes and the versioned schema registry."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference for identical validation results)
#   record families : salesforce_arr, salesforce_opportunity, aws_cur
#   sources         : salesforce, aws
#   registry        : data_type -> version -> (required fields, optional fields)
#   default version stamped on extracted records: v1
#   required raw billing columns: lineItem/UsageAccountId, lineItem/UnblendedCost
#   default account map: 123456789012 production, 234567890123 staging,
#                        345678901234 development; unmapped -> unallocated
# ---------------------------------------------------------------------------
ARR = "salesforce_arr"
OPPORTUNITY = "salesforce_opportunity"
BILLING = "aws_cur"
SOURCE_CRM = "salesforce"
SOURCE_BILLING = "aws"
STAMPED_VERSION = "v1"

REGISTRY: dict[str, dict[str, dict[str, list[str]]]] = {
    "salesforce_arr": {
        "v1": {
            "required_fields": ["account_id", "account_name", "arr", "timestamp", "data_type", "source"],
            "optional_fields": ["health_score", "industry", "customer_type", "csm"],
        },
        "v2": {
            "required_fields": ["account_id", "account_name", "arr", "timestamp", "data_type", "source"],
            "optional_fields": ["health_score", "industry", "customer_type", "csm",
                                "account_owner", "renewal_date"],
        },
    },
    "salesforce_opportunity": {
        "v1": {
            "required_fields": ["opportunity_id", "account_id", "amount", "timestamp", "data_type", "source"],
            "optional_fields": ["opportunity_name", "stage", "close_date", "type", "probability",
                                "is_closed", "is_won"],
        },
    },
    "aws_cur": {
        "v1": {
            "required_fields": ["account_id", "cost", "timestamp", "data_type", "source"],
            "optional_fields": ["service", "resource_id", "usage_amount", "usage_type", "billing_period"],
        },
    },
}

REQUIRED_BILLING_COLUMNS = ("lineItem/UsageAccountId", "lineItem/UnblendedCost")

DEFAULT_ACCOUNT_MAP = (
    ("123456789012", "production"),
    ("234567890123", "staging"),
    ("345678901234", "development"),
)
UNALLOCATED = "unallocated"
# ---------------------------------------------------------------------------


def latest_version(data_type: str | None) -> str | None:
    """Lexicographic maximum of the registered versions (so "v10" < "v2")."""
    versions = sorted(REGISTRY.get(data_type, {}).keys()) if data_type else []
    return versions[-1] if versions else None


def registered_fields(data_type: str, version: str) -> list[str]:
    entry = REGISTRY[data_type][version]
    return list(entry["required_fields"]) + list(entry["optional_fields"])


# FIXED VALUES: raw and landed billing column lists and wire formats below must match
# the files and messages that are exchanged. Raw billing layouts (all strings, slash-named).
FULL_BILLING_LAYOUT = [
    "identity/LineItemId", "identity/TimeInterval",
    "bill/InvoiceId", "bill/BillingEntity", "bill/BillType", "bill/PayerAccountId",
    "bill/BillingPeriodStartDate", "bill/BillingPeriodEndDate",
    "lineItem/UsageAccountId", "lineItem/LineItemType", "lineItem/UsageStartDate",
    "lineItem/UsageEndDate", "lineItem/ProductCode", "lineItem/UsageType", "lineItem/Operation",
    "lineItem/AvailabilityZone", "lineItem/ResourceId", "lineItem/UsageAmount",
    "lineItem/NormalizationFactor", "lineItem/NormalizedUsageAmount", "lineItem/CurrencyCode",
    "lineItem/UnblendedRate", "lineItem/UnblendedCost", "lineItem/BlendedRate",
    "lineItem/BlendedCost", "lineItem/LineItemDescription", "lineItem/TaxType",
    "lineItem/LegalEntity",
    "product/ProductName", "product/offeringClass", "product/servicecode", "product/region",
    "product/sku", "product/servicename", "product/fromLocation", "product/toLocation",
    "product/usagetype", "product/operation", "product/locationType",
    "pricing/publicOnDemandCost", "pricing/publicOnDemandRate", "pricing/term", "pricing/unit",
    "resourceTags/user:ClusterId", "resourceTags/user:Environment",
]

LANDED_DAILY_LAYOUT = [
    "identity/LineItemId", "identity/TimeInterval", "lineItem/UsageAccountId",
    "lineItem/ProductCode", "lineItem/UnblendedCost", "bill/BillingPeriod", "lineItem/UsageAmount",
]


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, S) for c in columns])


# Nested cost response (one landed document per day/page).
COST_RESPONSE = T.StructType([
    T.StructField("ResultsByTime", T.ArrayType(T.StructType([
        T.StructField("TimePeriod", T.StructType([
            T.StructField("Start", S), T.StructField("End", S)])),
        T.StructField("Groups", T.ArrayType(T.StructType([
            T.StructField("Keys", T.ArrayType(S)),
            T.StructField("Metrics", T.StructType([
                T.StructField("UnblendedCost", T.StructType([
                    T.StructField("Amount", S), T.StructField("Unit", S)])),
            ])),
        ]))),
    ]))),
])

# Work / dead-letter / delivery envelopes: records stay raw JSON objects so
# that per-record key presence survives for validation.
ENVELOPE = T.StructType([
    T.StructField("type", S),
    T.StructField("records", T.ArrayType(T.MapType(S, S))),
    T.StructField("timestamp", S),
    T.StructField("batch_number", T.LongType()),
    T.StructField("total_batches", T.LongType()),
    T.StructField("customer_id", S),
    T.StructField("failed_timestamp", S),
])

ARRIVAL_EVENT = T.StructType([
    T.StructField("action", S),
    T.StructField("bucket", S),
    T.StructField("key", S),
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("eventSource", S),
        T.StructField("body", S),
        T.StructField("s3", T.StructType([
            T.StructField("bucket", T.StructType([T.StructField("name", S)])),
            T.StructField("object", T.StructType([T.StructField("key", S)])),
        ])),
    ]))),
])

CHECKPOINT = T.StructType([
    T.StructField("query", S), T.StructField("last_id", S),
    T.StructField("processed_count", T.LongType()),
])
