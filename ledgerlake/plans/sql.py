"""Oracle SQL fragments (DuckDB dialect) mirroring the Spark operators.

Each fragment is a CTE over the adapter views of ``sources.adapters``; the
registry composes them into one statement per query. They restate the
reference's semantics independently of the Spark code (no shared helpers), so
agreement between the two is a real check.
"""

from __future__ import annotations

import datetime as _dt

from ledgerlake.params import DEFAULT_CONTEXT
from ledgerlake.sources.adapters import duck_sql

CTX = DEFAULT_CONTEXT
TS = CTX.ingest_iso
RECENT_FROM = (CTX.as_of - _dt.timedelta(days=180)).isoformat()
YESTERDAY = (CTX.as_of - _dt.timedelta(days=1)).isoformat()
LINEAGE = (f"'{CTX.environment}' AS lineage_environment, '{CTX.pipeline_version}' AS lineage_pipeline_version, "
           f"'{CTX.data_owner}' AS lineage_data_owner")
CRM_RX = "'^[a-zA-Z0-9]{15,18}$'"
ACCT_RX = "'^[0-9]{12}$'"


def tags(id_expr: str) -> str:
    return (f"sha256(coalesce({id_expr}, 'None')) AS obs_correlation_id, '{TS}' AS obs_ingest_timestamp, "
            f"md5(timestamp || '-' || source) AS obs_data_version, {LINEAGE}")


CTES: dict[str, str] = {
    "b_parse": "SELECT *, try_cast(unblended_cost AS double) AS _c, try_cast(usage_amount AS double) AS _u "
               "FROM v_billing_raw",
    "billing": f"""
SELECT line_item_id, usage_start, account_id, product_code AS service, resource_id,
       CASE WHEN _c IS NOT NULL AND _u IS NOT NULL THEN _c ELSE 0.0 END AS cost,
       CASE WHEN _c IS NOT NULL AND _u IS NOT NULL THEN _u ELSE 0.0 END AS usage_amount,
       usage_type, billing_period, NOT (_c IS NOT NULL AND _u IS NOT NULL) AS parse_failed,
       '{TS}' AS timestamp, 'aws_cur' AS data_type, 'aws' AS source, 'v1' AS schema_version
FROM b_parse""",
    "billing_cat": "SELECT b.*, coalesce(m.cost_category, 'unallocated') AS cost_category "
                   "FROM billing b LEFT JOIN v_account_map m ON b.account_id = m.account_id",
    "billing_tag": f"SELECT *, {tags('account_id')} FROM billing_cat",
    "billing_r": "SELECT *, CASE WHEN account_id IS NULL THEN 'account_id_null' END AS reject_reason FROM billing_tag",
    "billing_val": f"""
SELECT *, CASE WHEN reject_reason IS NULL THEN concat_ws(',',
          CASE WHEN cost < 0 THEN 'negative_cost' END,
          CASE WHEN NOT regexp_matches(account_id, {ACCT_RX}) THEN 'account_id_format' END,
          CASE WHEN parse_failed THEN 'unparsable_amount' END) ELSE '' END AS warnings
FROM billing_r""",
    "arr": f"""
SELECT Id AS account_id, Name AS account_name, Industry AS industry, Type AS customer_type, Arr AS arr,
       '{TS}' AS timestamp, 'salesforce_arr' AS data_type, 'salesforce' AS source
FROM v_accounts WHERE Type = 'Customer'""",
    "arr_all": f"""
SELECT Id AS account_id, Name AS account_name, Industry AS industry, Type AS customer_type, Arr AS arr,
       '{TS}' AS timestamp, 'salesforce_arr' AS data_type, 'salesforce' AS source
FROM v_accounts""",
    "opp_all": f"""
SELECT Id AS opportunity_id, Name AS opportunity_name, AccountId AS account_id, Amount AS amount,
       StageName AS stage, strftime(CloseDate, '%Y-%m-%d') AS close_date, Type AS type,
       Probability AS probability, IsClosed AS is_closed, IsWon AS is_won,
       '{TS}' AS timestamp, 'salesforce_opportunity' AS data_type, 'salesforce' AS source
FROM v_opportunities""",
    "arr_tag": f"SELECT *, {tags('account_id')}, 'v1' AS schema_version FROM arr",
    "arr_r": """
SELECT *, CASE WHEN arr IS NULL THEN 'arr_not_number' WHEN arr < 0 THEN 'arr_negative'
               WHEN account_id IS NULL THEN 'account_id_null' END AS reject_reason FROM arr_tag""",
    "arr_val": f"""
SELECT *, CASE WHEN reject_reason IS NULL THEN concat_ws(',',
          CASE WHEN NOT regexp_matches(account_id, {CRM_RX}) THEN 'account_id_format' END) ELSE '' END AS warnings
FROM arr_r""",
    "opp": f"""
SELECT Id AS opportunity_id, Name AS opportunity_name, AccountId AS account_id, Amount AS amount,
       StageName AS stage, strftime(CloseDate, '%Y-%m-%d') AS close_date, Type AS type,
       Probability AS probability, IsClosed AS is_closed, IsWon AS is_won,
       '{TS}' AS timestamp, 'salesforce_opportunity' AS data_type, 'salesforce' AS source
FROM v_opportunities WHERE CloseDate >= DATE '{RECENT_FROM}'""",
    "opp_tag": f"SELECT *, {tags('account_id')}, 'v1' AS schema_version FROM opp",
    "opp_r": """
SELECT *, CASE WHEN amount < 0 THEN 'amount_negative' WHEN opportunity_id IS NULL THEN 'opportunity_id_null'
               WHEN account_id IS NULL THEN 'account_id_null' END AS reject_reason FROM opp_tag""",
    "opp_val": f"""
SELECT * REPLACE (CASE WHEN reject_reason IS NULL THEN coalesce(amount, 0.0) ELSE amount END AS amount),
       CASE WHEN reject_reason IS NULL THEN concat_ws(',',
          CASE WHEN NOT regexp_matches(opportunity_id, {CRM_RX}) THEN 'opportunity_id_format' END,
          CASE WHEN NOT regexp_matches(account_id, {CRM_RX}) THEN 'account_id_format' END) ELSE '' END AS warnings
FROM opp_r""",
    "all_full": """
SELECT * EXCLUDE (line_item_id, usage_start, parse_failed) FROM billing_val
UNION ALL BY NAME SELECT * FROM arr_val UNION ALL BY NAME SELECT * FROM opp_val""",
    "all_val": """
SELECT data_type, account_id, CAST(NULL AS varchar) AS opportunity_id, reject_reason, warnings FROM billing_val
UNION ALL SELECT data_type, account_id, NULL, reject_reason, warnings FROM arr_val
UNION ALL SELECT data_type, account_id, opportunity_id, reject_reason, warnings FROM opp_val""",
    "dlog": """
SELECT *, CASE WHEN status_code >= 200 AND status_code < 300 THEN 'delivered' WHEN status_code = 429 THEN 'rate_limited'
               WHEN status_code >= 500 THEN 'retryable' WHEN status_code IN (400, 401, 403) THEN 'non_retryable'
               ELSE 'retryable' END AS delivery_class
FROM v_delivery_log""",
    "usage": """
SELECT cast(usage_start AS date) AS usage_date, product_code AS service, account_id,
       try_cast(unblended_cost AS double) AS cost FROM v_billing_raw""",
    "daily": """
SELECT strftime(usage_date, '%Y-%m-%d') AS cost_date, service, account_id,
       cast(cast(sum(exact) AS varchar) AS double) AS cost, cast(sum(exact) AS varchar) AS amount,
       count(*) AS usage_rows, count(*) - count(exact) AS unsummed_rows
FROM (SELECT *, try_cast(cast(cost AS varchar) AS decimal(28,12)) AS exact FROM usage) GROUP BY 1, 2, 3""",
}

# Dependencies of each CTE (adapter views are prefixed v_).
DEPS: dict[str, list[str]] = {
    "b_parse": ["v_billing_raw"], "billing": ["b_parse"], "billing_cat": ["billing", "v_account_map"],
    "billing_tag": ["billing_cat"], "billing_r": ["billing_tag"], "billing_val": ["billing_r"],
    "arr_all": ["v_accounts"], "opp_all": ["v_opportunities"], "arr": ["v_accounts"], "arr_tag": ["arr"], "arr_r": ["arr_tag"], "arr_val": ["arr_r"],
    "opp": ["v_opportunities"], "opp_tag": ["opp"], "opp_r": ["opp_tag"], "opp_val": ["opp_r"],
    "all_full": ["billing_val", "arr_val", "opp_val"], "all_val": ["billing_val", "arr_val", "opp_val"], "dlog": ["v_delivery_log"],
    "usage": ["v_billing_raw"], "daily": ["usage"],
}


def compose(select: str, *needs: str, extra: dict[str, tuple[str, list[str]]] | None = None) -> str:
    """``WITH`` every view/CTE the statement needs (dependencies first), then ``select``.

    ``extra`` adds statement-local CTEs as ``name -> (sql, dependencies)``.
    """
    extra = extra or {}
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        deps = extra[n][1] if n in extra else DEPS.get(n, [])
        for d in deps:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    parts = []
    for n in order:
        if n in extra:
            parts.append(f"{n} AS ({extra[n][0]})")
        elif n.startswith("v_"):
            parts.append(f"{n} AS ({duck_sql(n)})")
        else:
            parts.append(f"{n} AS ({CTES[n]})")
    if not parts:
        return select.strip()
    return "WITH " + ",\n".join(parts) + "\n" + select
