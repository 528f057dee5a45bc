"""Named queries over the given tables, each with an independent SQL text.

A query is ``f(t)`` where ``t`` is :class:`orderlens.sources.tables.Tables`.
The SQL texts read the same parquet tables and spell the canonical tables out as
common table expressions; they are written in the literal form of the operator
(joins with fan-out, plain windows), not in the form the Spark plan uses.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens.sources.tables import Tables

ORDERS_AS_OF = "2001-08-02 00:00:00"
JOBS_AS_OF = "2024-01-30 12:00:00"

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

# Canonical tables as DuckDB SQL.
CTES = {
    "a_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name,
               CASE WHEN c_acctbal < -800 THEN NULL WHEN c_acctbal < -600 THEN ''
                    ELSE 'user' || c_custkey::VARCHAR || '@example.com' END AS email,
               '+1-555-' || lpad(c_custkey::VARCHAR, 9, '0') AS phone,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'ENTERPRISE'
                    WHEN c_mktsegment = 'AUTOMOBILE' THEN 'PREMIUM' ELSE 'STANDARD' END AS customer_tier,
               c_acctbal::DECIMAL(12,2) AS lifetime_value, c_acctbal >= 0 AS is_active,
               'B2B,' || c_mktsegment AS tags, (c_custkey % 101)::INTEGER AS profile_score,
               (DATE '1995-01-01' + (c_custkey % 2400)::INTEGER)::TIMESTAMP AS created_at,
               'Street ' || c_custkey::VARCHAR AS street, n_name AS city, r_name AS state,
               lpad(c_custkey::VARCHAR, 9, '0') AS zip
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
             LEFT JOIN region ON n_regionkey = r_regionkey""",
    "a_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               p_retailprice::DECIMAL(10,2) AS price,
               (p_retailprice::DECIMAL(10,2) * (40 + p_partkey % 40)::DECIMAL(4,0) * 0.01::DECIMAL(3,2))::DECIMAL(10,2) AS cost,
               p_size >= 3 AS is_active, p_size::BIGINT AS inventory_count, p_brand AS vendor,
               CASE WHEN p_size > 25 THEN 'Premium' END AS support_level
        FROM part""",
    "a_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
               o_totalprice::DECIMAL(12,2) AS total_amount,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'SHIPPED' ELSE 'PENDING' END AS status,
               (o_totalprice::DECIMAL(12,2) * 0.05::DECIMAL(3,2))::DECIMAL(10,2) AS discount_amount,
               (o_totalprice::DECIMAL(12,2) * 0.08::DECIMAL(3,2))::DECIMAL(10,2) AS tax_amount,
               o_orderpriority AS order_priority
        FROM orders""",
    "a_order_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number,
               l_quantity::BIGINT AS quantity, l_extendedprice::DECIMAL(12,2) AS total_price,
               l_shipdate AS ship_date
        FROM lineitem""",
    "a_events": """
        SELECT event_id, ts, user_id, event_type, value::DECIMAL(12,2) AS value, props,
               (props->>'$.k')::INTEGER AS k
        FROM events""",
    "a_jobs": """
        SELECT event_id AS job_id, 'job ' || event_type AS job_name,
               CASE event_type WHEN 'view' THEN 'REPORT' WHEN 'click' THEN 'ANALYSIS' WHEN 'purchase' THEN 'DATA_SYNC'
                    WHEN 'signup' THEN 'VALIDATION' ELSE 'MAINTENANCE' END AS job_type,
               CASE WHEN event_type = 'error' THEN 'FAILED' WHEN value < 3 THEN 'RUNNING'
                    WHEN value < 8 THEN 'PENDING' ELSE 'COMPLETED' END AS status,
               user_id AS created_by, ts AS created_at,
               CASE WHEN value >= 3 THEN ts + to_seconds(floor(value)::INTEGER) END AS updated_at,
               value::DECIMAL(10,2) AS execution_time_seconds,
               CASE WHEN value > 30 THEN 1 WHEN value > 10 THEN 2 ELSE 3 END AS priority,
               (event_id % 5)::INTEGER AS retry_count, 3 AS max_retries,
               CASE WHEN event_type = 'error' THEN 'code ' || (props->>'$.k') END AS error_message,
               CASE event_type WHEN 'view' THEN 'sales_report' WHEN 'click' THEN 'CUSTOMER_ANALYSIS'
                    WHEN 'signup' THEN 'DATA_QUALITY' WHEN 'error' THEN 'EXECUTIVE_DASHBOARD' END AS report_type,
               CASE WHEN value > 10 THEN 'last_30_days' END AS date_range,
               CASE WHEN value > 30 THEN 'daily' ELSE 'adhoc' END AS schedule
        FROM events""",
    "a_task_errors": """
        SELECT event_id AS error_id, 'task_' || (user_id % 7)::VARCHAR AS task_name, ts AS error_timestamp,
               value > 40 AS resolved,
               CASE event_id % 4 WHEN 0 THEN 'DATA_PIPELINE' WHEN 1 THEN 'JOB_PROCESSING' WHEN 2 THEN 'MAINTENANCE'
                    ELSE 'ANALYTICS' END AS error_category,
               CASE WHEN value > 30 THEN 'CRITICAL' WHEN value > 10 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
        FROM events WHERE event_type = 'error'""",
    "a_sales_metrics": """
        SELECT 'SM_' || strftime(order_date, '%Y%m%d') AS metric_id, order_date::DATE AS metric_date,
               sum(total_amount)::DECIMAL(15,2) AS total_sales, count(*) AS total_orders,
               count(DISTINCT customer_id) AS unique_customers, max(order_date) AS updated_at
        FROM a_orders WHERE status IN ('COMPLETED', 'SHIPPED') GROUP BY 1, 2""",
    "a_api_calls": """
        SELECT event_id AS call_id, ts AS call_timestamp, CASE WHEN value > 40 THEN 500 ELSE 200 END AS status_code
        FROM events WHERE event_type = 'view'""",
    "a_system_metrics": """
        SELECT event_id AS metric_id, ts AS metric_timestamp,
               CASE WHEN value > 20 THEN 'data_processing' ELSE 'maintenance' END AS metric_type,
               value::DECIMAL(18,4) AS metric_value FROM events WHERE event_type = 'purchase'""",
    "a_quality_checks": """
        SELECT event_id AS check_id, CASE user_id % 4 WHEN 0 THEN 'Customer Email Validation'
               WHEN 1 THEN 'Order Items Validation' WHEN 2 THEN 'Product Price Validation' ELSE 'Order Date Validation' END AS check_name,
               CASE user_id % 4 WHEN 0 THEN 'customers' WHEN 1 THEN 'order_items' WHEN 2 THEN 'products' ELSE 'orders' END AS table_name,
               CASE user_id % 4 WHEN 0 THEN 'NULL_CHECK' WHEN 1 THEN 'REFERENTIAL' WHEN 2 THEN 'RANGE' ELSE 'TEMPORAL' END AS check_type,
               '{"invalid": 0}' AS expected_result,
               '{"invalid": ' || CASE WHEN value > 30 THEN props->>'$.k' ELSE '0' END || '}' AS actual_result,
               CASE WHEN value > 30 THEN 'FAIL' ELSE 'PASS' END AS status, ts AS check_timestamp,
               CASE WHEN value > 30 THEN 'observed ' || (props->>'$.k') END AS error_details
        FROM events WHERE event_type = 'click'""",
    "a_audit_log": """
        SELECT event_id AS audit_id, ts AS event_timestamp, user_id AS user_name FROM events WHERE event_type = 'signup'""",
    "a_questions": """
        SELECT conv_id, turn, text AS question FROM conversations WHERE role = 'user'""",
}


def _needed(sql: str) -> list[str]:
    names = [n for n in CTES if re.search(rf"\b{n}\b", sql)]
    grown = True
    while grown:
        grown = False
        for n in list(names):
            for dep in CTES:
                if dep not in names and re.search(rf"\b{dep}\b", CTES[n]):
                    names.append(dep)
                    grown = True
    return [n for n in CTES if n in names]


def with_tables(sql: str) -> str:
    """The SQL with the canonical tables it reads put in front as CTEs."""
    sql = sql.strip()
    heads = [f"{n} AS ({CTES[n]})" for n in _needed(sql)]
    if not heads:
        return sql
    recursive = ""
    match = re.match(r"WITH\s+(RECURSIVE\s+)?", sql, flags=re.IGNORECASE)
    if match:
        recursive = "RECURSIVE " if match.group(1) else ""
        return f"WITH {recursive}" + ",\n".join(heads) + ",\n" + sql[match.end():]
    return "WITH " + ",\n".join(heads) + "\n" + sql


def query(name: str, sql: str | None = None):
    """Registers ``f(t)`` under ``name``; ``sql`` is the independent check text."""

    def add(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = with_tables(sql)
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: fn(Tables(spark, folder))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
