"""Declared schemas (DDL text, accepted by readers) and fixed value lists."""

from __future__ import annotations

# --- source files (declared, so no footer is read to infer a schema) ---------

BASE = {
    "region": ("r_regionkey int, r_name string"),
    "nation": ("n_nationkey int, n_name string, n_regionkey int"),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "conversations": ("conv_id bigint, turn bigint, role string, text string"),
}

# --- canonical tables --------------------------------------------------------

JOBS = (
    "job_id string, job_name string, job_type string, status string, created_by string,"
    " created_at timestamp_ntz, updated_at timestamp_ntz, input_data string, output_location string,"
    " error_message string, execution_time_seconds decimal(10,2), priority int, retry_count int,"
    " max_retries int, tags array<string>, metadata string"
)
CUSTOMERS = (
    "customer_id string, customer_name string, email string, phone string, address string,"
    " customer_tier string, lifetime_value decimal(12,2), is_active boolean, tags array<string>,"
    " profile_score int, created_at timestamp_ntz, updated_at timestamp_ntz"
)
PRODUCTS = (
    "product_id string, product_name string, category string, price decimal(10,2), cost decimal(10,2),"
    " description string, is_active boolean, inventory_count bigint, supplier_info string,"
    " specifications string"
)
ORDERS = (
    "order_id string, customer_id string, order_date timestamp_ntz, total_amount decimal(12,2),"
    " status string, shipping_address string, payment_method string, discount_amount decimal(10,2),"
    " tax_amount decimal(10,2), created_at timestamp_ntz"
)
ORDER_ITEMS = (
    "order_item_id string, order_id string, product_id string, quantity bigint,"
    " unit_price decimal(10,2), total_price decimal(12,2)"
)
SALES_METRICS = (
    "metric_id string, metric_date date, total_sales decimal(15,2), total_orders bigint,"
    " unique_customers bigint, average_order_value decimal(10,2), top_product string, top_category string,"
    " updated_at timestamp_ntz"
)
DAILY_METRICS = (
    "metric_date date, total_revenue decimal(15,2), total_orders bigint, unique_customers bigint,"
    " new_customers bigint, returning_customers bigint, average_order_value decimal(10,2),"
    " products_sold bigint, top_selling_product string, top_selling_category string,"
    " jobs_completed bigint, jobs_failed bigint, system_health_score decimal(3,2)"
)
TASK_ERRORS = (
    "error_id string, task_name string, error_message string, error_timestamp timestamp_ntz,"
    " resolved boolean, resolution_notes string, error_category string, severity string"
)
SYSTEM_METRICS = (
    "metric_id string, metric_timestamp timestamp_ntz, metric_type string, metric_name string,"
    " metric_value decimal(18,4), metric_unit string, tags string, source_system string"
)
QUALITY_CHECKS = (
    "check_id string, check_name string, table_name string, check_type string, check_description string,"
    " expected_result string, actual_result string, status string, check_timestamp timestamp_ntz,"
    " error_details string"
)
API_CALLS = (
    "call_id string, endpoint string, status_code int, call_timestamp timestamp_ntz"
)
AUDIT_LOG = (
    "audit_id string, event_type string, user_name string, event_timestamp timestamp_ntz"
)
EVENTS = BASE["events"]
NUDGE = (
    "nudge_id string, user_id bigint, rule_id string, nudge_type string, event_id bigint, content string,"
    " channels array<string>, priority int, generated_at timestamp_ntz, expires_at timestamp_ntz,"
    " delivery_status map<string,string>"
)

ADDRESS = "street string, city string, state string, zip string"

# --- fixed values ------------------------------------------------------------

SOLD = ("COMPLETED", "SHIPPED")
ORDER_STATUS = ("PENDING", "PROCESSING", "SHIPPED", "COMPLETED", "CANCELLED")
REPORT_TYPES = (
    "SALES_REPORT",
    "CUSTOMER_ANALYSIS",
    "PRODUCT_PERFORMANCE",
    "EXECUTIVE_DASHBOARD",
    "DATA_QUALITY",
)
EVENT_TYPES = ("click", "signup", "view", "purchase", "error")
