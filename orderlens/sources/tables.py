"""The canonical tables, projected from parquet files with a declared schema.

Every table is a plain projection of one file set, so filters and column pruning
reach the scan.  Nothing is cached and nothing is read until an action.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import ntz
from orderlens.schemas import BASE


class Tables:
    """Lazy canonical frames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def base(self, name: str) -> DataFrame:
        return self.spark.read.schema(BASE[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        return self._customers(self.base("customer"))

    @cached_property
    def customers_placed(self) -> DataFrame:
        """Customers with city, state and the address document (joins two lookup tables)."""
        key = F.col("customer_id").cast("string")
        places = (
            self.base("nation")
            .join(self.base("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey"), F.col("n_name").alias("city"), F.col("r_name").alias("state"))
        )
        address = F.to_json(
            F.struct(
                F.concat(F.lit("Street "), key).alias("street"),
                F.col("city"),
                F.col("state"),
                F.lpad(key, 9, "0").alias("zip"),
            )
        )
        return (
            self._customers(self.base("customer"), "c_nationkey")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .withColumn("address", address)
            .drop("c_nationkey", "n_nationkey")
        )

    @staticmethod
    def _customers(raw: DataFrame, *more: str) -> DataFrame:
        key, balance, segment = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_mktsegment")
        return (
            raw
            .select(
                *more,
                key.alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.when(balance < -800, F.lit(None).cast("string"))
                .when(balance < -600, F.lit(""))
                .otherwise(F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")))
                .alias("email"),
                F.concat(F.lit("+1-555-"), F.lpad(key.cast("string"), 9, "0")).alias("phone"),
                F.when(segment.isin("BUILDING", "MACHINERY"), "ENTERPRISE")
                .when(segment == "AUTOMOBILE", "PREMIUM")
                .otherwise("STANDARD")
                .alias("customer_tier"),
                balance.cast("decimal(12,2)").alias("lifetime_value"),
                (balance >= 0).alias("is_active"),
                F.array(F.lit("B2B"), segment).alias("tags"),
                (key % 101).cast("int").alias("profile_score"),
                ntz(F.date_add(F.lit("1995-01-01").cast("date"), (key % 2400).cast("int"))).alias("created_at"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(10,2)")
        rate = (40 + F.col("p_partkey") % 40).cast("decimal(4,0)") * F.lit("0.01").cast("decimal(3,2)")
        return self.base("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            price.alias("price"),
            (price * rate).cast("decimal(10,2)").alias("cost"),
            (F.col("p_size") >= 3).alias("is_active"),
            F.col("p_size").cast("bigint").alias("inventory_count"),
            F.to_json(
                F.struct(
                    F.col("p_brand").alias("vendor"),
                    F.when(F.col("p_size") > 25, "Premium").alias("support_level"),
                )
            ).alias("supplier_info"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        total = F.col("o_totalprice").cast("decimal(12,2)")
        return self.base("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            total.alias("total_amount"),
            F.when(F.col("o_orderstatus") == "F", "COMPLETED")
            .when(F.col("o_orderstatus") == "P", "SHIPPED")
            .otherwise("PENDING")
            .alias("status"),
            (total * F.lit("0.05").cast("decimal(3,2)")).cast("decimal(10,2)").alias("discount_amount"),
            (total * F.lit("0.08").cast("decimal(3,2)")).cast("decimal(10,2)").alias("tax_amount"),
            F.col("o_orderpriority").alias("order_priority"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self.base("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("total_price"),
            F.col("l_shipdate").alias("ship_date"),
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.base("events").select(
            "event_id",
            "ts",
            "user_id",
            "event_type",
            F.col("value").cast("decimal(12,2)").alias("value"),
            "props",
        )

    @cached_property
    def jobs(self) -> DataFrame:
        kind, value, eid = F.col("event_type"), F.col("value"), F.col("event_id")
        report = (
            F.when(kind == "view", "sales_report")
            .when(kind == "click", "CUSTOMER_ANALYSIS")
            .when(kind == "signup", "DATA_QUALITY")
            .when(kind == "error", "EXECUTIVE_DASHBOARD")
        )
        return self.base("events").select(
            eid.alias("job_id"),
            F.concat(F.lit("job "), kind).alias("job_name"),
            F.when(kind == "view", "REPORT")
            .when(kind == "click", "ANALYSIS")
            .when(kind == "purchase", "DATA_SYNC")
            .when(kind == "signup", "VALIDATION")
            .otherwise("MAINTENANCE")
            .alias("job_type"),
            F.when(kind == "error", "FAILED")
            .when(value < 3, "RUNNING")
            .when(value < 8, "PENDING")
            .otherwise("COMPLETED")
            .alias("status"),
            F.col("user_id").alias("created_by"),
            F.col("ts").alias("created_at"),
            F.when(value >= 3, F.col("ts") + F.make_dt_interval(secs=F.floor(value)))
            .alias("updated_at"),
            value.cast("decimal(10,2)").alias("execution_time_seconds"),
            F.when(value > 30, 1).when(value > 10, 2).otherwise(3).alias("priority"),
            (eid % 5).cast("int").alias("retry_count"),
            F.lit(3).alias("max_retries"),
            F.when(kind == "error", F.concat(F.lit("code "), F.get_json_object("props", "$.k"))).alias(
                "error_message"
            ),
            F.to_json(
                F.struct(
                    report.alias("report_type"),
                    F.when(value > 10, "last_30_days").alias("date_range"),
                    F.get_json_object("props", "$.k").alias("k"),
                )
            ).alias("input_data"),
            F.to_json(F.struct(F.when(value > 30, "daily").otherwise("adhoc").alias("schedule"))).alias(
                "metadata"
            ),
        )

    @cached_property
    def task_errors(self) -> DataFrame:
        eid, value = F.col("event_id"), F.col("value")
        return (
            self.base("events")
            .filter(F.col("event_type") == "error")
            .select(
                eid.alias("error_id"),
                F.concat(F.lit("task_"), (F.col("user_id") % 7).cast("string")).alias("task_name"),
                F.col("ts").alias("error_timestamp"),
                (value > 40).alias("resolved"),
                F.element_at(
                    F.array(*map(F.lit, ("DATA_PIPELINE", "JOB_PROCESSING", "MAINTENANCE", "ANALYTICS"))),
                    (eid % 4 + 1).cast("int"),
                ).alias("error_category"),
                F.when(value > 30, "CRITICAL").when(value > 10, "HIGH").otherwise("MEDIUM").alias("severity"),
            )
        )

    @cached_property
    def sales_metrics(self) -> DataFrame:
        """Daily totals of sold orders; two-step so that one busy day is pre-aggregated."""
        day = F.to_date("order_date")
        per_customer = (
            self.orders.filter(F.col("status").isin("COMPLETED", "SHIPPED"))
            .groupBy(day.alias("metric_date"), "customer_id")
            .agg(
                F.sum("total_amount").alias("amount"),
                F.count(F.lit(1)).alias("n"),
                F.max("order_date").alias("latest"),
            )
        )
        return per_customer.groupBy("metric_date").agg(
            F.concat(F.lit("SM_"), F.date_format(F.first("metric_date"), "yyyyMMdd")).alias("metric_id"),
            F.sum("amount").cast("decimal(15,2)").alias("total_sales"),
            F.sum("n").alias("total_orders"),
            F.count("customer_id").alias("unique_customers"),
            F.max("latest").alias("updated_at"),
        )

    def _log(self, kind: str) -> DataFrame:
        return self.base("events").filter(F.col("event_type") == kind)

    @cached_property
    def api_calls(self) -> DataFrame:
        return self._log("view").select(
            F.col("event_id").alias("call_id"), F.col("ts").alias("call_timestamp"),
            F.when(F.col("value") > 40, 500).otherwise(200).alias("status_code"),
        )

    @cached_property
    def system_metrics(self) -> DataFrame:
        return self._log("purchase").select(
            F.col("event_id").alias("metric_id"), F.col("ts").alias("metric_timestamp"),
            F.when(F.col("value") > 20, "data_processing").otherwise("maintenance").alias("metric_type"),
            F.col("value").cast("decimal(18,4)").alias("metric_value"),
        )

    @cached_property
    def quality_checks(self) -> DataFrame:
        names = ("Customer Email Validation", "Order Items Validation", "Product Price Validation", "Order Date Validation")
        of = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("user_id") % 4 + 1).cast("int"))
        found = F.when(F.col("value") > 30, F.get_json_object("props", "$.k")).otherwise("0")
        return self._log("click").select(
            F.col("event_id").alias("check_id"),
            of(names).alias("check_name"),
            of(("customers", "order_items", "products", "orders")).alias("table_name"),
            of(("NULL_CHECK", "REFERENTIAL", "RANGE", "TEMPORAL")).alias("check_type"),
            F.lit('{"invalid": 0}').alias("expected_result"),
            F.concat(F.lit('{"invalid": '), found, F.lit("}")).alias("actual_result"),
            F.when(F.col("value") > 30, "FAIL").otherwise("PASS").alias("status"),
            F.col("ts").alias("check_timestamp"),
            F.when(F.col("value") > 30, F.concat(F.lit("observed "), F.get_json_object("props", "$.k"))).alias(
                "error_details"
            ),
        )

    @cached_property
    def audit_log(self) -> DataFrame:
        return self._log("signup").select(
            F.col("event_id").alias("audit_id"), F.col("ts").alias("event_timestamp"), F.col("user_id").alias("user_name")
        )

    @cached_property
    def questions(self) -> DataFrame:
        """User turns of the conversations."""
        return (
            self.base("conversations")
            .filter(F.col("role") == "user")
            .select("conv_id", "turn", F.col("text").alias("question"))
        )
