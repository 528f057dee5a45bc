"""SQL functions with default arguments, usable from plain SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A SQL function body is inlined by the analyzer, so these cost what the expression costs.
DEFINITIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION minutes_crossed(a TIMESTAMP_NTZ, b TIMESTAMP_NTZ DEFAULT NULL)
       RETURNS BIGINT RETURN timestampdiff(MINUTE, date_trunc('minute', a), date_trunc('minute', b))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION hours_crossed(a TIMESTAMP_NTZ, b TIMESTAMP_NTZ DEFAULT NULL)
       RETURNS BIGINT RETURN timestampdiff(HOUR, date_trunc('hour', a), date_trunc('hour', b))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION days_crossed(a TIMESTAMP_NTZ, b TIMESTAMP_NTZ DEFAULT NULL)
       RETURNS BIGINT RETURN timestampdiff(DAY, date_trunc('day', a), date_trunc('day', b))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION retries_left(done INT, most INT DEFAULT 3)
       RETURNS INT RETURN greatest(most - done, 0)""",
    # Table functions are called laterally: one row in, rows out, in the same plan.
    """CREATE OR REPLACE TEMPORARY FUNCTION order_checks(total DECIMAL(12,2), discount DECIMAL(12,2), high DECIMAL(12,2) DEFAULT 400000)
       RETURNS TABLE (check_name STRING, passed BOOLEAN)
       RETURN SELECT c.check_name, CASE c.check_name WHEN 'total_positive' THEN order_checks.total > 0
           WHEN 'total_in_range' THEN order_checks.total <= order_checks.high ELSE order_checks.discount < order_checks.total END AS passed
           FROM VALUES ('total_positive'), ('total_in_range'), ('discount_below_total') AS c(check_name)""",
)


def define_functions(spark: SparkSession) -> None:
    for text in DEFINITIONS:
        spark.sql(text)
