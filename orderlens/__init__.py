"""orderlens: order and event analytics as PySpark DataFrame jobs."""
