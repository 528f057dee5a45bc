"""Table snapshots: new content goes to a new folder and never touches the files being read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Clustering columns and point-lookup keys of the canonical tables.
CLUSTERING = {
    "jobs": ("status", "created_at"),
    "customers": ("customer_tier", "is_active"),
    "products": ("category", "is_active"),
    "orders": ("customer_id", "order_date"),
    "order_items": ("order_id",),
    "nudges": ("generated_at", "user_id"),
}
LOOKUP_KEYS = {"jobs": ("job_id",), "customers": ("customer_id",), "products": ("product_id",)}


def write_snapshot(
    df: DataFrame, folder: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = (), bloom_on: Sequence[str] = (),
) -> str:
    """Writes the frame to a folder of its own below ``folder`` and returns its path.

    ``sort_by`` clusters rows inside each file, so row-group statistics prune;
    ``bloom_on`` writes bloom filters for point lookups.
    """
    path = f"{folder.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    if sort_by:
        df = df.sortWithinPartitions(*[F.col(c) for c in sort_by])
    writer = df.write
    for column in bloom_on:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_clustered(folder: str, name: str, df: DataFrame) -> str:
    """Writes a canonical table in its declared order, with bloom filters on its lookup key.

    The range exchange puts equal leading values into few files, so statistics prune
    whole files and not only row groups.
    """
    order = [c for c in CLUSTERING[name] if c in df.columns]
    laid_out = df.repartitionByRange(*[F.col(c) for c in order])
    return write_snapshot(laid_out, folder, sort_by=order, bloom_on=LOOKUP_KEYS.get(name, ()))
