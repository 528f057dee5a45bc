"""DELETE, archive and retention as filters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.sources.versions import write_snapshot


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows kept by a DELETE; NULL predicates keep the row, as in SQL."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def split_where(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(archived, kept): two disjoint frames that cover the input."""
    return df.filter(predicate), delete_where(df, predicate)


def rewrite(df: DataFrame, expired: Column, folder: str, archive: str | None = None) -> tuple[str, str | None]:
    """Rewrites a table without its expired rows; returns the paths of the new snapshot and of the archived rows.

    The archive is written first, so a run that fails in between loses no row; the
    files being read stay as they are.
    """
    gone, kept = split_where(df, expired)
    archived = write_snapshot(gone, archive) if archive else None
    return write_snapshot(kept, folder), archived


def retention_report(tables: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row per table with deleted and kept counts, plus a total row.

    Each count is a one-row aggregate of one scan.
    """
    rows = None
    for name, (df, expired) in tables.items():
        hit = F.coalesce(expired, F.lit(False))
        row = df.agg(
            F.lit(name).alias("table_name"),
            F.count_if(hit).alias("deleted_rows"),
            F.count_if(~hit).alias("kept_rows"),
        )
        rows = row if rows is None else rows.unionByName(row)
    total = rows.agg(
        F.lit("TOTAL").alias("table_name"),
        F.sum("deleted_rows").alias("deleted_rows"),
        F.sum("kept_rows").alias("kept_rows"),
    )
    return rows.unionByName(total)
