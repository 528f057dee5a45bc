"""Reconciliation by digests: two tables are compared range by range, and only what differs is opened.

Keys are spread over ranges of their hash.  For each range both sides compute a digest that does
not depend on order: rows, and the sum and exclusive or of two row hashes.  These aggregates are
formed before the shuffle, so equal tables exchange a few digests a task and nothing else.
Ranges that differ are cut finer and compared again; the rows of the last ranges that differ
meet in one join.  Rows are compared by 128 bits of hash; repeated rows count as often as they
are there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.session import run_dir

FAN = 256  # ranges that one range is cut into


def _range(keys: Sequence[str], level: int) -> Column:
    """The range of a row at a level: levels nest, as each takes more low bits of the key's hash."""
    return F.pmod(F.xxhash64(F.lit("range"), *keys), F.lit(FAN ** (level + 1)))


def hashed(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys with two hashes of the compared columns; NULLs are marked, so that they differ from any value."""
    marks = [F.col(c).isNull() for c in columns]
    return df.select(*keys, F.xxhash64(*keys, *columns, *marks).alias("h1"), F.xxhash64(F.lit(7), *marks, *columns, *keys).alias("h2"))


def _digest(rows: DataFrame, keys: Sequence[str], level: int, side: str) -> DataFrame:
    return rows.groupBy(_range(keys, level).alias("r")).agg(
        F.struct(F.count(F.lit(1)), F.sum(F.col("h1").cast("decimal(38,0)")), F.bit_xor("h2")).alias(side)
    )


def differing_ranges(first: DataFrame, second: DataFrame, keys: Sequence[str], level: int) -> DataFrame:
    """Ranges whose digests are not the same, from hashed rows."""
    both = _digest(first, keys, level, "a").join(_digest(second, keys, level, "b"), "r", "full_outer")
    return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("r")


def reconcile(first: DataFrame, second: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, levels: int = 2) -> DataFrame:
    """Keys that differ, with ``rows_first``, ``rows_second`` and ``difference`` (only_in_first, only_in_second, changed).

    ``columns`` default to all that both sides have.  With ``levels`` of 2 a last range holds
    1 of 65,536 keys; more levels suit larger tables.
    """
    keys = list(keys)
    columns = [c for c in (columns or first.columns) if c in second.columns and c not in keys]
    sides = [hashed(df, keys, columns) for df in (first, second)]
    for level in range(levels):
        # Written: what the next level reads again is a list of ranges, and nothing where none differs.
        path = run_dir(first.sparkSession, f"ranges-{level}")
        differing_ranges(*sides, keys, level).write.parquet(path)
        ranges = first.sparkSession.read.schema("r long").parquet(path)
        sides = [s.withColumn("r", _range(keys, level)).join(ranges, "r", "left_semi").drop("r") for s in sides]
    counted = None
    for side, rows in zip(("a", "b"), sides):
        n = rows.groupBy(*keys, "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
        part = n.select(*keys, "h1", "h2", *[(F.col("n") if s == side else F.lit(0).cast("long")).alias(s) for s in ("a", "b")])
        counted = part if counted is None else counted.unionByName(part)
    by_row = counted.groupBy(*keys, "h1", "h2").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    by_key = by_row.groupBy(*keys).agg(F.sum("a").alias("rows_first"), F.sum("b").alias("rows_second"), F.max(F.col("a") != F.col("b")).alias("differs"))
    kind = F.when(F.col("rows_second") == 0, "only_in_first").when(F.col("rows_first") == 0, "only_in_second").otherwise("changed")
    return by_key.filter("differs").withColumn("difference", kind).drop("differs")
