"""MERGE-style writes as pure functions of two frames.

Parquet tables have no row-level MERGE, so the new table content is one full
outer join on the key; the caller writes it as a new version.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

Side = Callable[[str], Column]
Expr = Callable[[Side, Side], Column]

_SRC, _HIT_T, _HIT_S = "__src_", "__hit_target", "__hit_source"
_SALT_T, _SALT_S = "__salt_target", "__salt_source"


def _salt(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for a full key.  A key with a NULL equals nothing, so such rows go wherever their other values send them."""
    plain = [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    none = F.lit(False)
    for k in keys:
        none |= F.col(k).isNull()
    return F.when(none, F.xxhash64(*plain) if plain else F.lit(0)).otherwise(F.lit(0)).cast("long")


def unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source, raising at run time when a key repeats.

    The repeat test is a count with map-side combine, so a hot key costs one row
    per task.  Rows with a NULL key never match and are allowed to repeat.
    """
    others = [c for c in source.columns if c not in keys]
    keyed = source.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    keyless = source.filter(" OR ".join(f"`{k}` IS NULL" for k in keys))
    row = F.struct(*others) if others else F.struct(F.lit(True).alias("present"))
    one = keyed.groupBy(*keys).agg(F.first(row).alias("row"), F.count(F.lit(1)).alias("n"))
    checked = F.when(F.col("n") == 1, F.col("row")).otherwise(
        F.raise_error(F.lit("duplicate key in the source of an upsert")).cast(one.schema["row"].dataType)
    )
    fields = [F.col("row")[c].alias(c) for c in others]
    return (
        one.withColumn("row", checked)
        .filter(F.col("row").isNotNull())
        .select(*keys, *fields)
        .unionByName(keyless)
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, Expr] | None = None,
    insert: Mapping[str, Expr] | None = None,
    when: Expr | None = None,
    check_source: bool = True,
) -> DataFrame:
    """Target after ``MERGE``: update matched rows, insert the rest.

    ``update`` and ``insert`` map a target column to ``f(t, s)`` where ``t(name)``
    and ``s(name)`` read the *old* target row and the source row.  Left out, they
    copy equally named source columns.  ``when`` restricts the matched update.
    ``update={}`` keeps matched rows, ``insert={}`` drops unmatched source rows.
    """
    shared = [c for c in source.columns if c in target.columns]
    if update is None:
        update = {c: (lambda t, s, c=c: s(c)) for c in shared if c not in keys}
    inserts = insert is None or len(insert) > 0
    if insert is None:
        insert = {c: (lambda t, s, c=c: s(c)) for c in shared}
    if check_source:
        source = unique_source(source, keys)

    def t(name: str) -> Column:
        return F.col(name)

    def s(name: str) -> Column:
        return F.col(_SRC + name)

    left = target.withColumns({_HIT_T: F.lit(True), _SALT_T: _salt(target, keys)})
    right = source.select(*[F.col(c).alias(_SRC + c) for c in source.columns], F.lit(True).alias(_HIT_S), _salt(source, keys).alias(_SALT_S))
    on = [F.col(k) == F.col(_SRC + k) for k in keys] + [F.col(_SALT_T) == F.col(_SALT_S)]
    joined = left.join(right, on, "full_outer" if inserts else "left")

    old = F.coalesce(F.col(_HIT_T), F.lit(False))
    new = F.coalesce(F.col(_HIT_S), F.lit(False))
    matched = old & new
    if when is not None:
        matched = matched & F.coalesce(when(t, s), F.lit(False))
    out = []
    for field in target.schema.fields:
        name, value = field.name, F.col(field.name)
        if name in update:
            value = F.when(matched, update[name](t, s)).otherwise(value)
        if inserts:
            fresh = insert[name](t, s) if name in insert else F.lit(None)
            value = F.when(old, value).otherwise(fresh)
        out.append(value.cast(field.dataType).alias(name))
    return joined.select(*out)


def keyed_update(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Mapping[str, Expr]
) -> DataFrame:
    """UPDATE … FROM: matched rows change, unmatched source rows are ignored."""
    return upsert(target, source, keys, update=update, insert={})


def predicate_update(df: DataFrame, where: Column, changes: Mapping[str, Column]) -> DataFrame:
    """UPDATE … WHERE over one frame; a NULL predicate leaves the row alone."""
    hit = F.coalesce(where, F.lit(False))
    return df.select(
        *[
            F.when(hit, changes[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in changes
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def append(target: DataFrame, rows: DataFrame, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """INSERT of new rows; columns the rows lack take their default or NULL."""
    defaults = defaults or {}
    have = set(rows.columns)
    full = rows.select(
        *[
            (F.col(f.name) if f.name in have else defaults.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.schema.fields
        ]
    )
    return target.unionByName(full)
