"""Upsert, insert, update and delete as pure functions from table to new table.

The caller writes the result with ``rewrite_table`` or ``overwrite_partitions``. Every merge is one full outer or anti join, and each unmatched row passes once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MARK = "_in_source"


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Matched rows take ``update_cols`` from the source; unmatched source rows are added.

    Target and source have the same columns. One full outer join on the keys does both halves. A key that the source has more
    than once raises, as there is no telling which of its rows would win.
    """
    columns = target.columns
    updated = set(update_cols if update_cols is not None else [c for c in columns if c not in keys])
    old = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in columns if c not in keys], F.lit(True).alias("_t"))
    copies = F.count(F.lit(1)).over(W.partitionBy(*keys))
    once = F.when(copies == 1, F.lit(True)).otherwise(F.raise_error(F.lit("merge: the source has a key more than once")).cast("boolean"))
    new = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in columns if c not in keys], once.alias("_s"))
    joined = old.join(new, list(keys), "full")
    in_target, in_source = F.col("_t").isNotNull(), F.col("_s").isNotNull()

    def merged(c: str) -> Column:
        if c in keys:
            return F.col(c)
        take_source = in_source if c in updated else in_source & ~in_target
        return F.when(take_source, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c)

    return joined.select(*[merged(c) for c in columns])


def merge_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], target_filter: Column | None = None
) -> DataFrame:
    """Add source rows that match no target row. ``target_filter`` limits which target rows can match."""
    blocking = target if target_filter is None else target.filter(target_filter)
    fresh = source.join(blocking.select(*keys).distinct(), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def update_where(df: DataFrame, cond: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows that meet the condition; a NULL condition is not met."""
    hit = F.coalesce(cond, F.lit(False))
    flagged = df.withColumn("_hit", hit)
    out = flagged.select(
        *[
            F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in df.columns
        ]
    )
    return out


def update_keys(
    df: DataFrame, chosen: DataFrame, key: str, values: Mapping[str, Column], where: Column | None = None
) -> DataFrame:
    """Set columns on the rows whose key is in ``chosen`` and that meet ``where``."""
    marked = df.join(chosen.select(key).distinct().withColumn(MARK, F.lit(True)), key, "left")
    return update_where(marked, F.col(MARK) if where is None else F.col(MARK) & where, values).select(*df.columns)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    return df.filter(~F.coalesce(cond, F.lit(False)))


def delete_keys(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return df.join(gone.select(key), key, "left_anti")
