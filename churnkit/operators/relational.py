"""Generic building blocks: ranking, lookups, shares, ordered running totals.

Ranking keeps only the first rows of each key, so Spark cuts every key down on the map side
(partial group limit) before it shuffles. A key with a third of all rows costs one row per task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnkit.functions import category_rank, col, or_default, round_dec
from churnkit.session import kept

RANK = "_rank"
# Rows of one range where an order over everything is worked on in parallel.
RANGE_ROWS = 1_000_000


# --- ranking ----------------------------------------------------------------

def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], up_to: int, name: str = RANK) -> DataFrame:
    """The first ``up_to`` rows of each key with their rank."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= up_to)


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    return rank_within(df, keys, order, n).drop(RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_n_per_key(df, keys, order, 1)


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Rows that are unique in the key already, in a form that lets the optimizer see it: then a left join to them goes
    where nothing of theirs is used. No further shuffle, as the ranking before has dealt the rows by the key."""
    return df.groupBy(key).agg(*[F.first(c).alias(c) for c in df.columns if c != key])


def dedup_latest(
    df: DataFrame, keys: Sequence[str], recency: Sequence[str], tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Keep the newest copy of each key. Equal times are decided by the other columns, newest value first."""
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in {*keys, *recency}]
    return latest_per_key(df, keys, [F.desc(c) for c in (*recency, *tie_break)])


def latest_and_previous(
    df: DataFrame, key: str, order: Sequence[Column], values: Sequence[str]
) -> DataFrame:
    """Newest and second newest values side by side, in one pass instead of a self-join."""
    ranked = rank_within(df, [key], order, 2)
    picks = []
    for v in values:
        picks.append(F.max(F.when(F.col(RANK) == 1, F.col(v))).alias(f"{v}_latest"))
        picks.append(F.max(F.when(F.col(RANK) == 2, F.col(v))).alias(f"{v}_previous"))
    return ranked.groupBy(key).agg(*picks)


# --- joins ------------------------------------------------------------------

def look_up(fact: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join facts to a table with one row per key, whatever share of the facts one key has.

    Adaptive execution measures the shuffled facts and splits a partition that one key has made too large, but only where both
    sides come straight out of a shuffle, which a table just summed or ranked per key does not. The second join column is 0 on every
    row; it makes the join ask for a partitioning that neither side has yet, so both are shuffled and no row is copied
    unless a hot key is measured. A dimension under the broadcast limit is broadcast by Spark as in any join.
    """
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    return fact.withColumn("_zero", zero).join(dim.withColumn("_zero", zero), [key, "_zero"], how).drop("_zero")


def fk_valid(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in the dimension."""
    return look_up(fact, dim.select(key), key, "left_semi")


def fk_orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return look_up(fact, dim.select(key), key, "left_anti")


def named_in(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """The dimension rows some fact names. The fact's keys are made distinct before they are shuffled."""
    return dim.join(fact.select(key).distinct(), key, "left_semi")


def left_with_defaults(base: DataFrame, feat: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    joined = base.join(feat, key, "left")
    return joined.withColumns({c: or_default(c, v) for c, v in defaults.items()})


def latest_only(df: DataFrame, column: str) -> DataFrame:
    """Rows that carry the highest value of the column, which is read as a scalar subquery."""
    return df.filter(F.col(column) == df.select(F.max(column)).scalar())


def require_latest(df: DataFrame, column: str):
    """Highest value of the column; an error when there is none."""
    value = df.agg(F.max(column)).first()[0]
    if value is None:
        raise ValueError(f"no rows to take the latest {column} from")
    return value


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- groups -----------------------------------------------------------------

def any_match(df: DataFrame, key: str, cond: Column, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.coalesce(F.bool_or(cond), F.lit(False)).alias(name))


def max_per_key(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(column).alias(name))


def count_distinct_per_key(
    df: DataFrame, key: str, column, name: str, where: Column | None = None
) -> DataFrame:
    """Distinct values per key: copies are dropped on (key, value) first, so no task holds a whole key."""
    value = col(column) if where is None else F.when(where, col(column))
    pairs = df.select(F.col(key), value.alias("_v")).distinct()
    return pairs.groupBy(key).agg(F.count("_v").alias(name))


def distribution(df: DataFrame, column: str, count_name: str = "n", pct_name: str = "pct", digits: int = 1) -> DataFrame:
    """Rows per value and their share of all rows."""
    return with_share(df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name)), count_name, pct_name, digits)


def with_share(groups: DataFrame, count: str = "n", name: str = "pct", digits: int = 1) -> DataFrame:
    """Percent of the total count. The total is a scalar subquery on the summed groups, whose exchange both read, so the groups
    themselves stay where they are, however many there are."""
    total = groups.select(F.sum(count)).scalar()
    return groups.withColumn(name, round_dec(F.col(count) * F.lit(100.0) / total, digits))


def pivot_counts(
    df: DataFrame, row: str, column: str, values: Sequence[str], measure: str = "n", rest: str = "other"
) -> DataFrame:
    """Sums per row and value; everything outside the list, and NULL, is summed in the column ``rest``."""
    named = F.when(F.col(column).isin(list(values)), F.col(column)).otherwise(F.lit(rest))
    columns = [*values, rest]
    return df.withColumn(column, named).groupBy(row).pivot(column, columns).agg(F.sum(measure)).fillna(0, columns)


def histogram(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], name: str = "bin") -> DataFrame:
    """Rows per bin (lower, upper]; the first bin includes its lower edge. Values outside the edges, and NULL, are in no bin."""
    c = F.col(column)
    bin_ = F.when(c.between(edges[0], edges[1]), F.lit(labels[0]))
    for low, high, label in zip(edges[1:], edges[2:], labels[1:]):
        bin_ = bin_.when((c > low) & (c <= high), F.lit(label))
    return df.select(bin_.alias(name)).filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def column_spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample standard deviation per column, one row each, from a single pass."""
    wide = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "std").withColumn("is_constant", F.col("std") == 0)


def zero_variance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return column_spread(df, columns).filter("is_constant").select("feature")


# --- order ------------------------------------------------------------------

def order_by_category(df: DataFrame, column: str, order: Sequence[str], *then: Column) -> DataFrame:
    return df.orderBy(category_rank(column, order), *then)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def in_ranges(df: DataFrame, order: Sequence[str], range_rows: int) -> DataFrame:
    """The rows with ``_range``: consecutive pieces of the order with about ``range_rows`` rows each, as many as the rows need.

    The pieces come out of a range exchange and are written once, so that all that follows sees the same cuts.
    """
    rows = kept(df, "unordered")
    pieces = math.ceil(rows.count() / range_rows)
    if pieces <= 1:
        return rows.withColumn("_range", F.lit(0))
    return kept(rows.repartitionByRange(pieces, *order).withColumn("_range", F.spark_partition_id()), "ranges")


def global_sequence(df: DataFrame, key: str, name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Number the rows 1..N in the order of a unique key, whatever its values and their gaps."""
    numbered = prefix_offsets(df.withColumn("_one", F.lit(1)), key, "_one", "_before", range_rows)
    return numbered.withColumn(name, F.col("_before") + 1).drop("_one", "_before")


def prefix_offsets(df: DataFrame, key: str, count: str, name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Sum of ``count`` over all rows with a smaller key. The key is unique."""
    totals = running_totals(df.withColumn("_all", F.lit(0)), "_all", key, [count], range_rows=range_rows)
    return totals.withColumnRenamed(f"{count}_before", name).drop("_all", f"{count}_through")


def hash_ordered_rank(df: DataFrame, group: str, digest: Column, unique: str, name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rank of each row in its group, ordered by a digest and then a unique column, without one task per group."""
    ordered = [group, "_digest", unique]
    ranged = in_ranges(df.withColumn("_digest", digest), ordered, range_rows)
    starts = _range_starts(ranged, group, {"_start": F.count(F.lit(1))})
    inside = W.partitionBy(group, "_range").orderBy("_digest", unique)
    return (
        ranged.join(starts, [group, "_range"])
        .withColumn(name, F.col("_start") + F.row_number().over(inside))
        .drop("_digest", "_range", "_start")
    )


def _range_starts(ranged: DataFrame, by: str, sums: Mapping[str, Column], descending: bool = False) -> DataFrame:
    """What the ranges before each range of a ``by`` add up to: one row per range, far fewer than there are rows."""
    sizes = ranged.groupBy(by, "_range").agg(*[total.alias(name) for name, total in sums.items()])
    before = W.partitionBy(by).orderBy(F.desc("_range") if descending else F.asc("_range")).rowsBetween(W.unboundedPreceding, -1)
    return sizes.select(by, "_range", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in sums])


def running_totals(
    df: DataFrame, by: str, order: str, sums: Sequence[str], descending: bool = False, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Totals over all earlier rows (``<sum>_before``) and up to the row (``<sum>_through``), per ``by``.

    ``order`` is unique inside ``by``. A plain running window would put all rows of a ``by`` in one task. Here the window runs inside
    ranges of the order, and what the ranges before add up to is added.
    """
    ranged = in_ranges(df, [by, order], range_rows)
    starts = _range_starts(ranged, by, {f"_{s}_start": F.sum(s) for s in sums}, descending)
    direction = F.desc if descending else F.asc
    inside = W.partitionBy(by, "_range").orderBy(direction(order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = ranged.join(starts, [by, "_range"])
    for s in sums:
        out = out.withColumn(f"{s}_through", F.col(f"_{s}_start") + F.sum(s).over(inside))
    for s in sums:
        out = out.withColumn(f"{s}_before", F.col(f"{s}_through") - F.col(s))
    return out.drop("_range", *[f"_{s}_start" for s in sums])
