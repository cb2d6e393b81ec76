"""Seeded test data: every value is a function of a row number, so any task can make any row.

All numbers, lists and spans come from the caller; nothing here stands for a particular data set.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions import clamp, col, lookup, pick, round_dec, seeded_int
from churnkit.operators.relational import prefix_offsets, union_all
from churnkit.schemas import CLOSED_STATUSES


def gen_ids(spark: SparkSession, n: int, name: str = "id") -> DataFrame:
    """Row numbers 1..n, made in parallel."""
    return spark.range(1, n + 1).select(F.col("id").alias(name))


def draw(number, what: str, modulus: int) -> Column:
    """Repeatable number in [0, modulus) for a row number; draws of different names are independent."""
    return F.pmod(F.xxhash64(F.lit(what), col(number).cast("bigint")), F.lit(modulus)).cast("int")


def cohort(c, edges: Sequence[int], labels: Sequence[str]) -> Column:
    """Label by upper edge (inclusive); the last label takes the rest."""
    out = F.when(col(c) <= edges[0], F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(col(c) <= edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def fan_out(parents: DataFrame, count_col: str, name: str = "n") -> DataFrame:
    """As many child rows 1..count per parent."""
    return parents.filter(F.col(count_col) > 0).withColumn(name, F.explode(F.sequence(F.lit(1), F.col(count_col))))


def numbered_fan_out(parents: DataFrame, key: str, count_col: str, rank: str = "n", number: str = "number") -> DataFrame:
    """Child rows with a number that runs over all parents in key order.

    The offset of a parent is summed over the parents, before the rows are multiplied.
    """
    children = fan_out(prefix_offsets(parents, key, count_col, "_offset"), count_col, rank)
    return children.withColumn(number, F.col("_offset") + F.col(rank)).drop("_offset")


def surrogate_key(prefix: str, number, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(col(number).cast("string"), width, "0"))


def synthetic_uuid(number, space: str = "row") -> Column:
    """Repeatable id text: the first 32 hex digits of a digest of the number, in the usual five groups."""
    digest = F.sha2(F.concat(F.lit(f"{space}:"), col(number).cast("string")), 256)
    return F.concat_ws("-", *[F.substring(digest, at, width) for at, width in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def offset_days(cohort_col, number, leaning: Mapping[str, str], span: int, seeds: tuple[int, int]) -> Column:
    """Day offset in [0, span): cohorts that lean ``early`` take the smaller of two draws, ``late`` the larger, others the first."""
    one, two = (seeded_int(number, seed, span) for seed in seeds)
    ways = {"early": F.least(one, two), "late": F.greatest(one, two)}
    out = None
    for name, way in leaning.items():
        out = F.when(col(cohort_col) == name, ways[way]) if out is None else out.when(col(cohort_col) == name, ways[way])
    return out.otherwise(one)


def late_life(rank, count, share: float) -> Column:
    """True for the children after the given share of their parent's life."""
    return col(rank) > col(count) * F.lit(share)


def conditioned_pick(index: Column, late: Column, late_values: Sequence[str], early_values: Sequence[str]) -> Column:
    """Value from one of two lists, at ``index`` modulo the length of the list."""
    return F.when(late, pick(late_values, F.pmod(index, F.lit(len(late_values))))).otherwise(
        pick(early_values, F.pmod(index, F.lit(len(early_values))))
    )


def trend_score(rank, count, first: float, last: float, wobble: Column, low: float, high: float) -> Column:
    """Score that goes evenly from ``first`` at the first child to ``last`` at the last one, with a wobble, two decimals."""
    way = (col(rank) - 1).cast("double") / F.greatest(col(count) - 1, F.lit(1)).cast("double")
    return clamp(round_dec(F.lit(first) + F.lit(last - first) * way + wobble, 2), low, high)


def derive_dates(
    df: DataFrame, start: str, cycle: str, status: str, hours: str, survey_no: str,
    terms: Mapping[str, int], term_else: int, survey_every: int, survey_lead: int, closed: Sequence[str] = CLOSED_STATUSES,
) -> DataFrame:
    """Contract end by the cycle's term in days, ticket resolution (closed ones only) and survey date: every so many days, the first so
    many days earlier."""
    begun = F.col(start)
    days = F.ceil(F.col(hours) / F.lit(24.0)).cast("int") + 1
    return df.withColumns(
        {
            "end_date": F.date_add(begun, lookup(cycle, terms, term_else)),
            "resolved_date": F.when(F.col(status).isin(list(closed)), F.date_add(begun, days)),
            "survey_date": F.date_add(begun, (F.col(survey_no) * survey_every - survey_lead).cast("int")),
        }
    )


def with_history(current: DataFrame, had_one: Column, lower_plan: Mapping[str, str], days_before: int, ended: str) -> DataFrame:
    """Contracts (version 1) plus, where ``had_one``, the previous one (version 2): a plan lower, so many days earlier, ended."""
    previous = current.filter(had_one).withColumns(
        {
            "plan_type": F.coalesce(lookup("plan_type", lower_plan), F.col("plan_type")),
            "start_date": F.date_add("start_date", -days_before),
            "contract_version": F.lit(2),
            "status": F.lit(ended),
        }
    )
    return union_all(current.withColumn("contract_version", F.lit(1)), previous)


def start_date(first: dt.date, days_after: Column) -> Column:
    return F.date_add(F.lit(first), days_after)
