"""Column helpers shared by the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = "Column | str"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(as_of) -> Column:
    """``as_of`` as a date column; today when not given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


# --- time windows -----------------------------------------------------------

def since(c, as_of, days: int) -> Column:
    """In the trailing window. There is no upper bound: later rows count too."""
    return col(c) >= F.date_sub(day(as_of), days)


def band(c, as_of, older: int, newer: int) -> Column:
    """In the half-open band between ``older`` and ``newer`` days ago."""
    return since(c, as_of, older) & (col(c) < F.date_sub(day(as_of), newer))


def days_between(later, earlier) -> Column:
    return F.datediff(col(later), col(earlier))


def quarter_label(d) -> Column:
    return F.concat(F.lit("Q"), F.quarter(col(d)).cast("string"), F.lit("-"), F.year(col(d)).cast("string"))


# --- numbers ----------------------------------------------------------------

def trunc_int(c) -> Column:
    """Integer part, towards zero."""
    return col(c).cast("int")


def round_dec(c, digits: int) -> Column:
    """Round half away from zero on the decimal value, not on its binary form."""
    return F.round(col(c).cast("decimal(38,10)"), digits).cast("double")


def clamp(c, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col(c)))


def safe_ratio(num, den, scale: float = 1.0) -> Column:
    """``num * scale / max(den, 1)`` on doubles."""
    return col(num).cast("double") * F.lit(float(scale)) / F.greatest(col(den).cast("double"), F.lit(1.0))


def ratio_or_null(num, den) -> Column:
    return F.when(col(den) != 0, col(num).cast("double") / col(den))


def num(c) -> Column:
    """Numeric reading of a column; what cannot be read counts as 0."""
    return F.coalesce(F.nanvl(col(c).try_cast("double"), F.lit(0.0)), F.lit(0.0))


def or_default(c, value) -> Column:
    return F.coalesce(col(c), F.lit(value))


# --- aggregates -------------------------------------------------------------

def count_if(cond: Column) -> Column:
    return F.count_if(cond)


def exact_sum(c) -> Column:
    """Sum on decimals of 28 digits before the point and 10 after it: the same in every row order."""
    return F.sum(col(c).cast("decimal(38,10)"))


def exact_avg(c) -> Column:
    return exact_sum(c).cast("double") / F.count(col(c))


def avg_if(cond: Column, c) -> Column:
    return exact_avg(F.when(cond, col(c)))


def sum_if(cond: Column, c) -> Column:
    return F.sum(F.when(cond, col(c)).otherwise(F.lit(0)))


# --- choices ----------------------------------------------------------------

def in_domain(c, values: Sequence) -> Column:
    return col(c).isin(list(values))


def in_range(c, low, high) -> Column:
    return col(c).between(low, high)


def lookup(c, mapping: Mapping, default=None) -> Column:
    """Map a column's values through a small fixed table."""
    pairs = list(mapping.items())
    out = F.when(col(c) == F.lit(pairs[0][0]), F.lit(pairs[0][1]))
    for key, value in pairs[1:]:
        out = out.when(col(c) == F.lit(key), F.lit(value))
    return out.otherwise(F.lit(default))


def category_rank(c, order: Sequence) -> Column:
    """Position of the value in ``order``; values outside it come last."""
    return lookup(c, {v: i + 1 for i, v in enumerate(order)}, len(order) + 1)


def right_closed_bins(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin (lower, upper] the value falls in; the first bin has no lower edge."""
    out = F.when(col(c) <= F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(col(c) <= F.lit(edge), F.lit(label))
    return out


def health_tier(percent_points, high_below: int, medium_below: int) -> Column:
    """Tier of a score given in hundredths, so that the edges are exact."""
    c = col(percent_points)
    return (
        F.when(c < high_below * 100, F.lit("High"))
        .when(c < medium_below * 100, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


# --- text -------------------------------------------------------------------

def normalise_email(c) -> Column:
    return F.trim(F.lower(col(c)))


def percent_text(c, missing: str = "N/A") -> Column:
    return F.coalesce(F.concat(F.format_number(round_dec(col(c) * 100, 1), 1), F.lit("%")), F.lit(missing))


def amount_text(c, unit: str, missing: str = "N/A") -> Column:
    whole = F.format_number(round_dec(c, 0), 0)
    return F.coalesce(F.concat(whole, F.lit(f" {unit}")), F.lit(missing))


def text_or(c, missing: str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(missing))


def first_words(c, limit: int) -> Column:
    """The text cut after ``limit`` words; line breaks inside the kept part stay."""
    return F.regexp_extract(col(c), r"^(?:\s*\S+){0,%d}" % limit, 0)


# --- seeded generation ------------------------------------------------------

def seeded_int(c, multiplier: int, modulus: int) -> Column:
    """Repeatable number in [0, modulus) from a row number; large products wrap to 32 bits before hashing."""
    product = col(c).cast("bigint") * F.lit(multiplier)
    wrapped = F.pmod(product + F.lit(2**31), F.lit(2**32)) - F.lit(2**31)
    return F.pmod(F.hash(wrapped.cast("int")), F.lit(modulus))


def pick(values: Sequence, index) -> Column:
    """Element of a literal list; repeating a value gives it more weight."""
    return F.get(F.array(*[F.lit(v) for v in values]), col(index).cast("int"))
