"""Named contributions: map of input name to signed value, JSON text at the border."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expressions import col

MAP_TYPE = "map<string,double>"


def parse_factors(c) -> Column:
    """Map held in a JSON text; NULL when the text is not an object."""
    return F.from_json(col(c), MAP_TYPE)


def ranked_factors(c, k: int) -> Column:
    """The k strongest entries as (name, value), by absolute value, then by name."""

    def before(a: Column, b: Column) -> Column:
        stronger = F.abs(a["value"]) - F.abs(b["value"])
        return (
            F.when(stronger > 0, F.lit(-1))
            .when(stronger < 0, F.lit(1))
            .when(a["key"] < b["key"], F.lit(-1))
            .when(a["key"] > b["key"], F.lit(1))
            .otherwise(F.lit(0))
        )

    return F.slice(F.array_sort(F.map_entries(col(c)), before), 1, k)


def top_k_factors(c, k: int = 5, digits: int = 4) -> Column:
    """Ordered map of the k strongest entries, rounded."""
    rounded = F.transform(
        ranked_factors(c, k),
        lambda e: F.struct(
            e["key"].alias("key"),
            F.round(e["value"].cast("decimal(38,10)"), digits).cast("double").alias("value"),
        ),
    )
    return F.map_from_entries(rounded)


def factors_json(c, k: int = 5, digits: int = 4) -> Column:
    return F.to_json(top_k_factors(c, k, digits))


def factor_names(c, k: int = 3) -> Column:
    """Names of the k strongest entries of a map column; empty when there is none."""
    names = F.transform(ranked_factors(c, k), lambda e: e["key"])
    return F.coalesce(names, F.array().cast("array<string>"))
