"""Time-varying curriculum: sources mixed to target weights, every document placed in training order.

Each source has a weight over training time t in [0, 1] that goes linearly from ``begin`` to ``end`` times its share. The integral
of that line is the source's cumulative demand for tokens. Inside a source, documents follow one another in the
order of a hash of their id and text; a document that starts after c tokens of its source is due when the demand reaches c, so the
demand is inverted (a square root) to get its position, and rows are range-sorted by position. A source that is asked for more than it has
is gone through again, in the same order; the copy in which the target is reached is taken in part.

Targets: sources in order of code point (unknown last) weigh 5, 2, 1, 5, 2, 1, ... and share 150 % of all tokens by weight;
none takes more than twice its tokens, and what is cut off is shared among the others until none is above.

A source may hold any share of the rows: running sums are made within hash slices of a source (as many as its rows ask for), and slice
totals, a few numbers per source, are summed before them. The list of sources, not of documents, is worked out on the driver.

Null texts have no words, take nothing and have no position; documents without a source form the source null; repeated rows are
documents of their own. Extra columns are kept as they are, but for those named mix_...: such
names are the operator's own. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.llm.common import WORD, store

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST = 2
#: Weight of a source at the start and the end of training, relative to its mean; by place in the list, repeating.
SLOPES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
#: Documents of a hash slice at about most.
SLICE = 5_000


def targets_of(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> list[Fraction]:
    """Target of each source, in exact fractions."""
    left = share * sum(sizes)
    open_, out = list(range(len(sizes))), [Fraction(0)] * len(sizes)
    while open_:
        unit = left / sum(weights[i % len(weights)] for i in open_)
        full = [i for i in open_ if unit * weights[i % len(weights)] >= most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = unit * weights[i % len(weights)]
            break
        for i in full:
            out[i] = Fraction(most * sizes[i])
            left -= out[i]
        closed = set(full)
        open_ = [i for i in open_ if i not in closed]
    return out


def position(demand: Column, begin: Column, end: Column) -> Column:
    """Time at which the share ``demand`` (0..1) of a source is used up, its weight going from ``begin`` to ``end``.

    The integral to t of begin + (end - begin) * t, over its value at 1, is inverted.
    """
    whole = (begin + end) / 2
    slope = end - begin
    root = F.sqrt(F.greatest(F.lit(0.0), begin * begin + 2 * slope * demand * whole))
    # 2 * area / (begin + root) is the root of the quadratic without loss of digits, and holds for slope 0.
    return F.when(begin + root > 0, 2 * demand * whole / (begin + root)).otherwise(F.lit(0.0))


def _words(text: str) -> Column:
    return F.when(F.col(text).isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def assign(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """All rows and columns, with mix_size, mix_source_size, mix_target, mix_start and mix_copies: copy, words taken and position of each copy.

    ``mix_start``, the words of its source that come before a row, is another one for every row with words."""
    names = [F.col(f"`{c}`") for c in docs.columns if not c.startswith("mix_")]
    sized = docs.select(*names, _words("text").alias("mix_size"), F.xxhash64("doc_id", "text").alias("mix_key"))
    sources = [(r["source"], r["size"], r["n"]) for r in sized.groupBy("source").agg(F.sum("mix_size").alias("size"), F.count("*").alias("n")).collect()]
    sources.sort(key=lambda r: (r[0] is None, (r[0] or "").encode()))
    targets = targets_of([s for _, s, _ in sources], weights, share, most)
    rows = [
        (i, name, size, float(target), int(target), max(1, math.ceil(n / SLICE)), *map(float, SLOPES[i % len(SLOPES)]))
        for i, ((name, size, n), target) in enumerate(zip(sources, targets))
    ]
    plan = docs.sparkSession.createDataFrame(
        rows, "mix_index int, mix_source string, mix_source_size long, mix_target double, mix_words long, mix_slices int, mix_begin double, mix_end double"
    )
    sliced = sized.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("mix_source"))).withColumn("mix_slice", F.pmod("mix_key", "mix_slices"))
    # A few numbers per source: the words of each slice, and of the slices before it.
    sums = store(sliced.groupBy("mix_index", "mix_slice").agg(F.sum("mix_size").alias("size")), "mix_slices")
    ahead = Window.partitionBy("mix_index").orderBy("mix_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("mix_index", "mix_slice", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("mix_before"))
    inside = Window.partitionBy("mix_index", "mix_slice").orderBy("mix_key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("mix_inner", F.coalesce(F.sum("mix_size").over(inside), F.lit(0))).join(before, ["mix_index", "mix_slice"])
    placed = placed.withColumn("mix_start", F.col("mix_before") + F.col("mix_inner"))

    def copy(number: int) -> Column:
        start = F.col("mix_start") + F.lit(number) * F.col("mix_source_size")
        taken = F.greatest(F.lit(0), F.least(F.col("mix_size"), F.col("mix_words") - start)).cast("long")
        due = position(start / F.col("mix_target"), F.col("mix_begin"), F.col("mix_end"))
        return F.struct(F.lit(number).alias("copy"), taken.alias("taken"), due.alias("position"))

    copies = F.filter(F.array(*map(copy, range(most))), lambda x: x["taken"] > 0)
    return placed.select(*names, "mix_size", "mix_source_size", "mix_target", "mix_start", copies.alias("mix_copies"))


def _in_order(assigned: DataFrame, names: list[Column], more: tuple[str, ...] = ()) -> DataFrame:
    rows = assigned.select(
        *names, "mix_size", F.col("mix_of.copy").alias("mix_copy"), F.col("mix_of.taken").alias("mix_taken"), F.col("mix_of.position").alias("mix_position"), *more
    )
    return rows.orderBy(F.asc_nulls_last("mix_position"), "source", "doc_id", "mix_copy")


def taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and positions of every row; taken counts the words of all its copies, positions has one entry for each.

    The texts are put into training order, and what a row got is counted there, copy by copy. Rows of which nothing is taken follow behind, without their text.
    """
    copies = assign(docs.select("doc_id", "text", "source")).withColumn("mix_of", F.explode_outer("mix_copies"))
    names = [F.col("doc_id"), F.col("source"), F.when(F.col("mix_of").isNotNull(), F.col("text")).alias("text")]
    order = _in_order(copies, names, ("mix_source_size", "mix_target", "mix_start")).withColumn("mix_place", F.monotonically_increasing_id())
    used = F.col("mix_copy").isNotNull()
    # A row with words is known by where it begins in its source, one without has a place of its own.
    row = ["doc_id", "source", "mix_size", "mix_source_size", "mix_target", "mix_start", F.when(~used, F.col("mix_place")).alias("mix_alone")]
    found = order.groupBy(*row).agg(
        F.coalesce(F.sum(F.least("mix_taken", _words("text"))), F.lit(0)).alias("taken"),
        F.array_sort(F.collect_list(F.when(used, F.struct("mix_place", "mix_position")))).alias("mix_found"),
    )
    return found.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), "taken",
        F.transform("mix_found", lambda x: x["mix_position"]).alias("positions"),
    )


def schedule(docs: DataFrame) -> DataFrame:
    """The training order: a row per copy that is trained on, with mix_size, mix_copy, mix_taken and mix_position, range-sorted by position."""
    names = [F.col(f"`{c}`") for c in docs.columns if not c.startswith("mix_")]
    return _in_order(assign(docs).withColumn("mix_of", F.explode("mix_copies")), names)
