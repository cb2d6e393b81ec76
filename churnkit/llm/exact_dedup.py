"""Exact de-duplication with a heavy-hitter split, in DataFrame functions only.

1. Every row is reduced to (digest of the normalised text, id, row number), which is written once.
2. Misra-Gries counters find digests that may be frequent: ``approx_top_k`` keeps ``TRACKED`` counters in each of ``BUCKETS`` hash
   buckets and takes off a common amount when they are full; its summaries are made in every task and merged. In a bucket of b rows
   a digest of more than about 7 / ``TRACKED`` * b rows is always found, unless ``TOP`` digests of the bucket are more frequent.
3. The candidates are verified: one exact pass counts them and takes the row that stays, a row per candidate and task.
   These winners, ``BUCKETS * TOP`` at most whatever the input, are broadcast, and decide their copies where they lie.
4. All other digests, whose groups are small, take the ordinary way: one shuffle by digest.

A missed or needless candidate costs time only; results do not depend on the counters.

The row with the largest id stays; a row without an id only if its copies have none either, and of rows with equal id and text exactly one.
Null texts count as empty, so they are copies of each other and of empty ones. Very long texts are hashed whole. Extra columns, whatever their
names, are ignored by ``decisions`` and carried by ``distinct_documents``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnkit.llm.common import store

#: Hash buckets, counters and candidates of each; 64 is what an object aggregate holds without sorting.
BUCKETS, TRACKED, TOP = 64, 1024, 64


def unchanged(text: Column) -> Column:
    return text


def _digest(text: Column, normalise: Callable[[Column], Column]) -> Column:
    return F.unhex(F.sha2(normalise(F.coalesce(text.cast("string"), F.lit(""))), 256))


def _narrow(docs: DataFrame, normalise: Callable[[Column], Column]) -> DataFrame:
    """digest, doc_id and a row number, stored so that the number stays the row's."""
    digest = _digest(F.col("text"), normalise).alias("digest")
    return store(docs.select(digest, "doc_id", F.monotonically_increasing_id().alias("row")), "dedup_digests")


def frequent_winners(rows: DataFrame) -> DataFrame:
    """digest, copies, best (doc_id, row) of the frequent digests of ``rows`` (digest, doc_id, row); exact and of bounded size."""
    marked = rows.select(F.xxhash64("digest").alias("mark"))
    found = marked.groupBy(F.pmod("mark", F.lit(BUCKETS)).alias("bucket")).agg(
        F.expr(f"approx_top_k(mark, {TOP}, {TRACKED})").alias("top")
    )
    candidates = found.select(F.explode("top.item").alias("mark"))
    exact = (
        rows.withColumn("mark", F.xxhash64("digest")).join(F.broadcast(candidates), "mark", "left_semi")
        .groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.max(F.struct("doc_id", "row")).alias("best"))
    )
    return store(exact.filter("copies > 1"), "dedup_winners")


def decisions(docs: DataFrame, normalise: Callable[[Column], Column] = unchanged) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs`` (doc_id, text)."""
    rows = _narrow(docs, normalise)
    told = rows.join(F.broadcast(frequent_winners(rows)), "digest", "left")
    group = W.partitionBy("digest")
    ordinary = rows.columns
    few = told.filter("copies is null").select(
        *ordinary, F.count(F.lit(1)).over(group).alias("copies"), F.max(F.struct("doc_id", "row")).over(group).alias("best")
    )
    return told.filter("copies is not null").select(*few.columns).union(few).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, normalise: Callable[[Column], Column] = unchanged) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Copies of frequent texts go before the shuffle, so no task receives more than one row of them for each task that reads
    (rows that repeat id and text included, by the group limit of the ranking).
    """
    rows = _narrow(docs, normalise)
    told = docs.select(_digest(F.col("text"), normalise).alias("_digest"), F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"))
    winners = frequent_winners(rows).select(F.col("digest").alias("_digest"), F.col("best.doc_id").alias("_best"), F.lit(True).alias("_frequent"))
    left = told.join(F.broadcast(winners), "_digest", "left").filter(F.col("_frequent").isNull() | F.col("_doc.doc_id").eqNullSafe(F.col("_best")))
    turn = F.row_number().over(W.partitionBy("_digest").orderBy(F.desc_nulls_last("_doc.doc_id")))
    return left.select("_doc", turn.alias("_turn"), "_digest").filter("_turn = 1").select("_doc.*")
