import random
from collections import Counter

import pytest
from helpers import values
from pyspark.sql import functions as F

from churnkit.operators import relational as R


def test_dedup_keeps_the_newest_and_breaks_ties_by_the_other_columns(rows):
    df = rows([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, 1, None), (2, 1, "x")], "k int, at int, v string")
    assert values(R.dedup_latest(df, ["k"], ["at"])) == [(1, 7, "c"), (2, 1, "x")]


def test_lean_dedup_keeps_the_same_leading_values(rows):
    rnd = random.Random(1)
    data = [(rnd.randrange(20), rnd.randrange(3), rnd.randrange(3), rnd.choice("abc")) for _ in range(300)]
    df = rows(data, "k int, at int, v int, note string")
    full = R.dedup_latest(df, ["k"], ["at"], ["v", "note"]).select("k", "at", "v")
    lean = R.dedup_latest(df.select("k", "at", "v"), ["k"], ["at"], ["v"])
    assert values(full) == values(lean)


def test_latest_and_previous(rows):
    df = rows([(1, 1, 10), (1, 2, 20), (1, 3, 30), (2, 1, 5)], "k int, at int, v int")
    assert values(R.latest_and_previous(df, "k", [F.desc("at")], ["v"])) == [(1, 30, 20), (2, 5, None)]


def test_key_checks(rows):
    fact = rows([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    dim = rows([(1,), (1,)], "k int")
    assert values(R.fk_valid(fact, dim, "k")) == [(1, "a")]
    assert values(R.fk_orphans(fact, dim, "k")) == [(2, "b"), (None, "c")]


def test_latest_only_and_empty(rows):
    df = rows([(1, 1), (2, 2), (3, 2)], "v int, d int")
    assert values(R.latest_only(df, "d").select("v")) == [(2,), (3,)]
    assert R.require_latest(df, "d") == 2
    with pytest.raises(ValueError):
        R.require_latest(df.filter("d > 9"), "d")


def test_count_distinct_with_condition(rows):
    df = rows([(1, "a"), (1, "a"), (1, "b"), (2, "z")], "k int, v string")
    got = values(R.count_distinct_per_key(df, "k", "v", "n", F.col("v") != "z"))
    assert got == [(1, 2), (2, 0)]


def test_distribution_adds_up(rows):
    df = rows([("a",)] * 3 + [("b",)], "t string")
    assert values(R.distribution(df, "t")) == [("a", 3, 75.0), ("b", 1, 25.0)]


def test_pivot_fills_zero(rows):
    df = rows([("e", "p", 2), ("c", "q", 1)], "r string, s string, n int")
    assert values(R.pivot_counts(df, "r", "s", ["p", "q", "x"])) == [("c", 0, 1, 0, 0), ("e", 2, 0, 0, 0)]
    assert values(R.pivot_counts(df, "r", "s", ["p"])) == [("c", 0, 1), ("e", 2, 0)]


def test_histogram_includes_the_lowest_edge(rows):
    df = rows([(0.0,), (0.2,), (0.2001,), (1.0,)], "p double")
    assert values(R.histogram(df, "p", [0, 0.2, 1.0], ["low", "high"])) == [("high", 2), ("low", 2)]


def test_zero_variance(rows):
    df = rows([(1, 2), (1, 3)], "a int, b int")
    assert values(R.zero_variance(df, ["a", "b"])) == [("a",)]


def test_left_with_defaults(rows):
    base, feat = rows([(1,), (2,)], "k int"), rows([(1, 7)], "k int, v int")
    assert values(R.left_with_defaults(base, feat, "k", {"v": 0})) == [(1, 7), (2, 0)]


@pytest.mark.parametrize("range_rows", [7, 10_000])
def test_global_sequence_of_sparse_keys(spark, range_rows):
    keys = sorted(random.Random(3).sample(range(-(10**15), 10**15), 200))
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = R.global_sequence(df, "k", "seq", range_rows).orderBy("k").collect()
    assert [(r.k, r.seq) for r in got] == [(k, i + 1) for i, k in enumerate(keys)]


@pytest.mark.parametrize("range_rows", [3, 10_000])
def test_prefix_offsets(spark, range_rows):
    df = spark.createDataFrame([(i, i % 4) for i in range(40)], "k int, n int")
    got = {r.k: r.before for r in R.prefix_offsets(df, "k", "n", "before", range_rows).collect()}
    assert got == {i: sum(j % 4 for j in range(i)) for i in range(40)}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("range_rows", [2, 25, 60, 10_000])
def test_running_totals_match_a_plain_window(spark, range_rows, descending):
    rnd = random.Random(range_rows)
    data = [(g, s / 97, rnd.randrange(5), 1) for g in (0, 1) for s in rnd.sample(range(1000), 60)]
    df = spark.createDataFrame(data, "g int, s double, a bigint, b bigint")
    got = R.running_totals(df, "g", "s", ["a", "b"], descending, range_rows)
    for r in got.collect():
        earlier = [d for d in data if d[0] == r.g and ((d[1] > r.s) if descending else (d[1] < r.s))]
        assert r.a_before == sum(d[2] for d in earlier) and r.b_before == len(earlier)
        assert r.a_through == r.a_before + r.a and r.b_through == r.b_before + 1
    assert got.count() == len(data)


@pytest.mark.parametrize("range_rows", [40, 10_000])
def test_hash_ordered_rank_is_dense_per_group(spark, range_rows):
    df = spark.range(500).withColumn("g", (F.col("id") % 7 == 0).cast("int"))
    ranked = R.hash_ordered_rank(df, "g", F.md5(F.col("id").cast("string")), "id", "place", range_rows)
    for g, size in Counter(r.g for r in df.collect()).items():
        assert sorted(r.place for r in ranked.filter(F.col("g") == g).collect()) == list(range(1, size + 1))


@pytest.mark.parametrize("rows_, pieces", [(900, 1), (4_000, 4), (16_000, 16)])
def test_an_order_is_cut_into_as_many_ranges_as_its_rows_need(spark, rows_, pieces):
    df = spark.range(rows_).select((F.col("id") * 7919 % 100_003).alias("k"), F.lit(1).alias("n"))
    ranged = R.in_ranges(df, ["k"], 1_000)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) == pieces and max(sizes) < 3_000
    plan = R.prefix_offsets(df, "k", "n", "before", 1_000)._jdf.queryExecution().executedPlan().toString()
    # No search for a row's range, and no task that orders all rows.
    assert "aggregate(" not in plan and "lambda" not in plan and "SinglePartition" not in plan


def test_top_k_and_order(rows):
    df = rows([("b", 1), ("a", 3), ("c", 2)], "t string, n int")
    assert [r.t for r in R.top_k(df, [F.desc("n")], 2).collect()] == ["a", "c"]
    assert [r.t for r in R.order_by_category(df, "t", ["c", "b"]).collect()] == ["c", "b", "a"]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_look_up_equals_a_plain_join(rows, how):
    fact = rows([(i % 7 if i % 5 else None, i) for i in range(60)], "k int, v int")
    dim = rows([(k, f"d{k}") for k in range(4)], "k int, d string")
    assert values(R.look_up(fact, dim, "k", how)) == values(fact.join(dim, "k", how))


def test_named_in(rows):
    dim = rows([(1, "a"), (2, "b")], "k int, d string")
    assert values(R.named_in(dim, rows([(2,), (2,), (9,)], "k int"), "k")) == [(2, "b")]
