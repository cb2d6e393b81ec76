import datetime as dt
from decimal import Decimal

import pytest
from helpers import values
from pyspark.sql import functions as F

from churnkit import functions as X

AS_OF = dt.date(2024, 5, 31)


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_window_edges(rows):
    days = [90, 61, 60, 31, 30, 29, 0, -1]
    df = rows([(d, AS_OF - dt.timedelta(days=d)) for d in days], "age int, on date")
    got = {r[0]: tuple(r)[1:] for r in df.select(
        "age", X.since("on", AS_OF, 30), X.band("on", AS_OF, 60, 30), X.band("on", AS_OF, 90, 60), X.since("on", AS_OF, 90)
    ).collect()}
    assert got[90] == (False, False, True, True)
    assert got[61] == (False, False, True, True)
    assert got[60] == (False, True, False, True)
    assert got[31] == (False, True, False, True)
    assert got[30] == (True, False, False, True)
    assert got[-1] == (True, False, False, True)  # later rows count


def test_timestamp_is_compared_with_midnight(rows):
    df = rows([(dt.datetime(2024, 5, 1, 0, 0),), (dt.datetime(2024, 4, 30, 23, 59),)], "at timestamp")
    assert [r[0] for r in df.select(X.since("at", AS_OF, 30)).collect()] == [True, False]


def test_default_day_is_today(spark):
    assert one(spark, X.day(None) == F.current_date()) == (True,)
    assert one(spark, X.day("2024-05-31")) == (AS_OF,)


@pytest.mark.parametrize("value, expected", [(2.9, 2), (-2.9, -2), (0.0, 0)])
def test_trunc_int(spark, value, expected):
    assert one(spark, X.trunc_int(F.lit(value))) == (expected,)


@pytest.mark.parametrize("value, digits, expected", [(0.285, 2, 0.29), (2.675, 2, 2.68), (-0.285, 2, -0.29), (1.005, 2, 1.01)])
def test_round_dec_rounds_the_decimal_value(spark, value, digits, expected):
    assert one(spark, X.round_dec(F.lit(value), digits)) == (expected,)


def test_ratios(spark):
    assert one(spark, X.safe_ratio(F.lit(5), F.lit(0), 100), X.safe_ratio(F.lit(5), F.lit(4))) == (500.0, 1.25)
    assert one(spark, X.ratio_or_null(F.lit(5), F.lit(0)), X.ratio_or_null(F.lit(5), F.lit(2))) == (None, 2.5)


def test_num_reads_what_it_can(rows):
    df = rows([("1.5",), ("x",), (None,), ("NaN",)], "v string")
    assert [r[0] for r in df.select(X.num("v")).collect()] == [1.5, 0.0, 0.0, 0.0]


def test_exact_avg_skips_nulls_and_is_null_for_nothing(rows):
    df = rows([("a", 0.1), ("a", 0.2), ("a", None), ("b", None)], "k string, v double")
    got = dict(values(df.groupBy("k").agg(X.exact_avg("v"))))
    assert got["a"] == pytest.approx(0.15) and got["b"] is None


def test_conditional_aggregates(rows):
    df = rows([(1, True), (2, False), (3, None)], "v int, f boolean")
    assert tuple(df.agg(X.count_if(F.col("f")), X.sum_if(F.col("f"), "v"), X.avg_if(F.col("f"), "v")).first()) == (1, 1, 1.0)


def test_probability_tiers_are_closed_on_the_right(rows):
    df = rows([(p,) for p in (0.0, 0.4, 0.4001, 0.7, 0.7001, 1.0)], "p double")
    got = [r[0] for r in df.select(X.right_closed_bins("p", [0.4, 0.7, 1.001], ["Low", "Medium", "High"])).collect()]
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High"]


def test_health_tiers_are_closed_on_the_left(rows):
    df = rows([(p,) for p in (3999, 4000, 6499, 6500)], "p int")
    assert [r[0] for r in df.select(X.health_tier("p", 40, 65)).collect()] == ["High", "Medium", "Medium", "Low"]


def test_lookup_and_category_order(rows):
    df = rows([("b",), ("a",), ("z",), (None,)], "k string")
    got = values(df.select("k", X.lookup("k", {"a": 1, "b": 2}, 9), X.category_rank("k", ["b", "a"])))
    assert got == [("a", 1, 2), ("b", 2, 1), ("z", 9, 3), (None, 9, 3)]


def test_text_helpers(spark):
    assert one(spark, X.percent_text(F.lit(0.8215)), X.percent_text(F.lit(None).cast("double"))) == ("82.2%", "N/A")
    assert one(spark, X.amount_text(F.lit(12345.5), "EUR"), X.amount_text(F.lit(None).cast("int"), "EUR")) == ("12,346 EUR", "N/A")
    assert one(spark, X.normalise_email(F.lit("  A@X.Com "))) == ("a@x.com",)
    assert one(spark, X.quarter_label(F.lit(AS_OF))) == ("Q2-2024",)


def test_first_words_keeps_short_texts_and_line_breaks(spark):
    assert one(spark, X.first_words(F.lit("a b\nc d"), 3), X.first_words(F.lit("a b"), 3)) == ("a b\nc", "a b")
    long = " ".join(["word"] * 5000)
    assert len(one(spark, X.first_words(F.lit(long), 400))[0].split()) == 400


def test_pick_is_null_outside_the_list(spark):
    assert one(spark, X.pick(["a", "b"], F.lit(1)), X.pick(["a", "b"], F.lit(5))) == ("b", None)


def test_seeded_int_equals_spark_hash_and_survives_large_ids(spark):
    df = spark.range(1, 200).withColumn("h", F.pmod(F.hash((F.col("id") * 31).cast("int")), F.lit(97)))
    assert df.filter(X.seeded_int("id", 31, 97) != F.col("h")).count() == 0
    assert 0 <= one(spark, X.seeded_int(F.lit(10**12), 31, 97))[0] < 97


FACTORS = {"a": 0.5, "b": -0.9, "c": 0.5, "d": 0.1, "e": -0.00004, "f": 0.2}


def test_factors_are_ordered_by_size_then_name(rows):
    df = rows([(FACTORS,), ({},), (None,)], "m map<string,double>")
    got = [r[0] for r in df.select(X.factors_json("m", 3)).collect()]
    assert got == ['{"b":-0.9,"a":0.5,"c":0.5}', "{}", None]
    assert [r[0] for r in df.select(X.factor_names("m", 2)).collect()] == [["b", "a"], [], []]


def test_factors_survive_bad_text(rows):
    df = rows([('{"x":1.0}',), ("nope",), (None,)], "t string")
    assert [r[0] for r in df.select(X.factor_names(X.parse_factors("t"))).collect()] == [["x"], [], []]


def test_factors_are_rounded_to_four_digits(rows):
    df = rows([({"a": 0.123456},)], "m map<string,double>")
    assert df.select(X.factors_json("m")).first()[0] == '{"a":0.1235}'


def test_exact_sum_does_not_depend_on_order(rows):
    df = rows([(0.1,)] * 10 + [(1e9,)], "v double")
    assert df.agg(X.exact_sum("v")).first()[0] == Decimal("1000000001.0000000000")


def test_averages_keep_small_and_large_values(rows):
    df = rows([("a", 0.00004), ("a", 0.00004), ("b", 1e15), ("b", 3e15)], "k string, v double")
    assert dict(values(df.groupBy("k").agg(X.exact_avg("v")))) == {"a": 0.00004, "b": 2e15}
