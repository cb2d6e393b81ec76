import datetime as dt

from helpers import values
from pyspark.sql import functions as F

from churnkit.operators import datagen as G


def test_ids_and_cohorts(spark):
    df = G.gen_ids(spark, 10).withColumn("c", G.cohort("id", [3, 5], ["a", "b", "rest"]))
    assert [tuple(r) for r in df.groupBy("c").count().orderBy("c").collect()] == [("a", 3), ("b", 2), ("rest", 5)]
    assert dict(df.dtypes)["id"] == "bigint"


def test_children_are_numbered_over_all_parents(rows):
    parents = rows([(1, 2), (2, 0), (3, 3)], "id int, k int")
    got = G.numbered_fan_out(parents, "id", "k").orderBy("number")
    assert [(r.id, r.n, r.number) for r in got.collect()] == [(1, 1, 1), (1, 2, 2), (3, 1, 3), (3, 2, 4), (3, 3, 5)]


def test_ids_and_numbers_beyond_32_bits(rows):
    big = 2**31 + 5
    parents = rows([(big, 2), (big + 1, 1)], "id long, k int")
    got = G.numbered_fan_out(parents, "id", "k").select(F.max("id"), F.max("number")).first()
    assert tuple(got) == (big + 1, 3)
    before = rows([(1, 2**31), (2, 3)], "id long, k long")
    from churnkit.operators.relational import prefix_offsets

    assert prefix_offsets(before, "id", "k", "at").agg(F.max("at")).first()[0] == 2**31


def test_keys_and_ids(rows):
    df = rows([(7,)], "n int").select(G.surrogate_key("ROW-", "n", 7), G.synthetic_uuid("n"))
    key, uid = df.first()
    assert key == "ROW-0000007" and [len(p) for p in uid.split("-")] == [8, 4, 4, 4, 12]


def test_offsets_lean(spark):
    df = G.gen_ids(spark, 3000).withColumn("c", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.pmod("id", F.lit(3)) + 1).cast("int")))
    d = df.withColumn("d", G.offset_days("c", "id", {"a": "early", "b": "late"}, 100, (31, 37)))
    r = {x.c: x for x in d.groupBy("c").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.avg("d").alias("mean")).collect()}
    assert all(x.lo >= 0 and x.hi < 100 for x in r.values())
    assert r["a"].mean < 40 < r["c"].mean < 60 < r["b"].mean


def test_trend_score_is_clamped(spark):
    df = G.gen_ids(spark, 50).select("id", G.trend_score("id", F.lit(50), 0.5, -3.0, F.lit(0.0), -1.0, 1.0).alias("s"))
    assert df.filter("s < -1 or s > 1").count() == 0
    assert df.filter("id = 1").first().s == 0.5 and df.filter("id = 50").first().s == -1.0


def test_draws_of_different_names_differ(spark):
    df = G.gen_ids(spark, 1000).select(G.draw("id", "x", 10).alias("x"), G.draw("id", "y", 10).alias("y"))
    assert 50 < df.filter("x = y").count() < 200


def test_history_is_one_plan_lower_and_one_year_earlier(spark):
    current = spark.sql("SELECT 1 AS id, 'Enterprise' AS plan_type, DATE '2024-02-29' AS start_date, 'active' AS status")
    got = G.with_history(current, F.col("id") == 1, {"Enterprise": "Business"}, 365, "churned")
    assert values(got.select("plan_type", "start_date", "status", "contract_version")) == [
        ("Business", dt.date(2023, 3, 1), "churned", 2), ("Enterprise", dt.date(2024, 2, 29), "active", 1)
    ]
