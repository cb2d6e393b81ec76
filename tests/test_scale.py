"""Plan shapes that must hold at scale, and results on data where one key owns a third of the rows."""

import pathlib
import re

import pytest
from helpers import values
from pyspark.sql import functions as F

from churnkit import session
from churnkit.operators import conform, health
from churnkit.operators import relational as R
from churnkit.plans import registry
from churnkit.plans.catalogue import QUERIES
from churnkit.plans.medallion import quality_reports, run_all
from churnkit.plans.registry import Source
from churnkit.sources.adapters import AS_OF, EVENT_TYPES

FOLDER = "/root/testdata/sf0.001"
PACKAGE = pathlib.Path(__file__).parent.parent / "churnkit"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The adapted plan, after running the query that this very frame holds."""
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_library_neither_collects_rows_nor_pins_them_to_one_machine():
    allowed = {"explain.py": {"toPandas"}, "train.py": {"collect()"}}  # the nodes of one model, a row per fold
    for path in PACKAGE.rglob("*.py"):
        if "llm" in path.parts:  # stands alone and has tests of its own
            continue
        text = path.read_text()
        for word in ("localCheckpoint", "collect()", "toPandas", "crossJoin", ".rdd", "coalesce(1)", "repartition(1)"):
            if word in allowed.get(path.name, ()):
                continue
            assert word not in text, (path.name, word)


@pytest.mark.parametrize("name", ["silver_tickets", "silver_events", "health_nps", "rank_within", "top_n_per_key", "feat_nps"])
def test_ranking_is_cut_down_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert re.search(r"WindowGroupLimit .*Partial", plan) and re.search(r"WindowGroupLimit .*Final", plan)


def test_only_measured_rows_are_broadcast(spark, tmp_path):
    session.tune(spark)
    wide = [F.lit(f"text {i}").alias(f"text_{i}") for i in range(10)]
    for name, n in (("large", 600_000), ("small", 2_000)):
        spark.range(n).select(F.col("id").alias("company_id"), *wide).repartition(2).write.parquet(f"{tmp_path}/{name}")
    large, small = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("large", "small"))
    expected = int(str(large.select("company_id")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert expected < 600_000 * 16 / 3  # by its files the list of keys seems far smaller than it is
    facts = spark.range(1_500_000).select((F.col("id") % 700_000).alias("company_id"), F.col("id").alias("fact_id"))
    checked = R.fk_valid(facts, large, "company_id")
    assert "BroadcastHashJoin" not in plan_of(checked) and "BroadcastHashJoin" not in final_plan(checked)
    assert "BroadcastHashJoin" in final_plan(R.fk_valid(facts, small, "company_id"))


def test_facts_are_never_put_into_one_partition(spark):
    for name in ("company_health", "feature_store", "ml_folds", "global_sequence", "gen_surrogate"):
        plan = plan_of(QUERIES[name](spark, FOLDER))
        for block in plan.split("Exchange SinglePartition")[1:]:
            below = block.splitlines()[1]
            # Only summed rows, or the few sampled keys that each task keeps.
            assert "HashAggregate" in below or re.search(r"WindowGroupLimit .*Partial", below), (name, block[:300])


@pytest.mark.parametrize("name", ["feature_store", "feat_usage", "feat_contract", "feat_label", "ml_class_balance"])
def test_features_are_summed_by_hash_in_one_pass(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "SortAggregate" not in plan and "Expand" not in plan and "ObjectHashAggregate" not in plan


def test_gold_reads_only_the_columns_it_needs(spark):
    plan = plan_of(QUERIES["company_health"](spark, FOLDER))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert any("event_date" in s for s in scans)
    assert all("subject" not in s and "comment" not in s and "contact_id" not in s for s in scans)


@pytest.mark.parametrize("name,most", [("agent_performance", 9), ("action_context", 16), ("queue_to_pending", 16), ("pending_review", 9), ("rowcount_report", 40)])
def test_gold_is_planned_on_stored_silver(spark, name, most):
    """No plan goes back to the given tables for what is conformed already, except for raw counts, predictions and actions."""
    plan = plan_of(QUERIES[name](spark, FOLDER))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert len(scans) <= most
    if name != "rowcount_report":
        assert not any("o_orderkey" in s or "l_orderkey" in s for s in scans)


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["silver_nps"](spark, FOLDER))
    assert "IsNotNull(l_orderkey)" in plan


def skewed(spark, n=30000):
    """A third of the rows belongs to key 0."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).cast("int").alias("k"), F.col("id").alias("v"),
        F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 256)).alias("note"),
    )


@pytest.fixture()
def small_limits(spark):
    """Limits so low that a few thousand rows count as a skewed partition and nothing is broadcast."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_key_is_split_in_a_key_check(spark, small_limits):
    fact = skewed(spark).repartition(8, "v")
    dim = spark.range(0, 997, 2).select(F.col("id").cast("int").alias("k"))
    kept = R.fk_valid(fact, dim, "k")
    assert "skew=true" in final_plan(kept)
    assert kept.count() == fact.filter("k % 2 = 0").count()


def test_a_key_check_without_a_hot_key_copies_nothing(spark, small_limits):
    fact = spark.range(3000).select((F.col("id") % 997).cast("int").alias("k"), F.col("id").alias("v")).repartition(8, "v")
    dim = spark.range(0, 997, 2).select(F.col("id").cast("int").alias("k"))
    plan = final_plan(R.fk_valid(fact, dim, "k"))
    assert "skew=true" not in plan and "Generate" not in plan and "Expand" not in plan


def test_shares_of_many_values_stay_spread(spark):
    groups = spark.range(5000).groupBy((F.col("id") % 2500).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    plan = plan_of(R.with_share(groups))
    main = plan.split("Subquery")[0]
    assert "Window" not in plan and "SinglePartition" not in main
    assert R.with_share(groups).agg(F.sum("pct")).first()[0] == 0.0  # 0.04 % each, to one digit


def test_a_hot_company_is_split_in_the_contract_lookup(spark, small_limits):
    raw = skewed(spark).repartition(8, "v").select(
        F.col("k").alias("company_id"), F.col("v").alias("subscription_id"), (F.col("v") % 7 + 1).alias("mrr"),
        F.date_add(F.lit(AS_OF), -(F.col("v") % 50).cast("int")).alias("start_date"), F.lit(AS_OF).alias("end_date"),
        F.lit("active").alias("status"), F.lit("annual").alias("billing_cycle"), F.lit(AS_OF).alias("_ingested_at"), "note",
    )
    contracts = conform.fact_subscriptions(raw, None)
    assert "skew=true" in final_plan(contracts)
    current = health.current_contract(contracts)
    newest = raw.groupBy("company_id").agg(F.max(F.struct("start_date", "subscription_id")).alias("m"))
    assert values(current.select("company_id", "subscription_id")) == values(newest.select("company_id", "m.subscription_id"))


def test_results_hold_with_a_hot_key(spark):
    df = skewed(spark, 9000)
    copies = df.withColumn("v", F.when(F.col("k") == 0, 7).otherwise(F.col("v")))
    assert R.dedup_latest(copies, ["v"], ["k"]).count() == copies.select("v").distinct().count()
    top = R.top_n_per_key(df, ["k"], [F.desc("v")], 2).filter("k = 0")
    assert sorted(r.v for r in top.collect()) == sorted(r.v for r in df.filter("k = 0").orderBy(F.desc("v")).limit(2).collect())
    assert R.global_sequence(df.select("v"), "v", "n", 700).agg(F.max("n")).first()[0] == 9000


def test_whole_job_stores_every_layer(spark, tmp_path):
    stored = run_all(spark, Source(spark, FOLDER).raw, str(tmp_path), AS_OF, EVENT_TYPES)
    assert len(stored) == 19
    silver_keys = {"dim_companies": "company_id", "dim_contacts": "contact_id", "fact_subscriptions": "subscription_id",
                   "fact_support_tickets": "ticket_id", "fact_product_events": "event_id", "fact_nps_scores": "survey_id"}
    for name, key in silver_keys.items():
        df = stored[("SILVER", name)]
        assert df.count() == df.select(key).distinct().count() == df.filter(F.col(key).isNotNull()).count()
    companies = stored[("SILVER", "dim_companies")]
    for gold in ("agg_company_health_score", "feature_store_churn"):
        df = stored[("GOLD", gold)]
        assert df.count() == companies.count() == df.select("company_id").distinct().count()
    health = stored[("GOLD", "agg_company_health_score")]
    for c in ("usage_score", "support_score", "nps_score", "payment_score", "engagement_trend", "health_score"):
        assert health.filter(~F.col(c).between(0, 100)).count() == 0
    # The stored way and the plan straight from raw agree.
    direct = QUERIES["company_health"](spark, FOLDER)
    same = health.select(direct.columns)
    assert same.exceptAll(direct).count() == 0 and direct.exceptAll(same).count() == 0
    reports = quality_reports(stored)
    assert reports["rowcount"].count() == 19 and reports["rowcount"].filter("quality_status like 'OK (empty%'").count() == 2 and reports["null_keys"].agg(F.sum("violations")).first()[0] == 0
    assert abs(reports["tiers"].agg(F.sum("pct")).first()[0] - 100) < 0.3


@pytest.mark.parametrize("name", ["kpi_summary", "portfolio_stats", "pending_total", "all_actions"])
def test_reports_do_not_read_facts_they_do_not_show(spark, name):
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan_of(QUERIES[name](spark, FOLDER)))
    assert scans and not any("event_date" in s or "survey_date" in s or "l_orderkey" in s for s in scans)


def test_a_large_shuffle_is_cut_by_its_size(spark, small_limits, monkeypatch):
    """Few shuffle partitions must not make a task sort a share of the table that grows with it."""
    for name, value in (("advisoryPartitionSizeInBytes", "100KB"), ("coalescePartitions.minPartitionSize", "10KB")):
        monkeypatch.setitem(session.RUNTIME_CONF, f"spark.sql.adaptive.{name}", value)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    session.tune(spark)
    newest = R.dedup_latest(skewed(spark).repartition(8), ["v"], ["k"])
    pieces = newest.rdd.getNumPartitions()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert pieces > 8 and newest.count() == 30000


def test_copies_that_differ_in_their_source_only_are_not_told_apart(rows):
    raw = rows([(1, 7, "a", "x"), (1, 7, "a", None), (2, 5, None, "y")], "k int, _ingested_at int, v string, _source string")
    kept = conform._unique(raw, "k")
    assert values(kept) == [(1, "a"), (2, None)] and "_source" not in plan_of(kept).split("Exchange")[0]


def test_model_and_review_queries_store_lean_facts(spark, monkeypatch):
    monkeypatch.setattr(registry, "_SILVER", {})
    source = Source(spark, FOLDER)
    lean = source.lean
    assert not {"subject", "description", "category"} & set(lean.tickets.columns) and "company_name" in lean.companies.columns
    features, health_ = (df.drop("feature_computed_at", "computed_at") for df in (lean.features, lean.health))
    for mine, whole in ((features, source.gold.features), (health_, source.gold.health)):
        whole = whole.select(mine.columns)
        assert mine.count() and mine.exceptAll(whole).count() == 0 and whole.exceptAll(mine).count() == 0
    assert Source(spark, FOLDER).lean.tickets.columns == source.gold.tickets.columns  # what is stored whole is not stored again
