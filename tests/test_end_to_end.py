"""From generated raw tables to reviewed actions and reports, with string keys as in production."""

import datetime as dt

import pytest
from helpers import values
from pyspark.sql import functions as F

from churnkit.ml import matrix, metrics, select, train
from churnkit.operators import actions as A
from churnkit.operators import reports as P
from churnkit.operators.sample import sample_raw
from churnkit.plans.medallion import quality_reports, run_all
from churnkit.schemas import ACTIONS, PREDICTIONS
from churnkit.sources import tables as io

AS_OF = dt.date(2024, 5, 31)
NOW = dt.datetime(2024, 5, 31, 8, 0)
N = 300


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    stored = run_all(spark, sample_raw(spark, N, AS_OF), root, AS_OF)
    io.write_table(io.create_empty(spark, PREDICTIONS), root, "gold", "agg_churn_predictions", ["prediction_date"])
    io.write_table(io.create_empty(spark, ACTIONS), root, "gold", "agg_retention_actions")
    return root, {name: df for (_, name), df in stored.items()}, stored


def test_layers(lake):
    _, t, stored = lake
    assert t["dim_companies"].count() == t["feature_store_churn"].count() == N
    assert t["fact_subscriptions"].filter("is_current_contract").count() == N
    assert 0 < t["feature_store_churn"].agg(F.sum("is_churned")).first()[0] < N / 2
    tiers = {r.risk_tier for r in t["agg_company_health_score"].select("risk_tier").distinct().collect()}
    assert tiers == {"High", "Medium", "Low"}
    assert quality_reports(stored)["null_keys"].agg(F.sum("violations")).first()[0] == 0


def test_the_generated_data_is_the_same_every_time(spark):
    def rows():
        return values(sample_raw(spark, 20, AS_OF)["events"].drop("_ingested_at"))

    assert rows() == rows()


def test_scoring_queue_and_review(spark, lake, tmp_path):
    root, t, _ = lake
    features = matrix.model_matrix(t["feature_store_churn"])
    model = train.train_gbt(features, {"maxIter": 5, "stepSize": 0.3, "maxDepth": 3})
    scored = train.score(model, features, AS_OF, "churn_gbt", "1", str(tmp_path / "model"))
    assert metrics.roc_auc(scored, "churn_probability", "actual_churn").first().roc_auc > 0.6
    for _ in range(2):
        select.store_predictions(scored, root, AS_OF)
    predictions = io.read_table(spark, root, "gold", "agg_churn_predictions")
    assert predictions.count() == N and predictions.filter("top_factors is null").count() == 0

    health, companies = t["agg_company_health_score"], t["dim_companies"]
    picked = A.risk_candidates(predictions, companies, health, tier="All", n=30)
    context = A.company_context(
        picked, t["dim_contacts"], t["fact_support_tickets"], t["fact_nps_scores"], t["fact_subscriptions"], t["dim_cs_agents"]
    )
    decisions = A.decide_action(context)
    assert decisions.count() == 30
    actions = io.read_table(spark, root, "gold", "agg_retention_actions")
    queued = io.rewrite_table(A.enqueue(actions, decisions, NOW), root, "gold", "agg_retention_actions")
    assert values(queued.groupBy("status").count()) == [("queued", 30)]

    flat = A.action_context(
        queued, companies, health, t["dim_contacts"], t["fact_support_tickets"], t["fact_nps_scores"], t["fact_subscriptions"],
        t["dim_cs_agents"], predictions,
    )
    moved = A.queue_to_pending(queued, flat, NOW)
    assert A.invalid_transitions(queued, moved).count() == 0
    pending = io.rewrite_table(moved, root, "gold", "agg_retention_actions")
    assert values(pending.groupBy("status").count()) == [("pending", 30)]
    assert pending.filter("contact_id is null or agent_id is null or length(generated_content) < 40").count() == 0
    assert pending.groupBy("company_id", "action_type").count().filter("count > 1").count() == 0

    view = A.review_view(pending, companies, health, predictions, t["dim_contacts"], t["dim_cs_agents"])
    first = A.pending_review(view, limit=10)
    assert first.count() == 10 and P.action_card(first).count() == 10
    reviewed = A.bulk_review(pending, first, NOW)
    assert P.action_stats(reviewed).first().approved == 10
    assert P.action_stats(A.update_outcome(reviewed, F.col("status") == "approved", "saved", NOW)).first().saved == 10
    kpis = P.kpi_summary(predictions, reviewed, health).first()
    assert (kpis.total_companies, kpis.pending_actions, kpis.approved_actions) == (N, 20, 10) and kpis.mrr_at_risk > 0
    scored_view = P.scored_companies(predictions, companies, health)
    assert P.predictions_view(scored_view, min_prob=0.0).count() == N
    assert P.portfolio_text(predictions, companies, health, reviewed).filter("section = 2 and line_no > 0").count() == 10
