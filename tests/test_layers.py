import datetime as dt
import random

import pytest
from helpers import values
from pyspark.sql import functions as F

from churnkit.operators import agent_kpis as K
from churnkit.operators import conform as C
from churnkit.operators import features as FS
from churnkit.operators import health as H
from churnkit.operators import quality as Q
from churnkit.schemas import MODEL_INPUTS, NUMERIC_FEATURES

AS_OF = dt.date(2024, 5, 31)
T0 = dt.datetime(2024, 6, 1)


def ago(days):
    return AS_OF - dt.timedelta(days=days)


def at(days):
    return dt.datetime.combine(ago(days), dt.time())


# --- conforming ---------------------------------------------------------------------

def test_companies_are_valid_unique_and_without_simulation_columns(rows):
    raw = rows(
        [("c1", "PME", 10, "p", at(100), T0), ("c1", "PME", 20, "p", at(100), T0), ("c2", "XL", 5, "p", at(9), T0),
         ("c3", "GE", 0, "p", at(9), T0), (None, "GE", 5, "p", at(9), T0), ("c4", "TPE", 7, "p", at(5), T0)],
        "company_id string, company_size string, base_mrr int, churn_profile string, subscription_start_date timestamp, _ingested_at timestamp",
    ).withColumn("assigned_cs_agent_id", F.lit("a1"))
    subs = rows([("c1", "churned"), ("c1", "active"), ("c4", "churned")], "company_id string, status string")
    got = C.dim_companies(raw, subs)
    assert "churn_profile" not in got.columns and "_ingested_at" not in got.columns
    assert values(got.select("company_id", "base_mrr", "customer_since", "is_active")) == [
        ("c1", 20, ago(100), True), ("c4", 7, ago(5), False)
    ]
    assert values(C.company_keys(raw)) == [("c1",), ("c4",)]
    lean = C.dim_companies(raw, None, lean=True)
    assert values(lean.select("company_id", "base_mrr")) == [("c1", 20), ("c4", 7)]


def test_contacts_need_an_email_and_a_known_company(rows):
    raw = rows(
        [(1, "c1", " A@B.C ", at(1), T0), (2, "c1", None, at(1), T0), (3, "zz", "x@y.z", at(1), T0), (None, "c1", "q@q.q", at(1), T0)],
        "contact_id int, company_id string, email string, created_at timestamp, _ingested_at timestamp",
    )
    assert values(C.dim_contacts(raw, rows([("c1",)], "company_id string")).select("contact_id", "email")) == [(1, "a@b.c")]


def subscriptions(rows, data):
    return rows(
        [(i, c, m, ago(s), ago(s) + dt.timedelta(days=d), st, "annual", T0) for i, c, m, s, d, st in data],
        "subscription_id int, company_id string, mrr int, start_date date, end_date date, status string, billing_cycle string, _ingested_at timestamp",
    )


def test_current_contract_follows_the_newest_raw_start(rows):
    raw = subscriptions(rows, [
        (1, "c1", 10, 100, 365, "active"), (2, "c1", 20, 400, 365, "churned"),
        (3, "c2", 5, 200, 30, "active"), (4, "c2", 0, 50, 30, "active"),      # newest raw row is invalid
        (5, "c3", 7, 10, 30, "active"), (6, "c3", 9, 10, 30, "churned"),      # tie on the newest start
        (7, "zz", 7, 10, 30, "active"),
    ])
    companies = rows([("c1",), ("c2",), ("c3",)], "company_id string")
    got = C.fact_subscriptions(raw, companies)
    flags = {r.subscription_id: (r.is_current_contract, r.duration_days) for r in got.collect()}
    assert flags == {1: (True, 365), 2: (False, 365), 3: (False, 30), 5: (True, 30), 6: (True, 30)}
    assert values(H.current_contract(got).select("company_id", "subscription_id")) == [("c1", 1), ("c3", 6)]


@pytest.mark.parametrize("score, expected", [(0.2, "positive"), (0.19, "neutral"), (-0.19, "neutral"), (-0.2, "negative")])
def test_sentiment_edges(spark, score, expected):
    assert spark.range(1).select(C.sentiment_class(F.lit(score))).first()[0] == expected


@pytest.mark.parametrize("score, expected", [(6, "detractor"), (7, "passive"), (8, "passive"), (9, "promoter")])
def test_nps_edges(spark, score, expected):
    assert spark.range(1).select(C.nps_class(F.lit(score))).first()[0] == expected


def tickets(rows, data):
    return rows(
        [(i, c, p, st, s, at(d), h, "a1", T0) for i, c, p, st, s, d, h in data],
        "ticket_id int, company_id string, priority string, status string, sentiment_score double, created_at timestamp, ttr_hours int, assigned_agent_id string, _ingested_at timestamp",
    )


def test_ticket_flags(rows):
    raw = tickets(rows, [(1, "c1", "P1", "open", 0.5, 1, 4), (2, "c1", "P3", "open", 0.0, 1, 4), (3, "c1", "P2", "closed", -0.5, 1, 4)])
    got = {r.ticket_id: (r.sentiment_category, r.is_escalated) for r in C.fact_tickets(raw, None, lean=True).collect()}
    assert got == {1: ("positive", True), 2: ("neutral", False), 3: ("negative", False)}


def nps(rows, data):
    return rows([(i, c, s, ago(d), T0) for i, c, s, d in data],
                "survey_id int, company_id string, nps_score int, survey_date date, _ingested_at timestamp")


def test_nps_scores_outside_the_range_are_dropped(rows):
    got = C.fact_nps(nps(rows, [(1, "c1", 11, 1), (2, "c1", 10, 1), (3, "c1", -1, 1)]), None, lean=True)
    assert values(got.select("survey_id", "nps_category")) == [(2, "promoter")]


def events(rows, data):
    return rows([(i, c, t, dt.datetime.combine(ago(d), dt.time(13, 5)), u, T0) for i, (c, t, d, u) in enumerate(data)],
                "event_id int, company_id string, event_type string, event_timestamp timestamp, contact_id int, _ingested_at timestamp")


def test_events_get_date_and_hour(rows):
    got = C.fact_events(events(rows, [("c1", "a", 3, 1)]), rows([("c1",)], "company_id string"))
    assert values(got.select("event_date", "event_hour")) == [(ago(3), 13)]


# --- health -------------------------------------------------------------------------

def silver_events(rows, data):
    return C.fact_events(events(rows, data), None)


def test_usage_activity_counts_bands_and_types(rows):
    data = [("c1", "a", d, 1) for d in (0, 30, 31, 60, 61, 90, 91)] + [("c1", "b", 5, 1), ("c1", "c", 45, 1), ("c2", "a", 200, 1)]
    got = values(H.usage_activity(silver_events(rows, data), AS_OF).select(
        "company_id", "events_30d", "events_90d", "events_30_60d", "distinct_features_30d", "last_event_date"))
    assert got == [("c1", 3, 8, 3, 2, ago(0)), ("c2", 0, 0, 0, 0, ago(200))]


@pytest.mark.parametrize("e30, e90, expected", [(0, 0, 0), (1, 2, 59), (5, 9, 100), (3, 30, 27), (None, None, 0), (0, 3, 0)])
def test_usage_score(spark, e30, e90, expected):
    cols = [F.lit(v).cast("bigint") for v in (e30, e90)]
    assert spark.range(1).select(H.usage_score(*cols)).first()[0] == expected


@pytest.mark.parametrize("t, p, s, expected", [(0, 0, 1.0, 100), (2, 1, -0.5, 65), (50, 0, 0.0, 0), (None, None, None, 100), (1, 0, 0.1, 97)])
def test_support_score(spark, t, p, s, expected):
    cols = F.lit(t).cast("bigint"), F.lit(p).cast("bigint"), F.lit(s).cast("double")
    assert spark.range(1).select(H.support_score(*cols)).first()[0] == expected


@pytest.mark.parametrize("e30, before, expected", [(3, 0, 50), (5, 2, 65), (2, 5, 35), (90, 1, 100), (0, 90, 0), (4, 4, 50)])
def test_engagement_trend(spark, e30, before, expected):
    assert spark.range(1).select(H.engagement_trend(F.lit(e30), F.lit(before))).first()[0] == expected


def test_composite_uses_the_uncut_sum_for_the_tier(rows):
    schema = "company_id string, usage_score int, support_score int, nps_score int, payment_score int, engagement_trend int"
    df = rows([("a", 0, 100, 40, 30, 24), ("b", 0, 100, 40, 30, 30), ("c", 1, 99, 80, 100, 92), ("d", 100, 100, 100, 100, 100)], schema)
    got = {r.company_id: (r.health_score, r.risk_tier) for r in H.with_health_score(df).collect()}
    # a: 39.9, b: 40.5, c: 65.25
    assert got == {"a": (39, "High"), "b": (40, "Medium"), "c": (65, "Low"), "d": (100, "Low")}


def test_company_without_facts_gets_the_defaults(rows):
    companies = rows([("c1",)], "company_id string")
    subs = C.fact_subscriptions(subscriptions(rows, [(1, "other", 1, 1, 30, "active")]), None, lean=True)
    got = H.company_health(
        companies, silver_events(rows, [("other", "a", 1, 1)]), C.fact_tickets(tickets(rows, [(1, "other", "P1", "open", 0.0, 1, 1)]), None, True),
        C.fact_nps(nps(rows, [(1, "other", 5, 1)]), None, True), subs, AS_OF,
    ).first()
    assert (got.usage_score, got.support_score, got.nps_score, got.payment_score, got.engagement_trend) == (0, 100, 50, 50, 50)
    assert (got.nps_latest, got.events_30d, got.avg_sentiment_30d, got.mrr, got.contract_status) == (5, 0, 0.0, None, None)
    # 25 + 10 + 7.5 + 5 = 47.5
    assert (got.health_score, got.risk_tier) == (47, "Medium") and got.last_computed_at is not None


@pytest.mark.parametrize("status, pct", [("active", 100), ("churned", 30), ("downgraded", 30), ("renewed", 70), ("upgraded", 70)])
def test_payment_health(rows, status, pct):
    subs = C.fact_subscriptions(subscriptions(rows, [(1, "c1", 9, 10, 30, status)]), None, lean=True)
    assert values(H.contract_state(subs, AS_OF).select("payment_health_pct", "days_to_renewal")) == [(pct, 20)]


# --- features -----------------------------------------------------------------------

def test_usage_features(rows):
    data = [("c1", "a", 1, 7), ("c1", "a", 1, 8), ("c1", "b", 2, 7), ("c1", "a", 40, 9), ("c1", "z", 70, 9), ("c1", "z", 300, 1), ("c2", "a", 100, 1)]
    got = {r.company_id: r for r in FS.usage_features(silver_events(rows, data), AS_OF).collect()}
    r = got["c1"]
    assert (r.dau_last_30d, r.dau_last_90d, r.events_30d, r.events_30_60d, r.events_60_90d, r.events_90d) == (2, 4, 3, 1, 1, 5)
    assert (r.distinct_features_used_30d, r.feature_adoption_rate, r.days_since_last_login, r.active_users_30d) == (2, 0.133, 1, 2)
    assert (got["c2"].events_90d, got["c2"].dau_last_90d, got["c2"].days_since_last_login) == (0, 0, 100)


@pytest.mark.parametrize("now, before, expected", [(5, 0, 0.0), (5, 10, -50.0), (4, 3, 33.33), (None, 4, -100.0)])
def test_decline_30d(spark, now, before, expected):
    assert spark.range(1).select(FS.decline_30d(F.lit(now).cast("bigint"), F.lit(before).cast("bigint"))).first()[0] == expected


@pytest.mark.parametrize("e90, before, expected", [(9, 0, 0.0), (9, 3, 0.0), (10, 3, 11.11), (3, 4, -75.0)])
def test_decline_90d(spark, e90, before, expected):
    assert spark.range(1).select(FS.decline_90d(F.lit(e90).cast("bigint"), F.lit(before).cast("bigint"))).first()[0] == expected


def test_support_features(rows):
    raw = tickets(rows, [(1, "c1", "P1", "open", 0.5, 1, 10), (2, "c1", "P2", "closed", 0.25, 20, 5), (3, "c1", "P1", "in_progress", -0.5, 80, 3), (4, "c1", "P4", "closed", 0.9, 200, 1)])
    r = FS.support_features(C.fact_tickets(raw, None, True), AS_OF).first()
    assert (r.ticket_count_30d, r.ticket_count_90d, r.ticket_velocity_14d, r.p1_ticket_count_30d) == (2, 3, 1, 1)
    assert (r.avg_ticket_sentiment_30d, r.avg_ticket_sentiment_90d, r.avg_ttr_hours_30d) == (0.375, 0.083, 7.5)
    assert (r.open_ticket_count, r.escalation_count_90d) == (2, 2)


def test_nps_features(rows):
    raw = nps(rows, [(1, "c1", 9, 90), (2, "c1", 4, 1), (3, "c1", 10, 200), (4, "c2", 7, 3)])
    got = values(FS.nps_features(C.fact_nps(raw, None, True)))
    assert got == [("c1", 4, 9, -5, 1), ("c2", 7, 7, 0, 0)]


def test_contract_features_and_label(rows):
    raw = subscriptions(rows, [(1, "c1", 100, 10, 365, "downgraded"), (2, "c1", 150, 400, 365, "upgraded"), (3, "c1", 120, 800, 365, "upgraded"), (4, "c2", 50, 10, 30, "churned")])
    subs = C.fact_subscriptions(raw, None, lean=True)
    got = {r.company_id: r for r in FS.contract_features(subs, AS_OF).collect()}
    assert (got["c1"].mrr_trend_90d, got["c1"].upgrade_count, got["c1"].has_downgraded, got["c1"].days_to_renewal) == (-33.33, 2, 1, 355)
    assert (got["c2"].mrr_trend_90d, got["c2"].upgrade_count) == (0.0, 0)
    assert values(FS.churn_label(subs)) == [("c1", 0), ("c2", 1)]


def test_feature_store_has_all_inputs_and_defaults(rows):
    companies = rows([("c1", "ETI", ago(100))], "company_id string, company_size string, customer_since date")
    other = "other"
    r = FS.feature_store(
        companies, silver_events(rows, [(other, "a", 1, 1)]), C.fact_tickets(tickets(rows, [(1, other, "P1", "open", 0.0, 1, 1)]), None, True),
        C.fact_nps(nps(rows, [(1, other, 5, 1)]), None, True), C.fact_subscriptions(subscriptions(rows, [(1, other, 1, 1, 30, "active")]), None, True),
        rows([(1, other, True)], "contact_id int, company_id string, is_decision_maker boolean"), AS_OF,
    ).first().asDict()
    assert len(NUMERIC_FEATURES) == 32 and len(MODEL_INPUTS) == 33
    assert set(NUMERIC_FEATURES) <= set(r)
    assert (r["days_since_last_login"], r["nps_latest"], r["billing_cycle"], r["is_churned"]) == (9999, 5, "unknown", 0)
    assert (r["company_size_encoded"], r["customer_tenure_days"], r["active_users_ratio"]) == (3, 100, 0.0)


# --- account managers and quality -----------------------------------------------------

def test_agent_performance(rows):
    companies = rows([("c1", "a1"), ("c2", "a1"), ("c3", "a2")], "company_id string, assigned_cs_agent_id string")
    subs = C.fact_subscriptions(subscriptions(rows, [
        (1, "c1", 100, 10, 365, "churned"), (2, "c1", 50, 300, 30, "active"), (3, "c2", 30, 400, 30, "renewed"), (4, "c3", 5, 1, 30, "active"), (5, "c3", 6, 1, 30, "active")]), None, True)
    health = rows([("c1", "High"), ("c2", "Low"), ("c3", "High")], "company_id string, risk_tier string")
    work = C.fact_tickets(tickets(rows, [(1, "c1", "P1", "open", 0.0, 999, 3), (2, "c1", "P1", "open", 0.0, 1, 4)]), None, True)
    surveys = C.fact_nps(nps(rows, [(1, "c1", 9, 1), (2, "c2", 4, 1), (3, "c2", 5, 2)]), None, True)
    agents = rows([("a1",), ("a2",), ("a3",)], "agent_id string")
    got = {r.agent_id: tuple(r)[1:] for r in K.agent_performance(agents, companies, subs, health, work, surveys, AS_OF).collect()}
    assert got["a1"] == (2, 130, 1, 50.0, 50.0, 3.5, 6.0)
    # Two current contracts on the same day count once; both count as kept.
    assert got["a2"] == (1, 6, 1, 0.0, 200.0, 0.0, 5.0)
    assert got["a3"] == (0, 0, 0, 0.0, 0.0, 0.0, 5.0)


def test_quality_reports(rows):
    full, empty = rows([(1,), (None,)], "k int"), rows([], "k int")
    tables = {("BRONZE", "a"): full, ("GOLD", "b"): empty, ("GOLD", "c"): full}
    report = Q.rowcount_report(tables, {("BRONZE", "a"): 5, ("GOLD", "b"): 0, ("GOLD", "c"): 2})
    assert [tuple(r) for r in report.collect()] == [
        ("GOLD", "b", 0, "OK (empty as expected)"), ("GOLD", "c", 2, "OK"), ("BRONZE", "a", 2, "WARN: too few rows")
    ]
    assert values(Q.layer_counts(tables).select("table_name", "is_empty")) == [("a", False), ("b", True), ("c", False)]
    assert values(Q.null_key_report({"x": (full, "k")})) == [("x", 1)]


def test_usage_counts_days_far_ahead_and_everything_without_a_value(rows):
    as_of = dt.date(2024, 5, 31)
    rnd = random.Random(6)
    data = [
        (rnd.choice(["a", "b", "c"]), as_of + dt.timedelta(days=rnd.choice([*range(-120, 60), 400, 900])), rnd.choice(["t1", "t2", None]), rnd.choice(["k1", "k2", "k3", None]))
        for _ in range(600)
    ] + [("old", as_of - dt.timedelta(days=200), "t1", "k1"), ("none", None, "t1", "k1")]
    got = {r.company_id: r for r in FS.usage_features(rows(data, "company_id string, event_date date, event_type string, contact_id string"), as_of, 15).collect()}
    for company in {d[0] for d in data}:
        mine = [(on, t, k) for c, on, t, k in data if c == company and on is not None]
        age = lambda n: [x for x in mine if x[0] >= as_of - dt.timedelta(days=n)]
        r = got[company]
        assert (r.dau_last_30d, r.dau_last_90d) == (len({x[0] for x in age(30)}), len({x[0] for x in age(90)}))
        assert (r.events_30d, r.events_90d, r.events_30_60d, r.events_60_90d) == (len(age(30)), len(age(90)), len(age(60)) - len(age(30)), len(age(90)) - len(age(60)))
        assert r.distinct_features_used_30d == len({x[1] for x in age(30)} - {None}) and r.active_users_30d == len({x[2] for x in age(30)} - {None})
        assert r.days_since_last_login == ((as_of - max(x[0] for x in mine)).days if mine else None)
