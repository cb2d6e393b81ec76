import datetime as dt
import json

import pytest
from helpers import values
from pyspark.sql import functions as F

from churnkit.operators import actions as A
from churnkit.operators import content
from churnkit.operators import reports as P
from churnkit.schemas import ACTIONS

NOW = dt.datetime(2024, 5, 31, 12, 0)
CONTEXT = (
    "company_id string, company_name string, mrr_current int, contract_mrr int, risk_tier string, churn_probability double, "
    "days_to_renewal int, contract_status string, top_factors string, contacts array<string>, recent_tickets array<string>"
)


def decide(rows, mrr=100, tier="High", p=0.9, renewal=200, status="active", contacts=("x",), tickets=("t",)):
    factors = json.dumps({"a": 0.1, "b": -0.8, "c": 0.3, "d": 0.2})
    row = ("c1", "One", mrr, mrr, tier, p, renewal, status, factors, list(contacts) if contacts else None, list(tickets) if tickets else None)
    return A.decide_action(rows([row], CONTEXT)).first()


def test_decision_rules_are_tried_top_down(rows):
    assert decide(rows, mrr=5001, renewal=1).action_type == "escalation"
    assert decide(rows, mrr=5000, renewal=59).action_type == "discount"
    assert decide(rows, status="downgraded").action_type == "discount"
    assert decide(rows, renewal=60).action_type == "call"
    assert decide(rows, contacts=None).action_type == "email"
    assert decide(rows, tickets=None).action_type == "email"
    assert decide(rows, tier="Medium", renewal=1).action_type == "email"
    assert decide(rows, renewal=None, status=None).action_type == "call"


def test_urgency_signals_and_channel(rows):
    assert decide(rows, mrr=9000).urgency == "critical"
    r = decide(rows, p=0.7)
    assert (r.urgency, r.channel, r.key_signals) == ("high", "phone", ["b", "c", "d"])
    assert decide(rows, p=0.69).urgency == "medium"


def queue(rows, *data):
    """(id, company, type, status, content)"""
    full = [(i, c, "7", "m1", t, "email", s, txt, NOW, None, None, "pending", "x") for i, c, t, s, txt in data]
    return rows(full, ACTIONS)


def decisions(rows, *pairs):
    schema = "company_id string, action_type string, key_signals array<string>, rationale string, urgency string, churn_probability double"
    return rows([(c, t, ["s"], "why", "high", 0.8) for c, t in pairs], schema)


def test_enqueue_keeps_one_open_row_per_company_and_type(rows):
    actions = queue(rows, ("1", "c1", "email", "queued", "{}"), ("2", "c2", "email", "pending", "text"))
    new = decisions(rows, ("c1", "email"), ("c1", "call"), ("c2", "email"), ("c1", "call"))
    once = A.enqueue(actions, new, NOW)
    opened = once.filter("status = 'queued'")
    assert values(opened.select("company_id", "action_type")) == [("c1", "call"), ("c1", "email"), ("c2", "email")]
    assert A.enqueue(once, new, NOW).count() == once.count()
    meta = json.loads(opened.filter("action_type = 'call'").first().generated_content)
    assert meta == {"key_signals": ["s"], "rationale": "why", "urgency": "high", "churn_probability": 0.8}


def flat_context(rows):
    schema = (
        "company_id string, company_name string, cs_agent_id string, mrr_current int, contract_mrr int, days_to_renewal int, contact_id string, "
        "contact_name string, latest_nps int, latest_nps_category string, ticket_count int, plan_name string, churn_probability double, "
        "agent_name string, agent_email string, previous_nps int, previous_nps_category string, open_cases int, escalated_cases int, "
        "contract_status string, tenure_days int"
    )
    return rows([("c1", "One", "m9", 10, 12000, 5, "k1", "Ann", 3, "detractor", 2, "Pro", 0.9, "Bob", "b@x", 8, "passive", 1, 1, "active", 700),
                 ("c3", "Three", None, None, None, None, None, None, None, None, 0, None, None, None, None, None, None, 0, 0, None, None)], schema)


def test_queue_to_pending(rows):
    meta = json.dumps({"key_signals": ["s1", "s2"], "rationale": "because"})
    actions = queue(rows, ("1", "c1", "escalation", "queued", meta), ("2", "c1", "email", "pending", "done"),
                    ("3", "c2", "email", "queued", "{}"), ("4", "c3", "call", "queued", "bad json"))
    got = {(r.company_id, r.action_type): r for r in A.queue_to_pending(actions, flat_context(rows), NOW).collect()}
    assert len(got) == 4
    r = got["c1", "escalation"]
    assert (r.status, r.contact_id, r.agent_id, r.channel, r.created_by_agent) == ("pending", "k1", "m9", "in_app", "retention_action")
    assert r.action_id not in ("1", None) and "s1, s2" in r.generated_content and "because" in r.generated_content
    assert "12,000 EUR" in r.generated_content and "90.0%" in r.generated_content
    assert got["c1", "email"].generated_content == "done"
    assert (got["c2", "email"].status, got["c2", "email"].action_id) == ("queued", "3")
    assert got["c3", "call"].status == "pending" and "N/A" in got["c3", "call"].generated_content
    assert A.queue_to_pending(actions, flat_context(rows), NOW).dtypes == actions.dtypes


def test_content_can_come_from_a_python_generator(rows):
    actions = queue(rows, ("1", "c1", "email", "queued", "{}"))
    render = A.content_generator(lambda b: b["company_name"].str.upper() + "/" + b["action_type"], ["company_name", "action_type"])
    assert A.queue_to_pending(actions, flat_context(rows), NOW, render=render).first().generated_content == "ONE/email"


def test_review_states(rows):
    actions = queue(rows, ("1", "c1", "email", "pending", "a"), ("2", "c2", "email", "pending", "b"))
    first = F.col("action_id") == "1"
    r = A.approve(actions, first, NOW, "better").filter(first).first()
    assert (r.status, r.approved_at, r.generated_content, r.outcome) == ("approved", NOW, "better", "pending")
    r = A.reject(actions, first, NOW, "it's late").filter(first).first()
    assert (r.status, r.generated_content) == ("rejected", "[REJECTED 2024-05-31 12:00:00]\nReason: it's late")
    approved = A.approve(actions, first, NOW)
    r = A.update_outcome(approved, first, "saved", NOW).filter(first).first()
    assert (r.status, r.outcome, r.executed_at) == ("completed", "saved", NOW)
    assert values(A.update_outcome(actions, first, "saved", NOW)) == values(actions)
    done = A.update_outcome(approved, first, "saved", NOW)
    assert values(A.approve(done, first, NOW)) == values(done) == values(A.reject(done, first, NOW, "no"))
    assert values(A.refused(done, F.lit(True), "approved").select("action_id")) == [("1",)]
    asked = done.select("action_id").union(done.selectExpr("'9'"))
    assert tuple(A.bulk_counts(done, asked).first()) == (3, 1, 1, 1)
    with pytest.raises(ValueError):
        A.update_outcome(actions, first, "approved", NOW)
    bulk = A.bulk_review(actions, actions.select("action_id"), NOW, "reject", "all")
    assert values(bulk.select("status")) == [("rejected",), ("rejected",)]
    with pytest.raises(ValueError):
        A.bulk_review(actions, actions, NOW, "maybe")


def test_transitions(rows):
    before = rows([("1", "pending"), ("2", "queued"), ("3", "sent"), ("4", "pending")], "action_id string, status string")
    after = rows([("1", "approved"), ("2", "approved"), ("3", "completed"), ("4", "pending")], "action_id string, status string")
    assert values(A.invalid_transitions(before, after)) == [("2", "queued", "approved")]


def test_candidates_context_lists_are_short_and_ordered(rows):
    day = dt.date(2024, 5, 31)
    preds = rows([(c, d, p, "High", "{}", "1", "m") for c, p in (("c1", 0.9), ("c2", 0.8), ("c3", 0.7)) for d in (day, day - dt.timedelta(1))],
                 "company_id string, prediction_date date, churn_probability double, risk_tier string, top_factors string, model_version string, model_name string")
    companies = rows([(c, c.upper(), "s", "PME", "m1") for c in ("c1", "c2", "c3")],
                     "company_id string, company_name string, sector_label string, company_size string, assigned_cs_agent_id string")
    health = rows([("c1", 10, 5, 40, "High", "active"), ("c2", None, None, 50, "Low", None), ("c3", 3, 5, 60, "Low", "active")],
                  "company_id string, mrr int, days_to_renewal int, health_score int, risk_tier string, contract_status string")
    picked = A.risk_candidates(preds, companies, health, "High", 3, 1)
    assert values(picked.select("company_id")) == [("c1",)]
    assert A.risk_candidates(preds, companies, health, "High", 0, 50).count() == 2
    contacts = rows([(i, "c1", "F", str(i), r, "e", "p") for i, r in enumerate(["CTO", "Clerk", "CEO", "Director", "CFO", "CEO"])],
                    "contact_id int, company_id string, first_name string, last_name string, role string, email string, phone string")
    tickets = rows([(i, "c1", "P1", "open", 0.1, False, f"s{i}", NOW + dt.timedelta(days=i)) for i in range(8)],
                   "ticket_id int, company_id string, priority string, status string, sentiment_score double, is_escalated boolean, subject string, created_at timestamp")
    surveys = rows([(i, "c1", i, "passive", "n", day + dt.timedelta(i)) for i in range(4)],
                   "survey_id int, company_id string, nps_score int, nps_category string, comment string, survey_date date")
    subs = rows([(1, "c1", "Pro", 10, "annual", day, day, "active", True)],
                "subscription_id int, company_id string, plan_type string, mrr int, billing_cycle string, start_date date, end_date date, status string, is_current_contract boolean")
    agents = rows([("m1", "A", "B", "west", "a@b")], "agent_id string, first_name string, last_name string, region string, email string")
    r = A.company_context(picked, contacts, tickets, surveys, subs, agents).first()
    assert [(c.contact_name, c.role) for c in r.contacts] == [("F 2", "CEO"), ("F 5", "CEO"), ("F 4", "CFO")]
    assert [t.subject for t in r.recent_tickets] == ["s7", "s6", "s5", "s4", "s3"]
    assert [n.nps_score for n in r.nps_history] == [3, 2]
    assert (r.subscription.plan_name, r.cs_agent.agent_name) == ("Pro", "A B")


def test_reports_on_an_empty_and_a_small_queue(rows):
    empty = rows([], ACTIONS)
    assert tuple(P.action_stats(empty).first()) == (0,) * 10
    assert P.save_rate(empty).first().save_rate is None
    some = queue(rows, ("1", "c1", "email", "pending", "a"), ("2", "c1", "call", "approved", "b"))
    assert values(P.action_crosstab(some).select("action_type", "pending", "approved")) == [("call", 0, 1), ("email", 1, 0)]


def test_filters_are_optional(rows):
    df = rows([("1", "High", "m1", 10, "email"), ("2", "Low", "m2", None, "call")],
              "action_id string, risk_tier string, agent_id string, mrr int, action_type string")
    assert A.filter_actions(df).count() == 2
    assert values(A.filter_actions(df, "All", mrr_min=1).select("action_id")) == [("1",)]
    assert values(A.filter_actions(df, None, "m2", 0, ["call"]).select("action_id")) == [("2",)]


def test_a_text_is_sent_back_written_anew_and_sent(rows):
    actions = queue(rows, ("1", "c1", "email", "pending", "first text"), ("2", "c9", "call", "pending", "other"), ("3", "c1", "email", "approved", "x"))
    mine = F.col("action_id").isin("1", "2")
    asked = A.ask_changes(actions, F.lit(True), NOW, "be brief")
    assert {r.action_id: r.status for r in asked.collect()} == {"1": "modified", "2": "modified", "3": "approved"}
    assert values(A.approve(asked, mine, NOW)) == values(asked)  # nothing leaves ``modified`` but by a new text
    context = flat_context(rows).withColumn("top_factors", F.lit('{"dau": -0.5}'))
    renewed = A.regenerate(asked, context, NOW)
    got = {r.action_id: r for r in renewed.collect()}
    assert got["1"].status == "pending" and got["1"].generated_content.endswith("CHANGED AS ASKED: be brief")
    assert "first text" not in got["1"].generated_content and got["1"].approved_at is None
    assert got["2"].status == "modified"  # no context for its company
    sent = A.send(A.approve(renewed, mine, NOW), F.lit(True), NOW)
    assert {r.action_id: r.status for r in sent.collect()} == {"1": "sent", "2": "modified", "3": "sent"}
    assert {r.status for r in A.update_outcome(sent, F.lit(True), "saved", NOW).collect()} == {"completed", "modified"}
    steps = [actions, asked, renewed, A.approve(renewed, mine, NOW), sent]
    assert all(A.invalid_transitions(a, b).count() == 0 for a, b in zip(steps, steps[1:]))


def test_texts_have_all_sections_and_keep_their_limits(rows):
    kinds = F.explode(F.array(*[F.lit(k) for k in ("email", "call", "discount", "escalation")]))
    long = " ".join(["word"] * 600)
    made = flat_context(rows).filter("company_id = 'c1'").withColumns(
        {"action_type": kinds, "key_signals": F.array(F.lit("s1"), F.lit("s2")), "rationale": F.lit(long)}
    )
    text = {r.action_type: r.t for r in made.select("action_type", content.render_content().alias("t")).collect()}
    for kind, headings in {
        "call": ("ESTIMATED LENGTH", "OPENING", "DIAGNOSIS", "PROPOSAL", "CLOSING", "OBJECTIONS"),
        "discount": ("OFFER", "EMAIL", "INTERNAL CASE", "Break-even: 3 months"),
        "escalation": ("CONFIDENTIAL", "SUMMARY"),
        "email": ("SUBJECT", "Dear", "Kind regards"),
    }.items():
        assert all(h in text[kind] for h in headings), kind
    assert len(text["escalation"].split()) == 400
    assert all(len(section.split()) <= 280 for section in text["discount"].split("\n\n"))


@pytest.mark.parametrize("percent,months", [(20, 12), (10, 6), (15, 12), (5, 1)])
def test_break_even_is_the_first_month_that_has_paid_for_the_offer(rows, percent, months):
    got = rows([(percent, months)], "p int, m int").select(content.break_even(F.col("p"), F.col("m")).alias("e")).first().e
    cost = percent * months
    assert got * (100 - percent) >= cost > (got - 1) * (100 - percent)
