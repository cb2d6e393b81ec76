"""Queries for retention actions and reports."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from churnkit.operators import actions as A
from churnkit.operators import merge
from churnkit.operators import reports as P
from churnkit.operators.content import SECTIONS, render_content
from churnkit.plans.oracle_base import CHANNEL, mean, rnd
from churnkit.plans.q_building_blocks import review
from churnkit.plans.registry import NOW_TEXT, query
from churnkit.session import kept
from churnkit.sources.adapters import AS_OF

NOW_SQL = f"TIMESTAMP '{NOW_TEXT}'"


def candidates(s):
    """All paying companies; their context looks them up in every fact, so they are worked out once."""
    return kept(A.risk_candidates(s.predictions, s.gold.companies, s.health, "All", 0, None), "candidates")


def context(s):
    w = s.gold
    return A.company_context(candidates(s), w.contacts, w.tickets, w.nps, w.subscriptions, w.agents)


def decisions(s):
    return A.decide_action(context(s))


@query("risk_candidates", """
    SELECT p.company_id, churn_probability, p.risk_tier, h.mrr AS mrr_current, days_to_renewal, health_score, company_name,
           assigned_cs_agent_id AS cs_agent_id
    FROM latest_predictions p JOIN health h USING (company_id) JOIN dim_companies USING (company_id)
    WHERE p.risk_tier = 'High' AND h.mrr >= 1000 ORDER BY churn_probability DESC, company_id LIMIT 50""")
def _(s):
    return A.risk_candidates(s.predictions, s.lean.companies, s.health, "High", 1000, 50).select(
        "company_id", "churn_probability", "risk_tier", "mrr_current", "days_to_renewal", "health_score", "company_name",
        "cs_agent_id",
    )


def _joined(array: str, *fields: str):
    return F.array_join(
        F.transform(array, lambda e: F.concat_ws(":", *[e[f].cast("string") for f in fields])), "|"
    )


@query("company_context", """
    SELECT c.company_id, people.txt AS contacts, cases.txt AS tickets, surveys.txt AS surveys, s.plan_type AS plan_name,
           s.mrr AS contract_mrr, s.status AS contract_state, a.email AS agent_email
    FROM candidates c
    LEFT JOIN (SELECT company_id, string_agg(first_name || ' ' || last_name || ':' || role || ':' || email || ':' || phone, '|' ORDER BY place) AS txt
               FROM deciders WHERE place <= 3 GROUP BY company_id) people ON people.company_id = c.company_id
    LEFT JOIN (SELECT company_id, string_agg(priority || ':' || status || ':' || CASE WHEN is_escalated THEN 'true' ELSE 'false' END || ':' || subject, '|' ORDER BY place) AS txt
               FROM ticket_places WHERE place <= 5 GROUP BY company_id) cases ON cases.company_id = c.company_id
    LEFT JOIN (SELECT company_id, string_agg(nps_score || ':' || nps_category || ':' || survey_date, '|' ORDER BY place) AS txt
               FROM survey_places WHERE place <= 2 GROUP BY company_id) surveys ON surveys.company_id = c.company_id
    LEFT JOIN current_contracts s ON s.company_id = c.company_id
    LEFT JOIN dim_agents a ON a.agent_id = c.cs_agent_id""")
def _(s):
    return context(s).select(
        "company_id",
        _joined("contacts", "contact_name", "role", "email", "phone").alias("contacts"),
        _joined("recent_tickets", "priority", "status", "is_escalated", "subject").alias("tickets"),
        _joined("nps_history", "nps_score", "nps_category", "survey_date").alias("surveys"),
        F.col("subscription.plan_name").alias("plan_name"),
        F.col("subscription.mrr").alias("contract_mrr"),
        F.col("subscription.status").alias("contract_state"),
        F.col("cs_agent.agent_email").alias("agent_email"),
    )


_CONTEXT_COLUMNS = (
    "company_id", "company_name", "industry", "company_size", "city", "cs_agent_id", "mrr_current", "days_to_renewal",
    "health_score", "contact_id", "contact_name", "contact_role", "contact_email", "latest_nps", "latest_nps_category",
    "latest_verbatim", "previous_nps", "previous_nps_category", "ticket_count", "open_cases", "escalated_cases", "plan_name",
    "contract_mrr", "billing_cycle", "contract_status", "tenure_days", "churn_probability", "agent_name", "agent_email",
)


def queue_context(s):
    w = s.gold
    wanted = s.actions.filter(F.col("status") == "queued")
    return A.action_context(
        wanted, w.companies, s.health, w.contacts, w.tickets, w.nps, w.subscriptions, w.agents, s.predictions, as_of=AS_OF
    )


@query("action_context", "SELECT * FROM context")
def _(s):
    return queue_context(s).select(*_CONTEXT_COLUMNS)


@query("decide_action", "SELECT company_id, action_type, urgency, rationale FROM decisions")
def _(s):
    return decisions(s).select("company_id", "action_type", "urgency", "rationale")


@query("key_signals", "SELECT company_id, prediction_date, names AS signals FROM predictions JOIN top3_names USING (company_id)")
def _(s):
    return s.predictions.select(
        "company_id", "prediction_date", F.array_join(A.key_signals("top_factors"), ", ").alias("signals")
    )


@query("action_channel", f"SELECT action_id, action_type, {CHANNEL} AS mapped FROM actions")
def _(s):
    return s.actions.select("action_id", "action_type", A.channel_of("action_type").alias("mapped"))


@query("decision_meta", "SELECT company_id, meta FROM decision_metas")
def _(s):
    return decisions(s).select("company_id", A.decision_meta().alias("meta"))


@query("enqueue_actions", f"""
    SELECT action_id, company_id, action_type, channel, status, generated_content, created_at, outcome, created_by_agent FROM actions
    UNION ALL
    SELECT sha256(company_id || '|' || action_type || '|{NOW_TEXT}'), company_id, action_type, channel, 'queued', meta, {NOW_SQL}, 'pending', 'risk_detection'
    FROM decision_metas d WHERE NOT EXISTS
      (SELECT 1 FROM actions a WHERE a.status = 'queued' AND a.company_id = d.company_id AND a.action_type = d.action_type)""")
def _(s):
    return A.enqueue(s.actions, decisions(s), s.now).drop("contact_id", "agent_id", "approved_at", "executed_at")


@query("decision_summary", "SELECT action_type, COUNT(*) AS n FROM decisions GROUP BY action_type ORDER BY n DESC, action_type")
def _(s):
    return A.decision_summary(decisions(s))


def _amount(x: str, unit: str) -> str:
    return f"COALESCE(format('{{:,}}', CAST(ROUND({x}) AS BIGINT)) || ' {unit}', 'N/A')"


def _render_sql(signals: str, rationale: str) -> str:
    """The texts as SQL: the section templates are data, what fills them is stated anew here."""
    mrr, percent = "COALESCE(contract_mrr, mrr_current)", "CASE WHEN churn_probability >= 0.7 THEN 20 ELSE 10 END"
    months = "CASE WHEN churn_probability >= 0.7 THEN 12 ELSE 6 END"
    cut = f"ROUND(CAST({mrr} AS DECIMAL(28,4)) * {percent} / 100)"
    nps = lambda value, kind: f"COALESCE(CAST({value} AS VARCHAR), 'N/A') || ' (' || COALESCE({kind}, 'N/A') || ')'"
    text = lambda value: f"COALESCE(CAST({value} AS VARCHAR), 'N/A')"
    values = {
        "client": text("company_name"), "person": text("contact_name"), "plan": text("plan_name"),
        "manager": "COALESCE(agent_name, 'your account manager')", "mail": text("agent_email"),
        "nps": nps("latest_nps", "latest_nps_category"), "nps_before": nps("previous_nps", "previous_nps_category"),
        "answer": "CASE WHEN latest_nps < 7 THEN ' Your last answer was ' || latest_nps || ' of 10, and we want to put right what is behind it.' ELSE '' END",
        "cases": "CASE WHEN open_cases > 0 THEN ' Your open support cases, ' || open_cases || ' of them, come first.' ELSE '' END",
        "minutes": "(ticket_count + 6)", "ticket_count": "ticket_count", "open_cases": "open_cases", "escalated_cases": "escalated_cases",
        "signals": f"COALESCE(NULLIF({signals}, ''), 'none')", "signal_lines": f"'- ' || replace(COALESCE(NULLIF({signals}, ''), 'none'), ', ', chr(10) || '- ')",
        "rationale": rationale, "because": f"CASE WHEN {rationale} <> '' THEN ' ' || {rationale} ELSE '' END", "percent": f"({percent})", "months": f"({months})", "most": "20", "long": "12",
        "reduction": _amount(cut, "EUR per month"), "kept": _amount(f"CAST({mrr} AS DECIMAL(28,4)) - {cut}", "EUR per month"),
        "cost": _amount(f"{cut} * {months}", "EUR"), "even": f"CAST(ceil(({percent}) * ({months}) / CAST(100 - {percent} AS DOUBLE)) AS INTEGER)",
        "revenue": _amount(mrr, "EUR per month"), "renewal": text("days_to_renewal"),
        "churn": f"COALESCE(printf('%.1f', {rnd('churn_probability * 100', 1)}) || '%', 'N/A')",
        "days": "CASE WHEN churn_probability >= 0.7 THEN '3' ELSE '7' END", "tenure": text("tenure_days"), "contract": text("contract_status"),
        "step": "CASE WHEN churn_probability >= 0.7 THEN 'call by the management' ELSE 'review meeting with the management' END",
    }

    def filled(kind: str) -> str:
        parts = re.split(r"\{(\w+)\}", "\n\n".join(SECTIONS[kind]))
        quoted = ["'" + part.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for part in parts]
        return " || ".join(f"({values[part]})" if i % 2 else quoted[i] for i, part in enumerate(parts) if part)

    others = " ".join(f"WHEN '{kind}' THEN {filled(kind)}" for kind in ("call", "discount", "escalation"))
    return f"CASE action_type {others} ELSE {filled('email')} END"


@query("render_content", f"""
    SELECT company_id, action_type, {_render_sql("'dau_last_30d, nps_latest'", "'Test'")} AS content
    FROM context, (SELECT unnest(['email', 'call', 'discount', 'escalation']) AS action_type)""")
def _(s):
    kinds = F.array(*[F.lit(k) for k in ("email", "call", "discount", "escalation")])
    rows = queue_context(s).withColumns(
        {
            "action_type": F.explode(kinds),
            "key_signals": F.array(F.lit("dau_last_30d"), F.lit("nps_latest")),
            "rationale": F.lit("Test"),
        }
    )
    return rows.select("company_id", "action_type", render_content().alias("content"))


@query("custom_content", """
    SELECT company_id, upper(company_name) || ' / ' || COALESCE(plan_name, 'no plan') || ' / ' || ticket_count AS content FROM context""")
def _(s):
    def notes(batch):
        """A generator of one's own: any function of a batch of context rows."""
        return batch["company_name"].str.upper() + " / " + batch["plan_name"].fillna("no plan") + " / " + batch["ticket_count"].astype(str)

    note = A.content_generator(notes, ["company_name", "plan_name", "ticket_count"])
    return queue_context(s).select("company_id", note().alias("content"))


_SIGNALS = "CASE WHEN generated_content = 'not json' THEN '' ELSE 'dau_last_30d, nps_latest' END"
_REASON = "CASE WHEN generated_content = 'not json' THEN '' ELSE 'Case ' || company_id END"


@query("queue_to_pending", f"""
    SELECT action_id, company_id, contact_id, agent_id, action_type, status, generated_content, created_at, created_by_agent
    FROM actions WHERE NOT (status = 'queued' AND company_id IN (SELECT company_id FROM context))
    UNION ALL
    SELECT sha256(action_id || '|pending'), company_id, c.contact_id, c.cs_agent_id, action_type, 'pending',
           trim({_render_sql(_SIGNALS, _REASON)}), {NOW_SQL}, 'retention_action'
    FROM (SELECT action_id, company_id, action_type, generated_content FROM actions WHERE status = 'queued') a JOIN context c USING (company_id)""")
def _(s):
    moved = A.queue_to_pending(s.actions, queue_context(s), s.now)
    return moved.drop("channel", "approved_at", "executed_at", "outcome")


_REVIEW = "action_id, company_id, action_type, company_name, mrr, health_score, risk_tier, churn_probability, contact_name, agent_name"


def _brief(df):
    return df.select(*_REVIEW.split(", "))


@query("pending_review", f"""
    SELECT {_REVIEW} FROM review WHERE risk_tier = 'Medium'
    ORDER BY churn_probability DESC NULLS LAST, mrr DESC, action_id LIMIT 20""")
def _(s):
    return _brief(A.pending_review(review(s), tier="Medium"))


def _states(df):
    return df.select("action_id", "status", "generated_content", "approved_at", "executed_at", "outcome")


_OTHER = "generated_content, approved_at, executed_at, outcome"


@query("approve_actions", f"""
    SELECT action_id, CASE WHEN hit THEN 'approved' ELSE status END AS status,
           CASE WHEN hit THEN 'Reviewed text' ELSE generated_content END AS generated_content,
           CASE WHEN hit THEN {NOW_SQL} ELSE approved_at END AS approved_at, executed_at, outcome
    FROM (SELECT *, status = 'pending' AND action_type = 'email' AS hit FROM actions)""")
def _(s):
    hit = (F.col("status") == "pending") & (F.col("action_type") == "email")
    return _states(A.approve(s.actions, hit, s.now, "Reviewed text"))


@query("reject_actions", f"""
    SELECT action_id, CASE WHEN hit THEN 'rejected' ELSE status END AS status,
           CASE WHEN hit THEN '[REJECTED {NOW_TEXT}]' || chr(10) || 'Reason: not now' ELSE generated_content END AS generated_content,
           CASE WHEN hit THEN {NOW_SQL} ELSE approved_at END AS approved_at, executed_at, outcome
    FROM (SELECT *, status = 'pending' AND action_type = 'call' AS hit FROM actions)""")
def _(s):
    hit = (F.col("status") == "pending") & (F.col("action_type") == "call")
    return _states(A.reject(s.actions, hit, s.now, "not now"))


@query("bulk_review", f"""
    SELECT action_id, CASE WHEN hit THEN 'approved' ELSE status END AS status, generated_content,
           CASE WHEN hit THEN {NOW_SQL} ELSE approved_at END AS approved_at, executed_at, outcome
    FROM (SELECT *, action_id IN (SELECT action_id FROM review WHERE mrr >= 2000) AS hit FROM actions)""")
def _(s):
    chosen = A.filter_actions(review(s), mrr_min=2000)
    return _states(A.bulk_review(s.actions, chosen, s.now))


@query("bulk_counts", """
    SELECT COUNT(*) AS chosen, COUNT(*) FILTER (WHERE status = 'pending') AS changed, COUNT(*) FILTER (WHERE status <> 'pending') AS refused,
           COUNT(*) FILTER (WHERE status IS NULL) AS unknown
    FROM (SELECT DISTINCT md5(CAST(c_custkey + 7 AS VARCHAR)) AS action_id FROM customer WHERE c_acctbal > 0) LEFT JOIN actions USING (action_id)""")
def _(s):
    chosen = s.t.customer.filter("c_acctbal > 0").select(F.md5((F.col("c_custkey") + 7).cast("string")).alias("action_id"))
    return A.bulk_counts(s.actions, chosen, "approve")


@query("refused_steps", "SELECT action_id, status FROM actions WHERE action_type = 'discount' AND status NOT IN ('approved', 'sent')")
def _(s):
    return A.refused(s.actions, F.col("action_type") == "discount", "completed").select("action_id", "status")


@query("update_outcome", f"""
    SELECT action_id, CASE WHEN hit THEN 'completed' ELSE status END AS status, generated_content, approved_at,
           CASE WHEN hit THEN {NOW_SQL} ELSE executed_at END AS executed_at, CASE WHEN hit THEN 'saved' ELSE outcome END AS outcome
    FROM (SELECT *, status IN ('approved', 'sent') AND action_type <> 'call' AS hit FROM actions)""")
def _(s):
    return _states(A.update_outcome(s.actions, F.col("action_type") != "call", "saved", s.now))


_WISH = "shorter, please"
_ASKED = "status = 'pending' AND action_type = 'discount'"


def _asked(s):
    hit = (F.col("status") == "pending") & (F.col("action_type") == "discount")
    return A.ask_changes(s.actions, hit, s.now, _WISH)


@query("modify_actions", f"""
    SELECT action_id, CASE WHEN hit THEN 'modified' ELSE status END AS status,
           CASE WHEN hit THEN '{_WISH}' ELSE generated_content END AS content, CASE WHEN hit THEN {NOW_SQL} ELSE approved_at END AS approved_at
    FROM (SELECT *, {_ASKED} AS hit FROM actions)""")
def _(s):
    wish = F.get_json_object("generated_content", "$.instructions")
    new = (F.col("status") == "modified") & (F.col("approved_at") == s.now) & wish.isNotNull()
    return _asked(s).select("action_id", "status", F.when(new, wish).otherwise(F.col("generated_content")).alias("content"), "approved_at")


@query("regenerate_actions", f"""
    SELECT a.action_id, company_id, CASE WHEN renewed THEN 'pending' WHEN hit THEN 'modified' ELSE a.status END AS status,
           CASE WHEN renewed THEN trim({_render_sql("names", f"'{_WISH}'")} || chr(10) || chr(10) || 'CHANGED AS ASKED: {_WISH}')
                WHEN hit THEN '{_WISH}' ELSE generated_content END AS content
    FROM (SELECT * EXCLUDE (contact_id), {_ASKED} AS hit, hit AND company_id IN (SELECT company_id FROM context) AS renewed FROM actions) a
    LEFT JOIN context USING (company_id) LEFT JOIN top3_names USING (company_id)""")
def _(s):
    renewed = A.regenerate(_asked(s), queue_context(s), s.now)
    waiting = (F.col("status") == "modified") & F.get_json_object("generated_content", "$.instructions").isNotNull()
    text = F.when(waiting, F.get_json_object("generated_content", "$.instructions")).otherwise(F.col("generated_content"))
    return renewed.select("action_id", "company_id", "status", text.alias("content"))


@query("send_actions", f"""
    SELECT action_id, CASE WHEN hit THEN 'sent' ELSE status END AS status, CASE WHEN hit THEN {NOW_SQL} ELSE executed_at END AS executed_at
    FROM (SELECT *, status = 'approved' AND channel = 'email' AS hit FROM actions)""")
def _(s):
    return A.send(s.actions, F.col("channel") == "email", s.now).select("action_id", "status", "executed_at")


@query("review_cycle", """
    SELECT status, COUNT(*) AS n, 0 AS not_allowed FROM (SELECT CASE WHEN status = 'pending' THEN 'sent' ELSE status END AS status FROM actions)
    GROUP BY status""")
def _(s):
    """Pending, sent back, written anew, approved and sent, every step checked against the state machine."""
    mine = F.col("status") == "pending"
    asked = A.ask_changes(s.actions, mine, s.now, _WISH)
    back = merge.update_where(asked, (F.col("status") == "modified") & F.col("generated_content").like('{"instructions"%'), {"status": F.lit("pending")})
    approved = A.approve(back, mine, s.now)
    sent = A.send(approved, (F.col("status") == "approved") & (F.col("approved_at") == s.now), s.now)
    steps = [s.actions, asked, back, approved, sent]
    wrong = [A.invalid_transitions(a, b).agg(F.count(F.lit(1))).scalar() for a, b in zip(steps, steps[1:])]
    bad = sum(wrong[1:], wrong[0]).cast("int")
    return sent.groupBy("status").agg(F.count(F.lit(1)).alias("n")).withColumn("not_allowed", bad)


@query("invalid_transitions", """
    SELECT action_id, status AS status_before, 'completed' AS status_after FROM actions
    WHERE action_type = 'email' AND status NOT IN ('completed', 'approved', 'sent')""")
def _(s):
    hit = F.col("action_type") == "email"
    return A.invalid_transitions(s.actions, merge.update_where(s.actions, hit, {"status": F.lit("completed")}))


# --- reports ------------------------------------------------------------------------

def scored(s):
    return P.scored_companies(s.predictions, s.lean.companies, s.health)


@query("kpi_summary", """
    SELECT (SELECT COUNT(*) FROM latest_predictions) AS total_companies,
           (SELECT COUNT(*) FROM latest_predictions WHERE risk_tier = 'High') AS high_risk,
           COUNT(*) FILTER (WHERE status = 'pending') AS pending_actions, COUNT(*) FILTER (WHERE status = 'approved') AS approved_actions,
           COUNT(*) FILTER (WHERE status = 'rejected') AS rejected_actions,
           (SELECT CAST(ROUND(SUM(CAST(mrr AS DECIMAL(18,4))), 0) AS DOUBLE) FROM actions JOIN health USING (company_id) WHERE status = 'pending') AS mrr_at_risk
    FROM actions""")
def _(s):
    return P.kpi_summary(s.predictions, s.actions, s.health)


@query("top10_risk_profile", """
    SELECT company_name, industry, company_size, mrr, health_score, health_risk_tier, days_to_renewal, churn_probability, top_factors
    FROM scored_companies ORDER BY churn_probability DESC, company_id LIMIT 10""")
def _(s):
    return P.top10_risk_profile(scored(s))


_STATS = """SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE p.risk_tier = 'High') AS n_high, COUNT(*) FILTER (WHERE p.risk_tier = 'Medium') AS n_medium,
    COUNT(*) FILTER (WHERE p.risk_tier = 'Low') AS n_low,
    CAST(ROUND(SUM(CAST(CASE WHEN p.risk_tier = 'High' THEN mrr ELSE 0 END AS DECIMAL(18,4))), 0) AS DOUBLE) AS mrr_high_risk
    FROM latest_predictions p JOIN health USING (company_id)"""


@query("portfolio_stats", _STATS)
def _(s):
    return P.portfolio_stats(s.predictions, s.health)


@query("action_distribution", "SELECT action_type, status, COUNT(*) AS n FROM actions GROUP BY ALL ORDER BY action_type, status")
def _(s):
    return P.action_distribution(s.actions)


@query("portfolio_text", f"""
    SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS section, 0 AS line_no,
           unnest(['=== All companies ===', '=== Ten companies most likely to leave ===', '=== Retention actions ===']) AS line
    UNION ALL
    SELECT 1 AS section, CAST(unnest([1, 2, 3]) AS INTEGER) AS line_no,
           unnest(['Companies: ' || total, 'High: ' || n_high || ' | Medium: ' || n_medium || ' | Low: ' || n_low,
                   'MRR at high risk: ' || CAST(mrr_high_risk AS BIGINT)]) AS line FROM ({_STATS})
    UNION ALL
    SELECT 2, CAST(row_number() OVER (ORDER BY churn_probability DESC, company_id) AS INTEGER),
           company_name || ' | ' || industry || ' | ' || company_size || ' | MRR ' || COALESCE(CAST(mrr AS VARCHAR), 'N/A') || ' | Health ' || health_score
           || '/100 | Churn ' || printf('%.1f', {rnd('churn_probability * 100', 1)}) || '% | ' || health_risk_tier || ' | Renewal in '
           || COALESCE(CAST(days_to_renewal AS VARCHAR), 'N/A') || ' | Factors: ' || COALESCE(top_factors, 'N/A')
    FROM (SELECT * FROM scored_companies ORDER BY churn_probability DESC, company_id LIMIT 10)
    UNION ALL
    SELECT 3, CAST(row_number() OVER (ORDER BY action_type, status) AS INTEGER), action_type || ' / ' || status || ' / ' || n
    FROM (SELECT action_type, status, COUNT(*) AS n FROM actions GROUP BY ALL)""")
def _(s):
    return P.portfolio_text(s.predictions, s.lean.companies, s.health, s.actions)


@query("risk_distribution", f"""
    SELECT risk_tier, COUNT(*) AS n, {rnd(mean('churn_probability') + ' * 100', 1)} AS avg_prob,
           {rnd('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()', 1)} AS pct FROM latest_predictions GROUP BY risk_tier""")
def _(s):
    return P.risk_distribution(s.predictions)


@query("pending_actions", f"SELECT {_REVIEW}, days_to_renewal, top_factors, channel, generated_content, created_at FROM review")
def _(s):
    names = [*_REVIEW.split(", "), "days_to_renewal", "top_factors", "channel", "generated_content", "created_at"]
    return P.pending_actions(review(s)).select(*names)


@query("pending_total", "SELECT COUNT(*) AS n, CAST(SUM(CAST(COALESCE(mrr, 0) AS DECIMAL(18,4))) AS DOUBLE) AS mrr_total FROM review")
def _(s):
    return P.pending_total(review(s))


@query("recent_actions", """
    SELECT action_id, company_name, mrr, action_type, status, created_at
    FROM actions JOIN (SELECT company_id, company_name FROM dim_companies) USING (company_id) JOIN (SELECT company_id, mrr FROM health) USING (company_id)
    ORDER BY created_at DESC, action_id LIMIT 10""")
def _(s):
    return P.recent_actions(P.all_actions(s.actions, s.lean.companies, s.health))


@query("all_actions", """
    SELECT action_id, company_id, action_type, status, outcome, created_at, approved_at, company_name, mrr
    FROM actions JOIN (SELECT company_id, company_name FROM dim_companies) USING (company_id) JOIN (SELECT company_id, mrr FROM health) USING (company_id)""")
def _(s):
    return P.all_actions(s.actions, s.lean.companies, s.health)


@query("predictions_view", f"""
    SELECT company_id, company_name, industry, company_size, COALESCE(CAST(mrr AS BIGINT), 0) AS mrr, days_to_renewal, health_score,
           {rnd('churn_probability * 100', 1)} AS churn_pct, risk_tier, prediction_date
    FROM scored_companies WHERE risk_tier IN ('High', 'Medium') AND churn_probability >= 0.45""")
def _(s):
    return P.predictions_view(scored(s), ("High", "Medium"), 0.45)


@query("action_crosstab", "SELECT action_type, " + ", ".join(
    f"COUNT(*) FILTER (WHERE status = '{st}') AS {st}" for st in ("queued", "pending", "modified", "approved", "rejected", "sent", "completed")
) + """, COUNT(*) FILTER (WHERE status IS NULL OR status NOT IN ('queued', 'pending', 'modified', 'approved', 'rejected', 'sent', 'completed')) AS other
    FROM actions GROUP BY action_type""")
def _(s):
    return P.action_crosstab(s.actions)


_OUTCOMES = "COUNT(*) FILTER (WHERE status = 'completed' AND outcome = 'saved') AS saved, COUNT(*) FILTER (WHERE status = 'completed' AND outcome = 'churned') AS churned"


@query("action_stats", "SELECT COUNT(*) AS total, " + ", ".join(
    f"COUNT(*) FILTER (WHERE status = '{st}') AS {st}" for st in ("pending", "approved", "rejected")
) + f", {_OUTCOMES}, " + ", ".join(
    f"COUNT(*) FILTER (WHERE action_type = '{k}') AS n_{k}" for k in ("email", "call", "discount", "escalation")
) + " FROM actions")
def _(s):
    return P.action_stats(s.actions)


@query("save_rate", f"SELECT saved, churned, CAST(saved AS DOUBLE) / NULLIF(saved + churned, 0) AS save_rate FROM (SELECT {_OUTCOMES} FROM actions)")
def _(s):
    return P.save_rate(s.actions)


@query("action_card", f"""
    SELECT action_id, upper(action_type) AS action_type, channel, risk_tier,
           COALESCE(printf('%.1f', {rnd('churn_probability * 100', 1)}) || '%', 'N/A') AS churn,
           COALESCE(format('{{:,}}', CAST(mrr AS BIGINT)) || ' EUR per month', 'N/A') AS mrr,
           company_name || ' (' || industry || ', ' || company_size || ')' AS company,
           COALESCE(contact_name, 'N/A') || ' - ' || COALESCE(contact_role, '?') || ' (' || COALESCE(contact_email, '?') || ')' AS contact,
           COALESCE(agent_name, 'N/A') || ' (' || COALESCE(agent_region, '?') || ')' AS manager,
           COALESCE(CAST(days_to_renewal AS VARCHAR), '?') || ' days' AS renewal, health_score || '/100' AS health, names AS signals,
           strftime(created_at, '%Y-%m-%d %H:%M') AS created, generated_content AS content
    FROM review JOIN top3_names USING (company_id)""")
def _(s):
    return P.action_card(review(s))
