"""Retention actions: candidates, context, decision, queue and review states.

Each step handles all companies at once. A step on the queue is a pure function from the action
table to the new action table; the caller writes the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions import (
    all_of,
    category_rank,
    col,
    day,
    days_between,
    factor_names,
    lookup,
    num,
    parse_factors,
)
from churnkit.operators.content import render_content
from churnkit.operators.health import current_contract
from churnkit.operators.merge import merge_insert, update_keys, update_where
from churnkit.operators.relational import (
    latest_only,
    latest_per_key,
    look_up,
    named_in,
    rank_within,
    require_latest,
    top_k,
)
from churnkit.schemas import (
    ACTION_CHANNELS,
    ALLOWED_TRANSITIONS,
    CLOSED_OUTCOMES,
    DECISION_ROLES,
    ESCALATION_MRR,
    ML_MEDIUM_UP_TO,
    OPEN_STATUSES,
    RENEWAL_SOON_DAYS,
)

CONTACT_LIMIT, TICKET_LIMIT, NPS_LIMIT = 3, 5, 2
META_TYPE = "key_signals array<string>, rationale string, urgency string, churn_probability double"


# --- filters put together at run time -----------------------------------------

def filter_predictions(df: DataFrame, tiers: Sequence[str] = (), min_prob: float = 0.0, sizes: Sequence[str] = ()) -> DataFrame:
    """An empty list means no restriction."""
    conditions = [num("churn_probability") >= min_prob]
    if tiers:
        conditions.append(F.col("risk_tier").isin(list(tiers)))
    if sizes:
        conditions.append(F.col("company_size").isin(list(sizes)))
    return df.filter(all_of(conditions))


def filter_actions(
    df: DataFrame, tier: str | None = None, agent_id=None, mrr_min: float = 0, types: Sequence[str] = ()
) -> DataFrame:
    conditions = []
    if tier not in (None, "All"):
        conditions.append(F.col("risk_tier") == tier)
    if agent_id is not None:
        conditions.append(F.col("agent_id") == agent_id)
    if mrr_min > 0:
        conditions.append(num("mrr") >= mrr_min)
    if types:
        conditions.append(F.col("action_type").isin(list(types)))
    return df.filter(all_of(conditions))


# --- candidates and context ---------------------------------------------------

def latest_prediction_date(predictions: DataFrame):
    return require_latest(predictions, "prediction_date")


def risk_candidates(
    predictions: DataFrame, companies: DataFrame, health: DataFrame,
    tier: str = "High", mrr_min: float = 0, n: int | None = 50, date=None,
) -> DataFrame:
    """The n riskiest companies of the newest (or given) day that pass tier and MRR; with ``n=None`` all of them."""
    scored = (
        latest_only(predictions, "prediction_date")
        if date is None
        else predictions.filter(F.col("prediction_date") == F.lit(date))
    )
    if tier in ("High", "Medium"):
        scored = scored.filter(F.col("risk_tier") == tier)
    paying = health.filter(F.col("mrr").cast("double") >= mrr_min)
    found = (
        scored.select("company_id", "churn_probability", "risk_tier", "top_factors", "model_version")
        .join(
            paying.select(
                "company_id", F.col("mrr").alias("mrr_current"), "days_to_renewal", "contract_status", "health_score",
                F.col("risk_tier").alias("health_risk_tier"),
            ),
            "company_id",
        )
        .join(
            companies.select(
                "company_id", "company_name", F.col("sector_label").alias("industry"), "company_size",
                F.col("assigned_cs_agent_id").alias("cs_agent_id"),
            ),
            "company_id",
        )
    )
    return found if n is None else top_k(found, [F.desc("churn_probability"), F.asc("company_id")], n)


def person_name() -> Column:
    return F.concat_ws(" ", "first_name", "last_name")


def _thinned(facts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Only the facts of the wanted companies. Spark broadcasts the list of keys while it is small."""
    return facts.join(wanted.select("company_id").distinct(), "company_id", "left_semi")


def _first_lists(df: DataFrame, order: Sequence[Column], limit: int, fields: Sequence[Column | str], name: str) -> DataFrame:
    """At most ``limit`` rows of each company as one ordered array of structs."""
    ranked = rank_within(df, ["company_id"], order, limit)
    listed = ranked.groupBy("company_id").agg(F.sort_array(F.collect_list(F.struct("_rank", *fields))).alias("_list"))
    return listed.select("company_id", F.transform("_list", lambda e: e.dropFields("_rank")).alias(name))


def decision_contacts(contacts: DataFrame, roles: Sequence[str] = DECISION_ROLES) -> DataFrame:
    return contacts.filter(F.col("role").isin(list(roles)))


def contact_order(roles: Sequence[str] = DECISION_ROLES) -> list[Column]:
    return [category_rank("role", roles), F.asc("contact_id")]


def newest_tickets() -> list[Column]:
    return [F.desc("created_at"), F.desc("ticket_id")]


def newest_surveys() -> list[Column]:
    return [F.desc("survey_date"), F.desc("survey_id")]


def company_context(
    candidates: DataFrame, contacts: DataFrame, tickets: DataFrame, nps: DataFrame,
    subscriptions: DataFrame, agents: DataFrame, roles: Sequence[str] = DECISION_ROLES,
) -> DataFrame:
    """Candidates with their contacts, newest tickets and surveys (short lists), contract and manager."""
    people = _first_lists(
        _thinned(decision_contacts(contacts, roles), candidates), contact_order(roles), CONTACT_LIMIT,
        [person_name().alias("contact_name"), "role", "email", "phone"], "contacts",
    )
    cases = _first_lists(
        _thinned(tickets, candidates), newest_tickets(), TICKET_LIMIT,
        ["priority", "status", "sentiment_score", "is_escalated", "subject"], "recent_tickets",
    )
    surveys = _first_lists(
        _thinned(nps, candidates), newest_surveys(), NPS_LIMIT,
        ["nps_score", "nps_category", F.col("comment").alias("verbatim"), "survey_date"], "nps_history",
    )
    contract = current_contract(_thinned(subscriptions, candidates)).select(
        "company_id",
        F.struct(
            F.col("plan_type").alias("plan_name"), "mrr", "billing_cycle",
            F.col("end_date").alias("contract_end_date"), "status",
        ).alias("subscription"),
    )
    managers = agents.select(
        F.col("agent_id").alias("cs_agent_id"),
        F.struct(person_name().alias("agent_name"), "region", F.col("email").alias("agent_email")).alias("cs_agent"),
    )
    out = candidates
    for side in (people, cases, surveys, contract):
        out = out.join(side, "company_id", "left")
    return look_up(out, managers, "cs_agent_id")


def _cases(test: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.array_size(F.filter("recent_tickets", test)), F.lit(0))


def action_context(
    wanted: DataFrame, companies: DataFrame, health: DataFrame, contacts: DataFrame, tickets: DataFrame,
    nps: DataFrame, subscriptions: DataFrame, agents: DataFrame, predictions: DataFrame,
    roles: Sequence[str] = DECISION_ROLES, as_of=None,
) -> DataFrame:
    """One flat row per wanted company: facts, best contact, latest surveys, newest tickets and their states, contract, manager, score."""
    base = named_in(companies, wanted, "company_id").select(
        "company_id", "company_name", F.col("sector_label").alias("industry"), "company_size", "city", "country",
        F.col("assigned_cs_agent_id").alias("cs_agent_id"), days_between(day(as_of), "customer_since").alias("tenure_days"),
    )
    figures = health.select("company_id", F.col("mrr").alias("mrr_current"), "days_to_renewal", "health_score", "risk_tier")
    people = decision_contacts(_thinned(contacts, wanted), roles)
    person = latest_per_key(people, ["company_id"], contact_order(roles)).select(
        "company_id", "contact_id", person_name().alias("contact_name"), F.col("role").alias("contact_role"),
        F.col("email").alias("contact_email"),
    )
    surveys = _first_lists(
        _thinned(nps, wanted), newest_surveys(), NPS_LIMIT,
        ["nps_score", "nps_category", F.col("comment").alias("verbatim")], "nps_history",
    )
    cases = _first_lists(
        _thinned(tickets, wanted), newest_tickets(), 3,
        ["priority", "status", "subject", "sentiment_score", "is_escalated"], "recent_tickets",
    )
    contract = current_contract(_thinned(subscriptions, wanted)).select(
        "company_id", F.col("plan_type").alias("plan_name"), F.col("mrr").alias("contract_mrr"), "billing_cycle",
        F.col("status").alias("contract_status"), "duration_days",
    )
    newest = latest_per_key(named_in(predictions, wanted, "company_id"), ["company_id"], [F.desc("prediction_date")]).select(
        "company_id", "churn_probability", F.col("risk_tier").alias("churn_tier"), "top_factors", "prediction_date"
    )
    managers = agents.select(
        F.col("agent_id").alias("cs_agent_id"), person_name().alias("agent_name"), F.col("email").alias("agent_email")
    )
    out = base.join(figures, "company_id")
    for side in (person, surveys, cases, contract, newest):
        out = out.join(side, "company_id", "left")
    return (
        look_up(out, managers, "cs_agent_id")
        .withColumns(
            {
                "latest_nps": F.get("nps_history", F.lit(0))["nps_score"],
                "latest_nps_category": F.get("nps_history", F.lit(0))["nps_category"],
                "latest_verbatim": F.get("nps_history", F.lit(0))["verbatim"],
                "previous_nps": F.get("nps_history", F.lit(1))["nps_score"],
                "previous_nps_category": F.get("nps_history", F.lit(1))["nps_category"],
                "ticket_count": F.coalesce(F.array_size("recent_tickets"), F.lit(0)),
                "open_cases": _cases(lambda t: t["status"].isin(list(OPEN_STATUSES))),
                "escalated_cases": _cases(lambda t: t["is_escalated"]),
            }
        )
    )


# --- decision -----------------------------------------------------------------

def channel_of(action_type) -> Column:
    return lookup(action_type, ACTION_CHANNELS, "email")


def key_signals(top_factors, k: int = 3) -> Column:
    return factor_names(parse_factors(top_factors), k)


def decide_action(context: DataFrame) -> DataFrame:
    """Action type, urgency, reason and signals from the context; rules are tried top down."""
    high = F.col("risk_tier") == "High"
    big = F.col("mrr_current").cast("double") > ESCALATION_MRR
    leaving = (F.col("days_to_renewal") < RENEWAL_SOON_DAYS) | (F.col("contract_status") == "downgraded")
    reachable = F.col("recent_tickets").isNotNull() & F.col("contacts").isNotNull()
    action = (
        F.when(big, "escalation").when(high & leaving, "discount").when(high & reachable, "call").otherwise("email")
    )
    urgency = (
        F.when(F.col("action_type") == "escalation", "critical")
        .when(F.col("churn_probability") >= ML_MEDIUM_UP_TO, "high")
        .otherwise("medium")
    )
    reasons = {
        "escalation": "Monthly revenue is above the escalation limit.",
        "discount": "High risk close to renewal or after a downgrade.",
        "call": "High risk with support history and a decision maker to reach.",
        "email": "No stronger step applies.",
    }
    return (
        context.withColumn("action_type", action)
        .withColumn("urgency", urgency)
        .withColumn("rationale", lookup("action_type", reasons))
        .withColumn("key_signals", key_signals("top_factors"))
        .withColumn("channel", channel_of("action_type"))
    )


def decision_meta() -> Column:
    return F.to_json(F.struct("key_signals", "rationale", "urgency", "churn_probability"))


def parse_meta(content) -> Column:
    """Decision metadata of a queued row; unreadable text gives empty signals and no reason."""
    meta = F.from_json(col(content), META_TYPE)
    return F.struct(
        F.coalesce(meta["key_signals"], F.array().cast("array<string>")).alias("key_signals"),
        F.coalesce(meta["rationale"], F.lit("")).alias("rationale"),
    )


def decision_summary(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("action_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "action_type")


# --- queue --------------------------------------------------------------------

def stable_id(*parts) -> Column:
    """Key from the business values, so a retried task writes the same id."""
    return F.sha2(F.concat_ws("|", *[col(p).cast("string") for p in parts]), 256)


def queued_rows(decisions: DataFrame, now, created_by: str = "risk_detection") -> DataFrame:
    at = F.lit(now)
    return decisions.select(
        stable_id("company_id", "action_type", at).alias("action_id"),
        "company_id",
        F.lit(None).alias("contact_id"),
        F.lit(None).alias("agent_id"),
        "action_type",
        channel_of("action_type").alias("channel"),
        F.lit("queued").alias("status"),
        decision_meta().alias("generated_content"),
        at.alias("created_at"),
        F.lit(None).alias("approved_at"),
        F.lit(None).alias("executed_at"),
        F.lit("pending").alias("outcome"),
        F.lit(created_by).alias("created_by_agent"),
    )


def enqueue(actions: DataFrame, decisions: DataFrame, now, created_by: str = "risk_detection") -> DataFrame:
    """Add decisions as queued rows, one open row per company and action type.

    Of several decisions for the same pair in one batch the one with the highest probability is taken.
    """
    pair = ["company_id", "action_type"]
    chosen = latest_per_key(decisions, pair, [F.desc("churn_probability"), F.asc("urgency"), F.asc("rationale")])
    rows = queued_rows(chosen, now, created_by)
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in actions.schema.fields])
    return merge_insert(actions, typed, pair, F.col("status") == "queued")


def content_generator(generate: Callable[[pd.DataFrame], pd.Series], columns: Sequence[str]) -> Callable[[], Column]:
    """Content from a Python function instead of the templates: it gets Arrow batches of the named context columns.

    The result is passed to ``queue_to_pending`` as ``render``.
    """

    @F.pandas_udf("string")
    def content(batch: pd.DataFrame) -> pd.Series:
        return generate(batch)

    return lambda: content(F.struct(*columns))


def queue_to_pending(
    actions: DataFrame, context: DataFrame, now, created_by: str = "retention_action", render=render_content
) -> DataFrame:
    """Turn every queued row whose company has a context into a pending row with content.

    The pending row takes the place of the queued one in the same step, so a failed write leaves the
    queue as it was. Rows of unknown companies stay queued. ``render`` may be any column builder.
    """
    names = actions.columns
    clash = {c: f"_x_{c}" for c in context.columns if c in names and c != "company_id"}
    facts = context.withColumnsRenamed(clash).withColumn("_known", F.lit(True))
    joined = look_up(actions, facts, "company_id").withColumn("_meta", parse_meta("generated_content"))
    ready = joined.withColumns(
        {
            "_ready": (F.col("status") == "queued") & F.coalesce(F.col("_known"), F.lit(False)),
            "key_signals": F.col("_meta")["key_signals"],
            "rationale": F.col("_meta")["rationale"],
        }
    )
    new = {
        "action_id": stable_id("action_id", F.lit("pending")),
        "contact_id": F.col(clash.get("contact_id", "contact_id")),
        "agent_id": F.col("cs_agent_id"),
        "channel": channel_of("action_type"),
        "status": F.lit("pending"),
        "generated_content": F.trim(render()),
        "created_at": F.lit(now),
        "approved_at": F.lit(None),
        "executed_at": F.lit(None),
        "outcome": F.lit("pending"),
        "created_by_agent": F.lit(created_by),
    }
    types = {f.name: f.dataType for f in actions.schema.fields}
    return ready.select(
        *[
            F.when(F.col("_ready"), new[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
            for c in names
        ]
    )


# --- review -------------------------------------------------------------------

def review_view(
    actions: DataFrame, companies: DataFrame, health: DataFrame, predictions: DataFrame,
    contacts: DataFrame, agents: DataFrame,
) -> DataFrame:
    """Pending actions with company, health, newest score, contact and manager."""
    pending = actions.filter(F.col("status") == "pending").select(
        "action_id", "company_id", "contact_id", "agent_id", "action_type", "channel", "status",
        "generated_content", "created_at", "created_by_agent",
    )
    scores = latest_only(predictions, "prediction_date").select("company_id", "churn_probability", "top_factors")
    people = contacts.select(
        "contact_id", person_name().alias("contact_name"), F.col("role").alias("contact_role"),
        F.col("email").alias("contact_email"),
    )
    managers = agents.select("agent_id", person_name().alias("agent_name"), F.col("region").alias("agent_region"))
    # One row per company first, only for companies with a pending action; then the actions look it up.
    profile = (
        named_in(companies, pending, "company_id")
        .select("company_id", "company_name", F.col("sector_label").alias("industry"), "company_size")
        .join(health.select("company_id", "mrr", "health_score", "risk_tier", "days_to_renewal"), "company_id")
        .join(scores, "company_id", "left")
    )
    view = look_up(pending, profile, "company_id", "inner")
    view = look_up(view, named_in(people, pending, "contact_id"), "contact_id")
    return look_up(view, managers, "agent_id")


def pending_review(view: DataFrame, agent_id=None, tier: str = "All", limit: int = 20) -> DataFrame:
    """Most urgent pending actions first."""
    return (
        filter_actions(view, tier, agent_id)
        .orderBy(F.desc_nulls_last("churn_probability"), F.desc("mrr"), F.asc("action_id"))
        .limit(limit)
    )


def _review_values(actions: DataFrame, values: Mapping[str, Column]) -> dict[str, Column]:
    types = {f.name: f.dataType for f in actions.schema.fields}
    return {c: v.cast(types[c]) for c, v in values.items()}


def approve_values(actions: DataFrame, now, content: str | None = None) -> dict[str, Column]:
    values = {"status": F.lit("approved"), "approved_at": F.lit(now)}
    if content:
        values["generated_content"] = F.lit(content)
    return _review_values(actions, values)


def reject_values(actions: DataFrame, now, reason: str) -> dict[str, Column]:
    note = F.concat(F.lit("[REJECTED "), F.date_format(F.lit(now), "yyyy-MM-dd HH:mm:ss"), F.lit("]\nReason: "), F.lit(reason))
    return _review_values(
        actions, {"status": F.lit("rejected"), "generated_content": note, "approved_at": F.lit(now)}
    )


def may_become(status: str) -> Column:
    """Whether the state machine lets the row's status turn into this one."""
    return F.coalesce(F.col("status").isin([a for a, b in ALLOWED_TRANSITIONS if b == status]), F.lit(False))


def refused(actions: DataFrame, cond: Column, status: str) -> DataFrame:
    """Rows a step to this status was asked for but is not allowed on; the step leaves them as they are."""
    return actions.filter(F.coalesce(cond, F.lit(False)) & ~may_become(status))


def approve(actions: DataFrame, cond: Column, now, content: str | None = None) -> DataFrame:
    return update_where(actions, cond & may_become("approved"), approve_values(actions, now, content))


def reject(actions: DataFrame, cond: Column, now, reason: str) -> DataFrame:
    return update_where(actions, cond & may_become("rejected"), reject_values(actions, now, reason))


def ask_changes(actions: DataFrame, cond: Column, now, instructions: str) -> DataFrame:
    """Send pending texts back with instructions: ``pending`` becomes ``modified`` and waits for a new text."""
    wish = F.to_json(F.struct(F.lit(instructions).alias("instructions"), F.col("generated_content").alias("text")))
    values = {"status": F.lit("modified"), "generated_content": wish, "approved_at": F.lit(now)}
    return update_where(actions, cond & may_become("modified"), _review_values(actions, values))


def regenerate(actions: DataFrame, context: DataFrame, now, created_by: str = "retention_action", render=render_content) -> DataFrame:
    """Give ``modified`` rows whose company has a context a new text that follows the instructions, and put them back to ``pending``.

    The instructions take the place of the reason, and the newest score names the signals. Rows of unknown companies stay as they are.
    """
    names = actions.columns
    clash = {c: f"_x_{c}" for c in context.columns if c in names and c != "company_id"}
    facts = context.withColumnsRenamed(clash).withColumn("_known", F.lit(True))
    wish = F.from_json("generated_content", "instructions string, text string")["instructions"]
    ready = look_up(actions, facts, "company_id").withColumns(
        {
            "_ready": (F.col("status") == "modified") & F.coalesce(F.col("_known"), F.lit(False)),
            "key_signals": key_signals("top_factors"),
            "rationale": F.coalesce(wish, F.lit("")),
        }
    )
    text = F.trim(F.concat(render(), F.when(F.col("rationale") != "", F.concat(F.lit("\n\nCHANGED AS ASKED: "), F.col("rationale"))).otherwise("")))
    new = _review_values(
        actions,
        {"status": F.lit("pending"), "generated_content": text, "created_at": F.lit(now), "approved_at": F.lit(None), "created_by_agent": F.lit(created_by)},
    )
    return ready.select(*[F.when(F.col("_ready"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in names])


def send(actions: DataFrame, cond: Column, now) -> DataFrame:
    """Mark approved actions as sent: the step between approval and outcome."""
    return update_where(actions, cond & may_become("sent"), _review_values(actions, {"status": F.lit("sent"), "executed_at": F.lit(now)}))


_DECISIONS = {"approve": "approved", "reject": "rejected"}


def _decided(decision: str) -> str:
    if decision not in _DECISIONS:
        raise ValueError(f"unknown decision: {decision}")
    return _DECISIONS[decision]


def bulk_review(actions: DataFrame, chosen: DataFrame, now, decision: str = "approve", reason: str = "") -> DataFrame:
    """Approve or reject every action whose id is in ``chosen`` and whose state allows it."""
    status = _decided(decision)
    values = approve_values(actions, now) if decision == "approve" else reject_values(actions, now, reason)
    return update_keys(actions, chosen, "action_id", values, may_become(status))


def bulk_counts(actions: DataFrame, chosen: DataFrame, decision: str = "approve") -> DataFrame:
    """What a bulk step does: ids chosen, changed, refused for their state, and unknown."""
    asked = chosen.select("action_id").distinct().join(actions.select("action_id", "status", F.lit(True).alias("_is")), "action_id", "left")
    known, free = F.coalesce("_is", F.lit(False)), may_become(_decided(decision))
    return asked.agg(
        F.count(F.lit(1)).alias("chosen"), F.count_if(known & free).alias("changed"), F.count_if(known & ~free).alias("refused"),
        F.count_if(~known).alias("unknown"),
    )


def update_outcome(actions: DataFrame, cond: Column, outcome: str, now) -> DataFrame:
    """Close actions as saved or churned."""
    if outcome not in CLOSED_OUTCOMES:
        raise ValueError(f"outcome must be one of {CLOSED_OUTCOMES}, not {outcome!r}")
    values = {"outcome": F.lit(outcome), "executed_at": F.lit(now), "status": F.lit("completed")}
    return update_where(actions, cond & may_become("completed"), _review_values(actions, values))


def invalid_transitions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Actions whose status moved along a way that is not allowed."""
    moved = (
        before.select("action_id", F.col("status").alias("status_before"))
        .join(after.select("action_id", F.col("status").alias("status_after")), "action_id")
        .filter(F.col("status_before") != F.col("status_after"))
    )
    allowed = [F.concat_ws(">", F.lit(a), F.lit(b)) for a, b in ALLOWED_TRANSITIONS]
    return moved.filter(~F.concat_ws(">", "status_before", "status_after").isin(allowed))
