"""Texts of retention actions: sections with a limit of words each, filled from the flat context columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnkit.functions import amount_text, col, first_words, percent_text, round_dec, text_or
from churnkit.schemas import (
    BRIEF_WORDS,
    CALL_SECTION_WORDS,
    EMAIL_WORDS,
    LONG_COMMITMENT_MONTHS,
    MAX_DISCOUNT_PCT,
    ML_MEDIUM_UP_TO,
    NPS_PASSIVE,
    SHORT_COMMITMENT_MONTHS,
)

#: Sections by kind of action; ``{name}`` is filled in. Sections are parted by an empty line.
SECTIONS = {
    "email": (
        "SUBJECT: Making the most of your plan, {client}",
        "Dear {person},",
        "Thank you for working with us on the {plan} plan.{answer}{cases}",
        "We would like to offer a short session on your setup this week. Please reply with two dates that suit you and we will bring the right people.",
        "Kind regards,\n{manager}\n{mail}",
    ),
    "call": (
        "ESTIMATED LENGTH: {minutes} minutes",
        "OPENING (30 s):\nThank {person} of {client} for the partnership on the {plan} plan, and say in one sentence why you call.",
        "DIAGNOSIS (2-3 min):\n- Which parts of the product does your team use less than it did?\n- Are the last {ticket_count} support cases solved as you need them?"
        "\n- What would have to change for a better score than {nps}?",
        "PROPOSAL (2-3 min):\nSignals seen: {signals}.\nAs the answers suggest: a training session, a named support contact or a review of the plan.",
        "CLOSING (1 min):\nAgree one next step and its date. Caller: {manager}, {mail}",
        "OBJECTIONS:\n- It costs too much -> set the price against the work the {plan} plan saves.\n- Hardly anybody uses it -> offer two teams a start at no charge."
        "\n- We are leaving anyway -> ask what the other product does better, and report it.",
    ),
    "discount": (
        "OFFER:\n- Type: {percent}% off the monthly price\n- Value: {reduction}\n- Duration: {months} months"
        "\n- Conditions: commitment of {months} months; more than {most}% needs a manager's approval",
        "EMAIL:\nSUBJECT: An offer for {client}\n\nDear {person},\n\nWe would like you to stay with us. With a commitment of {months} months the {plan} plan"
        " costs {percent}% less from the next invoice on.\n\nKind regards,\n{manager}\n{mail}",
        "INTERNAL CASE:\n- Revenue kept: {kept}\n- Cost of the offer: {cost}\n- Break-even: {even} months\n- If nothing is done: {revenue} lost, renewal in {renewal} days"
        "\n- Reason: {rationale}",
    ),
    "escalation": (
        "ESCALATION BRIEF - CONFIDENTIAL",
        "CLIENT: {client}\nREVENUE: {revenue}\nURGENCY: within {days} days",
        "SUMMARY:\n{client} pays {revenue} and leaves with a probability of {churn}.{because}",
        "WARNING SIGNS:\n{signal_lines}",
        "HISTORY:\nClient for {tenure} days, contract {contract}. NPS: {nps}, before that {nps_before}."
        "\nNewest support cases: {ticket_count}, of these open {open_cases} and escalated {escalated_cases}.",
        "RECOMMENDATION:\n- Action: {step}\n- Latest date: in {days} days\n- Owner: {manager}",
        "PREPARATION:\n- Topics: {signals}\n- Possible concessions: {most}% for {long} months, a named support contact"
        "\n- Not on offer: free months without a commitment",
    ),
}
#: Words of a section, and of the whole text, at most.
SECTION_WORDS = {"email": EMAIL_WORDS, "call": CALL_SECTION_WORDS, "discount": EMAIL_WORDS, "escalation": BRIEF_WORDS}
WHOLE_WORDS = {"email": EMAIL_WORDS, "escalation": BRIEF_WORDS}


def fill(template: str, values: dict[str, Column]) -> Column:
    """The template with ``{name}`` replaced by columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[part] if i % 2 else F.lit(part) for i, part in enumerate(parts) if part])


def offer_percent() -> Column:
    """More for the likelier leavers, never above what needs no approval."""
    return F.least(F.lit(MAX_DISCOUNT_PCT), F.when(F.col("churn_probability") >= ML_MEDIUM_UP_TO, 20).otherwise(10))


def offer_months(percent: Column) -> Column:
    return F.when(percent >= MAX_DISCOUNT_PCT, LONG_COMMITMENT_MONTHS).otherwise(SHORT_COMMITMENT_MONTHS)


def break_even(percent: Column, months: Column) -> Column:
    """Whole months of reduced revenue that pay for all of the reduction."""
    return F.ceil(percent * months / (100 - percent)).cast("int")


def _values() -> dict[str, Column]:
    mrr = F.coalesce("contract_mrr", "mrr_current")
    percent = offer_percent()
    months = offer_months(percent)
    reduction = round_dec(mrr * percent / 100, 0)
    high = F.col("churn_probability") >= ML_MEDIUM_UP_TO
    score = lambda value, kind: F.concat(text_or(value, "N/A"), F.lit(" ("), text_or(kind, "N/A"), F.lit(")"))
    signals = F.coalesce("key_signals", F.array().cast("array<string>"))
    return {
        "client": text_or("company_name", "N/A"),
        "person": text_or("contact_name", "N/A"),
        "plan": text_or("plan_name", "N/A"),
        "manager": text_or("agent_name", "your account manager"),
        "mail": text_or("agent_email", "N/A"),
        "nps": score("latest_nps", "latest_nps_category"),
        "nps_before": score("previous_nps", "previous_nps_category"),
        "answer": F.when(
            F.col("latest_nps") < NPS_PASSIVE,
            F.concat(F.lit(" Your last answer was "), F.col("latest_nps").cast("string"), F.lit(" of 10, and we want to put right what is behind it.")),
        ).otherwise(F.lit("")),
        "cases": F.when(
            F.col("open_cases") > 0, F.concat(F.lit(" Your open support cases, "), F.col("open_cases").cast("string"), F.lit(" of them, come first."))
        ).otherwise(F.lit("")),
        "minutes": (F.lit(6) + F.col("ticket_count")).cast("string"),
        "ticket_count": F.col("ticket_count").cast("string"),
        "open_cases": F.col("open_cases").cast("string"),
        "escalated_cases": F.col("escalated_cases").cast("string"),
        "signals": F.when(F.size(signals) == 0, "none").otherwise(F.array_join(signals, ", ")),
        "signal_lines": F.when(F.size(signals) == 0, "- none").otherwise(F.array_join(F.transform(signals, lambda x: F.concat(F.lit("- "), x)), "\n")),
        "rationale": F.col("rationale"),
        "because": F.when(F.col("rationale") != "", F.concat(F.lit(" "), "rationale")).otherwise(F.lit("")),
        "percent": percent.cast("string"),
        "months": months.cast("string"),
        "most": F.lit(str(MAX_DISCOUNT_PCT)),
        "long": F.lit(str(LONG_COMMITMENT_MONTHS)),
        "reduction": amount_text(reduction, "EUR per month"),
        "kept": amount_text(mrr - reduction, "EUR per month"),
        "cost": amount_text(reduction * months, "EUR"),
        "even": break_even(percent, months).cast("string"),
        "revenue": amount_text(mrr, "EUR per month"),
        "renewal": text_or("days_to_renewal", "N/A"),
        "churn": percent_text("churn_probability"),
        "days": F.when(high, "3").otherwise("7"),
        "tenure": text_or("tenure_days", "N/A"),
        "contract": text_or("contract_status", "N/A"),
        "step": F.when(high, "call by the management").otherwise("review meeting with the management"),
    }


def render_content(action_type="action_type") -> Column:
    """Text of an action from the flat context columns plus ``key_signals`` and ``rationale``."""
    values, kind = _values(), col(action_type)

    def text(name: str) -> Column:
        whole = F.concat_ws("\n\n", *[first_words(fill(section, values), SECTION_WORDS[name]) for section in SECTIONS[name]])
        return first_words(whole, WHOLE_WORDS[name]) if name in WHOLE_WORDS else whole

    out = F.lit(None).cast("string")
    for name in ("call", "discount", "escalation"):
        out = F.when(kind == name, text(name)).otherwise(out)
    return F.when(kind.isin("call", "discount", "escalation"), out).otherwise(text("email"))
