"""Schemas of the externally filled tables, thresholds and defaults."""

from __future__ import annotations

from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold", "ml")

# --- fixed values -----------------------------------------------------------
# Domains, thresholds, weights and defaults that decide the results.
COMPANY_SIZES = ("TPE", "PME", "ETI", "GE")
SIZE_CODES = {"TPE": 1, "PME": 2, "ETI": 3, "GE": 4}
OPEN_STATUSES = ("open", "in_progress")
CLOSED_STATUSES = ("resolved", "closed")
URGENT_PRIORITIES = ("P1", "P2")
SENTIMENT_POSITIVE = 0.2
SENTIMENT_NEGATIVE = -0.2
NPS_RANGE = (0, 10)
NPS_PROMOTER = 9
NPS_PASSIVE = 7
HEALTH_WEIGHTS_PCT = {
    "usage_score": 30,
    "support_score": 25,
    "nps_score": 20,
    "payment_score": 15,
    "engagement_trend": 10,
}
HEALTH_HIGH_BELOW = 40
HEALTH_MEDIUM_BELOW = 65
ML_LOW_UP_TO = 0.40
ML_MEDIUM_UP_TO = 0.70
DECISION_THRESHOLD = 0.40
MIN_CHAMPION_AUC = 0.60
EVENT_TYPE_UNIVERSE = 15
NEVER_LOGGED_IN_DAYS = 9999
NEUTRAL_NPS = 5
ESCALATION_MRR = 5000
RENEWAL_SOON_DAYS = 60
ACTION_TYPES = ("email", "call", "discount", "escalation")
ACTION_CHANNELS = {"email": "email", "call": "phone", "discount": "email", "escalation": "in_app"}
ACTION_STATUSES = ("queued", "pending", "modified", "approved", "rejected", "sent", "completed")
CLOSED_OUTCOMES = ("saved", "churned")
ALLOWED_TRANSITIONS = (
    ("queued", "pending"),
    ("pending", "approved"),
    ("pending", "rejected"),
    ("pending", "modified"),
    ("approved", "sent"),
    ("approved", "completed"),
    ("sent", "completed"),
    ("modified", "pending"),
)
DECISION_ROLES = ("CEO", "CFO", "CTO", "VP Sales", "VP Operations", "Director")
EMAIL_WORDS = 280
CALL_SECTION_WORDS = 200
BRIEF_WORDS = 400
MAX_DISCOUNT_PCT = 20
LONG_COMMITMENT_MONTHS = 12
SHORT_COMMITMENT_MONTHS = 6

USAGE_FEATURES = (
    "dau_last_30d", "dau_last_90d", "usage_decline_pct_30d", "usage_decline_pct_90d",
    "distinct_features_used_30d", "feature_adoption_rate", "days_since_last_login", "active_users_ratio",
)
SUPPORT_FEATURES = (
    "ticket_count_30d", "ticket_count_90d", "ticket_velocity_14d", "p1_ticket_count_30d",
    "avg_ticket_sentiment_30d", "avg_ticket_sentiment_90d", "sentiment_trend",
    "open_ticket_count", "escalation_count_90d", "avg_ttr_hours_30d",
)
NPS_FEATURES = ("nps_latest", "nps_previous", "nps_delta_vs_prev", "is_detractor")
CONTRACT_FEATURES = (
    "mrr_current", "mrr_trend_90d", "days_to_renewal", "contract_duration_days", "has_downgraded", "upgrade_count",
)
GENERAL_FEATURES = ("company_size_encoded", "customer_tenure_days", "num_contacts", "num_decision_makers")
NUMERIC_FEATURES = USAGE_FEATURES + SUPPORT_FEATURES + NPS_FEATURES + CONTRACT_FEATURES + GENERAL_FEATURES
MODEL_INPUTS = NUMERIC_FEATURES + ("billing_cycle_annual",)
LABEL = "is_churned"
# --- end of fixed values ----------------------------------------------------


def _fields(spec: dict[str, tuple[T.DataType, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True, {"comment": c}) for n, (t, c) in spec.items()])


PREDICTIONS = _fields({
    "company_id": (T.StringType(), "Company key"),
    "prediction_date": (T.DateType(), "Day the batch was scored"),
    "churn_probability": (T.DoubleType(), "Probability of churn, 0 to 1"),
    "risk_tier": (T.StringType(), "High above 0.70, Medium above 0.40, else Low"),
    "top_factors": (T.StringType(), "JSON object: strongest inputs and their signed contribution"),
    "model_version": (T.StringType(), "Model version that scored the row"),
    "model_name": (T.StringType(), "Model that scored the row"),
})

ACTIONS = _fields({
    "action_id": (T.StringType(), "Action key"),
    "company_id": (T.StringType(), "Company key"),
    "contact_id": (T.StringType(), "Contact the action is aimed at"),
    "agent_id": (T.StringType(), "Responsible account manager"),
    "action_type": (T.StringType(), "email, call, discount or escalation"),
    "channel": (T.StringType(), "email, phone or in_app"),
    "status": (T.StringType(), "queued, pending, modified, approved, rejected, sent or completed"),
    "generated_content": (T.StringType(), "Decision metadata while queued, then the text"),
    "created_at": (T.TimestampType(), "Creation time"),
    "approved_at": (T.TimestampType(), "Review time"),
    "executed_at": (T.TimestampType(), "Execution time"),
    "outcome": (T.StringType(), "saved, churned or pending"),
    "created_by_agent": (T.StringType(), "Step that created the row"),
})

TABLE_COMMENTS = {
    "dim_cs_agents": "Account managers, one row each",
    "dim_companies": "Valid companies, one row each; no simulation columns",
    "dim_contacts": "Contacts of valid companies with a normalised e-mail",
    "fact_subscriptions": "Contracts with duration and current-contract flag",
    "fact_support_tickets": "Tickets with sentiment class and escalation flag",
    "fact_product_events": "Usage events with calendar date and hour",
    "fact_nps_scores": "Surveys with a score of 0 to 10 and recomputed class",
    "agg_company_health_score": "Weighted health score and risk tier per company",
    "feature_store_churn": "Model inputs and target, one row per company",
    "agg_churn_predictions": "Scored probabilities per company and day",
    "agg_retention_actions": "Retention actions and their review state",
    "agg_agent_performance": "Account-manager portfolio figures",
}

LAYER_COMMENTS = {
    "bronze": "Rows as the source systems delivered them",
    "silver": "Valid rows with settled types, one per key",
    "gold": "Figures per company and account manager, model inputs and the action queue",
    "ml": "Models, their scores and metrics",
}

COLUMN_COMMENTS = {
    "dim_companies": {
        "company_id": "Company key",
        "company_size": "Size class: TPE, PME, ETI or GE",
        "customer_since": "First day of the business relation",
        "is_active": "Whether a contract is running",
        "base_mrr": "Agreed monthly revenue in whole EUR",
    },
    "dim_contacts": {"contact_id": "Contact key", "email": "Address in lower case without blanks around it"},
    "fact_subscriptions": {
        "subscription_id": "Contract key",
        "duration_days": "Days from start to end",
        "is_current_contract": "Whether this is the company's newest contract",
    },
    "fact_support_tickets": {"ticket_id": "Ticket key", "sentiment_score": "From -1, bad, to 1, good"},
    "fact_product_events": {"event_id": "Event key", "event_date": "Calendar day of the event"},
    "fact_nps_scores": {"survey_id": "Survey key", "nps_score": "Answer from 0 to 10"},
    "agg_company_health_score": {
        "company_id": "Company key",
        "health_score": "Weighted score from 0 to 100",
        "risk_tier": "High below 40, Medium below 65, else Low",
    },
    "feature_store_churn": {"company_id": "Company key", "is_churned": "Target: 1 where the current contract has ended by churn"},
    "agg_agent_performance": {"agent_id": "Account-manager key", "portfolio_size": "Companies looked after"},
}
