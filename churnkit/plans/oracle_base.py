"""Named relations in ANSI SQL that the check queries are written on.

They state the same definitions as the DataFrame operators, over the same given tables. ``with_relations``
puts the ones a query names, and the ones those name, in front of it.
"""

from __future__ import annotations

import re

DAY = "DATE '2001-08-01'"

def rnd(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"

def mean(x: str, where: str | None = None) -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    return f"(favg(CAST({x} AS DOUBLE)){f})"

def cnt(where: str) -> str:
    return f"COUNT(*) FILTER (WHERE {where})"

def since(c: str, n: int) -> str:
    return f"{c} >= {DAY} - {n}"

def band(c: str, older: int, newer: int) -> str:
    return f"({c} >= {DAY} - {older} AND {c} < {DAY} - {newer})"

def days(later: str, earlier: str) -> str:
    return f"CAST(date_diff('day', CAST({earlier} AS DATE), CAST({later} AS DATE)) AS INTEGER)"

def newest(key: str, *order: str) -> str:
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return f"row_number() OVER (PARTITION BY {key} ORDER BY {by}) AS rn"

def pick(values: list[str], index: str) -> str:
    return "([" + ", ".join(f"'{v}'" for v in values) + f"])[CAST({index} AS BIGINT) + 1]"

def spark_hash(x: str) -> str:
    """Murmur3 of a 32-bit integer with seed 42, as Spark's hash()."""

    def mul(a: str, b: int) -> str:
        return f"CAST((CAST({a} AS HUGEINT) * {b}) % 4294967296 AS BIGINT)"

    def rotl(a: str, r: int) -> str:
        return f"((({a} << {r}) & 4294967295) | ({a} >> {32 - r}))"

    steps = [
        mul("v", 3432918353),
        rotl("v", 15),
        mul("v", 461845907),
        "xor(CAST(42 AS BIGINT), v)",
        rotl("v", 13),
        "(v * 5 + 3864292196) % 4294967296",
        "xor(v, CAST(4 AS BIGINT))",
        "xor(v, v >> 16)",
        mul("v", 2246822507),
        "xor(v, v >> 13)",
        mul("v", 3266489909),
        "xor(v, v >> 16)",
        "CASE WHEN v >= 2147483648 THEN v - 4294967296 ELSE v END",
    ]
    out = f"[(CAST({x} AS BIGINT) % 4294967296 + 4294967296) % 4294967296]"
    for s in steps:
        out = f"list_transform({out}, lambda v: {s})"
    return f"({out})[1]"

def seeded(x: str, multiplier: int, modulus: int) -> str:
    h = spark_hash(f"({x}) * {multiplier}")
    return f"CAST((({h} % {modulus}) + {modulus}) % {modulus} AS INTEGER)"

FACTORS = {"dau_last_30d": 7, "days_to_renewal": 11, "mrr_trend_90d": 13, "nps_latest": 17, "open_ticket_count": 19,
           "sentiment_trend": 23}
_factor_rows = " UNION ALL ".join(
    f"SELECT c_custkey AS company_id, '{n}' AS name, CAST((c_custkey * {k}) % 201 - 100 AS DOUBLE) / 100 AS value FROM customer"
    for n, k in FACTORS.items()
)
DECIDERS = "('CEO','CFO','CTO','VP Sales','VP Operations','Director')"
ROLE_RANK = (
    "CASE role WHEN 'CEO' THEN 1 WHEN 'CFO' THEN 2 WHEN 'CTO' THEN 3 WHEN 'VP Sales' THEN 4 "
    "WHEN 'VP Operations' THEN 5 WHEN 'Director' THEN 6 ELSE 7 END"
)
CHANNEL = "CASE action_type WHEN 'call' THEN 'phone' WHEN 'escalation' THEN 'in_app' ELSE 'email' END"

RELATIONS: dict[str, str] = {
    "raw_agents": f"""
        SELECT n_nationkey AS agent_id, n_name AS first_name, 'of ' || r_name AS last_name,
               ' ' || n_name || '@X.COM ' AS email, r_name AS region,
               {pick(['enterprise', 'midmarket', 'small'], 'n_nationkey % 3')} AS specialization,
               DATE '1990-01-01' + n_nationkey * 100 AS hire_date, n_nationkey % 5 <> 0 AS is_active
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "first_order": "SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_day FROM orders GROUP BY o_custkey",
    "raw_companies": f"""
        SELECT c_custkey AS company_id, c_name AS company_name, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS siren,
               substr(c_mktsegment, 1, 4) AS sector_naf_code, c_mktsegment AS sector_label,
               CASE WHEN c_acctbal < 2000 THEN 'TPE' WHEN c_acctbal < 5000 THEN 'PME'
                    WHEN c_acctbal < 8000 THEN 'ETI' ELSE 'GE' END AS company_size,
               CAST(c_custkey % 500 + 1 AS INTEGER) AS num_employees, n_name AS city, r_name AS region,
               'FR' AS country, lower(c_name) || '.example' AS website, first_day AS subscription_start_date,
               {pick(['Starter', 'Business', 'Enterprise'], 'c_custkey % 3')} AS plan_type,
               CAST(floor(c_acctbal) AS INTEGER) AS base_mrr, c_nationkey AS assigned_cs_agent_id,
               'profile_' || (c_custkey % 4) AS churn_profile
        FROM customer LEFT JOIN first_order ON o_custkey = c_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "raw_contacts": f"""
        SELECT person AS contact_id, c_custkey AS company_id, c_name AS first_name,
               'No ' || person AS last_name,
               CASE WHEN person % 11 <> 10 THEN ' ' || c_name || '@X.COM ' END AS email,
               lpad(CAST(person AS VARCHAR), 8, '0') AS phone,
               {pick(['CEO', 'CFO', 'CTO', 'VP Sales', 'Office Manager', 'Analyst'], 'person % 6')} AS role,
               person % 6 < 3 AS is_decision_maker, person % 4 = 0 AS is_primary_contact,
               CAST(DATE '1999-01-01' + CAST(person % 700 AS INTEGER) AS TIMESTAMP) AS created_at
        FROM (SELECT *, c_custkey * 4 + unnest(range(0, c_custkey % 4 + 1)) AS person FROM customer)""",
    "raw_subscriptions": f"""
        SELECT o_orderkey AS subscription_id, o_custkey AS company_id,
               {pick(['Starter', 'Business', 'Enterprise'], 'o_orderkey % 3')} AS plan_type,
               CASE WHEN o_orderkey % 2 = 0 THEN 'annual' ELSE 'monthly' END AS billing_cycle,
               CAST(floor(o_totalprice / 50) AS INTEGER) AS mrr, CAST(floor(o_totalprice / 50) AS INTEGER) * 12 AS arr,
               CAST(o_orderdate AS DATE) AS start_date,
               CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 2 = 0 THEN 365 ELSE 30 END AS end_date,
               CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'churned' ELSE 'renewed' END
                    WHEN 'O' THEN 'active'
                    ELSE {pick(['downgraded', 'upgraded', 'active'], 'o_orderkey % 3')} END AS status,
               CAST(o_orderkey % 2 + 1 AS INTEGER) AS contract_version, o_orderkey % 3 <> 0 AS auto_renew
        FROM orders""",
    "lines": """
        SELECT lineitem.*, o_custkey AS company_id, l_orderkey * 10 + l_linenumber AS line_key,
               CASE WHEN l_linestatus = 'O' THEN CASE WHEN l_orderkey % 2 = 0 THEN 'open' ELSE 'in_progress' END
                    ELSE CASE WHEN l_orderkey % 2 = 0 THEN 'resolved' ELSE 'closed' END END AS ticket_status
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "raw_tickets": """
        SELECT line_key AS ticket_id, company_id, l_suppkey AS contact_id, l_returnflag AS category,
               'P' || (CAST(l_quantity AS INTEGER) % 4 + 1) AS priority, ticket_status AS status,
               'Ticket ' || line_key AS subject, 'Part ' || l_partkey AS description,
               CAST((0.04::DOUBLE - l_tax) * 25 AS DECIMAL(4,2)) AS sentiment_score, l_shipdate AS created_at,
               CASE WHEN ticket_status IN ('resolved', 'closed') THEN
                    CAST(CAST(l_shipdate AS DATE) + (CAST(ceil(CAST(l_quantity AS INTEGER) / 24) AS INTEGER) + 1) AS TIMESTAMP)
                    END AS resolved_at,
               CAST(l_quantity AS INTEGER) AS ttr_hours, CAST(l_suppkey % 25 AS INTEGER) AS assigned_agent_id
        FROM lines""",
    "raw_nps": """
        SELECT line_key AS survey_id, company_id, l_suppkey AS contact_id,
               CAST(round(l_discount * 100) AS INTEGER) AS nps_score, 'Part ' || l_partkey AS comment,
               CAST(l_shipdate AS DATE) AS survey_date,
               'Q' || quarter(l_shipdate) || '-' || year(l_shipdate) AS quarter, l_shipdate AS stamped
        FROM lines""",
    "raw_events": f"""
        SELECT event_id, user_id AS company_id, event_id % 7 AS contact_id, event_type,
               CAST({DAY} - CAST(3 * (DATE '2024-01-31' - CAST(ts AS DATE)) AS INTEGER) AS TIMESTAMP) + to_hours(CAST(hour(ts) AS INTEGER)) AS event_timestamp,
               'S-' || lpad(CAST(event_id % 99999 AS VARCHAR), 5, '0') AS session_id,
               {pick(['desktop', 'desktop', 'mobile'], 'event_id % 3')} AS device_type,
               {pick(['b0', 'b1', 'b2', 'b3'], 'event_id % 4')} AS browser
        FROM events""",
    "factor_values": _factor_rows,
    "factors": """
        SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY abs(value) DESC, name) AS place FROM factor_values""",
    "top5_json": """
        SELECT company_id, '{' || string_agg('"' || name || '":' || CAST(value AS VARCHAR), ',' ORDER BY place) || '}' AS top_factors
        FROM factors WHERE place <= 5 GROUP BY company_id""",
    "top3_names": """
        SELECT company_id, string_agg(name, ', ' ORDER BY place) AS names FROM factors WHERE place <= 3 GROUP BY company_id""",
    "predictions": f"""
        SELECT p.company_id, prediction_date, churn_probability,
               CASE WHEN churn_probability <= 0.4 THEN 'Low' WHEN churn_probability <= 0.7 THEN 'Medium' ELSE 'High' END AS risk_tier,
               top_factors, '1' AS model_version, 'churn_gbt' AS model_name
        FROM (SELECT c_custkey AS company_id, CAST({DAY} + (n - 1) AS DATE) AS prediction_date,
                     CAST((c_custkey * 37 + n) % 1000 AS DOUBLE) / 1000.0::DOUBLE AS churn_probability
              FROM customer, (SELECT CAST(unnest([0, 1]) AS INTEGER) AS n)) p JOIN top5_json USING (company_id)""",
    "latest_predictions": "SELECT * FROM predictions WHERE prediction_date = (SELECT MAX(prediction_date) FROM predictions)",
    "actions": f"""
        SELECT *, {CHANNEL} AS channel FROM (
        SELECT md5(CAST(c_custkey AS VARCHAR)) AS action_id, c_custkey AS company_id,
               CASE WHEN c_custkey // 5 % 5 <> 0 THEN c_custkey * 4 END AS contact_id,
               CASE WHEN c_custkey // 5 % 5 <> 0 THEN c_nationkey END AS agent_id,
               {pick(['email', 'call', 'discount', 'escalation'], 'c_custkey % 4')} AS action_type,
               {pick(['queued', 'pending', 'approved', 'rejected', 'completed'], 'c_custkey // 5 % 5')} AS status,
               CASE WHEN c_custkey // 5 % 5 = 0 THEN CASE WHEN c_custkey % 3 = 0 THEN 'not json'
                    ELSE '{{"key_signals":["dau_last_30d","nps_latest"],"rationale":"Case ' || c_custkey
                         || '","urgency":"high","churn_probability":0.8}}' END
                    ELSE 'Text for ' || c_name END AS generated_content,
               CAST({DAY} - CAST(c_custkey % 30 AS INTEGER) AS TIMESTAMP) AS created_at,
               CASE WHEN c_custkey // 5 % 5 IN (2, 3, 4) THEN CAST({DAY} - CAST(c_custkey % 30 AS INTEGER) + 1 AS TIMESTAMP) END AS approved_at,
               CASE WHEN c_custkey // 5 % 5 = 4 THEN CAST({DAY} - CAST(c_custkey % 30 AS INTEGER) + 2 AS TIMESTAMP) END AS executed_at,
               CASE WHEN c_custkey // 5 % 5 = 4 THEN CASE WHEN c_custkey % 3 = 0 THEN 'saved' ELSE 'churned' END
                    ELSE 'pending' END AS outcome, 'risk_detection' AS created_by_agent
        FROM customer)""",
    "scored_labels": """
        SELECT doc_id, quality AS label, CAST((doc_id * 7919) % 70 + quality * 30 AS DOUBLE) / 100 AS score,
               CAST(doc_id % 3 AS INTEGER) AS part FROM labels""",
    # --- conformed ---
    "dim_agents": f"""
        SELECT agent_id, first_name, last_name, trim(lower(email)) AS email, region, specialization, hire_date,
               {rnd(f"{days(DAY, 'hire_date')} / 365.25::DOUBLE", 1)} AS years_of_service, is_active FROM raw_agents""",
    "dim_companies": """
        SELECT c.* EXCLUDE (subscription_start_date, churn_profile), subscription_start_date AS customer_since,
               COALESCE(any_active, FALSE) AS is_active
        FROM raw_companies c
        LEFT JOIN (SELECT company_id, bool_or(status = 'active') AS any_active FROM raw_subscriptions GROUP BY company_id) s
               USING (company_id)
        WHERE company_size IN ('TPE', 'PME', 'ETI', 'GE') AND base_mrr > 0""",
    "dim_contacts": """
        SELECT * REPLACE (trim(lower(email)) AS email) FROM raw_contacts
        WHERE email IS NOT NULL AND company_id IN (SELECT company_id FROM dim_companies)""",
    "fact_subscriptions": f"""
        SELECT s.*, {days('end_date', 'start_date')} AS duration_days, start_date = newest_start AS is_current_contract
        FROM raw_subscriptions s
        JOIN (SELECT company_id, MAX(start_date) AS newest_start FROM raw_subscriptions GROUP BY company_id) n USING (company_id)
        WHERE mrr > 0 AND company_id IN (SELECT company_id FROM dim_companies)""",
    "fact_tickets": f"""
        SELECT * EXCLUDE (rn) REPLACE (CAST(sentiment_score AS DOUBLE) AS sentiment_score),
               CASE WHEN sentiment_score >= 0.2 THEN 'positive' WHEN sentiment_score <= -0.2 THEN 'negative' ELSE 'neutral' END AS sentiment_category,
               priority IN ('P1', 'P2') AND status IN ('open', 'in_progress') AS is_escalated
        FROM (SELECT *, {newest('ticket_id', 'created_at', 'company_id', 'priority', 'status', 'sentiment_score', 'ttr_hours',
                                'assigned_agent_id', 'contact_id', 'category', 'subject', 'description', 'resolved_at')}
              FROM raw_tickets)
        WHERE rn = 1 AND company_id IN (SELECT company_id FROM dim_companies)""",
    "fact_nps": f"""
        SELECT * EXCLUDE (rn, stamped),
               CASE WHEN nps_score >= 9 THEN 'promoter' WHEN nps_score >= 7 THEN 'passive' ELSE 'detractor' END AS nps_category
        FROM (SELECT *, {newest('survey_id', 'stamped', 'company_id', 'nps_score', 'survey_date', 'contact_id', 'comment', 'quarter')}
              FROM raw_nps WHERE nps_score BETWEEN 0 AND 10)
        WHERE rn = 1 AND company_id IN (SELECT company_id FROM dim_companies)""",
    "fact_events": f"""
        SELECT * EXCLUDE (rn), CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour
        FROM (SELECT *, {newest('event_id', 'company_id', 'event_type', 'event_timestamp', 'contact_id', 'session_id',
                                'device_type', 'browser')} FROM raw_events)
        WHERE rn = 1 AND company_id IN (SELECT company_id FROM dim_companies)""",
    # --- health ---
    "usage_activity": f"""
        SELECT company_id, {cnt(since('event_date', 30))} AS events_30d, {cnt(since('event_date', 90))} AS events_90d,
               {cnt(band('event_date', 60, 30))} AS events_30_60d,
               COUNT(DISTINCT event_type) FILTER (WHERE {since('event_date', 30)}) AS distinct_features_30d,
               MAX(event_date) AS last_event_date
        FROM fact_events GROUP BY company_id""",
    "support_activity": f"""
        SELECT company_id, {cnt(since('created_at', 30))} AS tickets_30d, {cnt(since('created_at', 90))} AS tickets_90d,
               {mean('sentiment_score', since('created_at', 30))} AS avg_sentiment_30d,
               {cnt("priority IN ('P1', 'P2') AND " + since('created_at', 30))} AS p1p2_count_30d
        FROM fact_tickets GROUP BY company_id""",
    "latest_nps": f"""
        SELECT company_id, nps_score AS nps_latest, nps_category
        FROM (SELECT *, {newest('company_id', 'survey_date', 'survey_id')} FROM fact_nps) WHERE rn = 1""",
    "current_contracts": f"""
        SELECT * EXCLUDE (rn) FROM (SELECT *, {newest('company_id', 'start_date', 'subscription_id')}
        FROM fact_subscriptions WHERE is_current_contract) WHERE rn = 1""",
    "contract_state": f"""
        SELECT company_id, mrr, status AS contract_status, {days('end_date', DAY)} AS days_to_renewal,
               CASE WHEN status = 'active' THEN 100 WHEN status IN ('downgraded', 'churned') THEN 30 ELSE 70 END AS payment_health_pct
        FROM current_contracts""",
    "components": """
        SELECT company_id,
               CASE WHEN COALESCE(events_90d, 0) = 0 THEN 0 ELSE CAST(LEAST(100,
                    (CAST(COALESCE(events_30d, 0) AS HUGEINT) * 20000000000000000
                      + ((2 * events_90d * 1000000 + 3) // 6 + 1000000))
                    // (2 * ((2 * events_90d * 1000000 + 3) // 6 + 1000000)) // 100000000) AS INTEGER) END AS usage_score,
               CAST(GREATEST(0, LEAST(100, TRUNC(100 - COALESCE(tickets_30d, 0) * 5 - COALESCE(p1p2_count_30d, 0) * 15
                    + COALESCE(avg_sentiment_30d, 0) * 20))) AS INTEGER) AS support_score,
               COALESCE(nps_latest * 10, 50) AS nps_score, COALESCE(payment_health_pct, 50) AS payment_score,
               CASE WHEN COALESCE(events_30_60d, 0) = 0 THEN 50
                    ELSE CAST(GREATEST(0, LEAST(100, 50 + (COALESCE(events_30d, 0) - events_30_60d) * 5)) AS INTEGER) END AS engagement_trend,
               COALESCE(events_30d, 0) AS events_30d, COALESCE(events_90d, 0) AS events_90d,
               COALESCE(distinct_features_30d, 0) AS distinct_features_30d, last_event_date,
               COALESCE(tickets_30d, 0) AS tickets_30d, COALESCE(avg_sentiment_30d, 0) AS avg_sentiment_30d,
               COALESCE(nps_latest, 5) AS nps_latest, nps_category, mrr, days_to_renewal, contract_status
        FROM (SELECT company_id FROM dim_companies) LEFT JOIN usage_activity USING (company_id)
        LEFT JOIN support_activity USING (company_id) LEFT JOIN latest_nps USING (company_id)
        LEFT JOIN contract_state USING (company_id)""",
    "health": """
        SELECT * EXCLUDE (points), CAST(points // 100 AS INTEGER) AS health_score,
               CASE WHEN points < 4000 THEN 'High' WHEN points < 6500 THEN 'Medium' ELSE 'Low' END AS risk_tier
        FROM (SELECT *, usage_score * 30 + support_score * 25 + nps_score * 20 + payment_score * 15 + engagement_trend * 10 AS points
              FROM components)""",
    # --- features ---
    "usage_features": f"""
        SELECT company_id, COUNT(DISTINCT event_date) FILTER (WHERE {since('event_date', 30)}) AS dau_last_30d,
               COUNT(DISTINCT event_date) FILTER (WHERE {since('event_date', 90)}) AS dau_last_90d,
               {cnt(since('event_date', 30))} AS events_30d, {cnt(band('event_date', 60, 30))} AS events_30_60d,
               {cnt(band('event_date', 90, 60))} AS events_60_90d, {cnt(since('event_date', 90))} AS events_90d,
               COUNT(DISTINCT event_type) FILTER (WHERE {since('event_date', 30)}) AS distinct_features_used_30d,
               COUNT(DISTINCT contact_id) FILTER (WHERE {since('event_date', 30)}) AS active_users_30d,
               {rnd(f"COUNT(DISTINCT event_type) FILTER (WHERE {since('event_date', 30)}) / 5.0::DOUBLE", 3)} AS feature_adoption_rate,
               {days(DAY, 'MAX(event_date)')} AS days_since_last_login
        FROM fact_events GROUP BY company_id""",
    "support_features": f"""
        SELECT company_id, {cnt(since('created_at', 30))} AS ticket_count_30d, {cnt(since('created_at', 90))} AS ticket_count_90d,
               {cnt(since('created_at', 14))} AS ticket_velocity_14d,
               {cnt("priority = 'P1' AND " + since('created_at', 30))} AS p1_ticket_count_30d,
               {rnd(mean('sentiment_score', since('created_at', 30)), 3)} AS avg_ticket_sentiment_30d,
               {rnd(mean('sentiment_score', since('created_at', 90)), 3)} AS avg_ticket_sentiment_90d,
               {cnt("status IN ('open', 'in_progress')")} AS open_ticket_count,
               {cnt("is_escalated AND " + since('created_at', 90))} AS escalation_count_90d,
               {rnd(mean('ttr_hours', since('created_at', 30)), 1)} AS avg_ttr_hours_30d
        FROM fact_tickets GROUP BY company_id""",
    "nps_features": f"""
        SELECT a.company_id, a.nps_score AS nps_latest, COALESCE(b.nps_score, a.nps_score) AS nps_previous,
               a.nps_score - COALESCE(b.nps_score, a.nps_score) AS nps_delta_vs_prev,
               CASE WHEN a.nps_category = 'detractor' THEN 1 ELSE 0 END AS is_detractor
        FROM (SELECT * FROM (SELECT *, {newest('company_id', 'survey_date', 'survey_id')} FROM fact_nps) WHERE rn = 1) a
        LEFT JOIN (SELECT * FROM (SELECT *, {newest('company_id', 'survey_date', 'survey_id')} FROM fact_nps) WHERE rn = 2) b
               ON a.company_id = b.company_id""",
    "contract_features": f"""
        SELECT c.company_id, mrr AS mrr_current, {days('end_date', DAY)} AS days_to_renewal,
               duration_days AS contract_duration_days, billing_cycle,
               CASE WHEN status = 'downgraded' THEN 1 ELSE 0 END AS has_downgraded, COALESCE(upgrades, 0) AS upgrade_count,
               {rnd("(CAST(mrr AS DOUBLE) - COALESCE(past_mrr, mrr)) / GREATEST(CAST(COALESCE(past_mrr, mrr) AS DOUBLE), 1.0::DOUBLE) * 100", 2)} AS mrr_trend_90d
        FROM current_contracts c
        LEFT JOIN (SELECT company_id, MAX(mrr) AS past_mrr, {cnt("status = 'upgraded'")} AS upgrades
                   FROM fact_subscriptions WHERE NOT is_current_contract GROUP BY company_id) h ON h.company_id = c.company_id""",
    "contact_counts": f"""
        SELECT company_id, COUNT(*) AS contact_count, {cnt('is_decision_maker')} AS decision_maker_count
        FROM dim_contacts GROUP BY company_id""",
    "churn_label": """
        SELECT company_id, CASE WHEN status = 'churned' THEN 1 ELSE 0 END AS is_churned FROM current_contracts""",
    "feature_store": f"""
        SELECT company_id, COALESCE(dau_last_30d, 0) AS dau_last_30d, COALESCE(dau_last_90d, 0) AS dau_last_90d,
               CASE WHEN COALESCE(events_30_60d, 0) = 0 THEN 0.0::DOUBLE ELSE
                    {rnd("CAST(events_30d - events_30_60d AS DOUBLE) * 100 / events_30_60d", 2)} END AS usage_decline_pct_30d,
               CASE WHEN COALESCE(events_60_90d, 0) = 0 THEN 0.0::DOUBLE ELSE
                    {rnd("(" + rnd("events_90d / 3.0::DOUBLE", 6) + " - events_60_90d) * 100 / events_60_90d", 2)} END AS usage_decline_pct_90d,
               COALESCE(distinct_features_used_30d, 0) AS distinct_features_used_30d,
               COALESCE(feature_adoption_rate, 0) AS feature_adoption_rate,
               COALESCE(days_since_last_login, 9999) AS days_since_last_login,
               {rnd("CAST(COALESCE(active_users_30d, 0) AS DOUBLE) / GREATEST(COALESCE(contact_count, 1), 1)", 3)} AS active_users_ratio,
               COALESCE(ticket_count_30d, 0) AS ticket_count_30d, COALESCE(ticket_count_90d, 0) AS ticket_count_90d,
               COALESCE(ticket_velocity_14d, 0) AS ticket_velocity_14d, COALESCE(p1_ticket_count_30d, 0) AS p1_ticket_count_30d,
               COALESCE(avg_ticket_sentiment_30d, 0) AS avg_ticket_sentiment_30d,
               COALESCE(avg_ticket_sentiment_90d, 0) AS avg_ticket_sentiment_90d,
               {rnd("COALESCE(avg_ticket_sentiment_30d, 0) - COALESCE(avg_ticket_sentiment_90d, 0)", 3)} AS sentiment_trend,
               COALESCE(open_ticket_count, 0) AS open_ticket_count, COALESCE(escalation_count_90d, 0) AS escalation_count_90d,
               COALESCE(avg_ttr_hours_30d, 0) AS avg_ttr_hours_30d, COALESCE(nps_latest, 5) AS nps_latest,
               COALESCE(nps_previous, 5) AS nps_previous, COALESCE(nps_delta_vs_prev, 0) AS nps_delta_vs_prev,
               COALESCE(is_detractor, 0) AS is_detractor, COALESCE(mrr_current, 0) AS mrr_current,
               COALESCE(mrr_trend_90d, 0) AS mrr_trend_90d, COALESCE(days_to_renewal, 0) AS days_to_renewal,
               COALESCE(contract_duration_days, 0) AS contract_duration_days, COALESCE(has_downgraded, 0) AS has_downgraded,
               COALESCE(upgrade_count, 0) AS upgrade_count,
               CASE company_size WHEN 'TPE' THEN 1 WHEN 'PME' THEN 2 WHEN 'ETI' THEN 3 ELSE 4 END AS company_size_encoded,
               {days(DAY, 'customer_since')} AS customer_tenure_days, COALESCE(contact_count, 0) AS num_contacts,
               COALESCE(decision_maker_count, 0) AS num_decision_makers, COALESCE(billing_cycle, 'unknown') AS billing_cycle,
               COALESCE(is_churned, 0) AS is_churned
        FROM (SELECT company_id, company_size, customer_since FROM dim_companies)
        LEFT JOIN usage_features USING (company_id) LEFT JOIN support_features USING (company_id)
        LEFT JOIN nps_features USING (company_id) LEFT JOIN contract_features USING (company_id)
        LEFT JOIN contact_counts USING (company_id) LEFT JOIN churn_label USING (company_id)""",
    # --- account managers ---
    "agent_portfolio": f"""
        SELECT assigned_cs_agent_id AS agent_id, COUNT(DISTINCT c.company_id) AS portfolio_size,
               CAST(SUM(COALESCE(s.mrr, 0)) AS BIGINT) AS total_mrr_managed,
               COUNT(DISTINCT c.company_id) FILTER (WHERE h.risk_tier = 'High') AS high_risk_count
        FROM dim_companies c LEFT JOIN current_contracts s ON s.company_id = c.company_id
        LEFT JOIN health h ON h.company_id = c.company_id GROUP BY assigned_cs_agent_id""",
    "agent_churn": f"""
        SELECT assigned_cs_agent_id AS agent_id,
               {rnd(f"CAST({cnt(since('start_date', 365) + " AND s.status = 'churned'")} AS DOUBLE) * 100 / COUNT(DISTINCT c.company_id)", 2)} AS churn_rate_12m,
               {rnd(f"CAST({cnt(since('start_date', 365) + " AND s.status IN ('active', 'renewed', 'upgraded')")} AS DOUBLE) * 100 / ({cnt(since('start_date', 365) + " AND s.status = 'churned'")} + 1)", 2)} AS save_rate_12m
        FROM dim_companies c LEFT JOIN fact_subscriptions s ON s.company_id = c.company_id GROUP BY assigned_cs_agent_id""",
    "agent_response": f"""
        SELECT assigned_agent_id AS agent_id, {rnd(mean('ttr_hours'), 1)} AS avg_response_time_hours
        FROM fact_tickets GROUP BY assigned_agent_id""",
    "agent_nps": f"""
        SELECT assigned_cs_agent_id AS agent_id,
               {rnd("CAST(SUM(nps_score) AS DOUBLE) / COUNT(nps_score)", 2)} AS avg_nps_portfolio
        FROM dim_companies JOIN fact_nps USING (company_id) GROUP BY assigned_cs_agent_id""",
    "agent_performance": """
        SELECT agent_id, COALESCE(portfolio_size, 0) AS portfolio_size, COALESCE(total_mrr_managed, 0) AS total_mrr_managed,
               COALESCE(high_risk_count, 0) AS high_risk_count, COALESCE(churn_rate_12m, 0) AS churn_rate_12m,
               COALESCE(save_rate_12m, 0) AS save_rate_12m, COALESCE(avg_response_time_hours, 0) AS avg_response_time_hours,
               COALESCE(avg_nps_portfolio, 5) AS avg_nps_portfolio
        FROM (SELECT agent_id FROM dim_agents) LEFT JOIN agent_portfolio USING (agent_id)
        LEFT JOIN agent_churn USING (agent_id) LEFT JOIN agent_response USING (agent_id) LEFT JOIN agent_nps USING (agent_id)""",
    # --- actions ---
    "candidates": """
        SELECT p.company_id, churn_probability, p.risk_tier, top_factors, model_version, h.mrr AS mrr_current, days_to_renewal,
               contract_status, health_score, h.risk_tier AS health_risk_tier, company_name, sector_label AS industry,
               company_size, assigned_cs_agent_id AS cs_agent_id
        FROM latest_predictions p JOIN health h USING (company_id) JOIN dim_companies USING (company_id)
        WHERE h.mrr >= 0""",
    "deciders": f"""
        SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY {ROLE_RANK}, contact_id) AS place
        FROM dim_contacts WHERE role IN {DECIDERS}""",
    "ticket_places": f"""
        SELECT * RENAME (rn AS place) FROM (SELECT *, {newest('company_id', 'created_at', 'ticket_id')} FROM fact_tickets)""",
    "survey_places": f"""
        SELECT * RENAME (rn AS place) FROM (SELECT *, {newest('company_id', 'survey_date', 'survey_id')} FROM fact_nps)""",
    "decisions": f"""
        SELECT *, {CHANNEL} AS channel,
               CASE WHEN action_type = 'escalation' THEN 'critical' WHEN churn_probability >= 0.7 THEN 'high' ELSE 'medium' END AS urgency,
               CASE action_type WHEN 'escalation' THEN 'Monthly revenue is above the escalation limit.'
                    WHEN 'discount' THEN 'High risk close to renewal or after a downgrade.'
                    WHEN 'call' THEN 'High risk with support history and a decision maker to reach.'
                    ELSE 'No stronger step applies.' END AS rationale
        FROM (SELECT c.*, names,
                     CASE WHEN mrr_current > 5000 THEN 'escalation'
                          WHEN risk_tier = 'High' AND (days_to_renewal < 60 OR contract_status = 'downgraded') THEN 'discount'
                          WHEN risk_tier = 'High' AND company_id IN (SELECT company_id FROM fact_tickets)
                               AND company_id IN (SELECT company_id FROM deciders) THEN 'call'
                          ELSE 'email' END AS action_type
              FROM candidates c JOIN top3_names USING (company_id))""",
    "decision_metas": """
        SELECT *, '{"key_signals":["' || replace(names, ', ', '","') || '"],"rationale":"' || rationale || '","urgency":"' || urgency
               || '","churn_probability":' || CAST(churn_probability AS VARCHAR) || '}' AS meta FROM decisions""",
    "review": """
        SELECT a.action_id, a.company_id, a.contact_id, a.agent_id, action_type, channel, status, generated_content, a.created_at,
               created_by_agent, company_name, sector_label AS industry, company_size, h.mrr, health_score, h.risk_tier,
               days_to_renewal, churn_probability, top_factors, ct.first_name || ' ' || ct.last_name AS contact_name,
               ct.role AS contact_role, ct.email AS contact_email, ag.first_name || ' ' || ag.last_name AS agent_name,
               ag.region AS agent_region
        FROM actions a JOIN dim_companies USING (company_id) JOIN health h USING (company_id)
        LEFT JOIN latest_predictions p ON p.company_id = a.company_id LEFT JOIN dim_contacts ct ON ct.contact_id = a.contact_id
        LEFT JOIN dim_agents ag ON ag.agent_id = a.agent_id
        WHERE status = 'pending'""",
    "context": f"""
        SELECT c.company_id, company_name, sector_label AS industry, company_size, city, assigned_cs_agent_id AS cs_agent_id,
               h.mrr AS mrr_current, days_to_renewal, health_score, d.contact_id, d.first_name || ' ' || d.last_name AS contact_name,
               d.role AS contact_role, d.email AS contact_email, n.nps_score AS latest_nps, n.nps_category AS latest_nps_category,
               n.comment AS latest_verbatim, m.nps_score AS previous_nps, m.nps_category AS previous_nps_category,
               COALESCE(k.cases, 0) AS ticket_count, COALESCE(k.open_cases, 0) AS open_cases, COALESCE(k.escalated_cases, 0) AS escalated_cases,
               s.plan_type AS plan_name, s.mrr AS contract_mrr, s.billing_cycle, s.status AS contract_status,
               {days(DAY, 'customer_since')} AS tenure_days, churn_probability, ag.first_name || ' ' || ag.last_name AS agent_name, ag.email AS agent_email
        FROM dim_companies c JOIN health h USING (company_id)
        LEFT JOIN deciders d ON d.company_id = c.company_id AND d.place = 1
        LEFT JOIN survey_places n ON n.company_id = c.company_id AND n.place = 1
        LEFT JOIN survey_places m ON m.company_id = c.company_id AND m.place = 2
        LEFT JOIN (SELECT company_id, CAST(COUNT(*) AS INTEGER) AS cases, CAST({cnt("status IN ('open', 'in_progress')")} AS INTEGER) AS open_cases,
                          CAST({cnt("is_escalated")} AS INTEGER) AS escalated_cases FROM ticket_places WHERE place <= 3 GROUP BY company_id) k
               ON k.company_id = c.company_id
        LEFT JOIN current_contracts s ON s.company_id = c.company_id
        LEFT JOIN latest_predictions p ON p.company_id = c.company_id
        LEFT JOIN dim_agents ag ON ag.agent_id = c.assigned_cs_agent_id
        WHERE c.company_id IN (SELECT company_id FROM actions WHERE status = 'queued')""",
    "scored_companies": """
        SELECT p.company_id, prediction_date, churn_probability, p.risk_tier, top_factors, company_name, sector_label AS industry,
               company_size, h.mrr, health_score, h.risk_tier AS health_risk_tier, days_to_renewal
        FROM latest_predictions p JOIN dim_companies USING (company_id) JOIN health h USING (company_id)""",
}

_NAMES = re.compile(r"\b(" + "|".join(sorted(RELATIONS, key=len, reverse=True)) + r")\b")

def _named_in(sql: str) -> set[str]:
    # Relations are only named right after FROM or JOIN.
    return {m for m in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)\b", sql) if m in RELATIONS}

def with_relations(sql: str) -> str:
    needed: set[str] = set()
    todo = _named_in(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= _named_in(RELATIONS[name])
    ordered = [n for n in RELATIONS if n in needed]
    if not ordered:
        return sql.strip()
    body = ",\n".join(f"{n} AS ({RELATIONS[n].strip()})" for n in ordered)
    return f"WITH {body}\n{sql.strip()}"
