"""Queries for sources and sinks, projections, joins, aggregates, ranking, order and functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from churnkit import functions as X
from churnkit.operators import conform, merge, relational as R
from churnkit.operators.actions import filter_actions, filter_predictions, review_view
from churnkit.operators.health import current_contract
from churnkit.operators.reports import scored_companies
from churnkit.plans.oracle_base import CHANNEL, DAY, band, cnt, days, mean, newest, rnd, seeded, since
from churnkit.plans.registry import query
from churnkit.schemas import PREDICTIONS
from churnkit.session import ensure_checkpoint_dir
from churnkit.sources import tables as io
from churnkit.sources.adapters import AS_OF


# --- sources and sinks ----------------------------------------------------------

@query("io_roundtrip", "SELECT subscription_id, company_id, mrr, start_date, status FROM raw_subscriptions")
def _(s):
    rows = s.raw["subscriptions"].select("subscription_id", "company_id", "mrr", "start_date", "status")
    root = f"{ensure_checkpoint_dir(s.spark)}/io_roundtrip_{uuid.uuid4().hex}"
    return io.write_table(rows, root, "bronze", "raw_subscriptions")


@query("ensure_table", "SELECT prediction_date, COUNT(*) AS n, COUNT(DISTINCT company_id) AS companies FROM predictions GROUP BY prediction_date")
def _(s):
    """A typed table made empty, filled day by day, and left alone by a second ``ensure_table``."""
    root = f"{ensure_checkpoint_dir(s.spark)}/ensure_{uuid.uuid4().hex}"
    place = (root, "gold", "agg_churn_predictions")
    io.ensure_table(s.spark, PREDICTIONS, *place, ["prediction_date"])
    rows = s.predictions.select(*[F.col(f.name).cast(f.dataType) for f in PREDICTIONS.fields])
    today = F.col("prediction_date") == F.lit(AS_OF)
    io.overwrite_partitions(rows.filter(~today), *place, ["prediction_date"])
    io.overwrite_partitions(rows.filter(today), *place, ["prediction_date"])
    stored = io.ensure_table(s.spark, PREDICTIONS, *place, ["prediction_date"])
    return stored.groupBy("prediction_date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("company_id").alias("companies"))


@query("replace_keeps_old", "SELECT status, COUNT(*) AS n, COUNT(*) FILTER (WHERE status = 'pending') AS still_pending FROM actions GROUP BY status")
def _(s):
    """A table rewritten from itself, read through a plan made before the write: the old version is still whole."""
    root = f"{ensure_checkpoint_dir(s.spark)}/replace_{uuid.uuid4().hex}"
    before = io.write_table(s.actions.select("action_id", "status"), root, "gold", "actions")
    io.rewrite_table(before.withColumn("status", F.lit("queued")), root, "gold", "actions")
    return before.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "pending").alias("still_pending"))


_EXPORT = "company_id, prediction_date, churn_probability, risk_tier"


@query("csv_export", f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _EXPORT.split(', '))} FROM predictions")
def _(s):
    path = f"{ensure_checkpoint_dir(s.spark)}/export_{uuid.uuid4().hex}"
    io.export_csv(s.predictions.select(*_EXPORT.split(", ")), path)
    return s.spark.read.option("header", True).csv(path)


@query("latest_or_error", "SELECT risk_tier, prediction_date, COUNT(*) AS n FROM predictions WHERE prediction_date = (SELECT MAX(prediction_date) FROM predictions) GROUP BY ALL")
def _(s):
    newest = R.require_latest(s.predictions, "prediction_date")
    return s.predictions.filter(F.col("prediction_date") == F.lit(newest)).groupBy("risk_tier", "prediction_date").agg(F.count(F.lit(1)).alias("n"))


@query("bronze_stamp", "SELECT o_orderkey, o_custkey, 'billing' AS _source FROM orders")
def _(s):
    return io.stamp(s.t.orders.select("o_orderkey", "o_custkey"), "billing").drop("_ingested_at")


_UPDATES = f"""
    SELECT company_id, prediction_date, CAST((company_id * 13) % 1000 AS DOUBLE) / 1000.0::DOUBLE AS churn_probability, '2' AS model_version
    FROM predictions WHERE company_id % 3 = 0 AND prediction_date = {DAY}
    UNION ALL
    SELECT company_id, CAST({DAY} + 1 AS DATE), churn_probability, '2' FROM predictions WHERE company_id % 4 = 0 AND prediction_date = {DAY}"""


def _target_and_updates(s):
    target = s.predictions.select("company_id", "prediction_date", "churn_probability", "model_version")
    today = target.filter(F.col("prediction_date") == F.lit(AS_OF)).withColumn("model_version", F.lit("2"))
    key = F.col("company_id")
    changed = today.filter(F.pmod(key, F.lit(3)) == 0).withColumn(
        "churn_probability", (F.pmod(key * 13, F.lit(1000)) / F.lit(1000.0)).cast("double")
    )
    added = today.filter(F.pmod(key, F.lit(4)) == 0).withColumn("prediction_date", F.date_add("prediction_date", 1))
    return target, changed.unionByName(added)


_KEYS = ["company_id", "prediction_date"]


@query("merge_upsert", f"""
    SELECT company_id, prediction_date, COALESCE(u.churn_probability, p.churn_probability) AS churn_probability,
           COALESCE(u.model_version, p.model_version) AS model_version
    FROM predictions p FULL JOIN ({_UPDATES}) u USING (company_id, prediction_date)""")
def _(s):
    target, updates = _target_and_updates(s)
    return merge.merge_upsert(target, updates, _KEYS)


@query("merge_partial_update", f"""
    SELECT company_id, prediction_date, COALESCE(u.churn_probability, p.churn_probability) AS churn_probability,
           COALESCE(p.model_version, u.model_version) AS model_version
    FROM predictions p FULL JOIN ({_UPDATES}) u USING (company_id, prediction_date)""")
def _(s):
    target, updates = _target_and_updates(s)
    return merge.merge_upsert(target, updates, _KEYS, ["churn_probability"])


@query("merge_insert_only", f"""
    SELECT company_id, action_type, status FROM actions
    UNION ALL
    SELECT company_id, action_type, 'queued' FROM actions a WHERE status <> 'completed' AND NOT EXISTS
      (SELECT 1 FROM actions b WHERE b.status = 'queued' AND b.company_id = a.company_id AND b.action_type = a.action_type)""")
def _(s):
    target = s.actions.select("company_id", "action_type", "status")
    fresh = target.filter(F.col("status") != "completed").withColumn("status", F.lit("queued"))
    return merge.merge_insert(target, fresh, ["company_id", "action_type"], F.col("status") == "queued")


@query("update_where", f"""
    SELECT action_id, CASE WHEN status = 'pending' AND action_type = 'email' THEN 'approved' ELSE status END AS status,
           CASE WHEN status = 'pending' AND action_type = 'email' THEN CAST({DAY} AS TIMESTAMP) ELSE approved_at END AS approved_at
    FROM actions""")
def _(s):
    hit = (F.col("status") == "pending") & (F.col("action_type") == "email")
    values = {"status": F.lit("approved"), "approved_at": F.lit(AS_OF).cast("timestamp_ntz")}
    return merge.update_where(s.actions.select("action_id", "action_type", "status", "approved_at"), hit, values).drop(
        "action_type"
    )


@query("delete_where", "SELECT action_id, company_id, agent_id FROM actions WHERE NOT COALESCE(agent_id > 10, FALSE)")
def _(s):
    return merge.delete_where(s.actions.select("action_id", "company_id", "agent_id"), F.col("agent_id") > 10)


@query("inline_rows", """
    SELECT risk_tier, weight, COUNT(*) AS n FROM predictions
    JOIN (VALUES ('High', 3), ('Medium', 2), ('Low', 1)) AS w(risk_tier, weight) USING (risk_tier) GROUP BY ALL""")
def _(s):
    weights = io.inline_rows(s.spark, [("High", 3), ("Medium", 2), ("Low", 1)], "risk_tier string, weight int")
    counts = s.predictions.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(weights, "risk_tier")


# --- projections and filters ------------------------------------------------------

@query("proj_rename", """
    SELECT company_id, company_name AS name, sector_label AS industry, base_mrr * 12 AS yearly FROM raw_companies""")
def _(s):
    return s.raw["companies"].select(
        "company_id",
        F.col("company_name").alias("name"),
        F.col("sector_label").alias("industry"),
        (F.col("base_mrr") * 12).alias("yearly"),
    )


@query("cast_conform", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(TRUNC(o_totalprice) AS INTEGER) AS o_totalprice,
           CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders""")
def _(s):
    rows = s.t.orders.select("o_orderkey", "o_orderdate", "o_totalprice", "o_custkey")
    return conform.cast_columns(rows, {"o_orderdate": "date", "o_totalprice": "int", "o_custkey": "string"})


@query("valid_rows", "SELECT contact_id, email FROM raw_contacts WHERE contact_id IS NOT NULL AND email IS NOT NULL")
def _(s):
    return conform.require(s.raw["contacts"].select("contact_id", "email"), ["contact_id", "email"])


@query("filter_in", "SELECT ticket_id, priority FROM raw_tickets WHERE priority IN ('P1', 'P2')")
def _(s):
    return s.raw["tickets"].filter(X.in_domain("priority", ("P1", "P2"))).select("ticket_id", "priority")


@query("filter_between", "SELECT survey_id, nps_score FROM raw_nps WHERE nps_score BETWEEN 7 AND 8")
def _(s):
    return s.raw["nps"].filter(X.in_range("nps_score", 7, 8)).select("survey_id", "nps_score")


@query("window_bands", f"""
    SELECT event_id, {since('d', 30)} AS in_30, {band('d', 60, 30)} AS in_30_60, {band('d', 90, 60)} AS in_60_90,
           {since('d', 90)} AS in_90
    FROM (SELECT event_id, CAST(event_timestamp AS DATE) AS d FROM raw_events)""")
def _(s):
    on = F.col("event_timestamp").cast("date")
    return s.raw["events"].select(
        "event_id",
        X.since(on, AS_OF, 30).alias("in_30"),
        X.band(on, AS_OF, 60, 30).alias("in_30_60"),
        X.band(on, AS_OF, 90, 60).alias("in_60_90"),
        X.since(on, AS_OF, 90).alias("in_90"),
    )


@query("filter_predictions", """
    SELECT company_id, churn_probability, risk_tier, company_size FROM scored_companies
    WHERE risk_tier IN ('High', 'Medium') AND churn_probability >= 0.5 AND company_size IN ('PME', 'GE')""")
def _(s):
    rows = scored_companies(s.predictions, s.lean.companies, s.health)
    return filter_predictions(rows, ("High", "Medium"), 0.5, ("PME", "GE")).select(
        "company_id", "churn_probability", "risk_tier", "company_size"
    )


def review(s):
    w = s.lean
    return review_view(s.actions, w.companies, s.health, s.predictions, w.contacts, w.agents)


@query("filter_actions", """
    SELECT action_id, company_id, action_type, mrr, risk_tier, agent_id FROM review
    WHERE risk_tier = 'Medium' AND mrr >= 1000 AND action_type IN ('email', 'call')""")
def _(s):
    return filter_actions(review(s), "Medium", None, 1000, ("email", "call")).select(
        "action_id", "company_id", "action_type", "mrr", "risk_tier", "agent_id"
    )


@query("numeric_coerce", """
    SELECT event_id, COALESCE(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'n/a' ELSE CAST(event_id AS VARCHAR) END AS DOUBLE), 0) AS v
    FROM events""")
def _(s):
    text = F.when(F.pmod("event_id", F.lit(3)) == 0, "n/a").otherwise(F.col("event_id").cast("string"))
    return s.t.events.select("event_id", X.num(text).alias("v"))


# --- joins ------------------------------------------------------------------------

@query("join_inner", "SELECT company_id, n_name AS city, base_mrr FROM raw_companies JOIN nation ON n_nationkey = assigned_cs_agent_id")
def _(s):
    return s.raw["companies"].join(s.t.nation, F.col("assigned_cs_agent_id") == F.col("n_nationkey")).select(
        "company_id", F.col("n_name").alias("city"), "base_mrr"
    )


@query("fk_valid", "SELECT subscription_id, company_id FROM raw_subscriptions WHERE company_id IN (SELECT company_id FROM dim_companies)")
def _(s):
    return R.fk_valid(s.raw["subscriptions"].select("company_id", "subscription_id"), s.gold.company_keys, "company_id")


@query("fk_orphans", "SELECT subscription_id, company_id FROM raw_subscriptions WHERE company_id NOT IN (SELECT company_id FROM dim_companies)")
def _(s):
    return R.fk_orphans(s.raw["subscriptions"].select("company_id", "subscription_id"), s.gold.company_keys, "company_id")


@query("join_left_defaults", """
    SELECT company_id, COALESCE(contact_count, 0) AS contact_count, COALESCE(decision_maker_count, 0) AS decision_maker_count
    FROM dim_companies LEFT JOIN contact_counts USING (company_id)""")
def _(s):
    from churnkit.operators.features import contact_counts

    return R.left_with_defaults(
        s.gold.company_keys, contact_counts(s.gold.contacts), "company_id",
        {"contact_count": 0, "decision_maker_count": 0},
    )


@query("join_on_predicate", """
    SELECT c.company_id, s.mrr, s.status FROM dim_companies c LEFT JOIN current_contracts s
    ON s.company_id = c.company_id AND s.status = 'active'""")
def _(s):
    active = current_contract(s.gold.subscriptions).filter(F.col("status") == "active")
    return s.gold.company_keys.join(active.select("company_id", "mrr", "status"), "company_id", "left")


@query("nps_latest_prev", f"""
    SELECT company_id, MAX(nps_score) FILTER (WHERE place = 1) AS nps_score_latest,
           MAX(nps_score) FILTER (WHERE place = 2) AS nps_score_previous
    FROM survey_places WHERE place <= 2 GROUP BY company_id""")
def _(s):
    return R.latest_and_previous(
        s.gold.nps, "company_id", [F.desc("survey_date"), F.desc("survey_id")], ["nps_score"]
    )


@query("latest_only", "SELECT company_id, prediction_date, churn_probability FROM latest_predictions")
def _(s):
    return R.latest_only(s.predictions, "prediction_date").select("company_id", "prediction_date", "churn_probability")


# --- aggregates ---------------------------------------------------------------------

@query("group_basic", f"""
    SELECT company_id, COUNT(*) AS n, CAST(SUM(mrr) AS BIGINT) AS total, MIN(start_date) AS first_start, MAX(mrr) AS top,
           {rnd(mean('mrr'), 4)} AS mean_mrr FROM raw_subscriptions GROUP BY company_id""")
def _(s):
    return s.raw["subscriptions"].groupBy("company_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("mrr").alias("total"),
        F.min("start_date").alias("first_start"),
        F.max("mrr").alias("top"),
        X.round_dec(X.exact_avg("mrr"), 4).alias("mean_mrr"),
    )


@query("cond_agg", f"""
    SELECT assigned_agent_id, {cnt("priority = 'P1'")} AS p1,
           CAST(COALESCE(SUM(ttr_hours) FILTER (WHERE status = 'closed'), 0) AS BIGINT) AS closed_hours,
           {rnd(mean('sentiment_score', "status = 'open'"), 4)} AS open_sentiment
    FROM raw_tickets GROUP BY assigned_agent_id""")
def _(s):
    return s.raw["tickets"].groupBy("assigned_agent_id").agg(
        X.count_if(F.col("priority") == "P1").alias("p1"),
        X.sum_if(F.col("status") == "closed", "ttr_hours").alias("closed_hours"),
        X.round_dec(X.avg_if(F.col("status") == "open", "sentiment_score"), 4).alias("open_sentiment"),
    )


@query("distinct_cond", f"""
    SELECT company_id, COUNT(DISTINCT event_type) FILTER (WHERE {since('CAST(event_timestamp AS DATE)', 30)}) AS types_30d
    FROM raw_events GROUP BY company_id""")
def _(s):
    recent = X.since(F.col("event_timestamp").cast("date"), AS_OF, 30)
    return R.count_distinct_per_key(s.raw["events"], "company_id", "event_type", "types_30d", recent)


@query("global_agg", f"SELECT COUNT(*) AS n, CAST(SUM(mrr) AS BIGINT) AS total, {cnt("status = 'churned'")} AS churned FROM raw_subscriptions")
def _(s):
    return s.raw["subscriptions"].agg(
        F.count(F.lit(1)).alias("n"), F.sum("mrr").alias("total"), X.count_if(F.col("status") == "churned").alias("churned")
    )


@query("any_active", "SELECT company_id, bool_or(status = 'active') AS is_active FROM raw_subscriptions GROUP BY company_id")
def _(s):
    return R.any_match(s.raw["subscriptions"], "company_id", F.col("status") == "active", "is_active")


@query("max_per_key", "SELECT company_id, MAX(start_date) AS newest FROM raw_subscriptions GROUP BY company_id")
def _(s):
    return R.max_per_key(s.raw["subscriptions"], "company_id", "start_date", "newest")


@query("safe_ratio", f"""
    SELECT company_id, {rnd(f"CAST({cnt("status = 'upgraded'")} AS DOUBLE) * 100 / GREATEST({cnt("status = 'churned'")}, 1)", 2)} AS ratio
    FROM raw_subscriptions GROUP BY company_id""")
def _(s):
    counted = s.raw["subscriptions"].groupBy("company_id").agg(
        X.count_if(F.col("status") == "upgraded").alias("_up"), X.count_if(F.col("status") == "churned").alias("_lost")
    )
    return counted.select("company_id", X.round_dec(X.safe_ratio("_up", "_lost", 100), 2).alias("ratio"))


@query("prob_histogram", """
    SELECT bin, COUNT(*) AS n FROM (
      SELECT CASE WHEN churn_probability <= 0.2 THEN '0-20%' WHEN churn_probability <= 0.4 THEN '20-40%'
                  WHEN churn_probability <= 0.6 THEN '40-60%' WHEN churn_probability <= 0.8 THEN '60-80%' ELSE '80-100%' END AS bin
      FROM predictions) GROUP BY bin""")
def _(s):
    labels = ["0-20%", "20-40%", "40-60%", "60-80%", "80-100%"]
    return R.histogram(s.predictions, "churn_probability", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0], labels)


# --- ranking and order ------------------------------------------------------------------

@query("dedup_latest", f"""
    SELECT ticket_id, created_at, sentiment_score, ttr_hours FROM
      (SELECT *, {newest('ticket_id', 'created_at', 'sentiment_score', 'ttr_hours')} FROM raw_tickets) WHERE rn = 1""")
def _(s):
    rows = s.raw["tickets"].select("ticket_id", "created_at", F.col("sentiment_score"), "ttr_hours")
    return R.dedup_latest(rows, ["ticket_id"], ["created_at"])


@query("latest_per_key", f"""
    SELECT company_id, subscription_id, start_date FROM
      (SELECT *, {newest('company_id', 'start_date', 'subscription_id')} FROM raw_subscriptions) WHERE rn = 1""")
def _(s):
    rows = s.raw["subscriptions"].select("company_id", "subscription_id", "start_date")
    return R.latest_per_key(rows, ["company_id"], [F.desc("start_date"), F.desc("subscription_id")])


@query("rank_within", f"""
    SELECT company_id, subscription_id, CAST(rn AS INTEGER) AS place FROM
      (SELECT *, {newest('company_id', 'start_date', 'subscription_id')} FROM raw_subscriptions) WHERE rn <= 2""")
def _(s):
    rows = s.raw["subscriptions"].select("company_id", "subscription_id", "start_date")
    return R.rank_within(rows, ["company_id"], [F.desc("start_date"), F.desc("subscription_id")], 2, "place").drop(
        "start_date"
    )


@query("global_sequence", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS seq FROM orders")
def _(s):
    return R.global_sequence(s.t.orders.select("o_orderkey"), "o_orderkey", "seq")


@query("top_n_per_key", f"""
    SELECT company_id, ticket_id, created_at FROM
      (SELECT *, {newest('company_id', 'created_at', 'ticket_id')} FROM (SELECT DISTINCT company_id, ticket_id, created_at FROM raw_tickets))
    WHERE rn <= 5""")
def _(s):
    rows = s.raw["tickets"].select("company_id", "ticket_id", "created_at").distinct()
    return R.top_n_per_key(rows, ["company_id"], [F.desc("created_at"), F.desc("ticket_id")], 5)


@query("sort_nulls_last", "SELECT action_id, approved_at FROM actions ORDER BY approved_at DESC NULLS LAST, action_id")
def _(s):
    return s.actions.select("action_id", "approved_at").orderBy(F.desc_nulls_last("approved_at"), "action_id")


@query("sort_custom", """
    SELECT company_id, prediction_date, risk_tier FROM predictions
    ORDER BY CASE risk_tier WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END, company_id, prediction_date""")
def _(s):
    rows = s.predictions.select("company_id", "prediction_date", "risk_tier")
    return R.order_by_category(
        rows, "risk_tier", ["High", "Medium", "Low"], F.asc("company_id"), F.asc("prediction_date")
    )


@query("top_k", "SELECT subscription_id, company_id, mrr FROM raw_subscriptions ORDER BY mrr DESC, subscription_id LIMIT 25")
def _(s):
    rows = s.raw["subscriptions"].select("subscription_id", "company_id", "mrr")
    return R.top_k(rows, [F.desc("mrr"), F.asc("subscription_id")], 25)


@query("top_factors", """
    SELECT company_id, CAST(place AS INTEGER) AS place, name, value FROM factors WHERE place <= 5""")
def _(s):
    from churnkit.sources.adapters import contributions

    ranked = X.ranked_factors(contributions(F.col("company_id")), 5)
    return (
        s.t.customer.select(F.col("c_custkey").alias("company_id"))
        .select("company_id", F.posexplode(ranked).alias("place", "factor"))
        .select("company_id", (F.col("place") + 1).alias("place"), F.col("factor.key").alias("name"),
                F.col("factor.value").alias("value"))
    )


@query("union_all", """
    SELECT 'ticket' AS kind, ticket_id AS id, company_id FROM raw_tickets UNION ALL
    SELECT 'survey', survey_id, company_id FROM raw_nps UNION ALL SELECT 'event', event_id, company_id FROM raw_events""")
def _(s):
    def part(kind, short, key):
        return s.raw[short].select(F.lit(kind).alias("kind"), F.col(key).alias("id"), "company_id")

    return R.union_all(
        part("ticket", "tickets", "ticket_id"), part("survey", "nps", "survey_id"), part("event", "events", "event_id")
    )


# --- function families ------------------------------------------------------------------------

@query("fn_string", """
    SELECT agent_id, trim(lower(email)) AS email, first_name || ' ' || last_name AS full_name,
           lpad(CAST(agent_id AS VARCHAR), 5, '0') AS padded, lpad(first_name, 4, '0') AS cut, upper(specialization) AS shout,
           substr(first_name, 1, 8) AS short FROM raw_agents""")
def _(s):
    return s.raw["agents"].select(
        "agent_id",
        X.normalise_email("email").alias("email"),
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        F.lpad(F.col("agent_id").cast("string"), 5, "0").alias("padded"),
        F.lpad("first_name", 4, "0").alias("cut"),
        F.upper("specialization").alias("shout"),
        F.substring("first_name", 1, 8).alias("short"),
    )


@query("fn_date", f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) + 365 AS plus_year, CAST(o_orderdate AS DATE) - 90 AS minus_90,
           {days(DAY, 'o_orderdate')} AS age, CAST(hour(o_orderdate) AS INTEGER) AS hour_of_day,
           CAST(year(o_orderdate) AS INTEGER) AS year_of, 'Q' || quarter(o_orderdate) || '-' || year(o_orderdate) AS quarter_label
    FROM orders""")
def _(s):
    on = F.col("o_orderdate").cast("date")
    return s.t.orders.select(
        "o_orderkey",
        F.date_add(on, 365).alias("plus_year"),
        F.date_sub(on, 90).alias("minus_90"),
        X.days_between(F.lit(AS_OF), on).alias("age"),
        F.hour("o_orderdate").alias("hour_of_day"),
        F.year("o_orderdate").alias("year_of"),
        X.quarter_label(on).alias("quarter_label"),
    )


@query("fn_now", """
    SELECT o_orderkey, o_orderdate < current_date AS in_past, o_orderdate >= current_date - 30 AS in_30,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), current_date) AS INTEGER) AS age, TRUE AS stamped_now FROM orders""")
def _(s):
    """Windows and ages without a given day: today, and a row stamped with the time of the run."""
    on = F.col("o_orderdate").cast("date")
    stamped = io.stamp(s.t.orders, "billing")
    now = F.current_timestamp()
    return stamped.select(
        "o_orderkey", (on < X.day(None)).alias("in_past"), X.since(on, None, 30).alias("in_30"), X.days_between(X.day(None), on).alias("age"),
        F.col("_ingested_at").between(now - F.expr("INTERVAL 1 DAY"), now).alias("stamped_now"),
    )


@query("fn_math", f"""
    SELECT c_custkey, {rnd('c_acctbal / 7', 2)} AS rounded, CAST(ceil(c_acctbal) AS BIGINT) AS up, CAST(floor(c_acctbal) AS BIGINT) AS down,
           abs(c_acctbal) AS size, CAST(TRUNC(c_acctbal / 3) AS INTEGER) AS cut,
           CAST(GREATEST(0, LEAST(100, TRUNC(c_acctbal / 50))) AS INTEGER) AS clamped,
           ((c_nationkey - 7) % 5 + 5) % 5 AS modulo FROM customer""")
def _(s):
    balance = F.col("c_acctbal")
    return s.t.customer.select(
        "c_custkey",
        X.round_dec(balance / 7, 2).alias("rounded"),
        F.ceil(balance).alias("up"),
        F.floor(balance).alias("down"),
        F.abs(balance).alias("size"),
        X.trunc_int(balance / 3).alias("cut"),
        X.clamp(X.trunc_int(balance / 50), 0, 100).alias("clamped"),
        F.pmod(F.col("c_nationkey") - 7, F.lit(5)).alias("modulo"),
    )


@query("fn_hash", f"SELECT c_custkey, {seeded('c_custkey', 1, 1000)} AS h1, {seeded('c_custkey', 31, 65536)} AS h31, md5(c_name) AS digest FROM customer")
def _(s):
    return s.t.customer.select(
        "c_custkey", X.seeded_int("c_custkey", 1, 1000).alias("h1"), X.seeded_int("c_custkey", 31, 65536).alias("h31"),
        F.md5("c_name").alias("digest"),
    )


@query("fn_array", """
    SELECT c_custkey, (['a', 'b', 'c'])[c_custkey % 4 + 1] AS picked, unnest(range(1, c_custkey % 3 + 2)) AS step FROM customer""")
def _(s):
    index = F.pmod("c_custkey", F.lit(4))
    upto = (F.pmod("c_custkey", F.lit(3)) + 1).cast("bigint")
    return s.t.customer.select(
        "c_custkey",
        X.pick(["a", "b", "c"], index).alias("picked"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), upto)).alias("step"),
    )


@query("fn_json", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
           '{"type":"' || event_type || '","user":' || user_id || '}' AS packed, 0 AS bad_keys FROM events""")
def _(s):
    bad = X.factor_names(X.parse_factors(F.concat(F.lit("oops "), "props")))
    return s.t.events.select(
        "event_id",
        X.parse_factors("props")["k"].alias("k"),
        F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))).alias("packed"),
        F.size(bad).alias("bad_keys"),
    )


@query("fn_format", f"""
    SELECT company_id, printf('%.1f', {rnd('churn_probability * 100', 1)}) || '%' AS pct,
           COALESCE(format('{{:,}}', CAST(mrr AS BIGINT)) || ' EUR', 'N/A') AS amount, {CHANNEL} AS channel
    FROM latest_predictions LEFT JOIN current_contracts USING (company_id)
    LEFT JOIN (SELECT company_id, action_type FROM actions) USING (company_id)""")
def _(s):
    scores = R.latest_only(s.predictions, "prediction_date").select("company_id", "churn_probability")
    contracts = current_contract(s.gold.subscriptions).select("company_id", "mrr")
    kinds = s.actions.select("company_id", "action_type")
    from churnkit.operators.actions import channel_of

    return scores.join(contracts, "company_id", "left").join(kinds, "company_id", "left").select(
        "company_id", X.percent_text("churn_probability").alias("pct"), X.amount_text("mrr", "EUR").alias("amount"),
        channel_of("action_type").alias("channel"),
    )
