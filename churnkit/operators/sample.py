"""The seven raw tables as seeded test data of any size, for trying the whole job without a source.

A company is one of three moods. Content companies use the product evenly and write little; uneasy ones slow down and complain more and
more; leaving ones have all but stopped. Every value is a named draw on a row number (``datagen.draw``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.functions import day, lookup, pick, quarter_label
from churnkit.operators import datagen as G
from churnkit.operators.datagen import draw
from churnkit.schemas import COMPANY_SIZES, DECISION_ROLES
from churnkit.sources.tables import stamp

MANAGERS, PEOPLE, ASKED = 12, 3, 5
MOODS = ("content", "uneasy", "leaving")
PLANS = {"Solo": 250, "Crew": 1400, "Fleet": 5200}
EVENT_TYPES = tuple(f"screen_{i}" for i in range(15))
PLACES = ("coast", "hills", "plain")
# Per company and mood: product events, tickets, and the days over which its events lie.
USE = {"content": 150, "uneasy": 100, "leaving": 45}
WRITES = {"content": 9, "uneasy": 26, "leaving": 20}
MAIL = "@mail.example"


def _id(kind: str, number, width: int = 9) -> Column:
    return G.surrogate_key(kind, number, width)


def _companies(spark: SparkSession, n: int, as_of) -> DataFrame:
    luck = draw("id", "mood", 1000)
    return G.gen_ids(spark, n).withColumns(
        {
            "company_id": _id("co", "id"),
            "mood": F.when(luck < 680, MOODS[0]).when(luck < 880, MOODS[1]).otherwise(MOODS[2]),
            "plan_type": pick(list(PLANS), draw("id", "plan", len(PLANS))),
            "began": F.date_sub(day(as_of), draw("id", "began", 290) + 35),
        }
    )


def _each(parents: DataFrame, count: Column) -> DataFrame:
    return G.numbered_fan_out(parents.withColumn("_count", count), "id", "_count")


def _hour(on: Column, number, what: str) -> Column:
    return on.cast("timestamp") + F.make_dt_interval(F.lit(0), draw(number, what, 24))


def _managers(spark: SparkSession, as_of) -> DataFrame:
    name = F.col("id").cast("string")
    return G.gen_ids(spark, MANAGERS).select(
        _id("am", "id", 3).alias("agent_id"),
        F.concat(F.lit("Ann"), name).alias("first_name"),
        F.concat(F.lit("Ager"), name).alias("last_name"),
        F.concat(F.lit("  Am"), name, F.lit(MAIL.upper())).alias("email"),
        pick(PLACES, draw("id", "place", len(PLACES))).alias("region"),
        F.lit("accounts").alias("specialization"),
        F.date_sub(day(as_of), draw("id", "hired", 2000)).alias("hire_date"),
        F.lit(True).alias("is_active"),
    )


def _company_rows(base: DataFrame) -> DataFrame:
    return base.select(
        "company_id",
        F.concat(F.lit("Firm "), F.col("id").cast("string")).alias("company_name"),
        F.lit("trade").alias("sector_label"),
        pick(COMPANY_SIZES, draw("id", "size", len(COMPANY_SIZES))).alias("company_size"),
        F.lit("town").alias("city"),
        F.lit("land").alias("country"),
        F.col("began").alias("subscription_start_date"),
        "plan_type",
        lookup("plan_type", PLANS, 0).alias("base_mrr"),
        _id("am", draw("id", "manager", MANAGERS) + 1, 3).alias("assigned_cs_agent_id"),
        F.col("mood").alias("churn_profile"),
    )


def _person(company, place) -> Column:
    return _id("pe", (F.col(company) - 1) * PEOPLE + place, 10)


def _contact_rows(base: DataFrame) -> DataFrame:
    people = base.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(PEOPLE))))
    person = _person("id", F.col("n"))
    role = draw(F.col("id") * PEOPLE + F.col("n"), "role", 5)
    return people.select(
        person.alias("contact_id"),
        "company_id",
        F.lit("Pat").alias("first_name"),
        F.concat(F.lit("Person "), F.col("n").cast("string")).alias("last_name"),
        F.concat(person, F.lit(MAIL)).alias("email"),
        F.lit("0").alias("phone"),
        pick([*DECISION_ROLES[:4], "Assistant"], role).alias("role"),
        (role < 4).alias("is_decision_maker"),
        (F.col("n") == 1).alias("is_primary_contact"),
        F.col("began").cast("timestamp").alias("created_at"),
    )


def _contract_rows(base: DataFrame) -> DataFrame:
    turned = draw("id", "turned", 100) < 45
    status = F.when(turned & (F.col("mood") == "leaving"), "churned").when(turned & (F.col("mood") == "uneasy"), "downgraded").otherwise("active")
    current = base.select(
        "id", "company_id", "plan_type", pick(["annual", "monthly"], draw("id", "cycle", 2)).alias("billing_cycle"),
        F.col("began").alias("start_date"), status.alias("status"),
    )
    names = list(PLANS)
    all_ = G.with_history(current, draw("id", "second", 4) == 0, dict(zip(names[1:], names)), 365, "churned")
    mrr = lookup("plan_type", PLANS, 0) + draw("id", "extra", 150)
    return all_.withColumn("mrr", mrr).select(
        F.concat_ws("/", _id("ct", "id"), F.col("contract_version").cast("string")).alias("subscription_id"),
        "company_id", "plan_type", "billing_cycle", "mrr", (F.col("mrr") * 12).alias("arr"), "start_date",
        F.date_add("start_date", F.when(F.col("billing_cycle") == "annual", 365).otherwise(30)).alias("end_date"),
        "status", "contract_version", F.lit(True).alias("auto_renew"),
    )


def _survey_rows(base: DataFrame, as_of) -> DataFrame:
    asked = F.date_sub(day(as_of), (F.lit(ASKED) - F.col("n")) * 40 + 3)
    falls = lookup("mood", {"content": 0, "uneasy": 1, "leaving": 1}, 0) * F.col("n")
    mood = lookup("mood", {"content": 9, "uneasy": 7, "leaving": 5}, 5)
    return _each(base, F.lit(ASKED)).select(
        _id("sv", "number").alias("survey_id"), "company_id", F.lit(None).cast("string").alias("contact_id"),
        F.greatest(F.lit(0), mood - falls + draw("number", "answer", 2)).alias("nps_score"), F.lit("").alias("nps_category"),
        F.lit("remark").alias("comment"), asked.alias("survey_date"), quarter_label(asked).alias("quarter"),
    )


def _ticket_rows(base: DataFrame, as_of) -> DataFrame:
    tickets = _each(base, lookup("mood", WRITES, 0))
    uneasy = F.col("mood") != "content"
    late = G.late_life("n", "_count", 0.5) & uneasy
    # Tickets follow one another up to the day of the data.
    opened = F.date_sub(day(as_of), F.floor((F.col("_count") - F.col("n")) * 180 / F.col("_count")).cast("int"))
    state = pick(["open", "closed", "resolved"], draw("number", "state", 3))
    hours = draw("number", "hours", 60) + 1
    wobble = (draw("number", "tone", 31) - 15) / F.lit(100.0)
    return tickets.select(
        _id("tk", "number").alias("ticket_id"), "company_id", F.lit(None).cast("string").alias("contact_id"),
        G.conditioned_pick(draw("number", "about", 12), late, ["bug", "complaint", "bug"], ["request", "question"]).alias("category"),
        G.conditioned_pick(draw("number", "rank", 12), late, ["P2", "P1"], ["P4", "P3", "P4", "P3"]).alias("priority"),
        state.alias("status"), F.concat(F.lit("Matter "), F.col("number").cast("string")).alias("subject"), F.lit("words").alias("description"),
        F.when(uneasy, G.trend_score("n", "_count", 0.2, -0.6, wobble, -1.0, 1.0)).otherwise(F.lit(0.25)).alias("sentiment_score"),
        _hour(opened, "number", "opened").alias("created_at"),
        F.when(state != "open", F.date_add(opened, F.ceil(hours / 24).cast("int")).cast("timestamp")).alias("resolved_at"),
        hours.alias("ttr_hours"), _id("am", draw("number", "taken by", MANAGERS) + 1, 3).alias("assigned_agent_id"),
    )


def _event_rows(base: DataFrame, as_of) -> DataFrame:
    # Days back: even for content companies, the longer of two or three draws for the others.
    draws = [draw("number", f"ago {i}", 170) for i in range(3)]
    ago = F.when(F.col("mood") == "content", draws[0]).when(F.col("mood") == "uneasy", F.greatest(*draws[:2])).otherwise(F.greatest(*draws))
    return _each(base, lookup("mood", USE, 0)).select(
        _id("ev", "number", 12).alias("event_id"), "company_id",
        _person("id", draw("number", "who", PEOPLE) + 1).alias("contact_id"),
        pick(EVENT_TYPES, draw("number", "screen", len(EVENT_TYPES))).alias("event_type"),
        _hour(F.date_sub(day(as_of), ago), "number", "hour").alias("event_timestamp"),
        _id("vi", draw("number", "visit", 50_000), 5).alias("session_id"),
        pick(["phone", "desk"], draw("number", "device", 2)).alias("device_type"),
        pick(["x", "y"], draw("number", "browser", 2)).alias("browser"),
    )


def sample_raw(spark: SparkSession, companies: int = 500, as_of=None) -> dict[str, DataFrame]:
    """Raw frames by short name."""
    base = _companies(spark, companies, as_of)
    frames = {
        "agents": (_managers(spark, as_of), "hr"),
        "companies": (_company_rows(base), "crm"),
        "contacts": (_contact_rows(base), "crm"),
        "subscriptions": (_contract_rows(base), "billing"),
        "nps": (_survey_rows(base, as_of), "survey"),
        "tickets": (_ticket_rows(base, as_of), "helpdesk"),
        "events": (_event_rows(base, as_of), "analytics"),
    }
    return {name: stamp(df, source) for name, (df, source) in frames.items()}
