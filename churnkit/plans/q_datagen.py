"""Queries for seeded generation. The row numbers are the customers', so the output grows with them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from churnkit import functions as X
from churnkit.operators import datagen as G
from churnkit.plans.oracle_base import pick, seeded
from churnkit.plans.registry import query

LABELS = ["sleeping", "seasonal", "rising", "loyal"]
EDGES = [120, 260, 700]
LEANING = {"sleeping": "early", "rising": "late"}
SPAN, FIRST_DAY, DAYS = 540, dt.date(2019, 4, 1), 1000
MOST_CHILDREN = 5
ID = "CAST(c_custkey + 1 AS BIGINT)"
COHORT = "CASE WHEN id <= 120 THEN 'sleeping' WHEN id <= 260 THEN 'seasonal' WHEN id <= 700 THEN 'rising' ELSE 'loyal' END"
COUNT = f"{seeded('id', 29, MOST_CHILDREN + 1)}"
PARENTS = f"(SELECT id, {COHORT} AS cohort, {COUNT} AS children FROM (SELECT {ID} AS id FROM customer))"
CHILDREN = f"""(SELECT id, cohort, children, CAST(n AS INTEGER) AS n, row_number() OVER (ORDER BY id, n) AS number
    FROM {PARENTS}, (SELECT unnest(range(1, {MOST_CHILDREN + 1})) AS n) WHERE n <= children)"""


def ids(s):
    return s.t.customer.select((F.col("c_custkey") + 1).cast("long").alias("id"))


def parents(s):
    return ids(s).withColumns({"cohort": G.cohort("id", EDGES, LABELS), "children": X.seeded_int("id", 29, MOST_CHILDREN + 1)})


def children(s):
    return G.numbered_fan_out(parents(s), "id", "children")


@query("gen_ids", f"""
    SELECT n AS id, count(c.c_custkey) AS customers FROM (SELECT unnest(range(1, (SELECT count(*) FROM customer) + 1)) AS n)
    LEFT JOIN customer c ON {ID} = n GROUP BY n""")
def _(s):
    made = G.gen_ids(s.spark, s.t.customer.count())
    return made.join(ids(s).withColumn("_is", F.lit(1)), "id", "left").groupBy("id").agg(F.count("_is").alias("customers"))


@query("gen_uuid", f"""
    SELECT id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS uuid
    FROM (SELECT id, sha256('row:' || CAST(id AS VARCHAR)) AS h FROM (SELECT {ID} AS id FROM customer))""")
def _(s):
    return ids(s).select("id", G.synthetic_uuid("id").alias("uuid"))


@query("gen_seeded_int", f"SELECT id, {seeded('id', 41, 900)} AS a, {seeded('id', 2, 30011)} AS b FROM (SELECT {ID} AS id FROM customer)")
def _(s):
    return ids(s).select("id", X.seeded_int("id", 41, 900).alias("a"), X.seeded_int("id", 2, 30011).alias("b"))


@query("gen_pick", f"""
    SELECT id, {pick(['small', 'small', 'large'], 'id % 3')} AS by_modulo, {pick(['red', 'green', 'blue'], seeded('id', 43, 3))} AS by_seed
    FROM (SELECT {ID} AS id FROM customer)""")
def _(s):
    return ids(s).select(
        "id",
        X.pick(["small", "small", "large"], F.pmod("id", F.lit(3))).alias("by_modulo"),
        X.pick(["red", "green", "blue"], X.seeded_int("id", 43, 3)).alias("by_seed"),
    )


@query("gen_cohort", f"""
    SELECT id, cohort, CASE WHEN {seeded('id', 47, 1000)} < 125 THEN 'rare' ELSE 'common' END AS by_share FROM {PARENTS}""")
def _(s):
    share = F.when(X.seeded_int("id", 47, 1000) < 125, "rare").otherwise("common")
    return parents(s).select("id", "cohort", share.alias("by_share"))


@query("gen_fan_out", f"SELECT id, n FROM {CHILDREN}")
def _(s):
    return G.fan_out(parents(s), "children").select("id", "n")


@query("gen_surrogate", f"SELECT id, n, number, 'ROW-' || lpad(CAST(number AS VARCHAR), 12, '0') AS child_key FROM {CHILDREN}")
def _(s):
    return children(s).select("id", "n", "number", G.surrogate_key("ROW-", "number", 12).alias("child_key"))


@query("gen_offsets", f"""
    SELECT number, CASE cohort WHEN 'sleeping' THEN least({seeded('number', 31, SPAN)}, {seeded('number', 37, SPAN)})
       WHEN 'rising' THEN greatest({seeded('number', 31, SPAN)}, {seeded('number', 37, SPAN)})
       ELSE {seeded('number', 31, SPAN)} END AS offset_days FROM {CHILDREN}""")
def _(s):
    return children(s).select("number", G.offset_days("cohort", "number", LEANING, SPAN, (31, 37)).alias("offset_days"))


@query("gen_conditioned", f"""
    SELECT number, CASE WHEN 2 * n > children THEN {pick(['urgent', 'soon'], '(' + seeded('number', 53, 60) + ') % 2')}
                        ELSE {pick(['later', 'soon', 'never'], '(' + seeded('number', 53, 60) + ') % 3')} END AS priority,
           GREATEST(0::DOUBLE, LEAST(10::DOUBLE, CAST(ROUND(CAST(9::DOUBLE - 6::DOUBLE * (CAST(n - 1 AS DOUBLE) / CAST(GREATEST(children - 1, 1) AS DOUBLE))
                    + {seeded('number', 59, 201)} / 100.0::DOUBLE AS DECIMAL(38,10)), 2) AS DOUBLE))) AS score
    FROM {CHILDREN}""")
def _(s):
    late = G.late_life("n", "children", 0.5)
    return children(s).select(
        "number",
        G.conditioned_pick(X.seeded_int("number", 53, 60), late, ["urgent", "soon"], ["later", "soon", "never"]).alias("priority"),
        G.trend_score("n", "children", 9.0, 3.0, X.seeded_int("number", 59, 201) / F.lit(100.0), 0.0, 10.0).alias("score"),
    )


@query("gen_dates", f"""
    SELECT number, begun, begun + CASE WHEN id % 2 = 0 THEN 365 ELSE 30 END AS end_date,
           CASE WHEN status IN ('resolved', 'closed') THEN begun + (CAST(ceil(hours / 24.0::DOUBLE) AS INTEGER) + 1) END AS resolved_date,
           begun + (n * 50 - 20) AS survey_date
    FROM (SELECT *, DATE '2019-04-01' + {seeded('id', 61, DAYS)} AS begun, {seeded('number', 67, 96)} + 1 AS hours,
                 {pick(['open', 'resolved', 'closed'], seeded('number', 71, 3))} AS status FROM {CHILDREN})""")
def _(s):
    rows = children(s).withColumns(
        {
            "begun": G.start_date(FIRST_DAY, X.seeded_int("id", 61, DAYS)),
            "cycle": F.when(F.pmod("id", F.lit(2)) == 0, "annual").otherwise("monthly"),
            "status": X.pick(["open", "resolved", "closed"], X.seeded_int("number", 71, 3)),
            "hours": X.seeded_int("number", 67, 96) + 1,
        }
    )
    dated = G.derive_dates(rows, "begun", "cycle", "status", "hours", "n", {"annual": 365}, 30, survey_every=50, survey_lead=20)
    return dated.select("number", "begun", "end_date", "resolved_date", "survey_date")


_CURRENT = f"""(SELECT id, {pick(['Starter', 'Business', 'Enterprise'], 'id % 3')} AS plan_type,
    DATE '2019-04-01' + {seeded('id', 61, DAYS)} AS start_date, 'active' AS status FROM (SELECT {ID} AS id FROM customer))"""


@query("gen_history", f"""
    SELECT id, plan_type, start_date, status, 1 AS contract_version FROM {_CURRENT}
    UNION ALL
    SELECT id, CASE plan_type WHEN 'Enterprise' THEN 'Business' ELSE 'Starter' END, start_date - 365, 'churned', 2
    FROM {_CURRENT} WHERE id % 4 = 1""")
def _(s):
    current = ids(s).withColumns(
        {
            "plan_type": X.pick(["Starter", "Business", "Enterprise"], F.pmod("id", F.lit(3))),
            "start_date": G.start_date(FIRST_DAY, X.seeded_int("id", 61, DAYS)),
            "status": F.lit("active"),
        }
    )
    return G.with_history(current, F.pmod("id", F.lit(4)) == 1, {"Enterprise": "Business", "Business": "Starter"}, 365, "churned")
