"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnkit.plans.catalogue import QUERIES  # noqa: E402
from churnkit.plans.medallion import quality_reports, run_all  # noqa: E402
from churnkit.plans.registry import Source  # noqa: E402
from churnkit.session import drop_kept, local_session  # noqa: E402
from churnkit.sources.adapters import AS_OF, EVENT_TYPES  # noqa: E402

HEADLINE = (
    "company_health",
    "feature_store",
    "agent_performance",
    "silver_tickets",
    "silver_subscriptions",
    "silver_events",
    "silver_nps",
    "ml_folds",
    "ml_roc_auc",
    "merge_upsert",
    "company_context",
    "queue_to_pending",
    "pending_review",
    "kpi_summary",
    "predictions_view",
    "rowcount_report",
    "ml_train_score",
    "ml_importance",
    "ml_explain",
)


def calibrate(spark) -> float:
    """Seconds of a fixed job, to tell a slow machine from a slow query: it reads nothing and never changes."""
    began = time.perf_counter()
    spark.range(0, 40_000_000, 1, 8).selectExpr("id % 1000 AS k", "xxhash64(id) AS h").groupBy("k").agg({"h": "max"}).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - began, 3)


def layers(spark, folder: str) -> None:
    """The whole job: raw tables stored, conformed, scored, summed and checked."""
    with tempfile.TemporaryDirectory(prefix="churnkit-bench-") as root:
        stored = run_all(spark, Source(spark, folder).raw, root, AS_OF, EVENT_TYPES)
        for report in quality_reports(stored).values():
            report.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [*HEADLINE, "full_layers"]
    spark = local_session(cpus)
    # Start the JVM and compile what all queries use before the clock; the conformed tables are stored by the first query that needs them.
    spark.read.parquet(f"{folder}/orders.parquet").count()
    calibrate(spark)
    calibration = calibrate(spark)
    times: dict[str, float] = {}
    for name in names:
        began = time.perf_counter()
        if name == "full_layers":
            layers(spark, folder)
        else:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    drop_kept(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "churnkit_headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "calibration": calibration,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
