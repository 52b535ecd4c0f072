"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Each query is run to
completion once after a warm-up query that loads the session.
"""

from __future__ import annotations

import json
import os
import time

from reelspark import queries
from reelspark.session import build_session

HEADLINE = (
    "fact_user_activity",
    "analytics_daily_usage",
    "watch_history",
    "q_dau",
    "q_most_watched",
    "q_top_users",
    "q_genre_engagement",
    "q_plan_mrr",
    "q_device_funnel",
    "q_cohort_retention",
    "q_genre_rank",
    "rpt_top_watched",
    "rpt_platform_summary",
    "dq_score",
    "dq_error_log",
    "dedupe_keep_first",
    "clean_events",
    "etl_batch",
    "mask_table",
    "churn_scores",
    "churn_fleet_summary",
    "rec_user_profile",
    "rec_for_users",
    "rec_similar_titles",
    "anom_all",
    "text_chunks",
    "tfidf_index",
    "tfidf_search",
    "rag_answer",
    "stream_validate",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    memory = {"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")}
    spark = build_session("bench", f"local[{cpus}]", int(cpus), memory)
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries.registered()
    registered["docs_count"](spark, folder).write.format("noop").mode("overwrite").save()
    spent = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
