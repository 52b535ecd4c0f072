"""Churn, anomalies, watch history and retention on small frames."""

from datetime import datetime

from reelspark.operators import anomaly, churn
from reelspark.plans import analytics, marts, reports

EVENTS = (
    "event_id int, user_id string, event_type string, content_id string, watch_time_mins int,"
    " device string, timestamp timestamp_ntz, ip_address string"
)


def at(day, hour=0):
    return datetime(2024, 3, day, hour)


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], EVENTS)


def test_churn_levels(spark):
    users = spark.createDataFrame(
        [("a", "A", "", "", "Premium"), ("b", "B", "", "", "Basic"), ("c", "C", "", "", "Standard")],
        "user_id string, name string, email string, country string, tier string",
    )
    events = frame(
        spark,
        [
            ("a", "video_watch", "m1", 100, "TV", at(20), "1"),
            ("a", "video_watch", "m2", 90, "TV", at(20), "1"),
            ("a", "search", "m3", 0, "TV", at(20, 12), "1"),
            ("c", "error", None, 0, "TV", at(8, 18), "1"),
        ],
    )
    subs = spark.createDataFrame([(1, "c", "active"), (0, "c", "cancelled")], "sub_id int, user_id string, status string")
    rows = {r.user_id: r for r in churn.churn_scores(churn.churn_features(users, events, subs)).collect()}
    assert rows["a"].churn_risk_score == 2.0 and rows["a"].risk_level == "Low"
    assert rows["a"].risk_factors == "Healthy engagement patterns across catalog"
    assert rows["b"].days_inactive == 30 and rows["b"].churn_risk_score == 90.0
    assert rows["b"].risk_factors == (
        "Dormant: 30 days since last stream • Low engagement: Only 0 mins watched"
        " • Basic tier subscriber with low catalog discovery"
    )
    assert rows["c"].churn_risk_score == 98.0
    assert rows["c"].days_inactive == 11  # whole 24-hour days, not calendar days
    summary = churn.fleet_summary(churn.churn_scores(churn.churn_features(users, events, subs))).first()
    assert (summary.total_users, summary.high_risk, summary.low_risk) == (3, 2, 1)
    assert churn.churn_for_user(churn.churn_scores(churn.churn_features(users, events, subs)), "a").count() == 1


def test_anomaly_rules(spark):
    rows = [("m", "user_login", None, 0, d, at(1), ip) for d, ip in (("TV", "1"), ("Web", "2"), ("TV", "3"))]
    rows += [("s", "search", None, 0, "Web", at(1), "9")] * 5
    rows += [("w", "video_watch", "x", 241, "Web", at(1), "9")]
    found = {r.anomaly_id: r for r in anomaly.all_anomalies(frame(spark, rows)).collect()}
    assert set(found) == {"ANO-ACC-m", "ANO-SCRAP-s", "ANO-BOT-8"}
    assert "(TV, Web)" in found["ANO-ACC-m"].description
    assert found["ANO-ACC-m"].severity == "CRITICAL"
    summary = anomaly.anomaly_summary(frame(spark, rows)).first()
    assert (summary.total_anomalies, summary.critical_count, summary.fleet_status) == (3, 1, "Action Required")


def test_health_row_only_for_clean_input(spark):
    clean = frame(spark, [("m", "user_login", None, 0, "TV", at(1), "1")])
    assert [r.anomaly_id for r in anomaly.all_anomalies(clean).collect()] == ["ANO-HEALTH-OK"]
    assert anomaly.all_anomalies(clean.limit(0)).count() == 0
    assert anomaly.anomaly_summary(clean).first().fleet_status == "Healthy"


def test_watch_history(spark):
    rows = [
        ("u2", "video_watch", "m1", 50, "TV", at(1), "1"),
        ("u2", "video_watch", "m1", 80, "TV", at(2), "1"),
        ("u1", "video_watch", "m1", 85, "TV", at(1), "1"),
        ("u1", "video_watch", "lost", 200, "TV", at(1), "1"),
        ("u1", "video_watch", None, 10, "TV", at(1), "1"),
        (None, "video_watch", "m1", 10, "TV", at(1), "1"),
    ]
    content = spark.createDataFrame([("m1", 135)], "content_id string, duration_mins int")
    got = {r.history_id: r for r in marts.watch_history(frame(spark, rows), content).collect()}
    assert len(got) == 3
    assert (got["WH_0001"].content_id, got["WH_0001"].completion_percentage) == ("lost", 100.0)
    assert (got["WH_0002"].completion_percentage, got["WH_0002"].completed) == (63.0, False)
    assert (got["WH_0003"].completion_percentage, got["WH_0003"].completed) == (96.3, True)


def test_retention_matches_distinct_day_form(spark):
    rows = [("a", "search", None, 0, "TV", at(d), "1") for d in (1, 1, 3)]
    rows += [("b", "search", None, 0, "TV", at(2), "1")]
    got = [tuple(r)[1:] for r in analytics.cohort_retention(frame(spark, rows)).collect()]
    assert got == [(1, 1, 1), (1, 1, 0)]


def test_router_presets(spark):
    asked = [
        ("Which content has the highest watch time?", "Content Analytics"),
        ("Which users are most active?", "User Analytics"),
        ("What were the most common events today?", "Event Stream Analytics"),
        ("Which content is trending?", "Trend Analysis"),
        ("Summarize the current data quality status.", "Data Governance & Quality"),
        ("What is our subscription MRR and breakdown?", "Financial Analytics"),
        ("An explanation, please", "Financial Analytics"),
        ("Hi", "Platform Summary"),
    ]
    df = spark.createDataFrame([(q,) for q, _ in asked], "question string")
    assert [r.category for r in reports.route_questions(df).collect()] == [c for _, c in asked]


def test_adhoc_sql_raises_on_errors(spark):
    import pytest
    from pyspark.errors import AnalysisException

    tables = {"numbers": spark.range(5)}
    assert analytics.run_sql(spark, "SELECT count(*) AS n FROM numbers WHERE id > :low", tables, low=2).first().n == 2
    with pytest.raises(AnalysisException):
        analytics.run_sql(spark, "SELECT nope FROM numbers", tables).collect()
