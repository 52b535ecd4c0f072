"""Churn risk per user: behavioural features, score, level, factors and action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions.exprs import is_watch, round_even, whole_days

# Events that count as playback trouble.
FRICTION_EVENTS = ("buffering", "error", "playback_failed")

# Days assumed for users without events; average price for revenue at risk.
DORMANT_DAYS = 30
AVERAGE_PRICE = 14.99

# Retention action per level.
ACTIONS = {
    "High": "🚨 Immediate Win-back: Send 25% discount voucher + highlight trending new releases",
    "Medium": "⚡ Re-engagement Push: Recommend personalized watchlist based on past genres",
    "Low": "💎 Loyalty Nurture: Offer early access to 4K / VIP screenings",
}


def churn_features(
    users: DataFrame, events: DataFrame, subscriptions: DataFrame, ordinal: str = "sub_id"
) -> DataFrame:
    """One aggregation of events and one of subscriptions, both joined by user.

    ``ordinal`` orders subscriptions; the first one of a user gives the status.
    """
    newest = events.agg(F.max("timestamp").alias("t")).scalar()
    behaviour = events.groupBy("user_id").agg(
        F.count("*").alias("total_events"),
        F.count_if(is_watch()).alias("watch_count"),
        F.sum(F.when(is_watch(), F.col("watch_time_mins"))).alias("minutes"),
        F.countDistinct("content_id").alias("distinct_content"),
        F.count_if(F.col("event_type").isin(*FRICTION_EVENTS)).alias("error_count"),
        F.max("timestamp").alias("last_event"),
    )
    first_status = subscriptions.groupBy("user_id").agg(F.min_by("status", ordinal).alias("sub_status"))

    def counted(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).cast("bigint").alias(column)

    last = F.col("last_event")
    idle = F.when(last.isNotNull(), F.greatest(whole_days(newest, last), F.lit(0)))
    return (
        users.join(behaviour, "user_id", "left")
        .join(first_status, "user_id", "left")
        .select(
            "user_id",
            "name",
            "email",
            "country",
            "tier",
            counted("total_events"),
            F.coalesce(idle, F.lit(DORMANT_DAYS)).cast("bigint").alias("days_inactive"),
            F.coalesce("minutes", F.lit(0)).cast("bigint").alias("total_watch_time_mins"),
            counted("watch_count"),
            counted("error_count"),
            counted("distinct_content"),
            F.coalesce("sub_status", F.lit("active")).alias("sub_status"),
        )
    )


def _points() -> Column:
    days, minutes = F.col("days_inactive"), F.col("total_watch_time_mins")
    errors = F.col("error_count")
    inactivity = (
        F.when(days > 20, 40.0).when(days > 10, 25.0).when(days > 5, 10.0).otherwise(-10.0)
    )
    watching = (
        F.when((F.col("watch_count") == 0) | (minutes < 30), 25.0)
        .when(minutes > 150, -20.0)
        .when(minutes > 60, -10.0)
        .otherwise(0.0)
    )
    friction = F.when(errors >= 2, 15.0).when(errors == 1, 8.0).otherwise(0.0)
    variety = F.when(F.col("distinct_content") >= 3, -10.0).otherwise(0.0)
    tier = F.when(F.col("tier") == "Basic", 10.0).when(F.col("tier") == "Premium", -8.0).otherwise(0.0)
    return F.lit(15.0) + inactivity + watching + friction + variety + tier


def churn_scores(features: DataFrame) -> DataFrame:
    ended = F.col("sub_status").isin("cancelled", "expired")
    raw = F.when(ended, 98.0).otherwise(_points())
    score = F.col("churn_risk_score")
    factors = F.concat_ws(
        " • ",
        F.when(
            F.col("days_inactive") >= 10,
            F.format_string("Dormant: %d days since last stream", "days_inactive"),
        ),
        F.when(
            F.col("total_watch_time_mins") < 45,
            F.format_string("Low engagement: Only %d mins watched", "total_watch_time_mins"),
        ),
        F.when(
            F.col("error_count") > 0,
            F.format_string("Streaming friction: %d playback issue(s) reported", "error_count"),
        ),
        F.when(
            (F.col("tier") == "Basic") & (score > 40), "Basic tier subscriber with low catalog discovery"
        ),
    )
    actions = F.create_map(*(F.lit(x) for pair in ACTIONS.items() for x in pair))
    return (
        features.withColumn("churn_risk_score", F.greatest(F.least(raw, F.lit(98.0)), F.lit(2.0)))
        .withColumn("risk_level", F.when(score >= 65, "High").when(score >= 35, "Medium").otherwise("Low"))
        .withColumn("_factors", factors)
        .select(
            "user_id",
            "name",
            "email",
            "country",
            "tier",
            "days_inactive",
            "total_watch_time_mins",
            "watch_count",
            "error_count",
            "distinct_content",
            "churn_risk_score",
            "risk_level",
            F.when(F.col("_factors") == "", "Healthy engagement patterns across catalog")
            .otherwise(F.col("_factors"))
            .alias("risk_factors"),
            actions[F.col("risk_level")].alias("retention_action"),
        )
    )


def churn_ranked(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("churn_risk_score"), "user_id")


def churn_for_user(scores: DataFrame, user_id) -> DataFrame:
    return scores.where(F.col("user_id") == F.lit(user_id))


def fleet_summary(scores: DataFrame) -> DataFrame:
    def at(level: str) -> Column:
        return F.count_if(F.col("risk_level") == level)

    return scores.agg(
        F.count("*").alias("total_users"),
        at("High").alias("high_risk"),
        at("Medium").alias("medium_risk"),
        at("Low").alias("low_risk"),
        F.coalesce(round_even(F.avg("churn_risk_score"), 1), F.lit(0.0)).alias("avg_risk"),
        (at("High") * F.lit(AVERAGE_PRICE)).alias("at_risk_mrr_impact"),
    )


def level_counts(scores: DataFrame) -> DataFrame:
    return scores.groupBy("risk_level").agg(F.count("*").alias("n_users"))
