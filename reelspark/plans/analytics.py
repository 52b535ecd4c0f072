"""The SQL analytics suite as DataFrame plans.

Events are aggregated by title or user before they meet the catalog or the users,
so joins move one row per key and popular keys do not skew them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.functions.exprs import has_value, is_watch, ratio
from reelspark.operators.spread import dense_rank_within
from reelspark.plans.marts import user_activity


def _day() -> Column:
    return F.col("timestamp").cast("date")


def title_activity(events: DataFrame) -> DataFrame:
    """Per title: events, summed minutes and the number of known minutes."""
    return (
        events.where(has_value(events, "content_id"))
        .groupBy("content_id")
        .agg(
            F.count("event_id").alias("n_events"),
            F.sum("watch_time_mins").alias("minutes"),
            F.count("watch_time_mins").alias("n_minutes"),
        )
    )


def daily_active_users(events: DataFrame) -> DataFrame:
    counted = (
        events.where("user_id IS NOT NULL")
        .groupBy(_day().alias("activity_date"))
        .agg(F.countDistinct("user_id").alias("active_users"), F.count("event_id").alias("total_events"))
    )
    per_user = F.round(ratio(F.col("total_events"), F.col("active_users")), 2)
    return counted.withColumn("events_per_user", per_user).orderBy(F.desc("activity_date"))


def most_watched(content: DataFrame, events: DataFrame) -> DataFrame:
    views = title_activity(events.where(is_watch()))
    completion = ratio(F.col("minutes"), F.col("duration_mins") * F.col("n_events")) * 100
    return (
        content.join(views, "content_id")
        .select(
            "content_id",
            "title",
            "content_type",
            "genre",
            F.col("n_events").alias("total_views"),
            F.col("minutes").alias("total_watch_time_mins"),
            F.round(ratio(F.col("minutes"), F.col("n_minutes")), 1).alias("avg_watch_mins"),
            "duration_mins",
            F.round(completion, 1).alias("estimated_avg_completion_pct"),
        )
        .orderBy(F.desc("total_watch_time_mins"), "content_id")
    )


def top_users(users: DataFrame, events: DataFrame, limit: int = 15) -> DataFrame:
    """Most active users with a dense rank.

    The rows are cut to the first ``limit`` in rank order before the unpartitioned
    window: a dense rank never depends on rows further down.
    """
    activity = user_activity(events)
    first = (
        users.join(activity, "user_id", "left")
        .select(
            "user_id",
            "name",
            "country",
            "tier",
            F.coalesce("total_events", F.lit(0)).alias("total_interactions"),
            F.coalesce("total_watch_mins", F.lit(0)).alias("total_stream_mins"),
            F.coalesce("distinct_content", F.lit(0)).alias("unique_titles_viewed"),
        )
        .orderBy(F.desc("total_stream_mins"), F.desc("total_interactions"), "user_id")
        .limit(limit)
    )
    by_activity = Window.orderBy(F.desc("total_stream_mins"), F.desc("total_interactions"))
    return first.withColumn("activity_rank", F.dense_rank().over(by_activity)).orderBy("activity_rank", "user_id")


def genre_engagement(content: DataFrame, events: DataFrame) -> DataFrame:
    views = title_activity(events.where(is_watch()))
    return (
        content.join(views, "content_id", "left")
        .groupBy("content_type", "genre")
        .agg(
            F.countDistinct("content_id").alias("total_titles"),
            F.coalesce(F.sum("n_events"), F.lit(0)).alias("total_sessions"),
            F.coalesce(F.sum("minutes"), F.lit(0)).alias("cumulative_watch_mins"),
            F.round(ratio(F.sum("minutes"), F.sum("n_minutes")), 1).alias("mean_session_duration"),
        )
        .orderBy(F.desc("cumulative_watch_mins"), "content_type", "genre")
    )


def plan_revenue(subscriptions: DataFrame) -> DataFrame:
    """Active subscribers, revenue and share of all subscriptions, per plan."""
    everyone = subscriptions.agg(F.count("*").alias("n")).scalar()
    share = ratio(F.count("sub_id") * 100, F.first(everyone))
    return (
        subscriptions.where("status = 'active'")
        .groupBy("plan_name")
        .agg(
            F.count("sub_id").alias("subscriber_count"),
            F.round(F.sum("monthly_price"), 2).cast("double").alias("total_monthly_revenue"),
            F.round(ratio(F.sum("monthly_price"), F.count("monthly_price")), 2).alias("avg_plan_price"),
            F.round(share, 1).alias("plan_share_pct"),
        )
        .orderBy(F.desc("total_monthly_revenue"), "plan_name")
    )


def _by_device(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("device").isNotNull() & (F.col("device") != ""))
        .groupBy("device", "event_type")
        .agg(F.count("event_id").alias("event_count"))
    )


def device_funnel(events: DataFrame) -> DataFrame:
    """Events per device and type with the share inside the device. The window runs
    over the aggregate: a device has one row per distinct event type there."""
    total = F.sum("event_count").over(Window.partitionBy("device"))
    return (
        _by_device(events)
        .withColumn("device_percentage", F.round(ratio(F.col("event_count") * 100, total), 1))
        .orderBy("device", F.desc("event_count"), "event_type")
    )


def device_counts(events: DataFrame) -> DataFrame:
    return _by_device(events).orderBy("device", F.desc("event_count"), "event_type")


def cohort_retention(events: DataFrame) -> DataFrame:
    """First-seen-day cohorts: size, active on the first day, active on a later day.

    A user's first and last active day decide all three counts, so one partial
    aggregation by user replaces a distinct (user, day) set and its self-join.
    """
    spans = (
        events.where("user_id IS NOT NULL")
        .groupBy("user_id")
        .agg(F.min(_day()).alias("cohort_date"), F.max(_day()).alias("_last"))
    )
    return (
        spans.groupBy("cohort_date")
        .agg(
            F.count("*").alias("cohort_size"),
            F.count("cohort_date").alias("day_0_active"),
            F.count_if(F.col("_last") > F.col("cohort_date")).alias("retained_subsequent_days"),
        )
        .orderBy("cohort_date")
    )


def genre_rank(content: DataFrame, events: DataFrame) -> DataFrame:
    """Dense rank of titles by watch minutes inside their genre."""
    views = title_activity(events.where(is_watch()))
    summed = content.join(views, "content_id").select(
        "content_id",
        "title",
        "genre",
        F.col("minutes").alias("total_watch_minutes"),
        F.col("n_events").alias("total_stream_sessions"),
        "rating",
    )
    return dense_rank_within(summed, "genre", "total_watch_minutes", "genre_rank").orderBy(
        "genre", "genre_rank", "content_id"
    )


def daily_rollup(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(_day().alias("activity_date"))
        .agg(
            F.countDistinct("user_id").alias("daily_active_users"),
            F.sum("watch_time_mins").alias("total_platform_minutes"),
            ratio(F.sum("watch_time_mins"), F.count("watch_time_mins")).alias("avg_session_duration"),
            F.count_if(is_watch()).alias("total_plays"),
        )
        .orderBy(F.desc("activity_date"))
    )


def run_sql(spark: SparkSession, query: str, tables: dict[str, DataFrame], **parameters) -> DataFrame:
    """Run analyst SQL with named parameters (``:name``) over the given tables.

    Errors are raised; an empty result always means no matching rows.
    """
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(query, args=parameters)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counted: Column = F.count("*").alias("n")
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(counted).orderBy(F.desc("n"), column)
