"""Staging projections and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions.exprs import has_value, is_watch, ratio, round_even
from reelspark.operators.spread import sorted_positions
from reelspark.sources.sinks import VersionedStore, full_refresh


def stg_events(events: DataFrame) -> DataFrame:
    return events.where("user_id IS NOT NULL").select(
        "event_id",
        "user_id",
        F.lower(F.trim("event_type")).alias("event_type"),
        "content_id",
        F.coalesce("watch_time_mins", F.lit(0)).alias("watch_time_mins"),
        "device",
        "session_id",
        "timestamp",
        "ip_address",
    )


def stg_users(users: DataFrame) -> DataFrame:
    return users.where("user_id IS NOT NULL").select(
        "user_id", "name", "country", "tier", "status", "registration_date"
    )


def user_activity(events: DataFrame) -> DataFrame:
    """Per user: events, video minutes, distinct titles, last event.

    The distinct count makes Spark aggregate by (user, title) first, with map-side
    partial sums, so a user with very many events is spread over tasks.
    """
    return events.groupBy("user_id").agg(
        F.count("event_id").alias("total_events"),
        F.coalesce(F.sum(F.when(is_watch(), F.col("watch_time_mins"))), F.lit(0)).alias("total_watch_mins"),
        F.countDistinct("content_id").alias("distinct_content"),
        F.max("timestamp").alias("last_active_at"),
    )


def fact_user_activity(staged_users: DataFrame, staged_events: DataFrame) -> DataFrame:
    activity = user_activity(staged_events)
    return staged_users.join(activity, "user_id", "left").select(
        "user_id",
        "name",
        "country",
        "tier",
        F.coalesce("total_events", F.lit(0)).alias("total_events"),
        F.coalesce("total_watch_mins", F.lit(0)).alias("total_watch_mins"),
        F.coalesce("distinct_content", F.lit(0)).alias("distinct_content_consumed"),
        "last_active_at",
    )


def analytics_daily_usage(staged_events: DataFrame) -> DataFrame:
    return staged_events.groupBy(F.col("timestamp").cast("date").alias("usage_date")).agg(
        F.countDistinct("user_id").alias("daily_active_users"),
        F.count("event_id").alias("total_events_logged"),
        F.sum(F.when(is_watch(), F.col("watch_time_mins")).otherwise(0)).alias("total_daily_watch_mins"),
        F.count_if(F.col("event_type") == "subscription").alias("new_subscriptions_started"),
    )


def watch_totals(events: DataFrame) -> DataFrame:
    """Minutes and last view per (user, title) that was watched."""
    named = has_value(events, "user_id") & has_value(events, "content_id")
    return (
        events.where(is_watch() & named)
        .groupBy("user_id", "content_id")
        .agg(
            F.sum("watch_time_mins").alias("total_watch_time_mins"),
            F.max("timestamp").alias("last_watched_at"),
        )
    )


def watch_history(events: DataFrame, content: DataFrame) -> DataFrame:
    """Per (user, title): minutes, last view, completion; ids follow the key order.

    Views are summed before the catalog join, so the join sees one row per pair.
    """
    catalog = content.select("content_id", "duration_mins")
    percent = round_even(
        ratio(F.col("total_watch_time_mins"), F.coalesce("duration_mins", F.lit(90))) * 100, 1
    )
    measured = (
        watch_totals(events)
        .join(catalog, "content_id", "left")
        .withColumn("completion_percentage", F.least(percent, F.lit(100.0)))
    )
    placed = sorted_positions(measured, [F.col("user_id"), F.col("content_id")], "_position")
    number = (F.col("_position") + 1).cast("string")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    return placed.select(
        F.concat(F.lit("WH_"), padded).alias("history_id"),
        "user_id",
        "content_id",
        "total_watch_time_mins",
        "completion_percentage",
        "last_watched_at",
        (F.col("completion_percentage") >= 90.0).alias("completed"),
    )


MART_VIEWS = ("stg_events", "stg_users")


def materialize(events: DataFrame, users: DataFrame, root: str) -> dict[str, DataFrame]:
    """Build the models in dependency order: staging as views, marts as one new version
    of the store at ``root``. A failed build leaves the published marts as they are."""
    spark = events.sparkSession
    stg_events(events).createOrReplaceTempView("stg_events")
    stg_users(users).createOrReplaceTempView("stg_users")
    models = {name: spark.table(name) for name in MART_VIEWS}
    store = VersionedStore(spark, root)
    version = full_refresh(
        store,
        {
            "fact_user_activity": fact_user_activity(models["stg_users"], models["stg_events"]),
            "analytics_daily_usage": analytics_daily_usage(models["stg_events"]),
        },
    )
    return models | {name: store.read(name, version) for name in ("fact_user_activity", "analytics_daily_usage")}
