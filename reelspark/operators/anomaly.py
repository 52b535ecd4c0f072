"""Rule-based anomalies over events: shared accounts, friction, long sessions, crawlers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions.exprs import is_watch, ratio, round_even
from reelspark.operators.spread import stored, top_per_key

# Thresholds of the four rules.
MAX_ADDRESSES = 2
MAX_FRICTION = 0.10
MAX_SESSION_MINS = 240
MIN_SEARCHES = 5


def _row(
    anomaly_id: Column,
    category: str,
    severity: str,
    entity: Column,
    description: Column,
    metric: Column,
    action: str,
) -> list[Column]:
    return [
        anomaly_id.alias("anomaly_id"),
        F.lit(category).alias("category"),
        F.lit(severity).alias("severity"),
        entity.alias("affected_entity"),
        description.alias("description"),
        metric.alias("metric_value"),
        F.lit(action).alias("recommended_action"),
    ]


def _said(template: str, *columns: str) -> Column:
    return F.format_string(template, *(F.col(c).cast("string") for c in columns))


def _activity(events: DataFrame, ordinal: str) -> DataFrame:
    """Events counted per user, address and device: all that the rules on users and on
    friction need, in one pass with a partial aggregation."""
    return events.groupBy("user_id", "ip_address", "device").agg(
        F.min(ordinal).alias("_at"),
        F.count("*").alias("_events"),
        F.count("event_type").alias("_typed"),
        F.count_if(F.col("event_type").isin("buffering", "error")).alias("_friction"),
        F.count_if(F.col("event_type") == "search").alias("_searches"),
        F.count_if(is_watch()).alias("_plays"),
    )


def multi_ip(events: DataFrame, ordinal: str = "event_id") -> DataFrame:
    """Users with more than two distinct addresses, with their first three devices."""
    return _multi_ip(_activity(events, ordinal))


def _multi_ip(activity: DataFrame) -> DataFrame:
    known = activity.where("user_id IS NOT NULL")
    many = (
        known.groupBy("user_id")
        .agg(F.countDistinct("ip_address").alias("n_ips"))
        .where(F.col("n_ips") > MAX_ADDRESSES)
    )
    seen = known.where("device IS NOT NULL").groupBy("user_id", "device").agg(F.min("_at").alias("_at"))
    packed = F.sort_array(F.collect_list(F.struct("_place", "device")))
    devices = (
        top_per_key(seen, "user_id", [F.col("_at")], 3, "_place")
        .groupBy("user_id")
        .agg(F.array_join(packed["device"], ", ").alias("devices"))
    )
    return (
        many.join(devices, "user_id", "left")
        .withColumn("devices", F.coalesce("devices", F.lit("")))
        .select(
            *_row(
                _said("ANO-ACC-%s", "user_id"),
                "Security / Credential Sharing",
                "CRITICAL",
                _said("User %s", "user_id"),
                _said(
                    "Streaming activity detected across %s distinct IP addresses and multiple devices (%s).",
                    "n_ips",
                    "devices",
                ),
                _said("%s IPs", "n_ips"),
                "Trigger 2FA re-verification or prompt for Family Plan upgrade.",
            )
        )
    )


def friction_ratio(events: DataFrame) -> DataFrame:
    """One row when buffering and error events exceed a tenth of all typed events."""
    trouble = F.col("event_type").isin("buffering", "error")
    return _friction(events.agg(F.count_if(trouble).alias("_friction"), F.count("event_type").alias("_typed")))


def _friction(counted: DataFrame) -> DataFrame:
    share = ratio(F.sum("_friction"), F.sum("_typed"))
    return (
        counted.agg(share.alias("_share"))
        .where(F.col("_share") > MAX_FRICTION)
        .withColumn("_percent", round_even(F.col("_share") * 100, 1))
        .select(
            *_row(
                F.lit("ANO-QOS-01"),
                "QoS / Network Degradation",
                "HIGH",
                F.lit("CDN Streaming Cluster"),
                _said(
                    "Buffering & playback friction events represent %s%% of total stream traffic"
                    " (threshold: 10%%).",
                    "_percent",
                ),
                _said("%s%% friction", "_percent"),
                "Auto-switch CDN edge POP or downscale initial adaptive bitrate (ABR) profile.",
            )
        )
    )


def long_sessions(events: DataFrame) -> DataFrame:
    return events.where(is_watch() & (F.col("watch_time_mins") > MAX_SESSION_MINS)).select(
        *_row(
            _said("ANO-BOT-%s", "event_id"),
            "Abnormal Playback Duration",
            "MEDIUM",
            _said("User %s (%s)", "user_id", "device"),
            _said(
                "Continuous playback session exceeded %s minutes without user interaction.",
                "watch_time_mins",
            ),
            _said("%s mins", "watch_time_mins"),
            "Send 'Are you still watching?' prompt to preserve CDN bandwidth.",
        )
    )


def scrapers(events: DataFrame) -> DataFrame:
    """Users who search at least five times and never play."""
    counted = events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "search").alias("_searches"), F.count_if(is_watch()).alias("_plays")
    )
    return _scrapers(counted)


def _scrapers(counted: DataFrame) -> DataFrame:
    return (
        counted.where("user_id IS NOT NULL")
        .groupBy("user_id")
        .agg(F.sum("_searches").alias("searches"), F.sum("_plays").alias("_plays"))
        .where((F.col("searches") >= MIN_SEARCHES) & (F.col("_plays") == 0))
        .select(
            *_row(
                _said("ANO-SCRAP-%s", "user_id"),
                "Automated Crawler / Scraping",
                "WARNING",
                _said("User %s", "user_id"),
                _said(
                    "Disproportionate search requests (%s queries) with zero video playback initiation.",
                    "searches",
                ),
                _said("%s queries : 0 plays", "searches"),
                "Enforce rate limiting on search endpoint for this session.",
            )
        )
    )


def _findings(events: DataFrame, activity: DataFrame) -> DataFrame:
    found = [_multi_ip(activity), _friction(activity), long_sessions(events), _scrapers(activity)]
    return reduce(DataFrame.unionByName, found)


def all_anomalies(events: DataFrame, ordinal: str = "event_id") -> DataFrame:
    """Every finding; one health row when events exist and no rule fired. Events are
    read twice: once for the stored activity, once for long sessions."""
    activity = stored(_activity(events, ordinal))
    found = stored(_findings(events, activity))
    total = found.agg(F.count("*").alias("n")).scalar()
    healthy = (
        activity.agg(F.coalesce(F.sum("_events"), F.lit(0)).alias("_events"))
        .where((F.col("_events") > 0) & (total == 0))
        .select(
            *_row(
                F.lit("ANO-HEALTH-OK"),
                "System Health",
                "INFO",
                F.lit("Global Streaming Fleet"),
                F.lit(
                    "All streaming metrics, QoS buffering ratios, and concurrent session checks are"
                    " within nominal limits."
                ),
                F.lit("Nominal"),
                "Continue passive telemetry monitoring.",
            )
        )
    )
    return found.unionByName(healthy)


def anomaly_summary(events: DataFrame, ordinal: str = "event_id") -> DataFrame:
    """Counts by severity; a run with only the health row has no anomalies."""

    def at(*levels: str) -> Column:
        return F.count_if(F.col("severity").isin(*levels))

    return _findings(events, stored(_activity(events, ordinal))).agg(
        F.count("*").alias("total_anomalies"),
        at("CRITICAL").alias("critical_count"),
        at("HIGH", "WARNING").alias("warning_count"),
        at("MEDIUM").alias("medium_count"),
        F.when(at("CRITICAL") == 0, "Healthy").otherwise("Action Required").alias("fleet_status"),
    )
