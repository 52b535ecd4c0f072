"""Question routing, the named report queries and their one-sentence summaries."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions.exprs import is_watch, ratio, round_even, strip
from reelspark.operators.quality import audit, source_columns
from reelspark.operators.spread import stored
from reelspark.plans.analytics import title_activity
from reelspark.plans.marts import user_activity

# Topics and the phrases that lead to them, first match wins.
TOPICS = (
    ("Content Analytics", ("watch time", "most watched", "highest watch", "longest")),
    ("User Analytics", ("active user", "most active", "top user", "user activity")),
    (
        "Event Stream Analytics",
        ("common event", "events today", "event type", "most common", "event breakdown"),
    ),
    ("Trend Analysis", ("trending", "popular", "frequent")),
    ("Data Governance & Quality", ("data quality", "quality status", "dq", "duplicates", "null")),
    ("Financial Analytics", ("subscription", "revenue", "mrr", "plan", "paying")),
)
FALLBACK_TOPIC = "Platform Summary"


def topic_of(question: Column) -> Column:
    text = strip(F.lower(question))
    routed = None
    for topic, phrases in TOPICS:
        hit = reduce(or_, [F.contains(text, F.lit(p)) for p in phrases])
        routed = F.when(hit, topic) if routed is None else routed.when(hit, topic)
    return routed.otherwise(FALLBACK_TOPIC)


def route_questions(questions: DataFrame) -> DataFrame:
    return questions.withColumn("category", topic_of(F.col("question")))


def top_watched(content: DataFrame, events: DataFrame, limit: int = 5) -> DataFrame:
    """Most minutes, by title text: titles that share name, genre, type and rating add up."""
    views = title_activity(events.where(is_watch()))
    return (
        content.join(views, "content_id")
        .groupBy("title", "genre", "content_type", "rating")
        .agg(F.sum("minutes").alias("total_watch_mins"), F.sum("n_events").alias("total_sessions"))
        .orderBy(F.desc("total_watch_mins"), "title", "genre", "content_type", "rating")
        .limit(limit)
    )


def most_active_users(users: DataFrame, events: DataFrame, limit: int = 5) -> DataFrame:
    return (
        users.join(user_activity(events), "user_id")
        .select(
            "user_id",
            "name",
            "country",
            "tier",
            F.col("total_events").alias("total_interactions"),
            "total_watch_mins",
        )
        .orderBy(F.desc("total_watch_mins"), F.desc("total_interactions"), "user_id")
        .limit(limit)
    )


def event_mix(events: DataFrame) -> DataFrame:
    everything = events.agg(F.count("*").alias("n")).scalar()
    return (
        events.groupBy("event_type")
        .agg(F.count("*").alias("event_count"))
        .withColumn("percentage_share", F.round(ratio(F.col("event_count") * 100, everything), 1))
        .orderBy(F.desc("event_count"), "event_type")
    )


def trending(content: DataFrame, events: DataFrame, limit: int = 5) -> DataFrame:
    return (
        content.join(title_activity(events), "content_id")
        .select(
            "content_id",
            "title",
            "content_type",
            "genre",
            F.col("n_events").alias("total_interactions"),
            F.col("minutes").alias("watch_time_mins"),
        )
        .orderBy(F.desc("total_interactions"), "content_id")
        .limit(limit)
    )


def revenue(subscriptions: DataFrame) -> DataFrame:
    return (
        subscriptions.where("status = 'active'")
        .groupBy("plan_name")
        .agg(
            F.count("sub_id").alias("active_subscribers"),
            F.round(F.sum("monthly_price"), 2).cast("double").alias("monthly_revenue"),
            F.round(ratio(F.sum("monthly_price"), F.count("monthly_price")), 2).alias("avg_price"),
        )
        .orderBy(F.desc("monthly_revenue"), "plan_name")
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def platform_summary(users: DataFrame, content: DataFrame, events: DataFrame, subscriptions: DataFrame) -> DataFrame:
    def rows(frame: DataFrame) -> Column:
        return frame.agg(F.count("*").alias("n")).scalar()

    return users.agg(F.count("*").alias("total_users")).select(
        "total_users",
        rows(content).alias("total_titles"),
        rows(events).alias("total_events"),
        rows(subscriptions).alias("total_subs"),
    )


def _leaders(report: DataFrame, order: list[Column], top: int = 2) -> DataFrame:
    """The first rows of a report as one ordered array; ``order`` is total."""
    first = report.orderBy(*order).limit(top)
    # Negated or plain sort keys are folded into the order of collection by an index.
    ordered = first.coalesce(1).withColumn("_at", F.monotonically_increasing_id())
    packed = F.sort_array(F.collect_list(F.struct("_at", *report.columns)))
    return ordered.agg(packed.alias("rows"))


def _field(position: int, name: str) -> Column:
    return F.get("rows", F.lit(position))[name]


def _money(c: Column) -> Column:
    return F.format_string("$%,.2f", c)


def _second(*parts: Column) -> Column:
    """The clause on the second row, empty where there is none."""
    return F.coalesce(F.concat(*parts), F.lit(""))


def narratives(
    users: DataFrame, content: DataFrame, events: DataFrame, subscriptions: DataFrame
) -> DataFrame:
    """One sentence per topic, from the leading rows of its report. The wording is a
    fixed value."""
    watched = _leaders(
        top_watched(content, events),
        [F.desc("total_watch_mins"), *map(F.col, ("title", "genre", "content_type", "rating"))],
    ).select(
        F.lit("Content Analytics").alias("category"),
        F.concat(
            F.lit("**"), _field(0, "title"), F.lit("** leads the platform with **"),
            F.format_string("%,d", _field(0, "total_watch_mins")),
            F.lit(" total watch minutes** across "), _field(0, "total_sessions").cast("string"),
            F.lit(" streaming sessions."),
            _second(F.lit(" Followed by *"), _field(1, "title"), F.lit("* ("),
                    _field(1, "total_watch_mins").cast("string"), F.lit(" mins).")),
        ).alias("answer"),
    )
    active = _leaders(
        most_active_users(users, events),
        [F.desc("total_watch_mins"), F.desc("total_interactions"), F.col("user_id")],
    ).select(
        F.lit("User Analytics").alias("category"),
        F.concat(
            F.lit("The most active user is **"), _field(0, "name"), F.lit("** ("), _field(0, "tier"),
            F.lit(" tier from "), _field(0, "country"), F.lit(") with **"),
            _field(0, "total_watch_mins").cast("string"), F.lit(" streaming minutes** and "),
            _field(0, "total_interactions").cast("string"), F.lit(" total platform interactions."),
        ).alias("answer"),
    )
    mix = _leaders(event_mix(events), [F.desc("event_count"), F.col("event_type")]).select(
        F.lit("Event Stream Analytics").alias("category"),
        F.concat(
            F.lit("The most frequent event type is **`"), _field(0, "event_type"), F.lit("`** with **"),
            _field(0, "event_count").cast("string"), F.lit(" occurrences** ("),
            _field(0, "percentage_share").cast("string"),
            F.lit("% of all platform traffic)"),
            _second(F.lit(", followed by `"), _field(1, "event_type"), F.lit("` ("),
                    _field(1, "event_count").cast("string"), F.lit(" events)")),
            F.lit("."),
        ).alias("answer"),
    )
    trend = _leaders(trending(content, events), [F.desc("total_interactions"), F.col("content_id")]).select(
        F.lit("Trend Analysis").alias("category"),
        F.concat(
            F.lit("Trending content is led by **"), _field(0, "title"), F.lit("** ("), _field(0, "genre"),
            F.lit(") with "), _field(0, "total_interactions").cast("string"),
            F.lit(" total user interactions and "), _field(0, "watch_time_mins").cast("string"),
            F.lit(" minutes watched."),
        ).alias("answer"),
    )
    plans = revenue(subscriptions)
    earned = plans.agg(F.sum("monthly_revenue").alias("n")).scalar()
    money = _leaders(plans, [F.desc("monthly_revenue"), F.col("plan_name")]).select(
        F.lit("Financial Analytics").alias("category"),
        F.concat(
            F.lit("Total Monthly Recurring Revenue (MRR) stands at **"), _money(earned),
            F.lit("**. The top revenue driver is **"), _field(0, "plan_name"), F.lit("** bringing in "),
            _money(_field(0, "monthly_revenue")), F.lit("."),
        ).alias("answer"),
    )
    stored_events = events.select(*(F.col(c).cast("string").alias(c) for c in source_columns(events)))
    health = audit(stored_events, "events").select(
        F.lit("Data Governance & Quality").alias("category"),
        F.concat(
            F.lit("**Data Quality Status**: Operational warehouse tables are clean and healthy. Events health is at **"),
            F.col("dq_score").cast("string"),
            F.lit("%**, with zero unresolved duplicates remaining after ETL deduplication."),
        ).alias("answer"),
    )
    summary = platform_summary(users, content, events, subscriptions).select(
        F.lit(FALLBACK_TOPIC).alias("category"),
        F.concat(
            F.lit("Here is the high-level platform summary: **"), F.col("total_users").cast("string"),
            F.lit(" users**, **"), F.col("total_titles").cast("string"),
            F.lit(" catalog titles**, and **"), F.col("total_events").cast("string"),
            F.lit(" events logged**. Try asking specific questions like: *'Which content has the highest"
                  " watch time?'* or *'Which users are most active?'*"),
        ).alias("answer"),
    )
    # What is said when a report has no rows.
    nothing = {
        "Content Analytics": "No watch time records found. Please ensure the ETL pipeline has ingested the events data.",
        "User Analytics": "No user activity records found.",
        "Event Stream Analytics": "No event stream data available.",
        "Trend Analysis": "No content data available.",
        "Financial Analytics": "No active subscription records found.",
    }
    missing = F.create_map(*(F.lit(x) for pair in nothing.items() for x in pair))
    sentences = reduce(DataFrame.unionByName, [watched, active, mix, trend, health, money, summary])
    return sentences.withColumn("answer", F.coalesce("answer", missing[F.col("category")]))


def kpis(users: DataFrame, events: DataFrame, raw_events: DataFrame, content: DataFrame) -> DataFrame:
    """Users, events, distinct actions, quality score and titles in one row."""
    score = audit(raw_events, "events").select("dq_score").scalar()
    return events.agg(
        F.count("*").alias("total_events"), F.countDistinct("event_type").alias("event_types")
    ).select(
        users.agg(F.count("*").alias("n")).scalar().alias("total_users"),
        "total_events",
        "event_types",
        score.alias("dq_score"),
        content.agg(F.count("*").alias("n")).scalar().alias("total_titles"),
    )


def valid_rate(audited: DataFrame) -> DataFrame:
    percent = ratio(F.col("valid_records"), F.col("total_records")) * 100
    return audited.select(
        "total_records", "valid_records", round_even(percent, 1).alias("valid_percent")
    )


def answer_questions(
    questions: DataFrame, users: DataFrame, content: DataFrame, events: DataFrame, subscriptions: DataFrame
) -> DataFrame:
    """Every question with its category and the sentence that answers it. There is one
    sentence for each topic, so they are broadcast."""
    sentences = stored(narratives(users, content, events, subscriptions))
    return route_questions(questions).join(F.broadcast(sentences), "category")
