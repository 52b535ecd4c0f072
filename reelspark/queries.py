"""The registered queries: every operator over the supplied tables.

Operators keep typed dates and timestamps; here, at the outlet, they are written as
text (``yyyy-MM-dd`` and ``yyyy-MM-dd HH:mm:ss``) and arrays are joined.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.contracts import KEYS, ORDINAL
from reelspark.operators import anomaly, churn, cleaning, constraints, drift, masking, quality
from reelspark.operators import recommend, retrieval
from reelspark.operators.search_index import SearchIndex
from reelspark.operators.spread import stored
from reelspark.plans import analytics, batch, marts, reports
from reelspark.session import ensure_checkpoint_dir
from reelspark.sources import roles, sinks
from reelspark.streaming import events as stream

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def outlet(df: DataFrame) -> DataFrame:
    """Dates, timestamps, decimals and arrays in the form they leave the engine."""

    def form(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return c.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.left(c.cast("string"), F.lit(19)).alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(c, "|").alias(field.name)
        return c

    return df.select(*(form(f) for f in df.schema.fields if f.name != ORDINAL))


def query(name: str):
    def register(build: Query) -> Query:
        _REGISTRY[name] = lambda spark, folder: outlet(build(spark, folder))
        return build

    return register


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


class Tables:
    """The role tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._at = (spark, folder)

    def __getattr__(self, name: str) -> DataFrame:
        return getattr(roles, name)(*self._at)

    def raw(self) -> dict[str, DataFrame]:
        return {name: getattr(self, f"{name}_raw") for name in KEYS}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- documents, counts and ad-hoc SQL -------------------------------------------


@query("raw_docs_shape")
def _(spark, folder):
    docs = sinks.raw_documents(Tables(spark, folder).events_raw)
    return docs.select("event_id", "user_id", "event", "content_id", "timestamp", "metadata.*")


@query("sink_raw_docs")
def _(spark, folder):
    docs = sinks.raw_documents(Tables(spark, folder).events_raw)
    return docs.select("event_id", F.to_json("metadata").alias("metadata_json"))


@query("docs_recent")
def _(spark, folder):
    return sinks.newest(Tables(spark, folder).events, [F.desc("timestamp"), F.desc("event_id")], 50)


@query("docs_count")
def _(spark, folder):
    return Tables(spark, folder).events_raw.agg(F.count("*").alias("n_documents"))


@query("retain_last_n")
def _(spark, folder):
    return sinks.newest(Tables(spark, folder).events, [F.desc("event_id")], 5000)


@query("table_row_counts")
def _(spark, folder):
    t = Tables(spark, folder)
    history = marts.watch_totals(t.events)  # the history has one row per total
    return reports.table_row_counts(
        {
            "users": t.users,
            "content": t.content,
            "events": t.events,
            "subscriptions": t.subscriptions,
            "watch_history": history,
        }
    )


ADHOC = """
SELECT u.country, e.device, COUNT(*) AS n_events, SUM(e.watch_time_mins) AS minutes
FROM users u JOIN events e ON u.user_id = e.user_id
WHERE u.tier = :tier AND e.timestamp >= :since
GROUP BY u.country, e.device
"""


@query("adhoc_sql")
def _(spark, folder):
    t = Tables(spark, folder)
    tables = {"users": t.users, "events": t.events}
    return analytics.run_sql(spark, ADHOC, tables, tier="Premium", since="2024-01-05")


# --- quality ---------------------------------------------------------------------

AUDITED = ("events", "users")


def _each_audited(spark, folder, build):
    t = Tables(spark, folder)
    return _union(
        [
            build(getattr(t, f"{d}_raw"), d).select(F.lit(d).alias("dataset"), "*")
            for d in AUDITED
        ]
    )


@query("dq_duplicate_keys")
def _(spark, folder):
    return _each_audited(spark, folder, lambda df, d: quality.duplicate_members(df, KEYS[d]))


@query("dq_full_row_duplicates")
def _(spark, folder):
    raw = Tables(spark, folder).raw()
    return _union(
        [quality.full_row_duplicates(df).select(F.lit(d).alias("dataset"), "*") for d, df in raw.items()]
    )


@query("dq_null_profile")
def _(spark, folder):
    raw = Tables(spark, folder).raw()
    return _union([quality.null_profile(df).select(F.lit(d).alias("dataset"), "*") for d, df in raw.items()])


def _one_rule(name: str, dataset: str, rule: str) -> None:
    @query(name)
    def _(spark, folder):
        raw = getattr(Tables(spark, folder), f"{dataset}_raw")
        return quality.rule_counts(raw, dataset).select(F.col(rule).alias("violations"))


_one_rule("dq_missing_key", "events", "invalid_user_ids")
_one_rule("dq_accepted_values", "events", "invalid_event_types")
_one_rule("dq_numeric_bounds", "events", "invalid_numerics")
_one_rule("dq_email_format", "users", "invalid_emails")


@query("dq_timestamp_parse")
def _(spark, folder):
    t = Tables(spark, folder)
    return _union(
        [
            quality.rule_counts(t.events_raw, "events").select(
                F.lit("events").alias("dataset"), F.col("invalid_timestamps").alias("violations")
            ),
            quality.rule_counts(t.users_raw, "users").select(
                F.lit("users").alias("dataset"), F.col("invalid_dates").alias("violations")
            ),
        ]
    )


@query("dq_row_verdict")
def _(spark, folder):
    return quality.row_verdicts(Tables(spark, folder).events_raw, "events").withColumnRenamed(
        ORDINAL, "row_index"
    )


@query("dq_score")
def _(spark, folder):
    t = Tables(spark, folder)
    columns = (
        "dataset",
        "total_records",
        "valid_records",
        "invalid_records",
        "duplicates",
        "missing_values",
        "dq_score",
    )
    return _union([quality.audit(getattr(t, f"{d}_raw"), d).select(*columns) for d in AUDITED])


@query("dq_error_log")
def _(spark, folder):
    return quality.error_log(Tables(spark, folder).events_raw, "events")


@query("dq_error_log_users")
def _(spark, folder):
    return quality.error_log(Tables(spark, folder).users_raw, "users")


@query("dq_rule_report")
def _(spark, folder):
    return quality.rule_report(quality.audit(Tables(spark, folder).events_raw, "events"), "events")


@query("dq_ingest_summary")
def _(spark, folder):
    raw = Tables(spark, folder).raw()
    return _union([quality.load_summary(df, d, drift.check_drift(df, d)) for d, df in raw.items()])


@query("dq_entity_summary")
def _(spark, folder):
    t = Tables(spark, folder)
    return quality.entity_summary(t.events_raw, t.users_raw)


# --- drift and constraints ---------------------------------------------------------


def _arrivals(spark, folder) -> dict[str, DataFrame]:
    """Raw datasets, with the supplied event table as it stands in place of events."""
    t = Tables(spark, folder)
    supplied = roles.table(spark, folder, "events")
    return {**t.raw(), "events": supplied}


def _drift_kind(name: str, kind: str) -> None:
    @query(name)
    def _(spark, folder):
        return drift.check_all(_arrivals(spark, folder)).where(F.col("kind") == kind)


_drift_kind("drift_added_columns", "added")
_drift_kind("drift_missing_columns", "missing")


@query("drift_type_mismatches")
def _(spark, folder):
    return drift.check_all(Tables(spark, folder).raw()).where("kind = 'type_mismatch'")


@query("drift_report")
def _(spark, folder):
    return drift.check_all(_arrivals(spark, folder))


@query("assert_unique")
def _(spark, folder):
    t = Tables(spark, folder)
    return _union(
        [constraints.assert_unique(df, f"{d}_raw", KEYS[d]) for d, df in t.raw().items()]
        + [constraints.assert_unique(t.users, "users", "user_id")]
    )


@query("assert_not_null")
def _(spark, folder):
    t = Tables(spark, folder)
    return constraints.assert_not_null(t.events_raw, "events_raw", "event_id", "user_id", "device").unionByName(
        constraints.assert_not_null(t.users, "users", "user_id")
    )


@query("assert_accepted_values")
def _(spark, folder):
    t = Tables(spark, folder)
    return constraints.assert_accepted_values(
        t.events, "events", "event_type", constraints.EVENT_TYPES
    ).unionByName(constraints.assert_accepted_values(t.users_raw, "users_raw", "tier", constraints.TIERS))


@query("assert_suite")
def _(spark, folder):
    t = Tables(spark, folder)
    staged_users, staged_events = marts.stg_users(t.users), marts.stg_events(t.events)
    activity = marts.fact_user_activity(staged_users, staged_events)
    return constraints.run_suite(t.users, t.events, staged_users, staged_events, activity)


@query("assert_foreign_keys")
def _(spark, folder):
    t = Tables(spark, folder)
    return constraints.foreign_keys(
        {
            "users": t.users,
            "content": t.content,
            "events": t.events,
            "subscriptions": t.subscriptions,
            "watch_history": marts.watch_totals(t.events),
        }
    )


@query("assert_row_counts")
def _(spark, folder):
    t = Tables(spark, folder)
    return constraints.row_counts({"users": t.users, "content": t.content})


# --- cleaning and privacy ------------------------------------------------------------


@query("dedupe_keep_first")
def _(spark, folder):
    return cleaning.keep_first(Tables(spark, folder).events_raw, "event_id")


@query("clean_users")
def _(spark, folder):
    return cleaning.clean_users(Tables(spark, folder).users_raw)


@query("clean_users_masked")
def _(spark, folder):
    return cleaning.clean_users(Tables(spark, folder).users_raw, mask_pii=True)


@query("clean_content")
def _(spark, folder):
    return cleaning.clean_content(Tables(spark, folder).content_raw)


@query("clean_subscriptions")
def _(spark, folder):
    return cleaning.clean_subscriptions(Tables(spark, folder).subscriptions_raw)


@query("clean_events")
def _(spark, folder):
    return cleaning.clean_events(Tables(spark, folder).events_raw)


@query("clean_stats")
def _(spark, folder):
    return cleaning.all_clean_stats(Tables(spark, folder).raw())


@query("etl_batch")
def _(spark, folder):
    raw = Tables(spark, folder).raw()
    return batch.batch_metrics(raw, batch.clean_all(raw))


def _one_mask(name: str, dataset: str, key: str, column: str, mask) -> None:
    @query(name)
    def _(spark, folder):
        df = getattr(Tables(spark, folder), dataset)
        return df.select(F.col(ORDINAL).alias("row_index"), key, mask(F.col(column)).alias(column))


_one_mask("mask_email", "users_raw", "user_id", "email", masking.mask_email)
_one_mask("mask_phone", "users_raw", "user_id", "phone", masking.mask_phone)
_one_mask("mask_ip", "events_raw", "event_id", "ip_address", masking.mask_ip)


@query("mask_table")
def _(spark, folder):
    df = Tables(spark, folder).users_raw.withColumnRenamed(ORDINAL, "row_index")
    return masking.mask_table(df)


@query("detect_pii_columns")
def _(spark, folder):
    raw = Tables(spark, folder).raw()
    return _union(
        [masking.detect_pii_columns(df).select(F.lit(d).alias("dataset"), "*") for d, df in raw.items()]
    )


# --- staging, marts, SQL suite, reports ------------------------------------------------


@query("stg_events")
def _(spark, folder):
    return marts.stg_events(Tables(spark, folder).events)


@query("stg_users")
def _(spark, folder):
    return marts.stg_users(Tables(spark, folder).users)


@query("fact_user_activity")
def fact_user_activity(spark, folder):
    t = Tables(spark, folder)
    return marts.fact_user_activity(marts.stg_users(t.users), marts.stg_events(t.events))


@query("analytics_daily_usage")
def _(spark, folder):
    return marts.analytics_daily_usage(marts.stg_events(Tables(spark, folder).events))


@query("watch_history")
def _(spark, folder):
    t = Tables(spark, folder)
    return marts.watch_history(t.events, t.content)


def _suite(name: str, build, *needs: str) -> None:
    @query(name)
    def _(spark, folder):
        t = Tables(spark, folder)
        return build(*(getattr(t, n) for n in needs))


_suite("q_dau", analytics.daily_active_users, "events")
_suite("q_most_watched", analytics.most_watched, "content", "events")
_suite("q_top_users", analytics.top_users, "users", "events")
_suite("q_genre_engagement", analytics.genre_engagement, "content", "events")
_suite("q_plan_mrr", analytics.plan_revenue, "subscriptions")
_suite("q_device_funnel", analytics.device_funnel, "events")
_suite("q_device_counts", analytics.device_counts, "events")
_suite("q_cohort_retention", analytics.cohort_retention, "events")
_suite("q_genre_rank", analytics.genre_rank, "content", "events")
_suite("q_daily_rollup", analytics.daily_rollup, "events")
_suite("route_questions", reports.route_questions, "questions")
_suite("rpt_top_watched", reports.top_watched, "content", "events")
_suite("rpt_top_users", reports.most_active_users, "users", "events")
_suite("rpt_event_mix", reports.event_mix, "events")
_suite("rpt_trending", reports.trending, "content", "events")
_suite("rpt_revenue", reports.revenue, "subscriptions")
_suite("rpt_platform_summary", reports.platform_summary, "users", "content", "events", "subscriptions")
_suite("rpt_narrative", reports.narratives, "users", "content", "events", "subscriptions")


@query("answer_questions")
def _(spark, folder):
    t = Tables(spark, folder)
    answered = reports.answer_questions(t.questions, t.users, t.content, t.events, t.subscriptions)
    return answered.select("conv_id", "turn", "category", "answer")


# --- churn, recommendations, anomalies --------------------------------------------------

_suite("churn_features", churn.churn_features, "users", "events", "subscriptions")


def _scores(spark, folder) -> DataFrame:
    t = Tables(spark, folder)
    return churn.churn_scores(churn.churn_features(t.users, t.events, t.subscriptions))


@query("churn_scores")
def _(spark, folder):
    return _scores(spark, folder)


@query("churn_ranked")
def _(spark, folder):
    ranked = churn.churn_ranked(_scores(spark, folder))
    return ranked.select("user_id", "churn_risk_score", "risk_level", "risk_factors")


@query("churn_fleet_summary")
def _(spark, folder):
    return churn.fleet_summary(_scores(spark, folder))


@query("churn_level_counts")
def _(spark, folder):
    return churn.level_counts(_scores(spark, folder))


_suite("rec_user_profile", recommend.user_profiles, "events", "content")
_suite("rec_for_users", recommend.recommend_for_users, "events", "content")
_suite("rec_cold_start", recommend.cold_start, "users", "events", "content")
_suite("rec_similar_titles", recommend.similar_titles, "content")
_suite("anom_multi_ip", anomaly.multi_ip, "events")
_suite("anom_friction_ratio", anomaly.friction_ratio, "events")
_suite("anom_long_session", anomaly.long_sessions, "events")
_suite("anom_scraper", anomaly.scrapers, "events")
_suite("anom_all", anomaly.all_anomalies, "events")
_suite("anom_summary", anomaly.anomaly_summary, "events")


# --- text ------------------------------------------------------------------------------


@query("text_clean")
def _(spark, folder):
    return retrieval.cleaned_documents(Tables(spark, folder).documents).select("doc_id", "text")


def _chunks(spark, folder) -> DataFrame:
    return retrieval.chunk_documents(Tables(spark, folder).documents)


@query("text_chunks")
def _(spark, folder):
    return _chunks(spark, folder).select(
        "chunk_id",
        "doc_id",
        "text",
        "word_count",
        "start_word_index",
        F.col("metadata")["source"].alias("source"),
    )


def _index(spark, folder) -> SearchIndex:
    """The index of the folder's documents, built once and opened by every later call.
    Its place names the state of the files, so that changed files get an index anew."""
    files = roles.table(spark, folder, "documents").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"
    )
    state = files.distinct().agg(F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()[0]
    ensure_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/index-{state}"
    try:
        return SearchIndex.open(spark, root)
    except LookupError:
        return SearchIndex.build(Tables(spark, folder).documents, root)


@query("tfidf_index")
def _(spark, folder):
    postings = _index(spark, folder).postings()
    return postings.select("term", "chunk_id", "tf", F.round("weight", 6).alias("weight"))


@query("tfidf_search")
def _(spark, folder):
    return _index(spark, folder).search(Tables(spark, folder).search_queries)


@query("rag_answer")
def _(spark, folder):
    t, index = Tables(spark, folder), _index(spark, folder)
    hits = stored(index.search(t.search_queries))
    return retrieval.answers(t.search_queries, hits, index.quotes(hits, t.documents))


@query("doc_inventory")
def _(spark, folder):
    return retrieval.document_inventory(Tables(spark, folder).documents)


# --- stream operators in batch form, overview ---------------------------------------------


def _checked(spark, folder) -> DataFrame:
    lines = stream.to_lines(Tables(spark, folder).events_raw)
    return stream.validate(stream.parse_lines(lines))


@query("stream_validate")
def _(spark, folder):
    return _checked(spark, folder).select("event_id", "user_id", "event_type", "is_valid", "validation_note")


@query("stream_route_valid")
def _(spark, folder):
    checked = stored(_checked(spark, folder))  # as the consumed log is
    checked = checked.withColumn("consumed_at", F.current_timestamp()).withColumn("arrival", F.lit(0))
    # rows without a clock get the time of arrival, which no statement can know
    return stream.accepted_events(checked).drop("timestamp", "arrival")


@query("stream_dead_letter")
def _(spark, folder):
    return _checked(spark, folder).where("NOT is_valid").select("event_id", "user_id", "event_type", "validation_note")


@query("stream_documents")
def _(spark, folder):
    docs = stream.stream_documents(_checked(spark, folder))
    return docs.select("event_id", "user_id", "event", "content_id", "timestamp", "metadata.*")


_suite("stream_multi_ip_windows", stream.multi_ip_windows, "events")
_suite("stream_friction_windows", stream.friction_windows, "events")
_suite("stream_long_session_windows", stream.long_session_windows, "events")
_suite("stream_scraper_windows", stream.scraper_windows, "events")


@query("stream_metrics")
def _(spark, folder):
    return stream.metrics(_checked(spark, folder))


@query("stream_usage_windows")
def _(spark, folder):
    return stream.usage_windows(Tables(spark, folder).events, exact=True)


@query("ov_event_type_counts")
def _(spark, folder):
    return analytics.value_counts(Tables(spark, folder).events, "event_type")


@query("ov_device_counts")
def _(spark, folder):
    return analytics.value_counts(Tables(spark, folder).events_raw, "device")


@query("ov_kpis")
def _(spark, folder):
    t = Tables(spark, folder)
    return reports.kpis(t.users, t.events, t.events_raw, t.content)


@query("ov_valid_rate")
def _(spark, folder):
    audited = quality.audit(Tables(spark, folder).events_raw, "events")
    return reports.valid_rate(audited)
