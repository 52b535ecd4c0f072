"""Bind the supplied tables to the roles of the data model.

Each role is a projection of whole tables: ``users`` from customer and nation,
``content`` from part, ``events`` from events, ``subscriptions`` from orders. The
``*_raw`` roles render the same rows as untyped text with repeated, missing and
malformed values, as files arrive before cleaning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.contracts import ORDINAL


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def users(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    key = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("phone"),
        "country",
        F.date_add(F.lit("2023-01-01").cast("date"), (key % 365).cast("int")).alias("registration_date"),
        F.when(segment.isin("AUTOMOBILE", "BUILDING"), "Premium")
        .when(segment.isin("FURNITURE", "HOUSEHOLD"), "Standard")
        .otherwise("Basic")
        .alias("tier"),
        F.when(F.col("c_acctbal") < 0, "inactive").otherwise("active").alias("status"),
    )


def content(spark: SparkSession, folder: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, folder, "part").select(
        key.alias("content_id"),
        F.col("p_name").alias("title"),
        F.element_at(
            F.array(F.lit("Movie"), F.lit("Series"), F.lit("Documentary")), (size % 3 + 1).cast("int")
        ).alias("content_type"),
        F.col("p_type").alias("genre"),
        (size + 1974).alias("release_year"),
        (size * 2 + 30).alias("duration_mins"),
        (F.lit(5.0) + (key * 37 % 50) / F.lit(10.0)).alias("rating"),
        F.col("p_brand").alias("director"),
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    """All events. The clock of a user is set back by up to 24 days, which spreads
    first-seen dates and inactivity over the users."""
    eid, uid, verb = F.col("event_id"), F.col("user_id"), F.col("event_type")
    at = F.col("ts") - F.make_dt_interval((uid % 25).cast("int"))
    device = F.array(*(F.lit(d) for d in ("Smart TV", "Mobile", "Web", "Tablet")))
    mapped = (
        F.when((verb == "view") & (uid % 10 == 7), "content_view")
        .when(verb == "view", "video_watch")
        .when(verb == "click", "search")
        .when(verb == "purchase", "subscription")
        .when(verb == "signup", "user_login")
        .otherwise(verb)
    )
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        mapped.alias("event_type"),
        F.when(verb != "signup", F.get_json_object("props", "$.k").cast("bigint")).alias("content_id"),
        F.when(mapped == "video_watch", F.floor("value")).otherwise(F.lit(0)).cast("int").alias("watch_time_mins"),
        F.element_at(device, (eid % 4 + 1).cast("int")).alias("device"),
        F.concat_ws("_", F.lit("sess"), uid.cast("string"), at.cast("date").cast("string")).alias("session_id"),
        at.alias("timestamp"),
        F.concat(
            F.lit("10."), ((uid + eid % (uid % 4 + 1)) % 256).cast("string"), F.lit(".0.1")
        ).alias("ip_address"),
    )


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        key.alias("sub_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("plan_name"),
        (F.floor(F.col("o_totalprice") / 100).cast("decimal(12,0)") / F.lit(100))
        .cast("decimal(12,2)")
        .alias("monthly_price"),
        start.alias("start_date"),
        F.date_add(start, 30).alias("renewal_date"),
        F.when(key % 10 == 0, "cancelled").when(key % 10 == 1, "expired").otherwise("active").alias("status"),
        F.when(F.col("o_orderstatus") == "F", "credit_card")
        .when(F.col("o_orderstatus") == "O", "paypal")
        .otherwise("bank_transfer")
        .alias("payment_method"),
    )


def _seen_twice(key: Column, every: int) -> Column:
    """Ordinal offsets of a row's copies: one row, or two for each ``every``-th key."""
    return F.explode(
        F.when(key % every == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    ).alias("_copy")


def _ordinal(key: Column) -> Column:
    return (key * 2 + F.col("_copy")).alias(ORDINAL)


def _spoil(c: Column, key: Column, **faults) -> Column:
    """Replace the value on keys divisible by each ``m<divisor>``; first match wins."""
    out = None
    for divisor, value in faults.items():
        hit = key % int(divisor[1:]) == 0
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out.otherwise(c.cast("string"))


def events_raw(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("event_id")
    return (
        events(spark, folder)
        .select("*", _seen_twice(key, 50))
        .select(
            F.concat(F.lit("EVT"), key.cast("string")).alias("event_id"),
            _spoil(F.concat(F.lit("U"), F.col("user_id").cast("string")), key, m41=None, m83="  ").alias("user_id"),
            F.col("event_type"),
            F.concat(F.lit("C"), F.col("content_id").cast("string")).alias("content_id"),
            _spoil(F.col("watch_time_mins"), key, m37="-10", m53="abc").alias("watch_time_mins"),
            _spoil(F.col("device"), key, m29=None).alias("device"),
            _spoil(F.col("session_id"), key, m31=None).alias("session_id"),
            _spoil(F.left(F.col("timestamp").cast("string"), F.lit(19)), key, m43="malformed-date").alias("timestamp"),
            F.col("ip_address"),
            _ordinal(key),
        )
    )


def users_raw(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("user_id")
    return (
        users(spark, folder)
        .select("*", _seen_twice(key, 60))
        .select(
            _spoil(F.concat(F.lit("U"), key.cast("string")), key, m97=None).alias("user_id"),
            _spoil(F.concat(F.lit(" "), F.col("name"), F.lit("\t")), key, m31=None).alias("name"),
            _spoil(F.col("email"), key, m47="no-at-sign", m59=None).alias("email"),
            _spoil(F.col("phone"), key, m23="12", m37=None).alias("phone"),
            _spoil(F.col("country"), key, m19=None).alias("country"),
            _spoil(F.col("registration_date"), key, m43="not-a-date").alias("registration_date"),
            _spoil(F.col("tier"), key, m29=None).alias("tier"),
            _spoil(F.col("status"), key, m37=None).alias("status"),
            _ordinal(key),
        )
    )


def content_raw(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("content_id")
    return (
        content(spark, folder)
        .select("*", _seen_twice(key, 50))
        .select(
            F.concat(F.lit("C"), key.cast("string")).alias("content_id"),
            _spoil(F.concat(F.lit("  "), F.col("title")), key, m61=None).alias("title"),
            _spoil(F.col("content_type"), key, m67=None).alias("content_type"),
            _spoil(F.col("genre"), key, m71=None).alias("genre"),
            _spoil(F.col("release_year"), key, m41="n/a").alias("release_year"),
            _spoil(F.col("duration_mins"), key, m13=None, m11="95.7").alias("duration_mins"),
            _spoil(F.col("rating"), key, m19="bad", m17="7.26").alias("rating"),
            _spoil(F.col("director"), key, m23=None).alias("director"),
            _ordinal(key),
        )
    )


def subscriptions_raw(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("sub_id")
    return (
        subscriptions(spark, folder)
        .select("*", _seen_twice(key, 50))
        .select(
            F.concat(F.lit("S"), key.cast("string")).alias("sub_id"),
            _spoil(F.concat(F.lit("U"), F.col("user_id").cast("string")), key, m67=None).alias("user_id"),
            _spoil(F.col("plan_name"), key, m31=None).alias("plan_name"),
            _spoil((-F.col("monthly_price")).cast("string"), key, m71="free", m73=None).alias("monthly_price"),
            _spoil(F.col("start_date"), key, m43="soon").alias("start_date"),
            _spoil(F.col("renewal_date"), key, m29="later").alias("renewal_date"),
            _spoil(F.col("status"), key, m19=None).alias("status"),
            _spoil(F.col("payment_method"), key, m23=None).alias("payment_method"),
            _ordinal(key),
        )
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("source")
    )


def search_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


# An opening question per topic; the rest of a turn is its own text.
OPENINGS = (
    "Which content has the highest watch time?",
    "Which users are most active?",
    "What were the most common events today?",
    "Which content is trending?",
    "Summarize the current data quality status.",
    "What is our subscription MRR and breakdown?",
    "Hello.",
)


def questions(spark: SparkSession, folder: str) -> DataFrame:
    openings = F.array(*(F.lit(q) for q in OPENINGS))
    return (
        table(spark, folder, "conversations")
        .where(F.col("role") == "user")
        .select(
            "conv_id",
            "turn",
            F.concat_ws(
                " ",
                F.element_at(openings, (F.col("conv_id") % len(OPENINGS) + 1).cast("int")),
                F.col("text"),
            ).alias("question"),
        )
    )
