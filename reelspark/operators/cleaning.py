"""Cleaning of the four datasets: keep-first dedupe, defaults, typed values, dropped rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.contracts import EVENT_TYPES, KEYS, ORDINAL
from reelspark.functions.exprs import (
    is_blank,
    round_even,
    strip,
    to_date,
    to_number,
    to_timestamp,
    to_whole,
    whole_seconds,
)
from reelspark.operators.masking import mask_table
from reelspark.operators.quality import accepted
from reelspark.operators.spread import few_join, stored

_COPIES = "_copies"
_KEPT = "_kept"


def keep_first(df: DataFrame, key: str, copies: str | None = None, order: str = ORDINAL) -> DataFrame:
    """The first row per key in ingest order; null keys count as one key.

    ``order`` is a whole number that tells all rows apart, so that only (key, count,
    least number) are aggregated, by hashing and with a partial step. The keys that
    occur more than once are few, as a rule; they are stored, and a row stays unless
    its key is among them with a smaller number. Where those keys are measured small
    the rows are not shuffled at all.
    """
    counted = df.groupBy(F.col(key)).agg(F.count("*").alias("_n"), F.min(order).alias("_least"))
    repeated = stored(counted.where("_n > 1"))
    found = few_join(df, repeated, [key], "left").where(F.col("_least").isNull() | (F.col(order) == F.col("_least")))
    extra = [F.coalesce("_n", F.lit(1)).alias(copies)] if copies else []
    return found.select(*df.columns, *extra)


def _filled(column: str, default: str) -> Column:
    return strip(F.coalesce(F.col(column).cast("string"), F.lit(default)))


def _users(df: DataFrame) -> DataFrame:
    first = keep_first(df, KEYS["users"], _COPIES)
    return first.withColumns(
        {
            "name": _filled("name", "Anonymous User"),
            "country": _filled("country", "Global"),
            "tier": _filled("tier", "Basic"),
            "status": _filled("status", "active"),
            "registration_date": to_date(F.col("registration_date")),
        }
    ).withColumn(_KEPT, F.col("registration_date").isNotNull() & F.col("user_id").isNotNull())


def _content(df: DataFrame) -> DataFrame:
    first = keep_first(df, KEYS["content"], _COPIES)
    return first.withColumns(
        {
            "title": _filled("title", "Untitled Content"),
            "content_type": _filled("content_type", "Movie"),
            "genre": _filled("genre", "General"),
            "release_year": F.coalesce(to_whole(F.col("release_year")), F.lit(2023)),
            "duration_mins": F.coalesce(to_whole(F.col("duration_mins")), F.lit(90)),
            "rating": round_even(F.coalesce(to_number(F.col("rating")), F.lit(7.0)), 1),
            "director": _filled("director", "Unknown Director"),
            _KEPT: F.lit(True),
        }
    )


def _subscriptions(df: DataFrame) -> DataFrame:
    first = keep_first(df, KEYS["subscriptions"], _COPIES)
    price = F.abs(F.coalesce(to_number(F.col("monthly_price")), F.lit(9.99)))
    return first.withColumns(
        {
            "plan_name": _filled("plan_name", "Standard HD"),
            "monthly_price": round_even(price, 2),
            "start_date": to_date(F.col("start_date")),
            "renewal_date": to_date(F.col("renewal_date")),
            "status": _filled("status", "active"),
            "payment_method": _filled("payment_method", "credit_card"),
        }
    ).withColumn(
        _KEPT,
        F.col("sub_id").isNotNull() & F.col("user_id").isNotNull() & F.col("start_date").isNotNull(),
    )


def _events(df: DataFrame) -> DataFrame:
    first = keep_first(df, KEYS["events"], _COPIES)

    def optional(column: str, default: str) -> Column:
        return _filled(column, default) if column in df.columns else F.lit(default)

    return first.withColumns(
        {
            "watch_time_mins": F.greatest(
                F.coalesce(to_whole(F.col("watch_time_mins")), F.lit(0)), F.lit(0)
            ).cast("bigint"),
            "device": optional("device", "Smart TV"),
            "session_id": optional("session_id", "sess_gen"),
            "timestamp": whole_seconds(to_timestamp(F.col("timestamp"))),
        }
    ).withColumn(
        _KEPT,
        accepted("event_type", EVENT_TYPES) & ~is_blank(F.col("user_id")) & F.col("timestamp").isNotNull(),
    )


_CLEANERS = {
    "users": _users,
    "content": _content,
    "subscriptions": _subscriptions,
    "events": _events,
}


def _kept(df: DataFrame) -> DataFrame:
    return df.where(_KEPT).drop(_KEPT, _COPIES)


def clean_users(df: DataFrame, mask_pii: bool = False) -> DataFrame:
    cleaned = _kept(_users(df))
    return mask_table(cleaned) if mask_pii else cleaned


def clean_content(df: DataFrame) -> DataFrame:
    return _kept(_content(df))


def clean_subscriptions(df: DataFrame) -> DataFrame:
    return _kept(_subscriptions(df))


def clean_events(df: DataFrame, drop_invalid: bool = True, mask_ips: bool = True) -> DataFrame:
    """Dedupe happens before the validity filter: if the first copy of a key is
    invalid, the key disappears."""
    cleaned = _events(df)
    cleaned = _kept(cleaned) if drop_invalid else cleaned.drop(_KEPT, _COPIES)
    if mask_ips and "ip_address" in cleaned.columns:
        return mask_table(cleaned, emails=False, phones=False)
    return cleaned


def clean_stats(df: DataFrame, dataset: str) -> DataFrame:
    """Rows in, rows out, copies removed and invalid rows dropped, in one pass."""
    return _CLEANERS[dataset](df).agg(
        F.lit(dataset).alias("dataset"),
        F.coalesce(F.sum(_COPIES), F.lit(0)).alias("initial_rows"),
        F.count_if(F.col(_KEPT)).alias("cleaned_rows"),
        F.coalesce(F.sum(F.col(_COPIES) - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(~F.col(_KEPT)).alias("invalid_dropped"),
    )


def all_clean_stats(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [clean_stats(df, name) for name, df in frames.items()])
