"""Dataset contracts and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Position of a row in its source, unique per dataset; carried from the read on.
ORDINAL = "ingest_ord"

# Accepted event verbs.
EVENT_TYPES = (
    "user_login",
    "content_view",
    "video_watch",
    "search",
    "add_to_watchlist",
    "subscription",
    "logout",
)

# Accepted subscription tiers.
TIERS = ("Basic", "Standard", "Premium")

# Expected dtype per column of each dataset.
EXPECTED_TYPES = {
    "users": {
        "user_id": "object",
        "name": "object",
        "email": "object",
        "phone": "object",
        "country": "object",
        "registration_date": "object",
        "tier": "object",
        "status": "object",
    },
    "content": {
        "content_id": "object",
        "title": "object",
        "content_type": "object",
        "genre": "object",
        "release_year": "int64",
        "duration_mins": "int64",
        "rating": "float64",
        "director": "object",
    },
    "subscriptions": {
        "sub_id": "object",
        "user_id": "object",
        "plan_name": "object",
        "monthly_price": "float64",
        "start_date": "object",
        "renewal_date": "object",
        "status": "object",
        "payment_method": "object",
    },
    "events": {
        "event_id": "object",
        "user_id": "object",
        "event_type": "object",
        "content_id": "object",
        "watch_time_mins": "int64",
        "device": "object",
        "session_id": "object",
        "timestamp": "object",
        "ip_address": "object",
    },
}

# Primary key of each dataset.
KEYS = {
    "users": "user_id",
    "content": "content_id",
    "subscriptions": "sub_id",
    "events": "event_id",
}

# Fixed values: (child table, child column, parent table, parent column) of each declared
# foreign key.
FOREIGN_KEYS = (
    ("subscriptions", "user_id", "users", "user_id"),
    ("events", "user_id", "users", "user_id"),
    ("events", "content_id", "content", "content_id"),
    ("watch_history", "user_id", "users", "user_id"),
    ("watch_history", "content_id", "content", "content_id"),
)


def raw_schema(dataset: str) -> T.StructType:
    """All columns as text: what a CSV read must accept before cleaning."""
    return T.StructType([T.StructField(c, T.StringType()) for c in EXPECTED_TYPES[dataset]])


STREAM_FIELDS = tuple(EXPECTED_TYPES["events"])
