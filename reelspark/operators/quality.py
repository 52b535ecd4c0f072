"""Data-quality audit of raw events and users.

Counters that need no grouping come from one pass without a shuffle. Repeated keys
are found by a partial aggregation that ships only (key, count, broken rows), so a
key with very many copies reduces on the map side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.contracts import EVENT_TYPES, KEYS, ORDINAL
from reelspark.functions.exprs import (
    count_where,
    is_blank,
    ratio,
    round_even,
    text_of,
    to_number,
    to_timestamp,
)
from reelspark.operators.spread import few_join, stored


@dataclass(frozen=True)
class Rule:
    """A row check: counter name, label in the rule report, test and reason text."""

    name: str
    label: str
    broken: Callable[[], Column]
    reason: Callable[[], Column]


def _said(before: str, column: str, after: str) -> Callable[[], Column]:
    return lambda: F.concat(F.lit(before), text_of(F.col(column)), F.lit(after))


def _plain(text: str) -> Callable[[], Column]:
    return lambda: F.lit(text)


def accepted(column: str, values: tuple[str, ...]) -> Column:
    """Member of the list; a missing value is not accepted."""
    return F.coalesce(F.col(column).isin(*values), F.lit(False))


def _bad_minutes() -> Column:
    return F.coalesce(to_number(F.col("watch_time_mins")) < 0, F.lit(True))


RULES = {
    "events": (
        Rule("invalid_user_ids", "Missing Mandatory User IDs", lambda: is_blank(F.col("user_id")),
             _plain("Missing user_id")),
        Rule("invalid_event_types", "Invalid Event Types", lambda: ~accepted("event_type", EVENT_TYPES),
             _said("Invalid event_type '", "event_type", "'")),
        Rule("invalid_numerics", "Negative / Malformed Watch Time", _bad_minutes,
             _said("Negative/malformed watch_time (", "watch_time_mins", ")")),
        Rule("invalid_timestamps", "Unparseable Timestamps",
             lambda: to_timestamp(F.col("timestamp")).isNull(),
             _said("Malformed timestamp '", "timestamp", "'")),
    ),
    "users": (
        Rule("invalid_user_ids", "Missing Mandatory User IDs", lambda: is_blank(F.col("user_id")),
             _plain("Missing user_id")),
        Rule("invalid_emails", "Malformed or Missing Emails",
             lambda: F.coalesce(~F.contains("email", F.lit("@")), F.lit(True)),
             _plain("Malformed or missing email")),
        Rule("invalid_dates", "Unparseable Registration Dates",
             lambda: to_timestamp(F.col("registration_date")).isNull(),
             _plain("Invalid registration date")),
    ),
}

_DUPLICATE_LABEL = {"events": "Duplicate Event IDs", "users": "Duplicate User IDs"}


def source_columns(df: DataFrame) -> list[str]:
    """Columns that came with the data, without the ingest ordinal."""
    return [c for c in df.columns if c != ORDINAL]


def _nulls_in_row(df: DataFrame) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in source_columns(df)])


def _flagged(df: DataFrame, dataset: str) -> DataFrame:
    key = KEYS[dataset]
    flags = [rule.broken().alias(rule.name) for rule in RULES[dataset]]
    return df.select(F.col(key).alias("_key"), _nulls_in_row(df).alias("_nulls"), *flags)


def _any_broken(dataset: str) -> Column:
    return reduce(or_, [F.col(rule.name) for rule in RULES[dataset]])


def quality_score(total: Column, valid: Column, duplicates: Column, missing: Column, width: int) -> Column:
    """Half validity, a quarter uniqueness, a quarter completeness; 100 when empty."""
    blend = (
        ratio(valid, total) * 0.50
        + (F.lit(1.0) - ratio(duplicates, total)) * 0.25
        + (F.lit(1.0) - ratio(missing, total * width)) * 0.25
    ) * 100
    bounded = F.least(F.greatest(round_even(blend, 1), F.lit(0.0)), F.lit(100.0))
    return F.when(total == 0, F.lit(100.0)).otherwise(bounded)


def duplicate_members(df: DataFrame, key: str) -> DataFrame:
    """Rows that share their key with another row, all members counted."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicates"))
    )


def full_row_duplicates(df: DataFrame) -> DataFrame:
    """Second and later occurrences of identical rows."""
    return (
        df.groupBy(*source_columns(df))
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, one pass over the data."""
    columns = source_columns(df)
    counted = df.agg(*(count_where(F.col(c).isNull()).alias(c) for c in columns))
    return counted.unpivot([], columns, "column_name", "missing_values")


def rule_counts(df: DataFrame, dataset: str) -> DataFrame:
    """Violations of each row rule in one pass, one column per rule."""
    flagged = _flagged(df, dataset)
    return flagged.agg(*(count_where(F.col(r.name)).alias(r.name) for r in RULES[dataset]))


def audit(df: DataFrame, dataset: str) -> DataFrame:
    """The whole audit as one row."""
    flagged = _flagged(df, dataset)
    rules = [rule.name for rule in RULES[dataset]]
    by_key = flagged.groupBy("_key").agg(
        F.count("*").alias("_n"), F.count_if(_any_broken(dataset)).alias("_broken")
    )
    repeated = F.col("_n") > 1
    keyed = by_key.agg(
        F.struct(
            F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("duplicates"),
            F.coalesce(
                F.sum(F.when(repeated, F.col("_n")).otherwise(F.col("_broken"))), F.lit(0)
            ).alias("invalid"),
        ).alias("counts")
    )
    counted = flagged.agg(
        F.count("*").alias("total_records"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).cast("bigint").alias("missing_values"),
        *(count_where(F.col(name)).alias(name) for name in rules),
    ).withColumn("_keyed", keyed.scalar())
    measured = counted.select(
        F.lit(dataset).alias("dataset"),
        "total_records",
        (F.col("total_records") - F.col("_keyed.invalid")).alias("valid_records"),
        F.col("_keyed.invalid").alias("invalid_records"),
        F.col("_keyed.duplicates").alias("duplicates"),
        "missing_values",
        *rules,
    )
    score = quality_score(
        F.col("total_records"),
        F.col("valid_records"),
        F.col("duplicates"),
        F.col("missing_values"),
        len(source_columns(df)),
    )
    return measured.withColumn("dq_score", score)


def mark_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Add ``is_duplicate``. Only the keys that occur more than once are joined, which
    are few as a rule; null keys count as one key."""
    repeated = stored(df.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1"))
    marked = few_join(df, repeated, [key], "left")
    return marked.withColumn("is_duplicate", F.col("_n").isNotNull()).drop("_n")


def row_verdicts(df: DataFrame, dataset: str) -> DataFrame:
    """Every row with its rule flags and the verdict."""
    key = KEYS[dataset]
    flags = [rule.broken().alias(rule.name) for rule in RULES[dataset]]
    marked = mark_duplicates(df.select(ORDINAL, key, *flags), key)
    return marked.withColumn("is_valid", ~(F.col("is_duplicate") | _any_broken(dataset)))


def error_log(df: DataFrame, dataset: str) -> DataFrame:
    """One row per invalid record with its reasons in rule order."""
    key = KEYS[dataset]
    reasons = [F.when(rule.broken(), rule.reason()) for rule in RULES[dataset]]
    noted = df.select(ORDINAL, key, F.array_compact(F.array(*reasons)).alias("_reasons"))
    marked = mark_duplicates(noted, key)
    first = F.when(F.col("is_duplicate"), F.array(F.lit(f"Duplicate {key}"))).otherwise(
        F.array().cast("array<string>")
    )
    return (
        marked.where(F.col("is_duplicate") | (F.size("_reasons") > 0))
        .select(
            F.col(ORDINAL).alias("row_index"),
            key,
            F.array_join(F.concat(first, F.col("_reasons")), ", ").alias("reasons"),
        )
    )


def rule_report(summary: DataFrame, dataset: str) -> DataFrame:
    """Audit counters as rows: rule, violations, PASS or FAIL."""
    labelled = [(_DUPLICATE_LABEL[dataset], "duplicates")]
    labelled += [(rule.label, rule.name) for rule in RULES[dataset]]
    entries = F.array(
        *(F.struct(F.lit(label).alias("rule"), F.col(name).alias("violations")) for label, name in labelled)
    )
    return summary.select(F.inline(entries)).withColumn(
        "status", F.when(F.col("violations") > 0, "FAIL").otherwise("PASS")
    )


def entity_summary(events: DataFrame, users: DataFrame) -> DataFrame:
    def row(df: DataFrame, dataset: str) -> DataFrame:
        return audit(df, dataset).select(
            F.lit(dataset.capitalize()).alias("entity"),
            F.col("total_records").alias("total_rows"),
            "dq_score",
            "duplicates",
            F.col("invalid_records").alias("invalid_rows"),
        )

    return row(events, "events").unionByName(row(users, "users"))


_SUMMARY = (
    "total_records",
    "valid_records",
    "invalid_records",
    "duplicates",
    "missing_values",
    "dq_score",
)


def load_summary(df: DataFrame, dataset: str, warnings: DataFrame) -> DataFrame:
    """One row per load. ``warnings`` are the rows of the dataset's drift report."""
    if dataset in RULES:
        measured = audit(df, dataset).select(*_SUMMARY)
    else:
        measured = df.agg(
            F.count("*").alias("total_records"),
            F.coalesce(F.sum(_nulls_in_row(df)), F.lit(0)).cast("bigint").alias("missing_values"),
        ).select(
            "total_records",
            F.col("total_records").alias("valid_records"),
            F.lit(0).cast("bigint").alias("invalid_records"),
            full_row_duplicates(df).scalar().alias("duplicates"),
            "missing_values",
            F.lit(100.0).alias("dq_score"),
        )
    warned = warnings.agg(F.count("*").alias("n")).scalar()
    noted = (F.col("schema_warnings_count") > 0) | (F.col("invalid_records") > 0)
    return (
        measured.withColumn("schema_warnings_count", warned)
        .withColumn("status", F.when(noted, "COMPLETED_WITH_WARNINGS").otherwise("SUCCESS"))
        .select(F.lit(dataset).alias("dataset_name"), *_SUMMARY, "schema_warnings_count", "status")
    )
