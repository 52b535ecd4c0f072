"""Assertions on models: unique, not null, accepted values, foreign keys, row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.contracts import EVENT_TYPES, FOREIGN_KEYS, TIERS
from reelspark.functions.exprs import count_where


def _result(failures: DataFrame, test: str, model: str) -> DataFrame:
    return failures.select(
        F.lit(test).alias("test_name"),
        F.lit(model).alias("model"),
        F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"),
        "failures",
    )


def assert_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Fails with the number of keys that occur more than once."""
    repeated = df.groupBy(column).agg(F.count("*").alias("_n")).where("_n > 1")
    return _result(repeated.agg(F.count("*").alias("failures")), f"unique_{model}_{column}", model)


def _violations(df: DataFrame, model: str, tests: dict[str, Column]) -> DataFrame:
    """Row tests of one model in a single pass; each test is a failure condition."""
    counted = df.agg(*(count_where(broken).alias(name) for name, broken in tests.items()))
    rows = counted.unpivot([], list(tests), "test_name", "failures")
    return rows.select(
        "test_name",
        F.lit(model).alias("model"),
        F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"),
        "failures",
    )


def not_null(column: str) -> Column:
    return F.col(column).isNull()


def outside(column: str, values: tuple[str, ...]) -> Column:
    """Value outside the list; null passes, as in SQL ``NOT IN``."""
    return F.coalesce(~F.col(column).isin(*values), F.lit(False))


def assert_not_null(df: DataFrame, model: str, *columns: str) -> DataFrame:
    return _violations(df, model, {f"not_null_{model}_{c}": not_null(c) for c in columns})


def assert_accepted_values(df: DataFrame, model: str, column: str, values: tuple[str, ...]) -> DataFrame:
    return _violations(df, model, {f"accepted_values_{model}_{column}": outside(column, values)})


def run_suite(
    users: DataFrame,
    events: DataFrame,
    staged_users: DataFrame,
    staged_events: DataFrame,
    activity: DataFrame,
) -> DataFrame:
    """All declared model tests plus the three on the stored tables."""
    return reduce(
        DataFrame.unionByName,
        [
            assert_unique(users, "users", "user_id"),
            assert_not_null(users, "users", "user_id"),
            assert_accepted_values(events, "events", "event_type", EVENT_TYPES),
            assert_unique(staged_events, "stg_events", "event_id"),
            _violations(
                staged_events,
                "stg_events",
                {
                    "not_null_stg_events_event_id": not_null("event_id"),
                    "not_null_stg_events_user_id": not_null("user_id"),
                    "not_null_stg_events_event_type": not_null("event_type"),
                    "accepted_values_stg_events_event_type": outside("event_type", EVENT_TYPES),
                },
            ),
            assert_unique(staged_users, "stg_users", "user_id"),
            _violations(
                staged_users,
                "stg_users",
                {
                    "not_null_stg_users_user_id": not_null("user_id"),
                    "accepted_values_stg_users_tier": outside("tier", TIERS),
                },
            ),
            assert_unique(activity, "fact_user_activity", "user_id"),
            assert_not_null(activity, "fact_user_activity", "user_id"),
        ],
    )


def suite_passed(results: DataFrame) -> DataFrame:
    return results.agg((F.count_if(F.col("status") == "FAIL") == 0).alias("passed"))


def foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows without a parent, per declared foreign key. Children are counted per key
    before the anti join, so a frequent key is one row there."""

    def orphans(child: str, column: str, parent: str, parent_key: str) -> DataFrame:
        counted = (
            tables[child]
            .where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("_key"))
            .agg(F.count("*").alias("_n"))
        )
        parents = tables[parent].select(F.col(parent_key).alias("_key"))
        lost = counted.join(parents, "_key", "left_anti").agg(
            F.count("*").alias("orphan_keys"), F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows")
        )
        return lost.select(
            F.lit(child).alias("child"),
            F.lit(column).alias("child_column"),
            F.lit(parent).alias("parent"),
            "orphan_keys",
            "orphan_rows",
        )

    return reduce(DataFrame.unionByName, [orphans(*key) for key in FOREIGN_KEYS])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """PASS for each required table that holds rows."""
    checks = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.when(F.col("row_count") > 0, "PASS").otherwise("FAIL").alias("status"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, checks)
