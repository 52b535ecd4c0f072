"""The batch job: audit, clean, derive, load, report."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.contracts import KEYS, ORDINAL
from reelspark.operators import cleaning, drift, quality
from reelspark.plans.marts import watch_history, watch_totals
from reelspark.sources.sinks import VersionedStore, append_log, write_raw_documents

#: Characters of an error that the run log keeps.
ERROR_CHARS = 4_000

CLEANERS = {
    "users": cleaning.clean_users,
    "content": cleaning.clean_content,
    "subscriptions": cleaning.clean_subscriptions,
    "events": cleaning.clean_events,
}


def clean_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The cleaned datasets and the watch totals, as plans."""
    cleaned = {name: clean(raw[name]) for name, clean in CLEANERS.items()}
    cleaned["watch_history"] = watch_totals(cleaned["events"])
    return cleaned


def _movements(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame]) -> DataFrame:
    """Rows in, distinct keys and rows out per dataset; only keys are shuffled."""

    def counted(name: str) -> DataFrame:
        keys = raw[name].groupBy(KEYS[name]).agg(F.count("*").alias("_n"))
        return keys.agg(
            F.lit(name).alias("dataset"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"),
            F.count("*").alias("keys"),
        ).withColumn("rows_out", cleaned[name].agg(F.count("*").alias("n")).scalar())

    return reduce(DataFrame.unionByName, [counted(name) for name in raw])


def batch_metrics(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame]) -> DataFrame:
    """The metrics row of a run. ``cleaned`` holds the stored tables or their plans."""

    def of(name: str, value: str):
        return F.max(F.when(F.col("dataset") == name, F.expr(value)))

    def score(name: str):
        return quality.audit(raw[name], name).select("dq_score").scalar()

    loaded = _movements(raw, cleaned).agg(
        F.sum("rows_in").alias("total_extracted"),
        of("users", "rows_out").alias("users_loaded"),
        of("content", "rows_out").alias("content_loaded"),
        of("subscriptions", "rows_out").alias("subs_loaded"),
        of("events", "rows_out").alias("events_loaded"),
        of("events", "keys - rows_out").alias("invalid_dropped"),
        (of("events", "rows_in - keys") + of("users", "rows_in - keys")).alias("duplicates_removed"),
    )
    return loaded.select(
        "*",
        cleaned["watch_history"].agg(F.count("*").alias("n")).scalar().alias("watch_history_derived"),
        score("events").alias("events_dq_score"),
        score("users").alias("users_dq_score"),
    )


def run_batch(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    mask_pii: bool = False,
    arrived: dict[str, DataFrame] | None = None,
) -> str:
    """Check drift, clean and load all datasets as one new version and log the run.

    ``arrived`` has the datasets with the columns of their files (``Landed.arrived``);
    without it drift is checked on ``raw``. Later steps read what earlier steps wrote,
    so a lost executor repeats a scan and not the cleaning. The version is published
    last; a run that fails before is logged as FAILED with its error and leaves the
    published version as it was. Returns the new version.
    """
    log = f"{root.rstrip('/')}/runs"
    store = VersionedStore(spark, f"{root.rstrip('/')}/tables")
    version = store.new_version()
    try:
        metrics = _load_version(store, version, raw, mask_pii, arrived or raw)
        store.publish(version)
    except Exception as error:
        append_log(_run_row(spark.range(1).select(F.lit(str(error)[:ERROR_CHARS]).alias("error")), "FAILED"), log)
        raise
    append_log(_run_row(metrics, "SUCCESS"), log)
    return version


def _load_version(
    store: VersionedStore,
    version: str,
    raw: dict[str, DataFrame],
    mask_pii: bool,
    arrived: dict[str, DataFrame],
) -> DataFrame:
    """Write all tables of a version; returns its stored metrics."""
    tables = {}

    def load(name: str, df: DataFrame, by: str | None = None) -> None:
        tables[name] = store.write(version, name, df.drop(ORDINAL), by)

    store.write(version, "drift_report", drift.check_all(arrived))
    load("users", cleaning.clean_users(raw["users"], mask_pii))
    load("content", cleaning.clean_content(raw["content"]))
    load("subscriptions", cleaning.clean_subscriptions(raw["subscriptions"]))
    cleaned = cleaning.clean_events(raw["events"])
    load("events", cleaned.withColumn("event_date", F.col("timestamp").cast("date")), by="event_date")
    load("watch_history", watch_history(tables["events"], tables["content"]))
    write_raw_documents(raw["events"], store.path(version, "raw_documents"))
    return store.write(version, "run_metrics", batch_metrics(raw, tables))


def _run_row(values: DataFrame, status: str) -> DataFrame:
    return values.select(
        F.lit(f"etl_run_{uuid.uuid4().hex[:12]}").alias("run_id"),
        F.current_timestamp().alias("finished_at"),
        F.lit(status).alias("status"),
        "*",
    )


def record_load(df: DataFrame, dataset: str, path: str, arrived: DataFrame | None = None) -> None:
    """Append the load summary of one dataset to the ingestion history. ``arrived`` has
    the columns of its file, on which drift is checked."""
    summary = quality.load_summary(df, dataset, drift.check_drift(df if arrived is None else arrived, dataset))
    stamped = summary.select(
        F.lit(f"ingest_{uuid.uuid4().hex[:12]}_{dataset}").alias("run_id"),
        F.current_timestamp().alias("loaded_at"),
        "*",
    )
    append_log(stamped, path)
