"""Audit, drift, constraints and cleaning on small frames."""

from pyspark.sql import functions as F

from reelspark.contracts import ORDINAL
from reelspark.operators import cleaning, constraints, drift, quality, spread

EVENT = "event_id string, user_id string, event_type string, watch_time_mins string, timestamp string"


def events(spark, rows):
    numbered = [(*r, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(numbered, f"{EVENT}, {ORDINAL} long")


GOOD = ("video_watch", "10", "2024-03-01 10:00:00")


def test_duplicates_count_all_members(spark):
    df = events(spark, [("E1", "U1", *GOOD), ("E1", "U1", *GOOD), ("E2", "U2", *GOOD)])
    row = quality.audit(df, "events").first()
    assert (row.duplicates, row.valid_records, row.invalid_records) == (2, 1, 2)
    # 0.5 * 1/3 + 0.25 * 1/3 + 0.25
    assert row.dq_score == 50.0


def test_unknown_verb_and_negative_minutes(spark):
    df = events(
        spark,
        [
            ("E1", "U1", "hacked", "10", "2024-03-01 10:00:00"),
            ("E2", "U1", "video_watch", "-50", "2024-03-01 10:00:00"),
            ("E3", "U1", None, "nan", "soon"),
            ("E4", "  ", *GOOD),
        ],
    )
    row = quality.audit(df, "events").first()
    assert row.invalid_event_types == 2
    assert row.invalid_numerics == 2
    assert row.invalid_timestamps == 1
    assert row.invalid_user_ids == 1
    assert row.valid_records == 0
    log = {r.event_id: r.reasons for r in quality.error_log(df, "events").collect()}
    assert log["E1"] == "Invalid event_type 'hacked'"
    assert log["E3"] == (
        "Invalid event_type 'nan', Negative/malformed watch_time (nan), Malformed timestamp 'soon'"
    )


def test_empty_audit_scores_full(spark):
    assert quality.audit(events(spark, []), "events").first().dq_score == 100.0


def test_counters_agree_on_a_hot_key(spark):
    """A third of all rows are copies of one key."""
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("E"), "id")).alias("event_id"),
        F.when(F.col("id") % 7 == 0, None).otherwise("U1").alias("user_id"),
        F.lit("search").alias("event_type"),
        F.lit("1").alias("watch_time_mins"),
        F.lit("2024-01-01").alias("timestamp"),
        F.col("id").alias(ORDINAL),
    )
    row = quality.audit(df, "events").first()
    verdicts = quality.row_verdicts(df, "events")
    assert row.duplicates == 1000 == verdicts.where("is_duplicate").count()
    assert row.valid_records == verdicts.where("is_valid").count()
    assert row.invalid_records == quality.error_log(df, "events").count()
    first = cleaning.keep_first(df, "event_id", "copies")
    assert first.count() == 2001
    hot = first.where("event_id = 'HOT'").first()
    assert (hot[ORDINAL], hot.copies) == (0, 1000)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_moves_no_whole_rows(spark):
    """Only key, count and number are aggregated, by hashing; rows stay where they are."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("E"), F.col("id") % 1900)).alias("event_id"),
        F.repeat(F.lit("x"), 50).alias("payload"),
        F.col("id").alias(ORDINAL),
    )
    first = cleaning.keep_first(df, "event_id", "copies")
    rows = first.collect()
    want = {}
    for r in df.orderBy(ORDINAL).collect():
        want.setdefault(r.event_id, []).append(r[ORDINAL])
    assert {(r.event_id, r[ORDINAL], r.copies) for r in rows} == {(k, v[0], len(v)) for k, v in want.items()}
    assert "SortAggregate" not in plan_of(first) and "Exchange hash" not in plan_of(first)
    counted = quality.mark_duplicates(df, "event_id")
    assert "Exchange hash" not in plan_of(counted)
    assert counted.where("is_duplicate").count() == sum(len(v) for v in want.values() if len(v) > 1)


def test_dedupe_with_many_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(spread, "BROADCAST_BYTES", 0)
    df = spark.range(400).select((F.col("id") % 100).alias("event_id"), F.col("id").alias(ORDINAL))
    got = cleaning.keep_first(df, "event_id", "copies").collect()
    assert {(r.event_id, r[ORDINAL], r.copies) for r in got} == {(i, i, 4) for i in range(100)}


def test_added_column_is_low_drift(spark):
    row = ("U1", "A", "a@b.io", "123x", "US", "2024-01-01", "Basic", "active", True)
    names = "user_id name email phone country registration_date tier status surprise".split()
    report = drift.check_drift(spark.createDataFrame([row], names), "users").collect()
    assert [(r.kind, r.column_name, r.severity) for r in report] == [("added", "surprise", "Low")]


def test_missing_column_is_high_drift(spark):
    report = drift.check_drift(spark.createDataFrame([("U1",)], "user_id string"), "users").collect()
    assert "email" in {r.column_name for r in report if r.kind == "missing"}
    assert {r.severity for r in report} == {"High"}


def test_inferred_types(spark):
    rows = [("1", "1.5", "x", "true", None, "1"), ("-2", "7", "2", "False", None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string")
    got = drift.column_types(df).first().asDict()
    assert got == {"a": "int64", "b": "float64", "c": "object", "d": "bool", "e": "float64", "f": "float64"}


def test_unregistered_dataset_warns(spark):
    report = drift.check_drift(spark.range(1), "trailers").collect()
    assert [r.warning for r in report] == ["No baseline schema registered for 'trailers'."]


def test_not_in_passes_nulls(spark):
    df = spark.createDataFrame([("Basic",), (None,), ("Gold",)], "tier string")
    row = constraints.assert_accepted_values(df, "users", "tier", constraints.TIERS).first()
    assert (row.status, row.failures) == ("FAIL", 1)


def test_cleaning_without_optional_columns(spark):
    df = events(
        spark,
        [
            ("E1", "U1", "video_watch", "30.9", "2024-03-01 10:00:00.75"),
            ("E1", "U1", "video_watch", "30", "2024-03-01 10:00:00"),
            ("E2", "U2", "search", "oops", "2024-03-01 10:05:00"),
            ("E3", None, "search", "1", "2024-03-01 10:05:00"),
        ],
    )
    cleaned = {r.event_id: r for r in cleaning.clean_events(df).collect()}
    assert set(cleaned) == {"E1", "E2"}
    assert cleaned["E1"].watch_time_mins == 30
    assert str(cleaned["E1"].timestamp) == "2024-03-01 10:00:00"
    assert cleaned["E2"].watch_time_mins == 0
    assert (cleaned["E1"].device, cleaned["E1"].session_id) == ("Smart TV", "sess_gen")
    stats = cleaning.clean_stats(df, "events").first()
    assert (stats.initial_rows, stats.cleaned_rows, stats.duplicates_removed, stats.invalid_dropped) == (4, 2, 1, 1)


def test_invalid_first_copy_removes_the_key(spark):
    df = events(spark, [("E1", None, *GOOD), ("E1", "U1", *GOOD)])
    assert cleaning.clean_events(df).count() == 0


def test_numbers_are_told_by_pattern_before_a_cast(spark):
    """A failing cast is slow, so it is tried only where the pattern fits; the pattern lets
    through whatever the cast can read."""
    read = "1.5 .5 5. 1e5 1E-3 1.5f 2d 0x1p3 0x.8P1D inf -Inf +infinity Infinity".split()
    read += ["\x01 1.5\x1f", "\n2.5\n"]
    other = ["NaN", "-nan", "abc", "2024-01-01", "10:00", "e5", ".", "", " ", "1.5ff", "true", "1_000", "0x10", "1e", "\u0661"]
    df = spark.createDataFrame([(v,) for v in read + other], "v string")
    fits = f"v RLIKE '{drift._NUMBER}'"
    number = "coalesce(nullif(try_cast(v AS DOUBLE), double('NaN')) IS NOT NULL, false)"
    got = {r[0]: (r[1], r[2]) for r in df.selectExpr("v", number, fits).collect()}
    assert all(got[v] == (True, True) for v in read)
    assert not any(got[v][0] for v in other) and not any(got[v][1] for v in other[2:])
    assert "RLIKE" in drift._KINDS.split("try_cast")[0].splitlines()[-1]
