import json

import pytest
from pyspark.sql import functions as F

from reelspark.streaming import events as stream


def event(**changes):
    base = {
        "event_id": "E1",
        "user_id": "U1",
        "event_type": "search",
        "content_id": "M1",
        "watch_time_mins": 5,
        "device": "Web",
        "session_id": "s",
        "timestamp": "2024-03-01 10:00:00",
        "ip_address": "10.1.2.3",
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v != "absent"}


NOTES = [
    (event(), "Valid"),
    (event(event_id=None), "Missing event_id"),
    (event(event_id=""), "Missing event_id"),
    (event(user_id="absent"), "Missing user_id"),
    (event(event_type="hack"), "Invalid event_type 'hack'"),
    (event(event_type=None), "Invalid event_type 'None'"),
    (event(watch_time_mins="absent"), "Valid"),
    (event(watch_time_mins=None), "Malformed watch_time_mins"),
    (event(watch_time_mins="12"), "Valid"),
    (event(watch_time_mins="12.7"), "Malformed watch_time_mins"),
    (event(watch_time_mins=12.7), "Valid"),
    (event(watch_time_mins=-0.5), "Valid"),
    (event(watch_time_mins=-3), "Negative watch_time_mins"),
    (event(watch_time_mins="-3"), "Negative watch_time_mins"),
    (event(watch_time_mins=[1]), "Malformed watch_time_mins"),
    (event(timestamp="whenever"), "Valid"),
]


@pytest.mark.parametrize("record,note", NOTES)
def test_notes(spark, record, note):
    df = spark.createDataFrame([(json.dumps(record),)], "value string")
    assert stream.validate(stream.parse_lines(df)).first().validation_note == note


def test_broken_json_is_rejected(spark):
    row = stream.validate(stream.parse_lines(spark.createDataFrame([("{oops",)], "value string"))).first()
    assert (row.is_valid, row.validation_note) == (False, "Malformed JSON")


def put(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records) + "\n")


def run(spark, folder, store, checkpoint):
    query = stream.start_routing(stream.read_lines(spark, str(folder)), store, str(checkpoint), available_now=True)
    query.awaitTermination(120)
    assert query.exception() is None


def test_routing_and_replay(spark, tmp_path):
    incoming, store = tmp_path / "in", stream.StreamStore(str(tmp_path / "out"))
    put(incoming, "a.json", [event(), event(), event(event_id="E2", ip_address="absent"), event(event_type="hack")])
    run(spark, incoming, store, tmp_path / "cp")
    put(incoming, "b.json", [event(device="TV"), event(event_id="E3", timestamp="absent", device="absent")])
    run(spark, incoming, store, tmp_path / "cp")
    run(spark, incoming, store, tmp_path / "cp")

    consumed = spark.read.parquet(store.at("consumed"))
    assert consumed.count() == 6
    saved = {r.event_id: r for r in spark.read.parquet(store.at("events")).collect()}
    assert set(saved) == {"E1", "E2", "E3"}
    assert saved["E1"].ip_address == "10.1.*.*" and saved["E1"].device == "Web"
    assert saved["E2"].ip_address == "127.0.*.*"
    assert saved["E3"].device == "Unknown" and saved["E3"].timestamp is not None
    rejected = spark.read.parquet(store.at("rejected")).collect()
    assert [r.validation_note for r in rejected] == ["Invalid event_type 'hack'"]
    assert spark.read.json(store.at("raw_documents")).count() == 5
    row = stream.metrics(consumed).first()
    assert (row.total_consumed, row.valid_events, row.invalid_events, row.valid_rate) == (6, 5, 1, 83.3)

    # A repeated batch after a failure leaves the same rows.
    lines = spark.read.text(str(incoming / "b.json"))
    own = json.loads((tmp_path / "cp" / "metadata").read_text())["id"]
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", own)
    stream.route_batch(stream.validate(stream.parse_lines(lines)), 1, store)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert spark.read.parquet(store.at("events")).count() == 3
    assert spark.read.parquet(store.at("consumed")).count() == 6

    # A new checkpoint counts batches from 0 again; nothing stored goes, no id comes twice.
    later = tmp_path / "later"
    put(later, "c.json", [event(), event(event_id="E4")])
    run(spark, later, store, tmp_path / "new-cp")
    assert spark.read.parquet(store.at("consumed")).count() == 8
    assert spark.read.parquet(store.at("rejected")).count() == 1
    assert sorted(r.event_id for r in spark.read.parquet(store.at("events")).collect()) == ["E1", "E2", "E3", "E4"]
    assert spark.read.json(store.at("raw_documents")).count() == 7


def test_replay_from_a_new_checkpoint_changes_nothing(spark, tmp_path):
    """The same files read again, in other batches and with other byte ranges."""
    incoming, store = tmp_path / "in", stream.StreamStore(str(tmp_path / "out"))
    put(incoming, "a.json", [event(event_id=f"E{i}") for i in range(40)] + [event(event_type="hack"), event()])
    put(incoming, "b.json", [event(), event(), event(user_id="absent")])

    def sinks():
        readers = (("consumed", "parquet"), ("rejected", "parquet"), ("events", "parquet"), ("raw_documents", "json"))
        found = {}
        for name, kind in readers:
            df = spark.read.format(kind).load(store.at(name)).drop("batch_id")
            found[name] = sorted(map(str, df.collect()))
        return found

    run(spark, incoming, store, tmp_path / "cp")
    first = sinks()
    assert [len(first[n]) for n in ("consumed", "rejected", "events", "raw_documents")] == [45, 2, 40, 43]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        run(spark, incoming, store, tmp_path / "cp-2")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sinks() == first
    put(incoming, "c.json", [event(event_id="new")])
    run(spark, incoming, store, tmp_path / "cp-2")
    assert len(sinks()["consumed"]) == 46


def drain(df, name, mode):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    query.processAllAvailable()
    query.stop()
    return df.sparkSession.table(name)


@pytest.fixture
def live(spark, tmp_path):
    records = [
        event(event_id=f"E{i}", user_id=f"U{i % 3}", timestamp=f"2024-03-0{1 + i // 20} 10:00:{i % 20:02d}",
              event_type="search" if i % 3 else "video_watch", watch_time_mins=250 if i == 0 else 5,
              ip_address=f"10.{i % 4}.0.1")
        for i in range(40)
    ]
    put(tmp_path / "w", "1.json", records)
    put(tmp_path / "w", "2.json", records[:5] + [event(event_id="LATE", timestamp="2024-03-20 00:00:00")])

    def read():
        lines = stream.read_lines(spark, str(tmp_path / "w"), max_files=1)
        return stream.typed(stream.validate(stream.parse_lines(lines)))

    batch = stream.typed(stream.validate(stream.parse_lines(spark.read.text(str(tmp_path / "w")))))
    return read, batch


def test_repeats_are_dropped(spark, live):
    read, _ = live
    kept = drain(stream.drop_repeats(read(), "30 days"), "kept", "append")
    assert kept.count() == 41


def test_usage_windows_equal_batch(spark, live):
    read, batch = live
    got = drain(stream.usage_windows(read(), "1 hour"), "usage", "complete")
    want = stream.usage_windows(batch, exact=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_anomaly_windows_equal_batch(spark, live):
    read, batch = live
    for name, build in (
        ("ips", stream.multi_ip_windows),
        ("searches", stream.scraper_windows),
        ("friction", stream.friction_windows),
    ):
        got = drain(build(read(), "1 hour"), f"live_{name}", "append")
        last = F.lit("2024-03-20").cast("date")  # the newest window is still open
        want = build(batch, "1 hour").where(F.col("window_start").cast("date") < last)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    long = drain(stream.long_session_windows(read()), "live_long", "append")
    assert {r.event_id for r in long.collect()} == {"E0"}
