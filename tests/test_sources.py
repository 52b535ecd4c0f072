import csv as csv_module
import io
import random

import pytest
from pyspark.sql import functions as F

from reelspark.contracts import EXPECTED_TYPES, ORDINAL
from reelspark.operators import cleaning, drift
from reelspark.plans import batch, marts
from reelspark.sources import csv_records, files, sinks

USERS = """user_id,name,email,phone,country,registration_date,tier,status
U1,Ann Lee,ann@x.io,+1-555-0100,USA,2024-01-10,Premium,active
U2,Bo Ray,bo@x.io,+1-555-0101,,2024-01-11,Basic,active
U1,Ann Lee,ann@x.io,+1-555-0100,USA,2024-01-10,Premium,active
"""
CONTENT = """content_id,title,content_type,genre,release_year,duration_mins,rating,director
M1,Dawn,Movie,Drama,2023,100,8.7,Ann
M2,Dusk,Series,Noir,2022,,7.1,Bo
"""
SUBSCRIPTIONS = """sub_id,user_id,plan_name,monthly_price,start_date,renewal_date,status,payment_method
S1,U1,Premium 4K,-19.99,2024-01-10,2024-02-10,active,paypal
S2,U2,Basic SD,9.99,bad,2024-02-10,active,paypal
"""
EVENTS = """event_id,user_id,event_type,content_id,watch_time_mins,device,session_id,timestamp,ip_address
E1,U1,video_watch,M1,63,Web,s1,2024-03-01 10:00:00,10.0.0.1
E2,U2,video_watch,M2,85,Web,s2,2024-03-01 11:00:00,10.0.0.2
E3,,video_watch,M1,45,Web,s3,2024-03-01 12:00:00,10.0.0.3
E1,U9,video_watch,M1,63,Web,s1,2024-03-01 10:00:00,10.0.0.1
"""


def land(folder):
    for name, text in (
        ("users", USERS),
        ("content", CONTENT),
        ("subscriptions", SUBSCRIPTIONS),
        ("events", EVENTS),
    ):
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_registry_reads_contract_columns(spark, tmp_path):
    frames = files.load_datasets(spark, land(tmp_path))
    for name, df in frames.items():
        assert [c for c in df.columns if c != ORDINAL] == list(EXPECTED_TYPES[name])
    first = cleaning.keep_first(frames["events"], "event_id").where("event_id = 'E1'").first()
    assert first.user_id == "U1"


def test_inferred_read_and_drift(spark, tmp_path):
    folder = land(tmp_path)
    inferred = files.read_csv_inferred(spark, f"{folder}/content.csv")
    assert dict(inferred.dtypes)["release_year"] == "int"
    assert drift.check_drift(inferred, "content").count() == 0
    arrived = files.land_csv(spark, f"{folder}/content.csv", "content").arrived
    found = [(r.kind, r.column_name, r.actual) for r in drift.check_drift(arrived, "content").collect()]
    assert found == [("type_mismatch", "duration_mins", "float64")]


def test_batch_run_publishes_one_version(spark, tmp_path):
    raw = files.load_datasets(spark, land(tmp_path))
    root = str(tmp_path / "warehouse")
    version = batch.run_batch(spark, raw, root)
    store = sinks.VersionedStore(spark, f"{root}/tables")
    assert store.current() == version
    assert store.read("events").count() == 2
    history = {r.user_id: r for r in store.read("watch_history").collect()}
    assert history["U1"].completion_percentage == 63.0
    assert history["U2"].completion_percentage == 94.4 and history["U2"].completed
    assert store.read("subscriptions").first().monthly_price == 19.99
    assert spark.read.json(store.path(version, "raw_documents")).count() == 4
    assert "duration_mins" in [r.column_name for r in store.read("drift_report").collect()]
    run = spark.read.json(f"{root}/runs").first()
    assert (run.total_extracted, run.events_loaded, run.watch_history_derived) == (11, 2, 2)
    assert batch.run_batch(spark, raw, root, mask_pii=True) == store.current() != version
    assert "*" in store.read("users").first().email
    assert store.read("users", version).count() == 2
    assert spark.read.json(f"{root}/runs").count() == 2


def test_load_history(spark, tmp_path):
    raw = files.load_datasets(spark, land(tmp_path))
    path = str(tmp_path / "loads")
    for name, df in raw.items():
        batch.record_load(df, name, path)
    rows = {r.dataset_name: r for r in spark.read.json(path).collect()}
    assert rows["users"].status == "COMPLETED_WITH_WARNINGS"
    assert rows["subscriptions"].dq_score == 100.0


def test_full_refresh_switches_at_once(spark, tmp_path):
    store = sinks.VersionedStore(spark, str(tmp_path / "store"))
    assert store.current() is None
    sinks.full_refresh(store, {"t": spark.range(3)})
    draft = store.new_version()
    store.write(draft, "t", spark.range(9))
    assert store.read("t").count() == 3
    store.publish(draft)
    assert store.read("t").count() == 9


ROW = "k string, v int, at long"


def test_insert_ignore_keeps_the_first(spark, tmp_path):
    path = str(tmp_path / "events")
    sinks.insert_ignore(spark.createDataFrame([("a", 1, 0), ("b", 1, 1), (None, 1, 2)], ROW), path, "k", 0, "at")
    more = spark.createDataFrame([("b", 2, 0), ("c", 3, 2), ("c", 2, 1), (None, 2, 3)], ROW)
    sinks.insert_ignore(more, path, "k", 1, "at")
    sinks.insert_ignore(more, path, "k", 1, "at")
    got = sorted((str(r.k), r.v) for r in spark.read.parquet(path).collect())
    assert got == [("None", 1), ("a", 1), ("b", 1), ("c", 2)]


def test_key_table_is_merged_and_read_by_bucket(spark, tmp_path, monkeypatch):
    """The files that a batch opens do not grow with the number of batches before it."""
    monkeypatch.setattr(sinks, "MERGE_AFTER", 3)
    path, opened = str(tmp_path / "events"), []
    for n in range(8):
        rows = spark.createDataFrame([(f"k{7 * n + i}", n, i) for i in range(10)], ROW)
        keys = sinks.KeyTable(spark, path, "k")
        known = keys.known(spark.createDataFrame([("k1",)], "k string"), "other")
        if known is not None:
            opened.append(known.select(F.input_file_name()).distinct().count())
            assert known.where("k = 'k1'").count() == 1
        sinks.insert_ignore(rows, path, "k", n, "at")
    assert len(opened) == 7 and max(opened) <= 3 and len(keys.batches(keys.manifest())) < 3
    stored = [r.k for r in spark.read.parquet(path).collect()]
    assert sorted(stored) == sorted({f"k{7 * n + i}" for n in range(8) for i in range(10)})
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    # a merged batch that is repeated changes nothing
    before = sorted(map(tuple, spark.read.parquet(path).collect()), key=str)
    sinks.insert_ignore(spark.createDataFrame([(f"k{i}", 0, i) for i in range(10)], ROW), path, "k", 0, "at")
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == before


def test_rows_stored_before_the_key_table_count(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.createDataFrame([("a", 1)], "k string, v int").write.parquet(f"{path}/batch_id=0")
    sinks.insert_ignore(spark.createDataFrame([("a", 2, 0), ("b", 2, 1)], ROW), path, "k", 1, "at")
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 2)]


def test_retain_newest(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(30).withColumnRenamed("id", "n").write.json(path)
    kept = sinks.retain_newest(spark, path, [F.desc("n")], 10)
    assert sorted(r.n for r in spark.read.json(kept).collect()) == list(range(20, 30))


def test_models_are_rebuilt(spark, tmp_path):
    raw = files.load_datasets(spark, land(tmp_path))
    events, users = cleaning.clean_events(raw["events"]), cleaning.clean_users(raw["users"])
    models = marts.materialize(events, users, str(tmp_path / "marts"))
    assert list(models) == ["stg_events", "stg_users", "fact_user_activity", "analytics_daily_usage"]
    models = marts.materialize(events.limit(0), users, str(tmp_path / "marts"))
    assert models["fact_user_activity"].agg(F.sum("total_events")).first()[0] == 0


def test_text_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text("line one\nline two")
    row = files.read_documents(spark, str(tmp_path / "*.txt")).first()
    assert (row.doc_id, row.text) == ("a.txt", "line one\nline two")


def csv(folder, text, name="users"):
    (folder / f"{name}.csv").write_text(text)
    return f"{folder}/{name}.csv"


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    path = csv(tmp_path, "user_id,email,extra,name\nU1,ann@x.io,7,Ann\n")
    landed = files.land_csv(spark, path, "users")
    row = landed.rows.first()
    assert (row.user_id, row.email, row.name, row.phone) == ("U1", "ann@x.io", "Ann", None)
    found = {(r.kind, r.column_name) for r in drift.check_drift(landed.arrived, "users").collect()}
    assert ("added", "extra") in found and ("missing", "phone") in found


def test_csv_quotes_breaks_and_null_tokens(spark, tmp_path):
    path = csv(tmp_path, 'user_id,name,email\n"U1","A ""x"", y",N/A\nU2,"two\nlines",null\nU3,NaN,""\n')
    landed = files.land_csv(spark, path, "users")
    got = [(r.user_id, r.name, r.email) for r in landed.rows.orderBy("user_id").collect()]
    assert got == [("U1", 'A "x", y', None), ("U2", "two\nlines", None), ("U3", None, None)]
    assert landed.rejected.count() == 0


def test_csv_unfit_records_are_kept_apart(spark, tmp_path):
    path = csv(tmp_path, "user_id,name,email\nU1,Ann,a@x.io,more\nU2,Bo\nU3,Cy,c@x.io\n")
    landed = files.land_csv(spark, path, "users")
    assert [r.record for r in landed.rejected.collect()] == ["U1,Ann,a@x.io,more"]
    assert sorted((r.user_id, r.email) for r in landed.rows.collect()) == [("U2", None), ("U3", "c@x.io")]
    split = files.land_csv(spark, csv(tmp_path, 'user_id,name\nU1,"two\nlines"\nU2,Bo\n', "lines"), "users", False)
    assert split.rejected.count() >= 1


def test_csv_empty_file_and_other_header(spark, tmp_path):
    landed = files.land_csv(spark, csv(tmp_path, ""), "users")
    assert landed.rows.count() == landed.rejected.count() == 0
    folder = tmp_path / "parts"
    folder.mkdir()
    csv(folder, "user_id,name\nU1,Ann\n", "a")
    csv(folder, "name,user_id\nBo,U2\n", "b")
    with pytest.raises(Exception):
        files.land_csv(spark, str(folder), "users")


def test_failed_run_is_logged_and_not_published(spark, tmp_path):
    raw = files.load_datasets(spark, land(tmp_path))
    root = str(tmp_path / "warehouse")
    with pytest.raises(Exception):
        batch.run_batch(spark, raw | {"events": raw["events"].drop("timestamp")}, root)
    assert sinks.VersionedStore(spark, f"{root}/tables").current() is None
    run = spark.read.json(f"{root}/runs").first()
    assert run.status == "FAILED" and "timestamp" in run.error


def test_unpublished_store_says_so(spark, tmp_path):
    with pytest.raises(LookupError):
        sinks.VersionedStore(spark, str(tmp_path / "none")).read("t")


def test_equal_names_in_two_folders(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.txt").write_text(name)
    got = files.read_documents(spark, str(tmp_path / "*" / "*.txt")).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [("x/a.txt", "x"), ("y/a.txt", "y")]


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ("300b", "1")):
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def random_table(seed, n):
    choose = random.Random(seed)
    pieces = ["a", " ", ",", '"', "\n", "\n\n", "é", "x" * 40, '""', "\n,", ',"', '5" pipe']
    return [["U%d" % i, "".join(choose.choices(pieces, k=choose.randrange(9))), "m%d" % i] for i in range(n)]


@pytest.mark.parametrize("seed", (1, 2, 3))
def test_quoted_breaks_across_byte_ranges(spark, tmp_path, small_ranges, seed):
    """Many byte ranges, quoted breaks over several of them: the rows of the csv module."""
    rows = random_table(seed, 120)
    out = io.StringIO()
    csv_module.writer(out, lineterminator="\n").writerows([["user_id", "name", "email"], *rows])
    path = csv(tmp_path, out.getvalue() + 'U900,unquoted 5" pipe,z\n')
    lines = csv_records.read_lines(spark, path)
    assert lines.select("_block").distinct().count() > 8
    landed = files.land_csv(spark, path, "users")
    got = {r.user_id: (r.name, r.email) for r in landed.arrived.collect()}
    plain = lambda s: None if s in files.NULL_TOKENS else s
    assert got == {u: (plain(n), m) for u, n, m in rows} | {"U900": ('unquoted 5" pipe', "z")}
    assert landed.rejected.count() == 0
    ordered = [r.user_id for r in landed.rows.orderBy(ORDINAL).collect()]
    assert ordered == [r[0] for r in rows] + ["U900"]


def test_open_quotes_are_rejected_not_swallowed(spark, tmp_path, small_ranges):
    text = 'user_id,name,email\nU1,"a\nU2,Bo,b@x.io\nU3,"two\nlines",c@x.io\nU4,"Di",d@x.io\n'
    text += 'U5,"e\nU6,"f\nU7,"g\nU8,Hal,h@x.io\n' + "".join(f"V{i},n,e\n" for i in range(80)) + 'U9,"end\n'
    landed = files.land_csv(spark, csv(tmp_path, text), "users")
    assert sorted(r.record for r in landed.rejected.collect()) == ['U1,"a', 'U5,"e', 'U6,"f', 'U7,"g', 'U9,"end']
    got = {r.user_id: r.name for r in landed.rows.collect()}
    want = {"U2": "Bo", "U3": "two\nlines", "U4": "Di", "U8": "Hal"} | {f"V{i}": "n" for i in range(80)}
    assert got == want


def test_one_faulty_file_leaves_the_others(spark, tmp_path):
    folder = tmp_path / "both"
    folder.mkdir()
    csv(folder, 'user_id,name\nU1,"x\ny"\n', "a")
    csv(folder, 'user_id,name\nU2,"x\nU3,z\n', "b")
    landed = files.land_csv(spark, str(folder), "users")
    assert {(r.user_id, r.name) for r in landed.rows.collect()} == {("U1", "x\ny"), ("U3", "z")}
    assert [r.record for r in landed.rejected.collect()] == ['U2,"x']


def test_lines_with_odd_quotes_are_rejected_without_multi_line(spark, tmp_path):
    landed = files.land_csv(spark, csv(tmp_path, 'user_id,name\nU1,"a\nb"\nU2,"Bo"\n'), "users", False)
    assert [(r.user_id, r.name) for r in landed.rows.collect()] == [("U2", "Bo")]
    assert sorted(r.record for r in landed.rejected.collect()) == ['U1,"a', 'b"']


def test_repeated_and_odd_header_names(spark, tmp_path):
    path = csv(tmp_path, "user_id,name,Name,_corrupt_record,,user_id\nU1,Ann,Bo,c,d,e\n")
    landed = files.land_csv(spark, path, "users")
    assert landed.arrived.columns[:-1] == ["user_id", "name", "Name.1", "_corrupt_record", "Unnamed: 4", "user_id.1"]
    row = landed.rows.first()
    assert (row.user_id, row.name) == ("U1", "Ann")
    found = {(r.kind, r.column_name) for r in drift.check_drift(landed.arrived, "users").collect()}
    assert {("added", "Name.1"), ("added", "user_id.1"), ("added", "_corrupt_record")} <= found


def test_inferred_types_share_quoting_and_null_tokens(spark, tmp_path):
    path = csv(tmp_path, 'i,l,d,b,day,at,t,none\n1,3000000000,1.5,true,2024-01-02,2024-01-02 03:04:05,"x\ny",NA\nN/A,2,2,,,,7,\n')
    df = files.read_csv_inferred(spark, path)
    assert [t for _, t in df.dtypes] == ["int", "bigint", "double", "boolean", "date", "timestamp_ntz", "string", "string"]
    assert sorted(str(r.t) for r in df.collect()) == ["7", "x\ny"]
