from __future__ import annotations

import json
import os
from datetime import date

import pytest
from fixtures import change, land_lines, land_text, org, pay, raw, worker
from pyspark.sql import functions as F

from tenurelog.operators import DataTestFailure, flatten, incremental_upsert, latest_by_key
from tenurelog.plans import Warehouse, stg_job_changes
from tenurelog.sources import KeyedTable, RawStore, RebuiltTable, land
from tenurelog.streaming import refresh_history, stream_upsert

T1, T2, T3 = "2024-01-01 06:00:00", "2024-01-02 06:00:00", "2024-01-03 06:00:00"
DAY = "2024-01-01"


def ids(df, path="worker_id"):
    return sorted(r[0] for r in flatten(df, [(path, "string", "x")]).collect())


# -- landing and RAW ---------------------------------------------------------


def test_load_once_and_again_when_rewritten(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    path = land_lines(landing, "workers", DAY, [worker("W1")])
    os.utime(path, (1_700_000_000, 1_700_000_000))
    assert store.load(landing, "workers", DAY, T1, "lines").records == 1
    again = store.load(landing, "workers", DAY, T2, "lines")
    assert (again.files, again.records) == (0, 0)
    land_lines(landing, "workers", DAY, [worker("W1"), worker("W2")])
    assert store.load(landing, "workers", DAY, T3, "lines").records == 2
    rows = store.read("workers").select("_loaded_at", "_file_name", "_source").distinct().collect()
    assert {(str(r._loaded_at), r._file_name, r._source) for r in rows} == {
        (T1, "workers_2024-01-01.json", "workers"),
        (T3, "workers_2024-01-01.json", "workers"),
    }
    assert store.manifest("workers").count() == 2


@pytest.mark.parametrize("indent", [None, 0, 1, 2, 4])
@pytest.mark.parametrize("crlf", [False, True])
def test_array_files(spark, tmp_path, indent, crlf):
    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))

    def put(records, name):
        text = json.dumps(records, indent=indent)
        land_text(landing, "workers", DAY, text.replace("\n", "\r\n") if crlf else text, name=name)

    put([worker("W1"), worker("W2"), worker("W3")], "three.json")
    put([worker("W4")], "one.json")
    put([], "none.json")
    put(worker("W5"), "object.json")
    result = store.load(landing, "workers", DAY, T1)
    assert (result.files, result.records, result.bad_records) == (4, 5, 0)
    assert ids(store.read("workers")) == ["W1", "W2", "W3", "W4", "W5"]
    assert ids(store.read("workers"), "personal_data.first_name")[0] == "First W1"


def test_nothing_is_lost_or_made_up(spark, tmp_path):
    """Good and bad records add up to what the files hold, in both layouts."""
    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    one, two = json.dumps({"worker_id": "A"}), json.dumps({"worker_id": "B"})
    # (text, good, bad) as lines
    lines = [(one, 1, 0), (one + two, 0, 1), (f"{one} xx", 0, 1), (f"[{one}, {two}]", 2, 0), (f"{one},", 0, 1), ('"text"', 0, 1),
             ("7", 0, 1), (f"[{one}, 7]", 1, 1), (f"[{one}][{two}]", 0, 1), ("null", 0, 1), ("[]", 0, 0), (f'{one}],"end":1}} x', 0, 1)]
    for end, entity in (("\n", "workers"), ("\r\n", "positions")):
        land_text(landing, entity, DAY, end.join(t for t, _, _ in lines) + end)
        result = store.load(landing, entity, DAY, T1, "lines")
        assert (result.records, result.bad_records) == (sum(g for _, g, _ in lines), sum(b for *_, b in lines))
    # each text as a file of its own, as an array
    for number, (text, good, bad) in enumerate(lines):
        land_text(landing, "time_off", DAY, text, name=f"{number}.json")
    result = store.load(landing, "time_off", DAY, T1)
    want = [(1, 0), (0, 1), (0, 1), (2, 0), (0, 1), (0, 1), (0, 1), (1, 1), (0, 1), (0, 1), (0, 0), (0, 1)]
    assert (result.records, result.bad_records) == (sum(g for g, _ in want), sum(b for _, b in want))


def test_array_read_as_lines_makes_no_records(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    land_text(landing, "workers", DAY, json.dumps([worker("W1"), worker("W2")], indent=2))
    result = store.load(landing, "workers", DAY, T1, "lines")
    assert result.records == 0 and result.bad_records > 0


def test_indented_file_is_read_in_parts(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    land_text(landing, "workers", DAY, json.dumps([worker(f"W{i:04d}") for i in range(300)], indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1777")
    try:
        result = store.load(landing, "workers", DAY, T1)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (result.records, result.bad_records) == (300, 0)
    assert ids(store.read("workers")) == [f"W{i:04d}" for i in range(300)]


def test_array_on_a_line(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    land_text(landing, "workers", DAY, json.dumps([worker("W1"), worker("W2")]) + "\n" + json.dumps(worker("W3")))
    assert store.load(landing, "workers", DAY, T1, "lines").records == 3
    assert ids(store.read("workers")) == ["W1", "W2", "W3"]


def test_bad_records_are_set_aside(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    good, bad = json.dumps(worker("W1")), json.dumps(worker("W2"))[:-9]
    land_text(landing, "workers", DAY, f"{good}\n{bad}\n\n")
    result = store.load(landing, "workers", DAY, T1, "lines")
    assert (result.records, result.bad_records) == (1, 1)
    assert store.quarantine("workers").first().value == bad

    # the array as the source writes it loses only the bad element
    broken = json.dumps([worker("W1"), worker("W2"), worker("W3")], indent=2).replace('"worker_id": "W2",', '"worker_id": ,')
    land_text(landing, "positions", DAY, broken)
    result = store.load(landing, "positions", DAY, T1)
    assert (result.records, result.bad_records) == (2, 1)
    assert ids(store.read("positions")) == ["W1", "W3"]

    # any other array is set aside whole
    compact = json.dumps([worker("W1"), worker("W2")]).replace('"worker_id": "W2",', '"worker_id": ,')
    land_text(landing, "time_off", DAY, compact)
    land_text(landing, "time_off", DAY, json.dumps([worker("W7")]), name="other.json")
    result = store.load(landing, "time_off", DAY, T1)
    assert (result.records, result.bad_records) == (1, 1)
    assert store.quarantine("time_off").first().value == compact


def test_missing_and_empty_folders_are_skipped(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    land_lines(landing, "workers", DAY, [worker("W1")])
    os.makedirs(os.path.join(landing, "positions", f"load_date={DAY}"))
    results = store.load_all(landing, ["positions", "time_off", "workers"], DAY, T1, "lines")
    assert [(r.entity, r.files) for r in results] == [("positions", 0), ("time_off", 0), ("workers", 1)]
    assert store.read("positions").count() == store.read("time_off").count() == 0
    assert store.read("compensation") is None


def test_landing_replaces_one_date_only(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    for day, n in (("2024-01-01", 3), ("2024-01-02", 4), ("2024-01-01", 2)):
        land(spark.range(n).select(F.col("id").cast("string").alias("worker_id")), landing, "workers", day)
    assert store.load(landing, "workers", "2024-01-01", T1, "lines").records == 2
    assert store.load(landing, "workers", "2024-01-02", T1, "lines").records == 4


def test_default_load_time_is_one_value(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    land_lines(landing, "workers", DAY, [worker("W1"), worker("W2")])
    store.load(landing, "workers", DAY, layout="lines")
    assert store.read("workers").select("_loaded_at").distinct().count() == 1


# -- keyed tables --------------------------------------------------------------


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def keyed(spark, tmp_path, key="k", buckets=4):
    return KeyedTable(spark, str(tmp_path / "t"), key, buckets)


def test_upsert_updates_matches_and_adds_the_rest(spark, tmp_path):
    table = keyed(spark, tmp_path)
    assert table.read() is None
    table.replace(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string"))
    table.replace(spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], "k int, v string"))
    got = {(r.k, r.v) for r in table.read().collect()}
    assert got == {(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "m")}
    before = table.state()
    assert table.replace(spark.createDataFrame([], "k int, v string")) is None
    assert table.state() == before


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=16)
    table.replace(spark.range(200).select(F.col("id").cast("int").alias("k")))
    before = table.state().folders
    table.replace(spark.createDataFrame([(7,)], "k int"))
    after = table.state().folders
    assert sum(before[b] != after[b] for b in before) == 1
    assert table.read().count() == 200


def test_columns_follow_the_model(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.replace(spark.createDataFrame([(i, "a", i) for i in range(8)], "k int, v string, old int"))
    table.replace(spark.createDataFrame([(1, "b", 5)], "k int, v string, new int"))
    assert table.read().columns == ["k", "v", "new"]
    assert rows(table.read().where("k < 2")) == [(0, "a", None), (1, "b", 5)]
    table.replace(spark.createDataFrame([(2, "c", 6)], "k int, v string, old int"))
    assert table.read().where("old IS NOT NULL").count() == 1  # dropped values do not come back
    table.replace(spark.createDataFrame([(2, "c", 2**40)], "k int, v string, old long"))
    assert rows(table.read().where("old IS NOT NULL")) == [(2, "c", 2**40)]


def test_stored_bucket_count_wins(spark, tmp_path):
    keyed(spark, tmp_path, buckets=16).replace(spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")))
    other = keyed(spark, tmp_path, buckets=3)
    other.replace(spark.range(50, 120).select(F.col("id").cast("int").alias("k"), F.lit("b").alias("v")))
    assert other.state().buckets == 16
    assert {(r.v, r["count"]) for r in other.read().groupBy("v").count().collect()} == {("a", 50), ("b", 70)}


def test_retyped_columns_are_cast_or_refused(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.replace(spark.createDataFrame([(i, i, str(i)) for i in range(8)], "k int, n long, t string"))
    table.replace(spark.createDataFrame([(1, 10, 11)], "k int, n int, t int"))
    assert [f.dataType.simpleString() for f in table.read().schema] == ["int", "int", "int"]
    assert rows(table.read().where("k < 3")) == [(0, 0, 0), (1, 10, 11), (2, 2, 2)]
    table.replace(spark.createDataFrame([(1, "x", 5)], "k int, n string, t int"))
    before = table.state()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        table.replace(spark.createDataFrame([(2, 7, 5)], "k int, n int, t int"))
    assert table.state() == before and rows(table.read().where("k < 3")) == [(0, "0", 0), (1, "x", 5), (2, "2", 2)]


def test_second_writer_fails(spark, tmp_path, monkeypatch):
    table = keyed(spark, tmp_path)
    table.replace(spark.createDataFrame([(1, "a")], "k int, v string"))
    write, rival = table._write, keyed(spark, tmp_path)

    def slow(*args, **named):
        done = write(*args, **named)
        monkeypatch.setattr(table, "_write", write)
        rival.replace(spark.createDataFrame([(2, "rival")], "k int, v string"))
        return done

    monkeypatch.setattr(table, "_write", slow)
    with pytest.raises(RuntimeError, match="another writer"):
        table.replace(spark.createDataFrame([(3, "late")], "k int, v string"))
    assert rows(table.read()) == [(1, "a"), (2, "rival")]


def test_upsert_shuffles_old_rows_once(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.replace(spark.createDataFrame([(i, "a") for i in range(50)], "k int, v string"))
    state = table.state()
    kept = table._kept(
        table.read().withColumn("_bucket", table._bucket(state.buckets)), spark.createDataFrame([(3,)], "k int"), state.buckets, unique=True
    )
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert kept.count() == 49


def test_few_buckets_keep_all_tasks_busy(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=2)
    table.replace(spark.range(4000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")))
    settings = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows_ = table.read().withColumn("_bucket", table._bucket(2))
        kept = table._kept(rows_, spark.createDataFrame([(3,)], "k int"), 2, unique=True, touched=2)
        sizes = [r["count"] for r in kept.where("k IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()]
        table.replace(spark.createDataFrame([(3, "new")], "k int, v string"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and sum(sizes) == 3999 and max(sizes) < 3 * min(sizes)
    assert {(r.v, r["count"]) for r in table.read().groupBy("v").count().collect()} == {("a", 3999), ("new", 1)}


def test_rebucket_changes_the_number_and_nothing_else(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=2)
    assert not table.rebucket(5)
    rows_ = spark.range(300).select(F.col("id").cast("int").alias("k"), F.lit("2024-01-01").alias("v"))
    table.replace(rows_.unionByName(spark.createDataFrame([(None, "n")], "k int, v string")), watermark="v", writer="w", batch_id=3)
    old, content = table.state(), rows(table.read().na.fill(-1))
    assert table.rebucket(7) and not table.rebucket(7)
    new = table.state()
    assert (new.buckets, new.watermark, new.batches, new.schema) == (7, old.watermark, {"w": 3}, old.schema)
    assert len(new.folders) == 7 and rows(table.read().na.fill(-1)) == content
    table.replace(spark.createDataFrame([(5, "z")], "k int, v string"))
    assert table.read().count() == 301 and rows(table.read().where("k = 5")) == [(5, "z")]
    with pytest.raises(ValueError):
        table.rebucket(0)
    rival = keyed(spark, tmp_path)
    state = rival.state()
    table.rebucket(3)
    with pytest.raises(RuntimeError, match="another writer"):
        rival.log.append({}, {"file": state.file})


def test_rows_of_a_key_can_go(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.replace(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string"))
    table.replace(
        spark.createDataFrame([(2, "d"), (2, "e")], "k int, v string"),
        keys=spark.createDataFrame([(1,), (2,)], "k int"),
    )
    assert rows(table.read()) == [(2, "d"), (2, "e")]


def test_a_failed_write_changes_nothing(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.replace(spark.createDataFrame([(1, "2024-01-01")], "k int, v string"))
    bad = spark.createDataFrame([(1, "x")], "k int, v string").withColumn("v", F.col("v").cast("date").cast("string"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        table.replace(bad)
    assert rows(table.read()) == [(1, "2024-01-01")]
    table.replace(spark.createDataFrame([(1, "z")], "k int, v string"))
    assert rows(table.read()) == [(1, "z")]


def test_rebuilt_table_may_be_rebuilt_from_itself(spark, tmp_path):
    table = RebuiltTable(spark, str(tmp_path / "r"))
    assert table.read() is None
    table.write(spark.range(3))
    table.write(table.read().where("id > 0"))
    assert rows(table.read()) == [(1,), (2,)]


# -- incremental ----------------------------------------------------------------


def test_watermark(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "change_id", 4)
    one = (T1, [change("C1", "W1", "New Hire", "2024-01-01"), change("C2", "W1", "Transfer", "2024-01-02")])
    two = (T2, [change("C2", "W1", "Promotion", "2024-01-02"), change("C3", "W1", "Transfer", "2024-01-03")])
    late = (T2, [change("C4", "W1", "Transfer", "2024-01-04")])
    assert incremental_upsert(table, raw(spark, [one]), stg_job_changes)
    assert incremental_upsert(table, raw(spark, [one, two]), stg_job_changes)
    assert table.state().watermark == T2
    # stamped like the watermark but arriving later: not seen
    assert not incremental_upsert(table, raw(spark, [one, two, late]), stg_job_changes)
    got = {(r.change_id, r.change_type) for r in table.read().collect()}
    assert got == {("C1", "New Hire"), ("C2", "Promotion"), ("C3", "Transfer")}
    full = stg_job_changes(raw(spark, [one, two]))
    assert full.exceptAll(table.read()).count() == table.read().exceptAll(full).count() == 0


def test_watermark_day_prunes_folders(spark, tmp_path):
    from tenurelog.operators import newer_than

    landing, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    for day, at in (("2024-01-01", T1), ("2024-01-02", T2)):
        land_lines(landing, "workers", day, [worker("W1")])
        store.load(landing, "workers", day, at, "lines")
    fresh = newer_than(store.read("workers"), "_loaded_at", T1, "_load_day")
    assert fresh.count() == 1
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "_load_day" in plan.split("PartitionFilters: [")[1].split("]")[0]


# -- streams ----------------------------------------------------------------------


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "k int, at int, v string"

    def drop(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)

    def build(batch):
        return latest_by_key(batch, ["k"], ["at"])

    def run(table):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        stream_upsert(stream, table, build, str(tmp_path / "cp")).awaitTermination()

    table = keyed(spark, tmp_path)
    drop([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "n")])
    drop([(2, 2, "d"), (3, 1, "e")])
    run(table)
    drop([(1, 0, "late"), (4, 1, "f")])
    run(table)
    run(table)
    # the newest batch wins, even with an older record; NULL keys are only added
    assert {(r.k, r.v) for r in table.read().collect()} == {(1, "late"), (2, "d"), (3, "e"), (4, "f"), (None, "n")}
    last = table.state()
    run(table)
    assert table.state() == last

    # a new checkpoint is a new query: nothing it reads is taken for a replay
    stream = spark.readStream.schema(schema).parquet(source)
    stream_upsert(stream, table, build, str(tmp_path / "cp2")).awaitTermination()
    assert table.state().file > last.file and len(table.state().batches) == 2


def test_replayed_batch_is_merged_once(spark, tmp_path):
    from tenurelog.streaming import merge_batch

    table, schema = keyed(spark, tmp_path), "k int, v string"
    batch = spark.createDataFrame([(1, "a"), (None, "n")], schema)
    seen = []

    def merge(number, writer="q"):
        return merge_batch(batch, number, table, lambda b: b, writer, then=lambda rows: seen.append(rows.count()))

    assert merge(0)
    table.replace(spark.createDataFrame([(2, "by hand"), (None, "m")], schema))  # another change in between
    assert not merge(0)
    assert merge(0, "other") and not merge(0)
    got = [tuple(r) for r in table.read().collect()]
    assert got.count((None, "n")) == 2  # one from each of the two streams
    assert (1, "a") in got and (2, "by hand") in got and len(got) == 5
    assert seen == [2, 2, 2, 2]


def test_history_of_touched_keys_equals_full_rebuild(spark, tmp_path):
    from tenurelog.operators import scd2_from_changes

    spec = {"key": "w", "effective": "day", "tie_break": ["id"], "carry": ["id"]}
    schema = "id int, w string, day date"
    first = spark.createDataFrame([(1, "A", date(2024, 1, 1)), (2, "A", date(2024, 1, 9)), (3, "B", date(2024, 1, 5))], schema)
    late = spark.createDataFrame([(4, "A", date(2024, 1, 4)), (5, "C", date(2024, 1, 6))], schema)
    table = KeyedTable(spark, str(tmp_path / "h"), "w", 4)
    table.replace(scd2_from_changes(first, **spec))
    refresh_history(table, first.union(late), late, **spec)
    full = scd2_from_changes(first.union(late), **spec)
    assert full.exceptAll(table.read()).count() == table.read().exceptAll(full).count() == 0
    split = table.read().where("w = 'A'").orderBy("effective_from").collect()
    assert [(r.id, r.effective_to) for r in split] == [(1, date(2024, 1, 3)), (4, date(2024, 1, 8)), (2, date(9999, 12, 31))]


def test_moved_and_withdrawn_changes_leave_the_history(spark, tmp_path):
    from tenurelog.operators import scd2_from_changes

    spec = {"key": "w", "effective": "day", "tie_break": ["id"], "carry": ["id"]}
    schema = "id int, w string, day date, ok boolean"
    first = [(1, "A", date(2024, 1, 1), True), (2, "A", date(2024, 1, 9), True), (3, "B", date(2024, 1, 5), True)]
    later = [(2, "B", date(2024, 1, 9), True), (3, "B", date(2024, 1, 5), False)]
    table = KeyedTable(spark, str(tmp_path / "h"), "w", 4)
    table.replace(scd2_from_changes(spark.createDataFrame(first, schema).where("ok"), **spec))
    now = spark.createDataFrame(first[:1] + later, schema)
    refresh_history(table, now.where("ok"), spark.createDataFrame(later, schema), change_key="id", **spec)
    assert sorted((r.w, r.id, r.effective_to) for r in table.read().collect()) == [
        ("A", 1, date(9999, 12, 31)),
        ("B", 2, date(9999, 12, 31)),
    ]


def test_stream_keeps_history_up_to_date(spark, tmp_path):
    from tenurelog.operators import scd2_from_changes

    spec = {
        "key": "worker_id",
        "effective": "effective_date",
        "tie_break": ["source_updated_at", "change_id"],
        "carry": ["change_id", "change_type"],
    }
    source, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    changes = KeyedTable(spark, str(tmp_path / "changes"), "change_id", 4)
    history = KeyedTable(spark, str(tmp_path / "history"), "worker_id", 4)
    drops = [
        (T1, [change("C1", "W1", "New Hire", "2024-01-01"), change("C2", "W2", "New Hire", "2024-01-05")]),
        (T2, [change("C3", "W1", "Promotion", "2024-01-09"), change("C4", "W1", "Transfer", "2024-01-04")]),
        (T3, [change("C3", "W1", "Promotion", "2024-01-12")]),
    ]

    def follow(fresh):
        refresh_history(history, changes.read(), fresh, **spec)

    for drop in drops:
        raw(spark, [drop]).write.mode("append").parquet(source)
        stream = spark.readStream.schema(raw(spark, [drop]).schema).parquet(source)
        stream_upsert(stream, changes, stg_job_changes, cp, watermark="_loaded_at", then=follow).awaitTermination()
    full = scd2_from_changes(stg_job_changes(raw(spark, drops)), **spec)
    assert full.count() == 4
    assert full.exceptAll(history.read()).count() == history.read().exceptAll(full).count() == 0
    assert changes.state().watermark == T3


# -- all stages ---------------------------------------------------------------------


def land_day(landing, day, workers, changes, pays, orgs):
    land_lines(landing, "workers", day, workers)
    land_lines(landing, "job_changes", day, changes)
    land_lines(landing, "compensation", day, pays)
    land_lines(landing, "organizations", day, orgs)


def test_refresh(spark, tmp_path):
    landing, home = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "wh"), buckets=4)
    orgs = [org("ORG001", "Engineering"), org("ORG002", "Data", "ORG001")]
    hire = change("C1", "W1", "New Hire", "2024-01-01", org="ORG001")
    land_day(landing, "2024-01-01", [worker("W1")], [hire], [pay("P1", "W1", "2024-01-01", 100.0)], orgs)
    first = home.refresh(landing, "2024-01-01", date(2024, 1, 3), loaded_at=T1, layout="lines")
    assert [r.records for r in first.loads] == [1, 0, 2, 1, 0, 1]
    assert first.models["fct_headcount_daily"].count() == 3
    assert first.checks.count() == 16
    assert first.models["fct_turnover"].first().terminations == 0

    # next day: full pull again, a second worker, a back-dated transfer
    land_day(
        landing,
        "2024-01-02",
        [worker("W1", level="IC4"), worker("W2", hired="2024-01-02")],
        [hire, change("C2", "W1", "Transfer", "2024-01-02", org="ORG002"), change("C3", "W2", "New Hire", "2024-01-02")],
        [pay("P1", "W1", "2024-01-01", 100.0), pay("P2", "W1", "2024-01-02", 125.0)],
        [org("ORG001", "Engineering", pulled="2024-02-01T00:00:00"), org("ORG002", "Data", "ORG001")],
    )
    second = home.refresh(landing, "2024-01-02", date(2024, 1, 3), loaded_at=T2, layout="lines")
    dim = second.models["dim_worker"]
    assert dim.count() == 3 and dim.where("is_current").count() == 2
    assert second.models["dim_org"].count() == 2
    days = second.models["fct_headcount_daily"].groupBy("report_date").agg(F.sum("headcount").alias("n")).orderBy("report_date")
    assert [r.n for r in days.collect()] == [1, 2, 2]
    change_pct = {r.compensation_id: r.salary_change_pct for r in second.models["fct_compensation"].collect()}
    assert change_pct == {"P1": None, "P2": 25.0}

    # the same load again changes nothing
    third = home.refresh(landing, "2024-01-02", date(2024, 1, 3), loaded_at=T3, layout="lines")
    assert all(r.files == 0 for r in third.loads)
    assert third.models["dim_worker"].count() == 3


def test_refresh_fails_on_failed_checks(spark, tmp_path):
    landing, home = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "wh"), buckets=4)
    land_day(
        landing,
        "2024-01-01",
        [worker("W1", status="On Leave"), worker("W2")],
        [change("C1", "W1", "New Hire", "2024-01-01")],
        [pay("P1", "W1", "2024-01-01", 100.0)],
        [org("ORG001", "Engineering")],
    )
    with pytest.raises(DataTestFailure, match="employment_status accepted_values: 1.*") as e:
        home.refresh(landing, "2024-01-01", date(2024, 1, 3), loaded_at=T1, layout="lines")
    assert "dim_worker.worker_dim_key not_null: 1" in str(e.value)
    again = home.refresh(landing, "2024-01-01", date(2024, 1, 3), loaded_at=T2, layout="lines", strict_checks=False)
    assert again.checks.where("failures > 0").count() == 2


def test_first_day_without_organizations(spark, tmp_path):
    landing, home = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "wh"), buckets=4)
    land_text(landing, "workers", DAY, json.dumps([worker("W1")], indent=2))
    done = home.refresh(landing, DAY, date(2024, 1, 3), loaded_at=T1, strict_checks=False)
    counts = {name: df.count() for name, df in done.models.items()}
    assert counts["stg_workers"] == counts["dim_worker"] == 1
    assert counts["dim_org"] == counts["fct_compensation"] == counts["stg_job_changes"] == counts["fct_headcount_daily"] == 0


class FakeSession:
    def __init__(self, **conf):
        self.conf = conf


def test_scratch_folder():
    from tenurelog.session import scratch_dir

    shared = {"spark.checkpoint.dir": "hdfs://x/y/"}
    assert scratch_dir(FakeSession(**shared)).startswith("hdfs://x/y/tenurelog/run-")
    assert scratch_dir(FakeSession(**shared), "t") != scratch_dir(FakeSession(**shared), "t")
    for other in ({"spark.master": "yarn"}, {"spark.master": "local[2]"}, {}):
        with pytest.raises(RuntimeError):
            scratch_dir(FakeSession(**other))
