from __future__ import annotations

import json
import random

import pytest
from fixtures import land_text
from pyspark.sql import functions as F

from tenurelog.operators import flatten
from tenurelog.sources import RawStore, arrays, landing
from tenurelog.sources.arrays import depth_change

DAY = "2024-01-01"
TRICKY = ['x"]},{"', "a\\", "}\n]", "[[{", "é ", ""]


def record(number, draw):
    """A record whose last member may be an object, an array or a plain value."""
    last = draw.choice([{"a": {"b": []}}, [[1], {"c": draw.choice(TRICKY)}], draw.choice(TRICKY), {}, [], None])
    return {"worker_id": f"W{number:04d}", draw.choice(TRICKY) or "t": draw.choice(TRICKY), "last": last}


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "901")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def load(spark, tmp_path, **options):
    store = RawStore(spark, str(tmp_path / "wh"))
    result = store.load(str(tmp_path / "in"), "workers", DAY, "2024-01-01 06:00:00", **options)
    good = flatten(store.read("workers"), [("worker_id", "string", "w")]).collect()
    return result, sorted(r[0] for r in good), store


def test_brackets_in_strings_do_not_count(spark):
    lines = [('{"a": "}]", "b": [', 2), (r'"\\": "\"}", ]', -1), ('"[" : "\\u005b" }', -1), ('"open {', 0), ("  },", -1), ("[[", 2), ("", 0), ('"' + "[" * 50_000 + '"', 0)]
    got = spark.createDataFrame(lines, "v string, n long").select(depth_change(F.col("v")).alias("d"), "n").collect()
    assert [r["d"] for r in got] == [r["n"] for r in got]


def test_records_with_any_end_at_any_indent_in_small_blocks(spark, tmp_path, small_blocks):
    draw, number = random.Random(1), 0
    for name, indent, end in [("a b.json", 0, "\n"), ("c+d%20.json", 1, "\n"), ("e.json", 2, "\r\n"), ("f.json", 4, "\n"), ("g.json", None, "\n"), ("h.json", 3, "\n")]:
        records = [record(number + i, draw) for i in range(40)]
        number += 40
        text = json.dumps(records, indent=indent, ensure_ascii=draw.random() < 0.5)
        land_text(str(tmp_path / "in"), "workers", DAY, text.replace("\n", end), name=name)
    result, good, store = load(spark, tmp_path)
    assert (result.files, result.records, result.bad_records) == (6, number, 0)
    assert good == [f"W{i:04d}" for i in range(number)]
    names = {r[0] for r in store.read("workers").select("_file_name").distinct().collect()}
    assert len(names) == 6 and "e.json" in names


def test_records_are_found_in_several_blocks(spark, tmp_path, small_blocks):
    land_text(str(tmp_path / "in"), "workers", DAY, json.dumps([record(i, random.Random(i)) for i in range(100)], indent=2))
    lines = arrays.read_lines(spark, [str(tmp_path / "in")])
    assert lines.select("_block").distinct().count() > 10


def test_a_cut_off_file_loses_its_last_record_only(spark, tmp_path, small_blocks):
    records = [{"worker_id": f"W{i}", "last": {"a": [i]}} for i in range(30)]
    text = json.dumps(records, indent=2)
    land_text(str(tmp_path / "in"), "workers", DAY, text[: text.rindex('"a"')])
    result, good, store = load(spark, tmp_path)
    assert (result.records, result.bad_records) == (29, 1) and "W29" not in good
    assert '"W29"' in store.quarantine("workers").first().value


def test_elements_that_are_no_records_are_set_aside_beside_them(spark, tmp_path):
    text = '[\n1,\n"two",\n{"worker_id": "W1"},\n[3,\n4],\n{"worker_id": ,\n"x": 1},\nnull,\n{"worker_id":\n"W2"}\n]\n'
    land_text(str(tmp_path / "in"), "workers", DAY, text)
    result, good, _ = load(spark, tmp_path)
    assert good == ["W1", "W2"] and (result.records, result.bad_records) == (2, 5)


def test_a_piece_without_end_is_set_aside_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "LONGEST", 10)
    lines = ['{"worker_id": "W1"},', '{"worker_id": "W2", "open": {', *[f'"k{i}": {i},' for i in range(95)], '"z": 1}']
    land_text(str(tmp_path / "in"), "workers", DAY, "[\n" + "\n".join(lines) + "\n]")
    result, good, store = load(spark, tmp_path)
    assert good == ["W1"] and result.bad_records == 10
    assert sum(r[0].count('"k') for r in store.quarantine("workers").select("value").collect()) == 95


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    landing, store = str(tmp_path / "in"), RawStore(spark, str(tmp_path / "wh"))

    def run(at):
        store.stream(landing, "workers", str(tmp_path / "cp"), files_per_batch=1, loaded_at=lambda batch: at).awaitTermination()

    land_text(landing, "workers", DAY, json.dumps([{"worker_id": "W1"}, {"worker_id": "W2"}], indent=1), name="a b.json")
    land_text(landing, "workers", "2024-01-02", json.dumps([{"worker_id": "W3"}]), name="c.json")
    run("2024-01-03 06:00:00")
    run("2024-01-04 06:00:00")
    land_text(landing, "workers", "2024-01-02", '[{"worker_id": "W4"}, 5]', name="d.json")
    land_text(landing, "workers", DAY, '{"worker_id": "W0"}', name="loaded.json")
    assert store.load(landing, "workers", DAY, "2024-01-05 06:00:00").files == 1  # the stream's files are in the manifest
    run("2024-01-06 06:00:00")
    rows = flatten(store.read("workers"), [("worker_id", "string", "w")], keep=["_loaded_at"]).collect()
    assert sorted((r["w"], str(r["_loaded_at"])[:10]) for r in rows) == [
        ("W0", "2024-01-05"), ("W1", "2024-01-03"), ("W2", "2024-01-03"), ("W3", "2024-01-03"), ("W4", "2024-01-06"),
    ]
    assert store.quarantine("workers").count() == 1
    seen = store.manifest("workers").select("load_date", F.element_at(F.split("path", "/"), -1)).collect()
    assert sorted((str(r[0]), r[1]) for r in seen) == [
        ("2024-01-01", "a b.json"), ("2024-01-01", "loaded.json"), ("2024-01-02", "c.json"), ("2024-01-02", "d.json"),
    ]


def test_a_record_is_parsed_once(spark):
    """The plan names the parser once: a generator computes what it is made from at each mention."""
    text = spark.createDataFrame([('{"a": 1}', False, "f"), ('[{"a": 2}, 3]', True, "f")], "value string, whole boolean, _file_name string")
    found = landing._records(text)
    assert found._jdf.queryExecution().optimizedPlan().toString().count('{"r":[') == 1
    rows = found.selectExpr("to_json(raw_data) AS record", "value").collect()
    assert sorted(tuple(r) for r in rows if r[0]) == [('{"a":1}', None), ('{"a":2}', None)]
    assert [r[1] for r in rows if not r[0]] == ["3"]
