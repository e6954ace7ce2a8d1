from __future__ import annotations

import json
from datetime import date

import pytest
from fixtures import change, land_lines, land_text, org, pay, worker
from pyspark.sql import functions as F

from tenurelog.plans import Warehouse
from tenurelog.sources import CatalogLayers, KeyedTable, RawStore

DAY = "2024-01-01"


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_views_switch_to_the_next_version(spark):
    layers = CatalogLayers(spark, "cat_a_")
    first = layers.save("curated", "m", spark.createDataFrame([(1, "a")], "k int, `odd name` string"))
    reading = spark.table("cat_a_curated.m")
    layers.save("curated", "m", layers.table("curated", "m").union(spark.createDataFrame([(2, "b")], "k int, v string")))
    assert values(layers.table("curated", "m")) == [(1, "a"), (2, "b")]
    assert values(first) == values(reading) == [(1, "a")], "who reads the version before can go on"
    layers.save("curated", "m", spark.createDataFrame([(3, 1.5)], "k int, w double"))
    assert list(layers.versions("curated", "m")) == [2, 3] and layers.table("curated", "m").columns == ["k", "w"]
    with pytest.raises(ValueError):
        CatalogLayers(spark, "a b")


def test_keyed_tables_are_shown_without_a_copy(spark, tmp_path):
    layers = CatalogLayers(spark, "cat_b_")
    table = KeyedTable(spark, str(tmp_path / "it's a table"), "k", 4)
    schema = spark.createDataFrame([], "k int, v string").schema
    assert layers.publish_keyed("t", table, schema).columns == ["k", "v"] and layers.table("refined", "t").count() == 0
    table.replace(spark.createDataFrame([(i, "a") for i in range(20)], "k int, v string"))
    shown = layers.publish_keyed("t", table, schema)
    assert values(shown) == values(table.read()) and shown.inputFiles() and all("/data/c-" in f for f in shown.inputFiles())
    table.replace(spark.createDataFrame([(7, "b", 1.0)], "k int, v string, w double"))
    assert values(layers.table("refined", "t")) == [(i, "a") for i in sorted(range(20), key=str)], "until it is published"
    assert values(layers.publish_keyed("t", table, schema)) == values(table.read())


def test_raw_shows_good_records_of_entered_loads(spark, tmp_path):
    layers, store = CatalogLayers(spark, "cat_c_"), RawStore(spark, str(tmp_path / "wh"))
    store.load(str(tmp_path / "in"), "workers", DAY)
    assert layers.publish_raw("workers", store).count() == 0
    land_text(str(tmp_path / "in"), "workers", DAY, json.dumps([worker("W1"), 7, worker("W2")], indent=1))
    store.load(str(tmp_path / "in"), "workers", DAY, "2024-01-01 06:00:00")
    got = spark.sql("SELECT variant_get(raw_data, '$.worker_id', 'string') AS w, _load_day FROM cat_c_raw.workers") if layers.publish_raw("workers", store) else None
    assert values(got) == [("W1", date(2024, 1, 1)), ("W2", date(2024, 1, 1))]
    assert layers.table("raw", "workers").columns == store.read("workers").columns


def test_refresh_by_name_equals_refresh_by_folder(spark, tmp_path):
    landing = str(tmp_path / "landing")
    land_lines(landing, "workers", DAY, [worker("W1"), worker("W2", hired="2024-01-02")])
    land_lines(landing, "job_changes", DAY, [change("C1", "W1", "New Hire", "2024-01-01", org="ORG001"), change("C2", "W2", "New Hire", "2024-01-02")])
    land_lines(landing, "compensation", DAY, [pay("P1", "W1", "2024-01-01", 100.0)])
    land_lines(landing, "organizations", DAY, [org("ORG001", "Engineering")])
    named = Warehouse(spark, str(tmp_path / "named"), 4, CatalogLayers(spark, "cat_d_"))
    plain = Warehouse(spark, str(tmp_path / "plain"), 4)
    one, two = (w.refresh(landing, DAY, date(2024, 1, 3), loaded_at="2024-01-01 06:00:00", layout="lines") for w in (named, plain))
    for model, df in two.models.items():
        assert one.models[model].columns == df.columns
        assert values(one.models[model].select([F.col(c) for c in df.columns])) == values(df)
    assert spark.table("cat_d_curated.dim_worker").count() == 2 and spark.table("cat_d_curated.checks").count() == two.checks.count()
