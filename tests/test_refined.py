from __future__ import annotations

import pytest
from fixtures import change, pay, raw, worker
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tenurelog.operators import flatten, latest_by_key
from tenurelog.plans import stg_compensation, stg_job_changes, stg_workers

T1, T2 = "2024-01-01 06:00:00", "2024-01-02 06:00:00"


def test_later_load_wins_whatever_its_record_says(spark):
    df = stg_workers(
        raw(spark, [(T1, [worker("W1", level="new", updated="2025-01-01T00:00:00")]), (T2, [worker("W1", level="old")])])
    )
    assert [(r.worker_id, r.job_level) for r in df.collect()] == [("W1", "old")]


def test_missing_update_time_ranks_first_within_a_load(spark):
    a, b = worker("W1", level="dated"), worker("W1", level="undated", updated=None)
    df = stg_workers(raw(spark, [(T1, [a, b])]))
    assert [r.job_level for r in df.collect()] == ["undated"]


def test_same_change_twice_in_one_load(spark):
    early = change("C1", "W1", "Transfer", "2024-01-05", updated="2024-01-01T00:00:00")
    late = change("C1", "W1", "Promotion", "2024-01-05", updated="2024-01-01T00:00:00.000001")
    df = stg_job_changes(raw(spark, [(T1, [late, early])]))
    assert [r.change_type for r in df.collect()] == ["Promotion"]


def test_types_and_renames(spark):
    df = stg_job_changes(raw(spark, [(T1, [change("C1", "W1", "Transfer", "2024-01-05", reason="Reorganization")])]))
    row = df.first()
    assert row.change_reason == "Reorganization"
    assert dict(df.dtypes)["effective_date"] == "date"
    assert dict(df.dtypes)["source_updated_at"] == "timestamp_ntz"
    paid = stg_compensation(raw(spark, [(T1, [pay("P1", "W1", "2024-01-05", 100)])])).first()
    assert isinstance(paid.bonus_target_pct, float) and paid.base_salary == 100.0
    assert len(stg_workers(raw(spark, [(T1, [worker("W1")])])).columns) == 25


def test_bad_value_fails_or_becomes_null(spark):
    rows = raw(spark, [(T1, [change("C1", "W1", "Transfer", "not a date")])])
    with pytest.raises(PySparkException):
        stg_job_changes(rows).collect()
    assert stg_job_changes(rows, strict=False).first().effective_date is None


def test_flatten_reads_structs_too(spark):
    df = spark.sql("SELECT named_struct('a', named_struct('b', '7'), 'c', 'x') AS raw_data, 1 AS id")
    out = flatten(df, [("a.b", "long", "b"), ("c", "string", "c")], keep=["id"])
    assert out.first().asDict() == {"b": 7, "c": "x", "id": 1}
    assert flatten(df, [("c", "date", "d")], strict=False).first().d is None


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = latest_by_key(df, ["k"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert sorted(r.v for r in out.collect()) == [997, 998, 999]
