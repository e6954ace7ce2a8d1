from __future__ import annotations

from datetime import date

import pytest
from fixtures import change, org, pay, raw, worker
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tenurelog.operators import change_over_previous, run_checks, scd2_from_changes, split_hot_keys
from tenurelog.plans import (
    CHECKS,
    dim_org,
    dim_worker,
    fct_compensation,
    fct_headcount_daily,
    fct_turnover,
    stg_compensation,
    stg_job_changes,
    stg_workers,
)

T1 = "2024-01-01 06:00:00"
OPEN = date(9999, 12, 31)


def d(day):
    return date(2024, 1, day)


def build(spark, workers, changes, **options):
    return dim_worker(
        stg_workers(raw(spark, [(T1, workers)])), stg_job_changes(raw(spark, [(T1, changes)])), **options
    )


def spans(dim):
    rows = dim.orderBy("worker_id", "effective_from", "effective_to").collect()
    return [(r.worker_id, r.last_change_type, r.effective_from, r.effective_to, r.is_current) for r in rows]


def test_worker_without_approved_change(spark):
    dim = build(spark, [worker("W1", status="Terminated")], [change("C1", "W1", "New Hire", "2024-01-02", status="Denied")])
    row = dim.first()
    assert (row.worker_dim_key, row.effective_from, row.is_current) == (None, None, False)
    assert row.employment_status == "Active"
    checks = {(r.column, r.test): r.failures for r in run_checks({"dim_worker": dim}, [c for c in CHECKS if c.model == "dim_worker"]).collect()}
    assert checks == {("worker_dim_key", "not_null"): 1, ("worker_id", "not_null"): 0}


def test_pending_change_is_ignored(spark):
    dim = build(
        spark,
        [worker("W1")],
        [
            change("C1", "W1", "New Hire", "2024-01-02", position="P1", org="O1"),
            change("C2", "W1", "Promotion", "2024-01-05", status="Pending"),
            change("C3", "W1", "Transfer", "2024-01-09", org="O2"),
        ],
    )
    assert spans(dim) == [
        ("W1", "New Hire", d(2), d(8), False),
        ("W1", "Transfer", d(9), OPEN, True),
    ]
    assert [r.position_id for r in dim.orderBy("effective_from").collect()] == ["P1", "POS001"]
    assert "phone" not in dim.columns and len(dim.columns) == 24


def test_two_changes_on_one_day(spark):
    changes = [
        change("C1", "W1", "New Hire", "2024-01-02", updated="2024-01-02T08:00:00"),
        change("C2", "W1", "Promotion", "2024-01-02", updated="2024-01-02T09:00:00"),
    ]
    dim = build(spark, [worker("W1")], changes)
    assert spans(dim) == [("W1", "New Hire", d(2), d(1), False), ("W1", "Promotion", d(2), OPEN, True)]
    days = fct_headcount_daily(dim, d(3)).orderBy("report_date").collect()
    assert [(r.report_date, r.headcount, r.new_hires, r.promotions) for r in days] == [(d(2), 1, 0, 1), (d(3), 1, 0, 0)]
    assert len(spans(build(spark, [worker("W1")], changes, collapse_same_day=True))) == 1


def test_termination_and_rehire(spark):
    dim = build(
        spark,
        [worker("W1")],
        [
            change("C1", "W1", "New Hire", "2024-01-02"),
            change("C2", "W1", "Termination", "2024-01-04"),
            change("C3", "W1", "New Hire", "2024-01-06"),
        ],
    )
    left = dim.where("last_change_type = 'Termination'").first()
    assert (left.employment_status, left.position_id, left.organization_id) == ("Terminated", "POS001", "ORG001")
    days = fct_headcount_daily(dim, d(7)).orderBy("report_date").collect()
    assert [(r.report_date, r.headcount, r.terminations) for r in days] == [
        (d(2), 1, 0), (d(3), 1, 0), (d(6), 1, 0), (d(7), 1, 0),
    ]
    rate = fct_turnover(dim, d(10)).first()
    assert (rate.terminations, rate.average_headcount, rate.turnover_rate) == (1, 0.7, pytest.approx(1 / 0.7))


def test_calendar_stops_on_request_only(spark):
    dim = build(spark, [worker("W1", hired="2019-01-01")], [change("C1", "W1", "New Hire", "2019-01-01")])
    assert fct_headcount_daily(dim, d(1), max_days=1500).count() == 1500
    assert fct_headcount_daily(dim, d(1)).count() == (d(1) - date(2019, 1, 1)).days + 1
    assert fct_headcount_daily(dim, date(2018, 1, 1)).count() == 0


def test_change_without_date_stays_open_and_doubles_the_fact(spark):
    dim = build(
        spark,
        [worker("W1")],
        [change("C1", "W1", "New Hire", "2024-01-02"), change("C2", "W1", "Transfer", None)],
    )
    assert spans(dim) == [("W1", "Transfer", None, OPEN, True), ("W1", "New Hire", d(2), OPEN, True)]
    assert dim.where("effective_from IS NULL").first().worker_dim_key is None
    assert [r.headcount for r in fct_headcount_daily(dim, d(3)).collect()] == [1, 1]
    fact = fct_compensation(stg_compensation(raw(spark, [(T1, [pay("P1", "W1", "2024-01-02", 100)])])), dim)
    assert fact.count() == 2
    checks = run_checks({"fct_compensation": fact}, [c for c in CHECKS if c.model == "fct_compensation"])
    assert {(r.test, r.failures) for r in checks.collect()} == {("unique", 1), ("not_null", 0)}


def test_compensation_change(spark):
    records = [
        pay("P1", "W1", "2024-01-02", 100.0),
        pay("P2", "W1", "2024-01-03", 110.0),
        pay("P4", "W1", "2024-01-04", 55.0, currency="GBP", updated="2024-01-04T00:00:00"),
        pay("P3", "W1", "2024-01-04", 220.0, updated="2024-01-04T00:00:00"),
        pay("P5", "W9", "2024-01-04", 7.0),
    ]
    dim = build(spark, [worker("W1")], [change("C1", "W1", "New Hire", "2024-01-02")])
    fact = fct_compensation(stg_compensation(raw(spark, [(T1, records)])), dim).orderBy("compensation_id").collect()
    assert [(r.compensation_id, r.previous_base_salary, r.salary_change_pct, r.job_title) for r in fact] == [
        ("P1", None, None, "Engineer"),
        ("P2", 100.0, 10.0, "Engineer"),
        ("P3", 110.0, 100.0, "Engineer"),
        ("P4", 220.0, -75.0, "Engineer"),
        ("P5", None, None, None),
    ]


def test_previous_salary_of_zero(spark):
    df = spark.createDataFrame([("W1", 1, 0.0), ("W1", 2, 5.0)], "k string, o int, v double")
    spec = {"key": "k", "order": ["o"], "value": "v", "previous": "p", "change_pct": "c"}
    with pytest.raises(PySparkException):
        change_over_previous(df, **spec).collect()
    assert change_over_previous(df, **spec, zero_division="null").orderBy("o").collect()[1].c is None


def test_rounding_is_decimal_and_never_overflows(spark):
    df = spark.createDataFrame([("a", 1, 1000.0), ("a", 2, 1002.85), ("a", 3, 1e30), ("a", 4, 1e-300), ("a", 5, 1.0)], "k string, o int, v double")
    out = change_over_previous(df, key="k", order=["o"], value="v", previous="p", change_pct="c").orderBy("o").collect()
    assert out[1].c == 0.29
    assert out[2].c == pytest.approx((1e30 - 1002.85) / 1002.85 * 100)
    assert out[4].c == pytest.approx(1e302)


def test_organizations(spark):
    pulls = raw(
        spark,
        [
            (T1, [org("O1", "Engineering"), org("O2", "Data", "O1"), org("O3", "Lost", "O9")]),
            ("2024-01-02 06:00:00", [org("O1", "Tech", pulled="2024-02-01T00:00:00"), org("O2", "Data", "O1", pulled="2024-02-01T00:00:00")]),
        ],
    )
    dim = dim_org(pulls)
    got = sorted((r.org_id, r.org_name, r.parent_org_name or "") for r in dim.collect())
    assert got == [
        ("O1", "Engineering", ""),
        ("O1", "Tech", ""),
        ("O2", "Data", "Engineering"),
        ("O2", "Data", "Tech"),
        ("O3", "Lost", ""),
    ]
    latest = {(r.org_id, r.org_name, r.parent_org_name) for r in dim_org(pulls, latest_only=True).collect()}
    assert latest == {("O1", "Tech", None), ("O2", "Data", "Tech"), ("O3", "Lost", None)}
    checks = run_checks({"dim_org": dim}, [c for c in CHECKS if c.model == "dim_org"])
    assert {(r.test, r.failures) for r in checks.collect()} == {("unique", 2), ("not_null", 0)}


# -- hot keys ----------------------------------------------------------------


def skewed(spark):
    """One key with two thirds of the rows, many ties and NULL dates; NULL keys too."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 30 == 2, F.lit(None)).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.when(F.col("id") % 41 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 17).cast("int"))).alias("day"),
        F.col("id").alias("tie"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 1.0).alias("v"),
    )


def test_hot_key_gives_the_same_history(spark):
    spec = {"key": "k", "effective": "day", "tie_break": ["tie"], "carry": ["tie"], "rank": "rank"}
    plain = scd2_from_changes(skewed(spark), **spec)
    split = scd2_from_changes(skewed(spark), **spec, max_rows=100)
    assert plain.columns == split.columns
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0
    assert split.count() == 3000


def test_hot_key_gives_the_same_previous_value(spark):
    spec = {"key": "k", "order": ["day", "tie"], "value": "v", "previous": "p", "change_pct": "c", "zero_division": "null"}
    plain = change_over_previous(skewed(spark), **spec)
    split = change_over_previous(skewed(spark), **spec, max_rows=100)
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0
    window = Window.partitionBy("k").orderBy(F.col("day").asc_nulls_last(), "tie")
    want = skewed(spark).withColumn("p", F.lag("v").over(window))
    assert want.exceptAll(split.select(*want.columns)).count() == 0


def test_no_piece_is_large(spark):
    split = split_hot_keys(skewed(spark), ["k"], ["day", "tie"], max_rows=100)
    sizes = split.rows.groupBy(*split.by).count()
    assert sizes.agg(F.max("count")).first()[0] <= 300
    assert split.rows.count() == 3000


def test_one_worker_with_most_changes(spark):
    workers = stg_workers(raw(spark, [(T1, [worker(w) for w in ("W0", "W1", "W2", "W3")])]))
    kinds = ["New Hire", "Promotion", "Transfer", "Termination"]
    changes = stg_job_changes(
        raw(
            spark,
            [(T1, [
                change(f"C{i:04d}", "W0" if i % 3 else f"W{1 + i % 2}", kinds[i % 4], f"2024-01-{1 + i % 28:02d}", org=f"O{i % 5}")
                for i in range(600)
            ])],
        )
    )
    plain, split = dim_worker(workers, changes), dim_worker(workers, changes, max_rows=40)
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0
    assert plain.count() == 601
    records = [pay(f"P{i:04d}", "W0" if i % 3 else "W1", f"2024-01-{1 + i % 28:02d}", 100.0 + i) for i in range(300)]
    comp = stg_compensation(raw(spark, [(T1, records)]))
    plain, split = fct_compensation(comp, plain), fct_compensation(comp, plain, max_rows=40)
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0
    assert plain.count() == 300


# -- plans -------------------------------------------------------------------


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_per_side_and_no_nested_loop(spark):
    workers = stg_workers(raw(spark, [(T1, [worker("W1")])]))
    changes = stg_job_changes(raw(spark, [(T1, [change("C1", "W1", "New Hire", "2024-01-02")])]))
    plan = executed(fct_headcount_daily(dim_worker(workers, changes), d(9)))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    df = skewed(spark)
    spec = {"key": "k", "effective": "day", "tie_break": ["tie"], "carry": ["tie"]}
    assert executed(scd2_from_changes(df, **spec)).count("Exchange ") == 1
    out = change_over_previous(df, key="k", order=["day", "tie"], value="v", previous="p", change_pct="c")
    assert executed(out).count("Exchange ") == 1
