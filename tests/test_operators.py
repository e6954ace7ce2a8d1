from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenurelog.operators import (
    Check,
    date_spine,
    interval_snapshot,
    page,
    page_after,
    run_checks,
    spine_bounds,
    status_counts,
    unexpected_values,
    updated_since,
)

LO, HI = date(2024, 1, 3), date(2024, 1, 20)
SCHEMA = "grp string, who int, a date, b date, kind string"

day = st.one_of(st.none(), st.integers(1, 28).map(lambda n: date(2024, 1, n)))
interval = st.tuples(
    st.sampled_from(["x", "y", None]),
    st.sampled_from([1, 2, 3, None]),
    day,
    st.one_of(day, st.just(date(9999, 12, 31))),
    st.sampled_from(["new", "old", None]),
)


def by_range_join(df, lo, hi):
    """The definition: a calendar joined on BETWEEN, then counted."""
    spine = date_spine(df.sparkSession, lo, hi, None)
    started = F.when((F.col("kind") == "new") & (F.col("a") == F.col("report_date")), 1).otherwise(0)
    return (
        spine.join(df, F.col("report_date").between(F.col("a"), F.col("b")))
        .groupBy("report_date", "grp")
        .agg(F.countDistinct("who").alias("headcount"), F.sum(started).alias("started"))
    )


def snapshot(df, **options):
    return interval_snapshot(
        df, dims=["grp"], entity="who", start="a", end="b", bounds=(LO, HI),
        starts={"started": F.col("kind") == "new"}, **options,
    )


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(interval, max_size=25))
def test_snapshot_equals_range_join(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted(snapshot(df).collect(), key=str)
    want = sorted(by_range_join(df, LO, HI).collect(), key=str)
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_snapshot_of_disjoint_intervals(spark):
    data = [
        ("x", 1, date(2023, 12, 1), date(2024, 1, 5), "new"),
        ("x", 1, date(2024, 1, 6), date(9999, 12, 31), "new"),
        ("x", 2, date(2024, 1, 4), date(2024, 1, 4), "old"),
        ("y", None, date(2024, 1, 10), date(2024, 1, 11), "new"),
        ("y", 3, date(2024, 1, 9), date(2024, 1, 8), "new"),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    want = by_range_join(df, LO, HI)
    for got in (snapshot(df), snapshot(df, disjoint=True)):
        assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


def test_snapshot_never_multiplies_intervals_by_days(spark):
    plan = snapshot(spark.createDataFrame([], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    # the days are generated after both aggregations
    assert plan.index("explode(sequence") < plan.index("HashAggregate")


def test_spine(spark):
    assert spine_bounds(None, HI) is None and spine_bounds(HI, LO) is None
    assert spine_bounds(date(2000, 1, 1), HI, 1500)[1] == date(2004, 2, 8)
    assert spine_bounds(date(2000, 1, 1), HI)[1] == HI
    assert date_spine(spark, LO, HI).count() == 18
    assert date_spine(spark, HI, LO).count() == 0
    assert date_spine(spark, date(2000, 1, 1), HI, 1500).count() == 1500
    assert date_spine(spark, date(2000, 1, 1), HI).count() == (HI - date(2000, 1, 1)).days + 1


def test_updated_since(spark):
    data = [
        (1, "2024-01-05T00:00:00", "2024-01-01T00:00:00"),
        (2, "2024-01-04T23:59:59.999999", "2024-01-09T00:00:00"),
        (3, "", "2024-01-05T00:00:00.000001"),
        (4, None, "2024-01-04T00:00:00"),
        (5, None, None),
        (6, "", ""),
    ]
    df = spark.createDataFrame(data, "id int, updated_at string, created_at string")
    typed = df.select("id", *[F.nullif(F.col(c), F.lit("")).cast("timestamp_ntz").alias(c) for c in ("updated_at", "created_at")])
    for frame in (df, typed):
        assert sorted(r.id for r in updated_since(frame, "2024-01-05T00:00:00").collect()) == [1, 3]
        assert updated_since(frame, None).count() == 6


def test_updated_since_reaches_the_scan(spark, tmp_path):
    at = F.timestamp_seconds("id").cast("timestamp_ntz")
    spark.range(10).select("id", at.alias("updated_at"), at.alias("created_at")).write.parquet(str(tmp_path / "p"))
    plan = updated_since(spark.read.parquet(str(tmp_path / "p")), "1970-01-01T00:00:05")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updated_at" in plan.split("PushedFilters")[1]


def test_page(spark):
    df = spark.range(95).select(
        "id", F.when(F.col("id") % 10 != 0, F.date_format(F.timestamp_seconds(F.col("id") % 7), "yyyy-MM-dd'T'HH:mm:ss")).otherwise("").alias("at")
    )
    rows = sorted(df.collect(), key=lambda r: r.id)
    rows.sort(key=lambda r: r["at"], reverse=True)
    for offset, limit in ((0, 20), (20, 20), (75, 20), (80, 20), (94, 1), (200, 5)):
        got = page(df, newest="at", key="id", offset=offset, limit=limit)
        assert [r.id for r in got.data.collect()] == [r.id for r in rows[offset : offset + limit]]
        assert (got.total, got.has_more) == (95, offset + limit < 95)
    for bad in ({"offset": -1}, {"limit": 0}, {"limit": 101}):
        with pytest.raises(ValueError):
            page(df, newest="at", key="id", **bad)


def test_page_reads_the_days_of_the_page_only(spark, tmp_path):
    at = F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz")
    spark.range(2000).select("id", at.alias("at")).write.parquet(str(tmp_path / "p"))
    got = page(spark.read.parquet(str(tmp_path / "p")), newest="at", key="id", offset=1000, limit=10)
    assert [r.id for r in got.data.collect()] == list(range(999, 989, -1))
    pushed = got.data._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    assert "GreaterThanOrEqual(at" in pushed and "LessThan(at" in pushed


def test_pages_one_after_another(spark):
    df = spark.range(57).select("id", F.when(F.col("id") % 9 != 0, F.timestamp_seconds(F.col("id") % 5).cast("timestamp_ntz")).alias("at"))
    want = [r.id for r in page(df, newest="at", key="id", limit=57).data.collect()]
    got, after = [], None
    while rows := page_after(df, newest="at", key="id", after=after, limit=10).collect():
        got += [r.id for r in rows]
        after = (rows[-1]["at"], rows[-1].id)
    assert got == want


def test_round_once(spark):
    from tenurelog.functions import round_half_up

    values = [0.284999999996, 0.285, -0.285, 2.5, 1234567890123456.0, 0.1 + 0.2, float("nan"), None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(round_half_up(F.col("v"), 2)).collect()]
    assert got[:6] == [0.28, 0.29, -0.29, 2.5, 1234567890123456.0, 0.3] and got[6] != got[6] and got[7] is None


def test_status_counts(spark):
    df = spark.createDataFrame([("Active",), ("Terminated",), (None,)], "s string")
    assert tuple(status_counts(df, status="s").first()) == (3, 1)


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, "Active"), (1, "On Leave"), (2, "On Leave"), (None, None), (None, "Terminated")], "k int, s string"
    )
    checks = [
        Check("m", "k", "unique"),
        Check("m", "k", "not_null"),
        Check("m", "s", "not_null"),
        Check("m", "s", "accepted_values", ("Active", "Terminated")),
    ]
    got = {(r["column"], r.test): r.failures for r in run_checks({"m": df}, checks).collect()}
    assert got == {("k", "unique"): 1, ("k", "not_null"): 2, ("s", "not_null"): 1, ("s", "accepted_values"): 1}
    assert unexpected_values(df, "s", ["Active", "Terminated"]).first().n_records == 2
    with pytest.raises(ValueError):
        run_checks({"m": df}, [Check("m", "k", "relationships")])
