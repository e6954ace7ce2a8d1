from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenurelog.operators import as_of_join, scd2_from_changes

day = st.one_of(st.none(), st.integers(1, 20).map(lambda n: date(2024, 1, n)))
key = st.sampled_from(["a", "b", "c", None])


def canon(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def join(points, spans, **options):
    return as_of_join(points, spans, key="k", at="day", start="effective_from", end="effective_to", carry=["id", "effective_from"], **options)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(key, day, st.integers(0, 3)), max_size=25),
    st.lists(st.tuples(key, day), max_size=15),
    st.sampled_from([2, 1000]),
)
def test_equals_the_range_join(spark, points, changes, max_rows):
    p = spark.createDataFrame([(*r, None) for r in points], "k string, day date, n int, _row string")
    c = spark.createDataFrame([(k, d, i) for i, (k, d) in enumerate(changes)], "k string, day date, id int")
    spans = scd2_from_changes(c, key="k", effective="day", tie_break=["id"], carry=["id"])
    s = spans.withColumnRenamed("k", "sk")
    for inner, how in ((False, "left"), (True, "inner")):
        want = p.join(s, (p.k == s.sk) & p.day.between(s.effective_from, s.effective_to), how).select(*p.columns, "id", "effective_from")
        got = join(p, spans, inner=inner, max_rows=max_rows)
        assert got.columns == want.columns and canon(got) == canon(want)


def test_no_comparison_of_all_points_with_all_spans(spark):
    points = spark.range(100).select((F.col("id") % 3).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    spans = points.select("k", F.col("day").alias("effective_from"), F.col("day").alias("effective_to"), F.lit(1).alias("id"))
    plan = join(points.withColumn("x", F.lit(1)), spans)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError):
        join(points.withColumn("id", F.lit(1)), spans)
