from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenurelog.operators import StepTable, interval_snapshot, scd2_from_changes

SCHEMA = "who int, grp string, a date, b date, kind string"
day = st.integers(0, 25).map(lambda n: date(2024, 1, 1) + timedelta(n))
change = st.tuples(st.sampled_from([1, 2, 3, 4]), day, st.sampled_from(["x", "y", None]), st.sampled_from(["new", "old", None]))


def spans(spark, changes):
    """One history per entity, whose intervals do not overlap."""
    rows = [(*c, i) for i, c in enumerate(changes)]
    df = spark.createDataFrame(rows, "who int, day date, grp string, kind string, id int")
    out = scd2_from_changes(df, key="who", effective="day", tie_break=["id"], carry=["grp", "kind"])
    return out.withColumnsRenamed({"effective_from": "a", "effective_to": "b"})


def starts():
    return {"new": F.col("kind") == "new"}


def table(spark, path):
    return StepTable(spark, str(path), dims=["grp"], entity="who", start="a", end="b", starts=starts(), buckets=2)


def full(df, bounds):
    return interval_snapshot(df, dims=["grp"], entity="who", start="a", end="b", bounds=bounds, starts=starts(), disjoint=True)


def canon(df):
    return sorted(tuple(str(r[c]) for c in ("report_date", "grp", "headcount", "new")) for r in df.collect())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, max_size=12), st.lists(change, max_size=12), st.integers(0, 20), st.integers(0, 30))
def test_corrected_steps_equal_a_full_count(spark, tmp_path_factory, one, two, lo, length):
    bounds = (date(2024, 1, 1) + timedelta(lo), date(2024, 1, 1) + timedelta(lo + length))
    steps = table(spark, tmp_path_factory.mktemp("steps") / "t")
    before, after = spans(spark, one), spans(spark, two)
    steps.apply(None, before)
    if one:
        assert canon(steps.counts(bounds)) == canon(full(before, bounds))
    # entity 1 stays as it was
    kept = spans(spark, [c for c in one if c[0] == 1] + [c for c in two if c[0] != 1])
    steps.apply(before.where("who != 1"), after.where("who != 1"))
    if one or two:
        assert canon(steps.counts(bounds)) == canon(full(kept, bounds))


def test_a_replayed_batch_and_an_unchanged_history_change_nothing(spark, tmp_path):
    steps = table(spark, tmp_path / "t")
    with pytest.raises(LookupError):
        steps.counts((date(2024, 1, 1), date(2024, 1, 9)))
    history = spans(spark, [(1, date(2024, 1, 2), "x", "new"), (1, date(2024, 1, 5), "y", "old"), (2, date(2024, 1, 2), None, "new")])
    assert steps.apply(None, history, writer="w", batch_id=0)
    assert not steps.apply(None, history, writer="w", batch_id=0)
    folders = steps.table.state().folders
    steps.apply(history, history, writer="w", batch_id=1)
    assert steps.table.state().folders == folders, "an interval in both is no change"
    bounds = (date(2024, 1, 1), date(2024, 1, 9))
    assert canon(steps.counts(bounds)) == canon(full(history, bounds))
    assert steps.counts(None).count() == 0
