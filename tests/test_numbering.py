from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tenurelog.operators import export_pages, number_rows


def test_numbers_follow_the_order_whatever_the_names(spark):
    rows = [(k % 7 if k % 5 else None, k) for k in range(500)]
    df = spark.createDataFrame(rows, "`_place` int, `_tie` int").repartition(9)
    got = number_rows(df, [F.col("_place").desc_nulls_last(), F.col("_tie").asc()], "n").collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r[0], r[1]) for r in sorted(got, key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in got) == list(range(1, 501))


def test_equal_rows_are_spread_and_numbered_without_gaps(spark):
    same = spark.range(4000, numPartitions=8).select(F.lit("x").alias("k"))
    # adaptive execution would join partitions as small as these
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(same, [F.col("k").asc()])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["row_number"] for r in numbered.select("row_number").collect()) == list(range(1, 4001))
    folder = Path(numbered.inputFiles()[0].removeprefix("file://")).parent
    assert len(list(folder.glob("part-*.parquet"))) > 1, "equal rows must not meet in one task"


def test_pages_are_whole_and_in_order(spark, tmp_path):
    folder = str(tmp_path / "out")
    df = spark.range(1000, numPartitions=6).select((F.lit(999) - F.col("id")).alias("v"))
    got = export_pages(df, [F.col("v").asc()], folder, 64).collect()
    assert all(r["row_number"] == r["v"] + 1 and r["page"] == r["v"] // 64 + 1 for r in got)
    assert len(got) == 1000
    assert sorted(int(n.split("=")[1]) for n in os.listdir(folder) if n.startswith("page=")) == list(range(1, 17))
    with pytest.raises(FileExistsError):
        export_pages(df, [F.col("v").asc()], folder, 64)


def test_pages_as_json_of_an_empty_table_and_wrong_names(spark, tmp_path):
    none = spark.createDataFrame([], "v long")
    assert export_pages(none, [F.col("v").asc()], str(tmp_path / "none"), 10, file_format="json").collect() == []
    with pytest.raises(ValueError):
        export_pages(none, [F.col("v").asc()], str(tmp_path / "zero"), 0)
    with pytest.raises(ValueError):
        number_rows(none.withColumn("row_number", F.lit(1)), [F.col("v").asc()])
