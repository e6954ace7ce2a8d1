"""Global row numbers, and exports of a whole table in order.

``row_number()`` over a whole table runs in one task. Here the rows are
range-partitioned by the order, sorted inside each partition and written once to
the shared scratch folder with their place. One count per partition comes back
to the driver; the sum of the counts before it says where a partition begins.
The written table makes the numbers the same in every plan and after the loss of
an executor.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import path_exists, scratch_dir

PLACE_BITS = 33  # fixed value: monotonically_increasing_id has the partition above and the row in it below
SMALL = 10_000  # a table of so many partitions is broadcast, a larger one joined by shuffle


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """The rows and, as the new column ``name``, their number from 1 in the given order.

    Rows that are equal in ``order`` are numbered in an order that is fixed when
    they are written; they need not share a partition, so very many equal rows
    do no harm. An empty table gives an empty result.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    spark = df.sparkSession
    place, tie, part, before = (_unused(df, n) for n in ("_place", "_tie", "_part", "_before"))
    by = [*order, F.col(tie)]
    sorted_ = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    placed = sorted_.withColumn(place, F.monotonically_increasing_id()).drop(tie)
    path = scratch_dir(spark, "numbered")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path).withColumn(part, F.shiftright(place, PLACE_BITS).cast("int"))

    sizes = placed.groupBy(part).agg(F.count(F.lit(1))).orderBy(part).collect()  # one number per partition
    sums = accumulate((n for _, n in sizes), initial=0)
    starts = spark.createDataFrame([(p, s) for (p, _), s in zip(sizes, sums)], f"{part} int, {before} long")
    joined = placed.join(F.broadcast(starts) if len(sizes) <= SMALL else starts, part)
    inside = F.col(place).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(before) + inside + 1).alias(name))


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def export_pages(
    df: DataFrame,
    order: Sequence[Column],
    folder: str,
    page_rows: int,
    *,
    file_format: str = "parquet",
    number: str = "row_number",
    page: str = "page",
) -> DataFrame:
    """Write all rows in order as pages of ``page_rows`` rows, and return them as read back.

    Each page is a folder ``page=N``, counted from 1, and each row has its number in
    the whole. A page that lies across two partitions has two files. Rows are
    shuffled once, by the order; writing the pages needs no further exchange.
    ``folder`` must not exist: an export is never mixed with another one. A table
    without rows gives a folder without pages.
    """
    if page_rows < 1:
        raise ValueError("a page has at least one row")
    if page in df.columns:
        raise ValueError(f"there is a column {page} already")
    spark = df.sparkSession
    if path_exists(spark, folder):
        raise FileExistsError(folder)
    numbered = number_rows(df, order, number)
    paged = numbered.withColumn(page, F.expr(f"cast((`{number}` - 1) div {page_rows} + 1 AS bigint)"))
    paged.write.partitionBy(page).format(file_format).save(folder)
    return spark.read.schema(paged.schema).format(file_format).load(folder)
