"""Splitting hot keys so that an ordered window never has to hold one in a task.

Spark runs a window over ``partitionBy(key)`` in one task per key value. If one
key owns a third of the table, that task does a third of the work. Adaptive
execution splits skewed joins, not skewed windows, so the split is made here:

* count rows per key (map-side combined; only key columns are scanned);
* if no key exceeds ``max_rows`` nothing is changed: one plain window;
* otherwise the rows of the hot keys alone are range-partitioned by key and
  sort order and written to the shared scratch folder with their partition
  number. Each hot key then consists of pieces that follow one another, and
  the window runs per ``(key, piece)``. A row at the edge of a piece takes its
  neighbour from a table with one row per piece of a hot key.

Spark's range partitioning uses the window's own ordering, so the result is
exact wherever it cuts; the cuts only balance the work. The written table makes
the piece numbers the same in every plan and survives lost executors.

The number of rows per piece does not depend on the size of the table. Tables of
hot keys and of pieces have one row per ``max_rows`` rows at most; they are
broadcast while they have no more than ``SMALL`` rows and joined by shuffle beyond.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import asc, desc, null_safe_equal, order_struct
from ..session import scratch_dir

PIECE = "_piece"
SMALL = 10_000
MAX_ROWS = 2_000_000


@dataclass(frozen=True)
class KeySplit:
    """The rows of a table with hot keys divided; unchanged if there are none."""

    keys: tuple[str, ...]
    rows: DataFrame  # with PIECE if hot: -1 for ordinary keys
    hot_rows: DataFrame | None = None
    small: bool = True  # whether tables of hot keys and pieces may be broadcast

    @property
    def hot(self) -> bool:
        return self.hot_rows is not None

    @property
    def by(self) -> list[str]:
        """Columns that identify one unit of work."""
        return [*self.keys, PIECE] if self.hot else list(self.keys)

    def fan_out(self, df: DataFrame) -> DataFrame:
        """Copy rows of a hot key to each of its pieces, to join ``rows`` on ``by``."""
        if not self.hot:
            return df
        pieces = self.hot_rows.groupBy(*self.keys).agg(F.collect_set(PIECE).alias("_pieces"))
        copies = F.explode(F.coalesce("_pieces", F.array(F.lit(-1))))
        return attach(df, pieces, self.keys, self.small).select(*df.columns, copies.alias(PIECE))


def attach(df: DataFrame, other: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Left join a table with one row per key; its first columns correspond to ``keys``."""
    names = [f"_k{i}" for i in range(len(keys))]
    other = other.toDF(*names, *other.columns[len(names) :])
    return df.join(F.broadcast(other) if small else other, null_safe_equal(keys, names), "left").drop(*names)


def write_pieces(df: DataFrame, order: Sequence[str], pieces: int) -> DataFrame:
    """The rows with the number of the stretch of the sort order they fall into."""
    path = scratch_dir(df.sparkSession, "pieces")
    ranged = df.repartitionByRange(pieces, *asc(*order)).withColumn(PIECE, F.spark_partition_id())
    ranged.write.parquet(path)
    return df.sparkSession.read.schema(ranged.schema).parquet(path)


def split_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int = MAX_ROWS,
) -> KeySplit:
    """Divide keys that have too many rows for one task.

    ``order`` should end with a column that is unique within a key: rows that
    are equal in all of its columns cannot be told apart and stay together.
    One job counts. Only when some key is hot are the rows of the hot keys
    written out, once.
    """
    keys = tuple(keys)
    hot_sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows)
    found = hot_sizes.limit(SMALL + 1).collect()
    if not found:
        return KeySplit(keys, df)

    spark = df.sparkSession
    if len(found) <= SMALL:
        hot_keys = spark.createDataFrame(found, hot_sizes.schema)
        pieces = sum(ceil(row["_n"] / max_rows) for row in found)
    else:
        path = scratch_dir(spark, "hot-keys")
        hot_sizes.write.parquet(path)
        hot_keys = spark.read.schema(hot_sizes.schema).parquet(path)
        pieces = hot_keys.agg(F.sum(F.ceil(F.col("_n") / max_rows))).first()[0]

    marked = attach(df, hot_keys, keys, len(found) <= SMALL)
    hot = marked.where("_n IS NOT NULL").drop("_n")
    hot_rows = write_pieces(hot, [*keys, *order], int(pieces))
    ordinary = marked.where("_n IS NULL").drop("_n").withColumn(PIECE, F.lit(-1))
    # a cut can add one (key, piece) to each key
    return KeySplit(keys, ordinary.unionByName(hot_rows), hot_rows, pieces + len(found) <= SMALL)


def with_neighbour(
    df: DataFrame,
    split: KeySplit,
    order: Sequence[str],
    column: str,
    alias: str,
    step: int,
) -> DataFrame:
    """LEAD (``step=1``) or LAG (``step=-1``) of one column.

    ``df`` holds the rows of the split, or a join with them that adds columns to
    ``order`` at most behind those of the split. Neighbours across a cut come from
    the split's own rows, so the join is not run for them.
    """
    shift = F.lead if step == 1 else F.lag
    window = Window.partitionBy(*split.by).orderBy(*asc(*order))
    if not split.hot:
        return df.withColumn(alias, shift(column).over(window))

    # A struct is NULL only where there is no row, never for a NULL value.
    boxed = F.struct(F.col(column).alias("v"))
    outer = F.min_by if step == 1 else F.max_by
    own = [c for c in order if c in split.hot_rows.columns]
    edges = (
        split.hot_rows.groupBy(*split.by)
        .agg(outer(boxed, order_struct(own)).alias("_box"))
        .withColumn("_far", shift("_box").over(Window.partitionBy(*split.keys).orderBy(PIECE)))
        .drop("_box")
    )  # one row per piece of a hot key
    near = df.withColumn("_near", shift(boxed).over(window))
    return attach(near, edges, split.by, split.small).withColumn(
        alias, F.when(F.col("_near").isNotNull(), F.col("_near.v")).otherwise(F.col("_far.v"))
    ).drop("_near", "_far")


def with_rank_from_end(df: DataFrame, split: KeySplit, order: Sequence[str], alias: str) -> DataFrame:
    """1 for the last row of each key in ``order``, 2 for the one before, and so on."""
    window = Window.partitionBy(*split.by).orderBy(*desc(*order))
    ranked = df.withColumn(alias, F.row_number().over(window).cast("long"))
    if not split.hot:
        return ranked
    later = Window.partitionBy(*split.keys).orderBy(PIECE).rowsBetween(1, Window.unboundedFollowing)
    edges = (
        split.hot_rows.groupBy(*split.by)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_later", F.sum("_rows").over(later))
        .drop("_rows")
    )
    return attach(ranked, edges, split.by, split.small).withColumn(
        alias, F.col(alias) + F.coalesce("_later", F.lit(0))
    ).drop("_later")
