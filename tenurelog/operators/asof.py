"""Points joined to the interval that holds them, without a range join.

``point BETWEEN start AND end`` is no equality, so Spark compares every point of a
key with every interval of it. Here points and interval starts of a key are put in
one order, and each point takes the last start before it: one exchange and one
window, linear in both. Keys with very many rows are divided as for any window
(:mod:`.skew`); what the pieces before a piece ended with comes from a table with
one row per piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import asc, order_struct
from .skew import MAX_ROWS, PIECE, attach, split_hot_keys

AT, POINT, TIE = "_at", "_point", "_tie"


def as_of_join(
    points: DataFrame,
    intervals: DataFrame,
    *,
    key: str,
    at: str,
    start: str,
    end: str,
    tie_break: Sequence[str] = (),
    carry: Sequence[str] = (),
    inner: bool = False,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Each point with the columns ``carry`` of the interval of its key that holds it, both ends included.

    Equals a left join (``inner`` keeps only points that found one) on ``key`` and
    ``at BETWEEN start AND end`` for intervals of one key that do not overlap, as
    histories are. Of overlapping ones the one that began last is looked at, by
    ``tie_break`` if they began together. Intervals that are empty or have no
    bound hold nothing, nor does a NULL key or point match. All points are kept,
    repeated ones too.
    """
    clash = set(carry) & set(points.columns)
    if clash:
        raise ValueError(f"points have columns of the same name: {sorted(clash)}")
    same = points.schema[key].dataType
    whole = F.struct(*[F.col(f"`{c}`") for c in points.columns])
    held = F.struct(F.col(end).alias("until"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    ties = [f"{TIE}{i}" for i in range(len(tie_break))]

    some = points.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    none = points.where(F.col(key).isNull() | F.col(at).isNull())
    # An interval goes before the points of the day it begins on.
    left = some.select(F.col(key).alias("_key"), F.col(at).alias(AT), F.lit(1).alias(POINT), whole.alias("_row"), F.monotonically_increasing_id().alias("_row_id"))
    right = intervals.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end))).select(
        F.col(key).cast(same).alias("_key"),
        F.col(start).cast(points.schema[at].dataType).alias(AT),
        F.lit(0).alias(POINT),
        held.alias("_held"),
        *[F.col(c).alias(t) for c, t in zip(tie_break, ties)],
    )
    both = right.unionByName(left, allowMissingColumns=True)
    order = [AT, POINT, *ties, "_row_id"]
    split = split_hot_keys(both, ["_key"], order, max_rows)
    before = Window.partitionBy(*split.by).orderBy(*asc(*order)).rowsBetween(Window.unboundedPreceding, 0)
    found = split.rows.withColumn("_last", F.last("_held", ignorenulls=True).over(before)).where(F.col(POINT) == 1)
    if split.hot:
        begins = F.col(POINT) == 0
        earlier = Window.partitionBy("_key").orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
        edges = (
            split.hot_rows.groupBy("_key", PIECE)
            .agg(F.max_by(F.when(begins, F.col("_held")), F.when(begins, order_struct(order))).alias("_box"))
            .withColumn("_far", F.last("_box", ignorenulls=True).over(earlier))
            .drop("_box")
        )  # one row per piece of a hot key
        found = attach(found, edges, split.by, split.small).withColumn("_last", F.coalesce("_last", "_far"))
    # The last interval to begin may have ended before the point.
    hit = F.col("_last").isNotNull() & (F.col(AT) <= F.col("_last.until"))
    joined = found.where(hit) if inner else found
    out = joined.select("_row.*", *[F.when(hit, F.col(f"_last.c{i}")).alias(c) for i, c in enumerate(carry)])
    if inner:
        return out
    types = {f.name: f.dataType for f in out.schema}
    return out.unionByName(none.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in carry]))
