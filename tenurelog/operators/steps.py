"""Daily counts kept as steps, corrected by what has changed.

:func:`.snapshot.interval_snapshot` counts from all intervals each time. Here the
+1 on an interval's first day and the -1 after its last are kept, summed per group
and day, in a table. When intervals change, late, moved or withdrawn, the steps of
the old ones are taken off and those of the new ones added: the work follows the
number of changed intervals and the rows they touch, not the number of all.

Steps are kept without a calendar. It is applied when the counts are read, so its
ends may move from one day to the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import OPEN_END
from ..sources.table import BUCKETS, KeyedTable

KEY, DAY, ROWS, NET = "_key", "_day", "_rows", "_net"


class StepTable:
    """The steps of one count in a keyed table; ``starts`` are conditions counted on the day an interval starts.

    Intervals of one entity in one group must not share a day, as in a history:
    then the entities of a day are its intervals.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        dims: Sequence[str],
        entity: str,
        start: str,
        end: str,
        starts: Mapping[str, Column] | None = None,
        buckets: int = BUCKETS,
    ):
        self.spark, self.dims, self.entity, self.start, self.end = spark, list(dims), entity, start, end
        self.starts = dict(starts or {})
        self.table = KeyedTable(spark, path, KEY, buckets)

    @property
    def _sums(self) -> list[str]:
        return [ROWS, NET, *self.starts]

    def _steps(self, intervals: DataFrame, sign: int) -> DataFrame:
        one, none = F.lit(sign).cast("long"), F.lit(0).cast("long")
        known = F.col(self.entity).isNotNull()

        def step(day: Column, by: Column, counted: bool) -> Column:
            events = [(F.when(c, one).otherwise(none) if counted else none).alias(e) for e, c in self.starts.items()]
            return F.struct(day.alias(DAY), by.alias(ROWS), F.when(known, by).otherwise(none).alias(NET), *events)

        first = step(F.col(self.start), one, True)
        behind = F.when(F.col(self.end) < F.lit(OPEN_END).cast("date"), step(F.date_add(self.end, 1), -one, False))
        # The condition removes NULL and inverted intervals, which cover no day.
        live = intervals.where(F.col(self.start) <= F.col(self.end))
        steps = live.select(*self.dims, F.explode(F.array(first, behind)).alias("_s")).where("_s IS NOT NULL")
        return steps.select(*self.dims, "_s.*")

    def apply(self, before: DataFrame | None, after: DataFrame | None, *, writer: str | None = None, batch_id: int | None = None) -> bool:
        """Replace the intervals ``before`` by ``after``; False if this batch of this writer was applied already.

        Both hold the intervals of the entities that changed, whole, as they were and
        as they are. An interval that is in both changes nothing.
        """
        state = self.table.state()
        if writer is not None and state is not None and state.batches.get(writer, -1) >= batch_id:
            return False
        parts = [self._steps(df, sign) for df, sign in ((before, -1), (after, 1)) if df is not None]
        delta = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        keyed = F.sha2(F.to_json(F.struct(*self.dims, DAY)), 256).alias(KEY)
        changed = F.lit(False)
        for c in self._sums:
            changed = changed | (F.col(c) != 0)
        delta = delta.groupBy(*self.dims, DAY).agg(*[F.sum(c).alias(c) for c in self._sums]).where(changed).select(keyed, "*")
        old = self.table.read(state) if state is not None else None
        if old is None:
            fresh = delta
        else:
            # Only rows of touched keys are read on from here.
            touched = old.join(delta.select(KEY), KEY, "left_semi")
            both = touched.unionByName(delta)
            fresh = both.groupBy(KEY, *self.dims, DAY).agg(*[F.sum(c).alias(c) for c in self._sums])
        self.table.replace(fresh, writer=writer, batch_id=batch_id)
        return True

    def counts(self, bounds: tuple[date, date] | None, count: str = "headcount", day: str = "report_date") -> DataFrame:
        """The same rows as :func:`.snapshot.interval_snapshot` over all intervals, from the steps alone."""
        steps = self.table.read()
        if steps is None:
            raise LookupError("no interval was ever applied")
        if bounds is None:
            bounds, steps = (date(1970, 1, 1), date(1970, 1, 1)), steps.where(F.lit(False))
        lo, hi = (F.lit(b.isoformat()).cast("date") for b in bounds)
        inside = F.col(DAY) >= lo  # what began earlier counts from the first day, but did not start on it
        daily = (
            steps.where(F.col(DAY) <= hi)
            .groupBy(*self.dims, F.greatest(F.col(DAY), lo).alias(DAY))
            .agg(F.sum(ROWS).alias(ROWS), F.sum(NET).alias(NET), *[F.sum(F.when(inside, F.col(e)).otherwise(0)).alias(e) for e in self.starts])
        )
        by_day = Window.partitionBy(*self.dims).orderBy(DAY)  # a row per calendar day and group at most
        runs = daily.select(
            *self.dims,
            DAY,
            F.coalesce(F.date_sub(F.lead(DAY).over(by_day), 1), hi).alias("_last"),
            F.sum(ROWS).over(by_day).alias("_covered"),
            F.sum(NET).over(by_day).alias("_count"),
            *self.starts,
        ).where("_covered > 0")
        first = F.col(day) == F.col(DAY)
        return runs.withColumn(day, F.explode(F.sequence(DAY, "_last"))).select(
            day,
            *self.dims,
            F.col("_count").alias(count),
            *[F.when(first, F.col(e)).otherwise(F.lit(0).cast("long")).alias(e) for e in self.starts],
        )
