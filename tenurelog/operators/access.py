"""Reading changed rows, pages and live counts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Bounds of one page.
MIN_LIMIT, MAX_LIMIT = 1, 100
# Length of a time in text form, cut to a unit, and the unit.
UNITS = {10: timedelta(days=1), 13: timedelta(hours=1), 16: timedelta(minutes=1), 19: timedelta(seconds=1)}


def updated_since(
    df: DataFrame,
    cutoff: str | None,
    *,
    updated: str = "updated_at",
    created: str | None = "created_at",
) -> DataFrame:
    """Rows changed at or after ``cutoff``; without a cutoff, all rows.

    A row without an update time falls back to its creation time; with neither
    it is dropped. Text columns may hold ISO times, an empty text is absent.
    The condition is written without COALESCE so that on timestamp columns
    parquet can skip row groups by it.
    """
    if not cutoff:
        return df
    at = F.lit(cutoff).cast("timestamp_ntz")
    present = _time(df, updated)
    changed = present >= at
    if created is not None:
        changed = changed | (present.isNull() & (_time(df, created) >= at))
    return df.where(changed)


def _time(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, StringType):
        return F.nullif(F.col(name), F.lit("")).cast("timestamp_ntz")
    return F.col(name)


@dataclass(frozen=True)
class Page:
    total: int
    offset: int
    limit: int
    has_more: bool
    data: DataFrame


def _check_limit(limit: int) -> None:
    if not MIN_LIMIT <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must lie between {MIN_LIMIT} and {MAX_LIMIT}")


def page(df: DataFrame, *, newest: str, key: str, offset: int = 0, limit: int = 20) -> Page:
    """One slice of the rows sorted by ``newest`` descending, missing ones last.

    Ties go by ``key``. Rows are counted per day (one small row per day and
    task), which gives the total and the days that hold the page; within them per
    hour, minute and second. The rest of the table is filtered out by a range
    on the column itself, which reaches the scan, and only what is left is sorted.
    """
    if offset < 0:
        raise ValueError("offset must not be negative")
    _check_limit(limit)
    at = _time(df, newest).cast("timestamp_ntz")
    rows, skip, total = df, offset, None
    for length, unit in UNITS.items():
        sizes = rows.groupBy(F.substring(at.cast("string"), 1, length).alias("at")).count().collect()
        if total is None:
            total = sum(r["count"] for r in sizes)
        sizes.sort(key=lambda r: (r["at"] is not None, r["at"]), reverse=True)
        before, wanted = 0, []
        for r in sizes:
            if not wanted and before + r["count"] <= skip:
                before += r["count"]
            elif sum(w["count"] for w in wanted) < skip - before + limit:
                wanted.append(r)
            else:
                break
        if not wanted:
            rows = rows.where(F.lit(False))
            break
        rows, skip = rows.where(_between(at, wanted, unit)), skip - before
        if all(w["at"] is None for w in wanted):
            break
    data = rows.orderBy(at.desc_nulls_last(), F.col(key).asc_nulls_last()).offset(skip).limit(limit)
    return Page(total, offset, limit, offset + limit < total, data)


def _between(at: Column, wanted: list, unit: timedelta) -> Column:
    """Whether a time lies in the wanted units, which follow one another; the last may be the missing times."""
    known = [datetime.fromisoformat(w["at"]) for w in wanted if w["at"] is not None]
    missing = at.isNull() if len(known) < len(wanted) else F.lit(False)
    if not known:
        return missing
    low, high = (F.lit(str(t)).cast("timestamp_ntz") for t in (min(known), max(known) + unit))
    inside = (at >= low) & (at < high)
    return inside if len(known) == len(wanted) else inside | missing


def page_after(df: DataFrame, *, newest: str, key: str, after: tuple | None = None, limit: int = 20) -> DataFrame:
    """The rows that follow ``after``, the (newest, key) of the last row seen; without it the first ones.

    For reading a whole table page by page: no row before the page is counted or
    sorted. Keys must not be NULL.
    """
    _check_limit(limit)
    at = _time(df, newest).cast("timestamp_ntz")
    rows = df
    if after is not None:
        seen, last = after
        further = F.col(key) > F.lit(last)
        if seen is None:
            rows = df.where(at.isNull() & further)
        else:
            then = F.lit(str(seen)).cast("timestamp_ntz")
            rows = df.where((at < then) | ((at == then) & further) | at.isNull())
    return rows.orderBy(at.desc_nulls_last(), F.col(key)).limit(limit)


def status_counts(df: DataFrame, *, status: str, active: str = "Active") -> DataFrame:
    """Number of rows and number of active ones, in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("worker_count"),
        F.count_if(F.col(status) == active).alias("active_workers"),
    )
