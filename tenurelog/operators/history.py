"""Validity intervals (slowly changing dimension, type 2) from dated changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import open_end
from .skew import MAX_ROWS, PIECE, KeySplit, split_hot_keys, with_neighbour, with_rank_from_end


def scd2_from_changes(
    changes: DataFrame,
    *,
    key: str,
    effective: str,
    tie_break: Sequence[str] = (),
    carry: Sequence[str] = (),
    rank: str | None = None,
    collapse_same_day: bool = False,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per change: it is valid from its date to the day before the next.

    Both ends are inclusive and the last interval ends on 9999-12-31. Two
    changes on one day leave the earlier an empty interval (it ends the day
    before it starts); ``collapse_same_day`` drops those rows. A NULL date
    sorts last, and both it and its predecessor are then open. ``rank`` names
    an optional column that counts back from the newest change.
    """
    order = [effective, *tie_break]
    split = split_hot_keys(changes, [key], order, max_rows)
    return intervals(split, effective, order, carry, rank, collapse_same_day).drop(PIECE)


def intervals(
    split: KeySplit,
    effective: str,
    order: Sequence[str],
    carry: Sequence[str],
    rank: str | None = None,
    collapse_same_day: bool = False,
) -> DataFrame:
    """The same for changes already split; keeps the columns they are split by."""
    dated = with_neighbour(split.rows, split, order, effective, "_next", 1)
    if rank:
        dated = with_rank_from_end(dated, split, order, rank)
    until = F.coalesce(F.date_sub("_next", 1), open_end())
    out = dated.select(
        *split.by,
        *carry,
        F.col(effective).alias("effective_from"),
        until.alias("effective_to"),
        current_flag(until).alias("is_current"),
        *([rank] if rank else []),
    )
    if collapse_same_day:
        out = out.where(F.col("effective_from").isNull() | (F.col("effective_from") <= F.col("effective_to")))
    return out


def current_flag(until: Column) -> Column:
    """TRUE for an open interval, FALSE for any other and for NULL."""
    return F.when(until == open_end(), F.lit(True)).otherwise(F.lit(False))
