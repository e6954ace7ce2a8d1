"""The incremental loads as Structured Streaming jobs.

Ranking rows is not allowed on a stream, so each micro-batch is merged as a
batch. The table's log keeps the last batch merged from each stream, so a batch
that is replayed after a failure is recognised, also when others have changed the
table in between; everything that arrived is processed, late or not.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.history import scd2_from_changes
from ..sources.table import KeyedTable


def merge_batch(
    batch: DataFrame,
    batch_id: int,
    table: KeyedTable,
    build: Callable[[DataFrame], DataFrame],
    writer: str,
    *,
    watermark: str | None = None,
    then: Callable[[DataFrame], None] | None = None,
) -> bool:
    """Merge one micro-batch; False if this batch of this writer was merged before."""
    state = table.state()
    if state is not None and state.batches.get(writer, -1) >= batch_id:
        if then is not None:  # it may not have run to its end
            then(build(batch))
        return False
    merged = table.replace(build(batch), watermark=watermark, writer=writer, batch_id=batch_id)
    if then is not None and merged is not None:
        then(merged)
    return merged is not None


def stream_upsert(
    stream: DataFrame,
    table: KeyedTable,
    build: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    *,
    watermark: str | None = None,
    then: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Merge all that has arrived into ``table`` and stop.

    ``build`` gives one row per key of a batch. ``then`` is called with the
    merged rows of each batch, for tables that depend on this one; a replayed
    batch calls it again.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        # The id of the query, which its checkpoint keeps: a new checkpoint
        # starts a new query whose batches count from 0 again.
        kept = batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0]
        merge_batch(batch, batch_id, table, build, json.loads(kept)["id"], watermark=watermark, then=then)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_history(
    history: KeyedTable,
    changes: DataFrame,
    touched: DataFrame,
    *,
    key: str,
    effective: str,
    tie_break: Sequence[str],
    carry: Sequence[str],
    change_key: str | None = None,
) -> bool:
    """Rebuild the intervals of the touched keys only.

    ``changes`` are all changes that count now, ``touched`` the new versions of
    changes, whatever their status: a change that was withdrawn must leave the
    history too, so they must not be filtered. All changes of a touched key are
    read, not just the new ones, as a back-dated change splits an interval that was
    built before. ``change_key`` names the id of a change among the carried
    columns; with it a change that now belongs to another key is also taken out of
    the history of its former one.
    """
    keys = touched.select(key)
    if change_key is not None:
        before = history.read()
        if before is not None:
            moved = touched.select(change_key).distinct()
            keys = keys.union(before.select(key, change_key).join(moved, change_key, "left_semi").select(key))
    keys = keys.where(F.col(key).isNotNull()).distinct()
    affected = changes.join(keys, key, "left_semi")
    rebuilt = scd2_from_changes(affected, key=key, effective=effective, tie_break=tie_break, carry=carry)
    return history.replace(rebuilt, keys=keys) is not None
