"""Contiguous shards of nearly equal size from global prefix sums of bytes.

The sizes (not the texts) are range-partitioned by id and written once with their
partition number. One total per partition comes back to the driver; their prefix
sums say where each partition begins in the whole. Inside a partition a running
sum does the rest, so no task and no driver ever sees all rows. Shard k is what
lies between k and k + 1 parts of the total; a document belongs where its middle
byte lies.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .workspace import ID, TEXT, Workspace, texts


def byte_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Documents are taken in the order of their ids, NULL first; rows with one id
    follow one another in an order that is fixed when the sizes are written.
    ``size`` is the text's UTF-8 bytes plus one, 1 for NULL, so empty texts
    count. ``shard`` runs from 0 to ``shards - 1`` and ``slot`` from 0 in each
    shard without gaps. No shard is off the equal share by more than the largest
    document. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "shards")
    text = F.coalesce(TEXT, F.lit(""))
    sized = texts(docs, id_col, text_col).select(
        ID, (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    # The row number parts rows with one id, so that many of them need not share a partition.
    ranged = sized.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(ID, "tie")
    table = work.write(ranged.withColumn("part", F.spark_partition_id()), "sizes")

    # One row per partition.
    parts = table.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before = list(accumulate((p["bytes"] for p in parts), initial=0))
    rows = list(accumulate((p["n"] for p in parts), initial=0))
    starts = spark.createDataFrame(
        [(p["part"], b, r) for p, b, r in zip(parts, before, rows)], "part int, part_bytes long, part_rows long"
    )
    total = max(1, before[-1])

    within = Window.partitionBy("part").orderBy(F.col(ID).asc_nulls_first(), "tie")
    middle = 2 * (F.col("part_bytes") + F.sum("size").over(within)) - F.col("size")  # twice the middle byte
    placed = table.join(F.broadcast(starts), "part").withColumn("middle", middle).select(
        ID,
        "size",
        "text_crc32",
        F.expr(f"cast(middle * {shards} div {2 * total} AS int)").alias("shard"),
        (F.col("part_rows") + F.row_number().over(within) - 1).alias("row"),
    )
    placed = work.write(placed, "placed")
    # The first row of each shard: as many numbers as shards.
    first = {r["shard"]: r["row"] for r in placed.groupBy("shard").agg(F.min("row").alias("row")).collect()}
    base = F.coalesce(*[F.when(F.col("shard") == s, F.lit(n)) for s, n in first.items()], F.lit(0).cast("long"))
    return placed.select(
        F.col(ID).alias(id_col), "size", "text_crc32", "shard", (F.col("row") - base).cast("long").alias("slot")
    )
