"""Intermediate tables in the shared scratch folder, and small frame helpers."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_path, scratch_dir

ID, TEXT = "_id", "_text"
BATCH_ROWS = 1000


class Workspace:
    """A fresh folder under ``spark.checkpoint.dir`` for the tables of one run.

    A table written here cuts the lineage: it is the same each time it is read
    and outlives the executors that wrote it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.count = spark, scratch_dir(spark, name), 0
        self.paths: list[str] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{self.count:03d}-{name}"
        self.count += 1
        df.write.option("compression", "zstd").parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        self.paths.append(path)
        return table

    def write_counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """The table and its rows, counted while they are written; a job of its own would only add plans and stages."""
        seen = Observation()
        table = self.write(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
        return table, seen.get.get("n") or 0  # nothing is observed where Spark finds the table empty

    def drop(self, table: DataFrame | None) -> None:
        """Delete a table that no result reads any more."""
        path = getattr(table, "_scratch_path", None)
        if path in self.paths:
            drop_path(self.spark, path)
            self.paths.remove(path)

    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all other tables of this run."""
        kept = {getattr(t, "_scratch_path", None) for t in tables}
        for path in [p for p in self.paths if p not in kept]:
            drop_path(self.spark, path)
            self.paths.remove(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    The archive is made on the driver and handed to Spark, which copies it to
    every executor, also to those that join later.
    """
    sc = spark.sparkContext
    if getattr(sc, "_shipped_package", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._shipped_package = True


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand rows to Python a few MB of text at a time; a smaller setting of the session stays.

    A batch lies in the memory of the task and of its Python worker, going in
    and coming out, so its size counts several times.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def texts(docs: DataFrame, id_col: str, text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Id and text, and the columns to keep, under names that no column of ``docs`` can clash with."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    return docs.select(
        F.col(f"`{id_col}`").alias(ID),
        F.col(f"`{text_col}`").cast("string").alias(TEXT),
        *[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)],
    )


def kept_schema(base: DataFrame) -> str:
    """The schema of id and kept columns, as text."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema if f.name == ID or f.name.startswith("_keep"))


def restored(df: DataFrame, id_col: str, keep: Sequence[str]) -> DataFrame:
    """Outer names again: the kept columns, or else the id, and then the rest."""
    inner = [f"_keep{i}" for i in range(len(keep))]
    first = [F.col(n).alias(c) for n, c in zip(inner, keep)] or [F.col(ID).alias(id_col)]
    return df.select(*first, *[c for c in df.columns if c != ID and c not in inner])


def sample_of_each(rows: DataFrame, group: str, name: str, n: int) -> DataFrame:
    """The ``n`` rows of each group with the smallest hash of ``name``, fewer if there are no more.

    Groups are counted first, and only rows with a hash small enough for some
    ``4 n`` of them go on, so that what meets in one task does not grow with the
    table. There must be few groups: one number each comes to the driver.
    """
    sizes = {r[0]: r[1] for r in rows.groupBy(group).count().collect()}
    hashed = F.pmod(F.xxhash64(name), F.lit(1 << 32))
    bound = F.lit(1 << 32)
    for value, size in sizes.items():
        if size > 4 * n:
            bound = F.when(F.col(group) == F.lit(value), F.lit(int(4 * n / size * (1 << 32)))).otherwise(bound)
    order = Window.partitionBy(group).orderBy("_hash", *[c for c in rows.columns if c != group])
    near = rows.withColumn("_hash", hashed).where(F.col("_hash") < bound)
    return near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n", "_hash")


def digest(column: str | Column = TEXT) -> Column:
    """128 bits that name a text; NULL for NULL."""
    return F.unhex(F.md5(column))


def text_bytes(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Rows and UTF-8 bytes of a table, as two numbers."""
    row = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()
    return int(row[0]), int(row[1] or 0)
