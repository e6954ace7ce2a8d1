"""A parquet table that can replace the rows of given keys.

Plain parquet has no MERGE, and a table cannot be overwritten while it is
read. Rows are therefore stored in hash buckets of the key; a change writes
the touched buckets into a new folder and then one file to a log that says
which folder is current for each bucket. Readers use the newest log file, so
they see a change whole or not at all. A job that dies before that leaves
unused files and an unchanged table.

Each log file is created under the next version number and never overwritten:
of two writers that change the table at the same time the second fails. Old
folders are left in place. Where the catalog offers MERGE INTO, use that.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import create_file, drop_path, file_names, path_exists

BUCKET = "_bucket"
BUCKETS = 64
SLOT = "_slot"
SLOTS_PER_TASK = 8  # so many that hardly a task has none


def read_if_exists(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


class CommitLog:
    """Versions of a table, one small JSON file each."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _versions(self) -> list[str]:
        return sorted(n for n in file_names(self.spark, self.folder) if n.endswith(".json"))

    def last(self) -> dict | None:
        """The newest entry; one that a writer did not finish does not count."""
        for name in reversed(self._versions()):
            text = self.spark.read.text(f"{self.folder}/{name}", wholetext=True).first()
            try:
                return json.loads(text[0]) | {"file": name} if text else None
            except ValueError:
                continue
        return None

    def append(self, entry: dict, after: dict | None) -> None:
        """Add the entry; fails if another writer has added one after ``after``."""
        names = self._versions()
        if names and (after is None or names[-1] > after["file"]):
            last = self.last()
            if last is not None and (after is None or last["file"] != after["file"]):
                raise RuntimeError(f"{self.folder}: changed by another writer meanwhile")
        number = 1 + (int(names[-1].partition(".")[0]) if names else -1)
        create_file(self.spark, f"{self.folder}/{number:010d}.json", json.dumps(entry))


class RebuiltTable:
    """A table that is written whole each time; readers keep the last complete one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/log")

    def read(self) -> DataFrame | None:
        last = self.log.last()
        if last is None:
            return None
        schema = StructType.fromJson(last["columns"])
        return self.spark.read.schema(schema).parquet(f"{self.path}/data/{last['folder']}")

    def write(self, df: DataFrame) -> DataFrame:
        last, folder = self.log.last(), f"c-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.path}/data/{folder}")
        self.log.append({"folder": folder, "columns": df.schema.jsonValue()}, last)
        return self.read()


@dataclass(frozen=True)
class State:
    schema: StructType
    buckets: int
    folders: dict[int, str]
    watermark: str | None = None
    batches: dict[str, int] = field(default_factory=dict)  # last batch merged, by stream
    file: str = ""


class KeyedTable:
    """``buckets`` counts for a table that does not exist yet; after that the stored number does."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.log = CommitLog(spark, f"{self.path}/log")

    # -- reading ---------------------------------------------------------

    def state(self) -> State | None:
        last = self.log.last()
        if last is None:
            return None
        folders = {int(b): f for b, f in last["folders"].items()}
        schema = StructType.fromJson(last["columns"])
        return State(schema, last["buckets"], folders, last["watermark"], last["batches"], last["file"])

    def read(self, state: State | None = None) -> DataFrame | None:
        """The current rows, or None if nothing was ever written."""
        state = state or self.state()
        return None if state is None else self._read(state, state.folders)

    def _read(self, state: State, buckets: Iterable[int]) -> DataFrame:
        paths = [f"{self.path}/data/{state.folders[b]}/{BUCKET}={b}" for b in sorted(buckets)]
        if not paths:
            return self.spark.createDataFrame([], state.schema)
        return self.spark.read.schema(state.schema).parquet(*paths)

    # -- writing ---------------------------------------------------------

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def replace(
        self,
        fresh: DataFrame,
        *,
        keys: DataFrame | None = None,
        watermark: str | None = None,
        writer: str | None = None,
        batch_id: int | None = None,
    ) -> DataFrame | None:
        """Drop all rows whose key occurs in ``keys`` and add the rows of ``fresh``.

        Without ``keys`` those of ``fresh`` are used, which makes it an upsert.
        A NULL key matches nothing: such rows are only ever added. Columns
        follow ``fresh``: new ones are NULL in older rows, missing ones go, and
        a changed type is cast; a value that does not fit fails the job and
        leaves the table as it was. ``watermark`` names a column whose largest
        value is kept in the log, ``writer`` and ``batch_id`` what a stream has
        merged. Returns the rows of ``fresh`` as written, None if there was
        nothing to do.

        New rows are written once, to their final folder; the rows that stay
        follow into the same folder.
        """
        state = self.state()
        buckets = state.buckets if state else self.buckets
        commit = f"c-{uuid.uuid4().hex}"
        mark = F.max(watermark).cast("string") if watermark else F.lit(None).cast("string")
        schema = fresh.schema

        seen = self._write(fresh.withColumn(BUCKET, self._bucket(buckets)).hint("rebalance", BUCKET), commit, mark)
        added, touched = set(seen["buckets"]), set(seen["buckets"])
        written = self.spark.createDataFrame([], schema)
        if added:
            written = self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{commit}/{BUCKET}={b}" for b in sorted(added)])
        folders, kept_in = {}, set()
        if state is not None:
            gone, staged_keys = written.select(self.key), None
            if keys is not None:
                staged_keys = f"{self.path}/stage/{commit}"
                gone = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
                touched |= set(self._write(gone.withColumn(BUCKET, self._bucket(buckets)), None, F.lit(None), staged_keys)["buckets"])
                gone = self.spark.read.schema(gone.schema).parquet(staged_keys)
            if not touched:
                return None
            if self._rewrite_all(state.schema, schema):
                touched |= set(state.folders)
            old = [b for b in touched if b in state.folders]
            if old:
                rows = self._as(self._read(state, old), schema).withColumn(BUCKET, self._bucket(buckets))
                kept = self._kept(rows, gone, buckets, unique=keys is None, touched=len(old))
                kept_in = set(self._write(kept, commit, F.lit(None))["buckets"])
            if staged_keys:
                drop_path(self.spark, staged_keys)
            folders = {b: f for b, f in state.folders.items() if b not in touched}
        elif not touched:
            return None
        folders |= {b: commit for b in added | kept_in}

        marks = [m for m in (seen["mark"], state.watermark if state else None) if m is not None]
        batches = dict(state.batches) if state else {}
        if writer is not None:
            batches[writer] = batch_id
        entry = {
            "folders": folders,
            "buckets": buckets,
            "columns": schema.jsonValue(),
            "watermark": max(marks, key=_as_time) if marks else None,
            "batches": batches,
        }
        self.log.append(entry, None if state is None else {"file": state.file})
        return written

    def _slot(self, touched: int) -> Column:
        """A part of a bucket, so that the rows of few buckets keep all tasks busy.

        There are some slots per task, however many buckets are touched. The hash is
        another one than the bucket's, whose rows it must divide.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return F.pmod(F.xxhash64(F.lit(SLOT), self.key), F.lit(max(1, ceil(SLOTS_PER_TASK * tasks / touched)))).cast("int")

    def rebucket(self, buckets: int) -> bool:
        """Write the whole table anew in another number of buckets; False if it has that number or no rows were ever written.

        For a table that has outgrown the number chosen at its creation. Rows,
        columns, watermark and what streams have merged stay as they are; readers see the old
        table until the new one is complete, and of a merge that runs meanwhile
        and this the later one fails.
        """
        if buckets < 1:
            raise ValueError("a table has at least one bucket")
        state = self.state()
        if state is None or state.buckets == buckets:
            return False
        commit = f"c-{uuid.uuid4().hex}"
        rows = self.read(state).withColumn(BUCKET, self._bucket(buckets))
        written = self._write(rows.hint("rebalance", BUCKET), commit, F.lit(None))["buckets"]
        entry = {
            "folders": {b: commit for b in written},
            "buckets": buckets,
            "columns": state.schema.jsonValue(),
            "watermark": state.watermark,
            "batches": state.batches,
        }
        self.log.append(entry, {"file": state.file})
        return True

    def _kept(self, rows: DataFrame, gone: DataFrame, buckets: int, unique: bool, touched: int | None = None) -> DataFrame:
        """The old rows whose key is not in ``gone``; NULL keys match nothing and need no shuffle."""
        known, unknown = rows.where(F.col(self.key).isNotNull()), rows.where(F.col(self.key).isNull())
        gone = gone.where(F.col(self.key).isNotNull())
        if not unique:
            # A key may have very many rows: a join that adaptive execution can split.
            return known.join(gone, self.key, "left_anti").hint("rebalance", BUCKET).unionByName(unknown)
        # One exchange, by bucket and slot, serves both the match and the write.
        marks = gone.withColumn(BUCKET, self._bucket(buckets))
        both = known.withColumn("_gone", F.lit(False)).unionByName(marks.withColumn("_gone", F.lit(True)), allowMissingColumns=True)
        both = both.withColumn(SLOT, self._slot(touched or buckets))
        hit = F.max("_gone").over(Window.partitionBy(BUCKET, SLOT, self.key))
        survivors = both.repartition(BUCKET, SLOT).withColumn("_hit", hit).where("NOT _hit").drop("_gone", "_hit", SLOT)
        return survivors.unionByName(unknown)

    @staticmethod
    def _as(rows: DataFrame, schema: StructType) -> DataFrame:
        """Old rows with the new columns and types."""
        have = set(rows.columns)
        out = rows.select(
            *[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        )
        if [(f.name, f.dataType) for f in out.schema.fields] != [(f.name, f.dataType) for f in schema.fields]:
            raise TypeError("old rows cannot take the new schema")
        return out

    @staticmethod
    def _rewrite_all(old: StructType, new: StructType) -> bool:
        """A dropped or retyped column must not survive in untouched buckets."""
        types = {f.name: f.dataType for f in new.fields}
        return any(types.get(f.name) != f.dataType for f in old.fields)

    def _write(self, df: DataFrame, commit: str | None, mark: Column, path: str | None = None) -> dict:
        """Write once, by bucket unless a path is given, and learn the buckets on the way."""
        seen = Observation()
        observed = df.observe(seen, F.collect_set(BUCKET).alias("buckets"), mark.cast("string").alias("mark"))
        writer = observed.write.option("compression", "zstd")
        if path:
            writer.parquet(path)
        else:
            writer.mode("append").partitionBy(BUCKET).parquet(f"{self.path}/data/{commit}")
        return seen.get


def _as_time(text: str) -> tuple[str, str]:
    """Sort key for timestamps in text form, with or without a fraction."""
    whole, _, fraction = text.partition(".")
    return whole, fraction.ljust(9, "0")
