"""JSON landing files to append-only RAW tables, each file loaded once.

Landing: ``{landing}/{entity}/load_date=YYYY-MM-DD/*.json``, plain or gzipped
(``*.json.gz``, each file read by one task), in one of two layouts:

* ``array``: one array of records (or one record) per file, whatever its indent and
  line ends. It is cut between records by the depth of its brackets, all parts of
  a file in parallel, see :mod:`.arrays`; a bad record costs only itself. An array
  written on one line is one text.
* ``lines``: one record, or one array of records, per line. What :func:`land`
  writes.

A text counts as parsed only if all of it was consumed, and only objects are
records. Everything else is set aside, so nothing is lost without a trace.

RAW: ``raw_data VARIANT, _loaded_at, _file_name, _source`` plus ``_load_day``,
the date of ``_loaded_at``, as partition column. Each load writes a folder of its
own, records and what is set aside in one job and the manifest beside them, and
becomes visible with one entry in the entity's log. A job that dies before that
leaves an unused folder, so loading again gives each record once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import drop_unchanged, file_names, path_exists, scratch_dir, settings, side_by_side
from .arrays import pieces, read_lines, with_places
from .table import CommitLog

RAW_SCHEMA = "raw_data variant, _loaded_at timestamp_ntz, _file_name string, _source string, _load_day date"
BAD_SCHEMA = "value string, _loaded_at timestamp_ntz, _file_name string, _source string, _load_day date"
SEEN_SCHEMA = "path string, length long, modificationTime timestamp, _loaded_at timestamp_ntz, load_date date"
STORED_SCHEMA = "raw_data variant, value string, _loaded_at timestamp_ntz, _file_name string, _source string, _commit string, _kind string, _load_day date"
LAYOUTS = ("array", "lines")
FILES = "*.{json,json.gz}"
PER_FILE = 100_000  # records of a landed file: a compressed one cannot be read in parts
ONE_PASS = {"spark.sql.maxConcurrentOutputFileWriters": "8"}  # a task writes its folders side by side and sorts nothing for it


@dataclass(frozen=True)
class LoadResult:
    entity: str
    files: int
    records: int
    bad_records: int


def land(records: DataFrame, landing: str, entity: str, load_date: str) -> None:
    """Write one load date as gzipped JSON lines; a rerun replaces that date only."""
    with settings(records.sparkSession, ONE_PASS):
        (
            records.withColumn("load_date", F.lit(load_date))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "gzip")
            .option("zlib.compress.level", "THREE")  # a third less time than by default for a fifth more bytes
            .option("maxRecordsPerFile", PER_FILE)
            .partitionBy("load_date")
            .json(f"{landing}/{entity}")
        )


def list_files(spark: SparkSession, folder: str, pattern: str = FILES) -> DataFrame | None:
    """Path, length and change time of the files, without reading them."""
    if not path_exists(spark, folder):
        return None
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length", "modificationTime")


def read_records(spark: SparkSession, paths: list[str], layout: str = "array") -> DataFrame:
    """One row per record: raw_data (NULL if it is none), value (the text if so), _file_name."""
    return records_of(read_lines(spark, paths), layout)


def records_of(lines: DataFrame, layout: str = "array") -> DataFrame:
    """The records of lines read by :func:`.arrays.with_places`."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if layout == "lines":
        return _records(lines.withColumn("whole", F.lit(True)))
    return _records(pieces(lines))


def _records(text: DataFrame) -> DataFrame:
    """The elements of ``[value]``; where ``whole``, those of arrays among them instead of the arrays.

    The parser takes the first value of a text and leaves the rest unread. Here a
    member behind the records, under a name that no text can know, shows that the
    parser came through.
    """
    end = f"end{uuid.uuid4().hex}"
    parsed = F.try_parse_json(F.concat(F.lit('{"r":['), "value", F.lit(f'],"{end}":1}}')))
    # A column of its own each, as what a generator or a lambda is made from is computed anew at each mention.
    read = text.select("value", "whole", "_file_name", parsed.alias("parsed"))
    elements = F.when(F.try_variant_get("parsed", f"$.{end}", "int") == 1, F.try_variant_get("parsed", "$.r", "array<variant>"))
    read = read.select("value", "whole", "_file_name", elements.alias("elements"))
    # One element whose text begins like an object is one; only others are looked into.
    alone = (F.size("elements") == 1) & F.col("value").rlike(r"^\s*+\{")
    inner = F.transform("elements", lambda x: F.coalesce(F.try_variant_get(x, "$", "array<variant>"), F.array(x)))
    elements = F.when(F.col("whole") & ~alone, F.flatten(inner)).otherwise(F.col("elements"))
    read = read.select("value", "_file_name", elements.alias("elements"), alone.alias("alone"))

    def record(x: Column) -> Column:
        is_object = F.try_variant_get(x, "$", "struct<r:variant>").isNotNull()
        return F.struct(F.when(is_object, x).alias("raw_data"), F.when(~is_object, F.to_json(x)).alias("value"))

    no_text, no_record = F.lit(None).cast("string"), F.lit(None).cast("variant")
    only = F.array(F.struct(F.element_at("elements", 1).alias("raw_data"), no_text.alias("value")))
    set_aside = F.array(F.struct(no_record.alias("raw_data"), F.col("value").alias("value")))
    found = F.when(F.col("alone"), only).otherwise(F.coalesce(F.transform("elements", record), set_aside))
    return read.select(F.inline(found), "_file_name")


def _plain_path(file_path: Column) -> Column:
    """A file's location in Spark's metadata, which is URL-encoded, as a listing gives it."""
    plain = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


class RawStore:
    """The RAW tables, their load manifests and the records set aside."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, entity: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/raw/{entity}/log")

    def _stored(self, entity: str) -> DataFrame | None:
        last = self._log(entity).last()
        if last is None:
            return None
        data = f"{self.root}/raw/{entity}/data"
        if not last["commits"]:
            return self.spark.createDataFrame([], STORED_SCHEMA)
        # The folders of the loads in the log; one that did not come so far is not among them.
        return self.spark.read.schema(STORED_SCHEMA).option("basePath", data).parquet(*[f"{data}/_commit={c}" for c in last["commits"]])

    def places(self, entity: str) -> tuple[str, list[tuple[str, str, str]]]:
        """The folder of the records, and (commit, kind, load day) of each folder in it that the log knows."""
        folder = f"{self.root}/raw/{entity}/data"
        last = self._log(entity).last()
        found = []
        for commit in last["commits"] if last else []:
            for kind in file_names(self.spark, f"{folder}/_commit={commit}"):
                if kind.startswith("_kind="):
                    days = file_names(self.spark, f"{folder}/_commit={commit}/{kind}")
                    found += [(commit, kind.removeprefix("_kind="), d.removeprefix("_load_day=")) for d in days]
        return folder, found

    def read(self, entity: str) -> DataFrame | None:
        """All records ever loaded for the entity, or None if no load was ever tried."""
        stored = self._stored(entity)
        return None if stored is None else stored.where("_kind = 'good'").select(*names_of(RAW_SCHEMA))

    def quarantine(self, entity: str) -> DataFrame | None:
        """The texts set aside, or None if there never were any."""
        last = self._log(entity).last()
        if last is None or not last["bad"]:
            return None
        return self._stored(entity).where("_kind = 'bad'").select(*names_of(BAD_SCHEMA))

    def manifest(self, entity: str) -> DataFrame | None:
        """The files loaded, or None if there never were any."""
        last = self._log(entity).last()
        if last is None or not last["commits"]:
            return None
        folders = [f"{self.root}/raw/{entity}/manifest/{c}" for c in last["commits"]]
        return self.spark.read.schema(SEEN_SCHEMA).parquet(*folders)

    def load(
        self,
        landing: str,
        entity: str,
        load_date: str,
        loaded_at: str | None = None,
        layout: str = "array",
        pattern: str = FILES,
        purge: bool = False,
    ) -> LoadResult:
        """Append the records of files not loaded before.

        A file counts as loaded if its path, length and change time are in the
        manifest; a rewritten file is loaded again. Records, manifest and texts set
        aside become visible at once. Without files the RAW table is only created,
        with no rows. Of two loads of an entity at the same time the later one fails.
        ``purge`` deletes files of that date behind the log entry that holds their records,
        also those that an earlier load left.
        """
        log = self._log(entity)
        if log.last() is None:
            log.append({"commits": [], "batches": {}, "bad": False}, None)
        files = list_files(self.spark, f"{landing}/{entity}/load_date={load_date}", pattern)
        if files is None:
            return LoadResult(entity, 0, 0, 0)
        listed = files.collect() if purge else []  # the file index of a read lies on the driver anyway
        new = self._unseen(entity, files, load_date).collect()
        good, bad = 0, 0
        if new:
            records = read_records(self.spark, [r["path"] for r in new], layout)
            files = self.spark.createDataFrame(new, "path string, length long, modificationTime timestamp")
            good, bad = self._commit(entity, records, files, load_date, loaded_at)
        # A file that came behind the listing was not loaded; one that was written anew since is another one.
        taken = {(r["path"], r["length"], r["modificationTime"]) for r in listed} & self._loaded(entity, load_date) if listed else ()
        for path, length, changed in taken:
            drop_unchanged(self.spark, path, length, changed)
        return LoadResult(entity, len(new), good, bad)

    def _loaded(self, entity: str, load_date: str) -> set[tuple]:
        """Path, length and change time of the files of a date in the manifest."""
        seen = self.manifest(entity)
        if seen is None:
            return set()
        seen = seen.where(F.col("load_date") == F.lit(load_date).cast("date"))
        return {tuple(r) for r in seen.select("path", "length", "modificationTime").collect()}

    def _unseen(self, entity: str, files: DataFrame, load_date: str | None) -> DataFrame:
        seen = self.manifest(entity)
        if seen is None:
            return files
        if load_date is not None:
            seen = seen.where(F.col("load_date") == F.lit(load_date).cast("date"))
        return files.join(seen.select("path", "length", "modificationTime"), ["path", "length", "modificationTime"], "left_anti")

    def _commit(
        self, entity: str, records: DataFrame, files: DataFrame, load_date: str | Column, loaded_at: str | None, writer: str | None = None, batch_id: int | None = None
    ) -> tuple[int, int]:
        """Write one load and enter it in the log; each record is parsed once."""
        log = self._log(entity)
        last = log.last()
        now = F.lit(loaded_at).cast("timestamp_ntz")
        if loaded_at is None:
            # one time for the whole load, not one per query
            now = F.lit(str(self.spark.sql("SELECT cast(current_timestamp() AS timestamp_ntz)").first()[0])).cast("timestamp_ntz")
        good = F.col("raw_data").isNotNull()
        seen = Observation()
        stored = records.select(
            "raw_data",
            "value",
            now.alias("_loaded_at"),
            "_file_name",
            F.lit(entity).alias("_source"),
            F.when(good, "good").otherwise("bad").alias("_kind"),
            now.cast("date").alias("_load_day"),
        ).observe(seen, F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
        commit = f"c-{uuid.uuid4().hex}"
        folder = f"{self.root}/raw/{entity}"
        with settings(stored.sparkSession, ONE_PASS):
            stored.write.option("compression", "zstd").partitionBy("_kind", "_load_day").parquet(f"{folder}/data/_commit={commit}")
        day = F.lit(load_date).cast("date") if isinstance(load_date, str) else load_date
        files.select("path", "length", "modificationTime", now.alias("_loaded_at"), day.alias("load_date")).write.parquet(f"{folder}/manifest/{commit}")
        counts = seen.get
        entry = {k: last[k] for k in ("commits", "batches", "bad")} if last else {"commits": [], "batches": {}, "bad": False}
        entry["commits"] = [*entry["commits"], commit]
        entry["bad"] = entry["bad"] or counts["bad"] > 0
        if writer is not None:
            entry["batches"] = {**entry["batches"], writer: batch_id}
        log.append(entry, last)
        return counts["good"], counts["bad"]

    def load_all(
        self,
        landing: str,
        entities: Iterable[str],
        load_date: str,
        loaded_at: str | None = None,
        layout: str = "array",
        purge: bool = False,
    ) -> list[LoadResult]:
        """The same load for each entity; one without files does not stop the others."""
        steps = {e: partial(self.load, landing, e, load_date, loaded_at, layout, purge=purge) for e in entities}
        return list(side_by_side(self.spark, steps).values())

    def stream(
        self,
        landing: str,
        entity: str,
        checkpoint: str,
        layout: str = "array",
        pattern: str = FILES,
        files_per_batch: int | None = None,
        loaded_at: Callable[[int], str] | None = None,
    ) -> StreamingQuery:
        """Load all files that have arrived under any load date, as a stream, and stop.

        The next run with the same checkpoint goes on from there. A batch's records,
        manifest and number become visible with one log entry, so a batch that is
        replayed after a failure is recognised. Files in the manifest, also those
        that :meth:`load` took, are left out. The stream looks at a path once: a file rewritten
        later is for :meth:`load`. ``loaded_at`` gives the load time for a batch number.
        """
        where = f"{landing}/{entity}"
        reader = self.spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        meta = [F.col("_metadata.file_size").alias("_size"), F.col("_metadata.file_modification_time").alias("_changed")]
        lines = reader.schema("value string").text(where).select("value", "_metadata", *meta)
        writer = f"stream:{checkpoint.rstrip('/')}"

        def take(batch: DataFrame, batch_id: int) -> None:
            last = self._log(entity).last()
            if last is not None and last["batches"].get(writer, -1) >= batch_id:
                return
            # Each read of the batch reads the files again, so what is new is found once, by file and not by line.
            sized = batch.select(F.col("_metadata.file_path").alias("_raw"), "_size", "_changed").distinct()
            files = sized.select("_raw", _plain_path(F.col("_raw")).alias("path"), F.col("_size").alias("length"), F.col("_changed").alias("modificationTime"))
            found = scratch_dir(self.spark, "found")
            new = self._unseen(entity, files, None)
            new.write.parquet(found)
            new = self.spark.read.schema(new.schema).parquet(found)
            taken = with_places(batch).join(new.select("_raw"), F.col("_path") == F.col("_raw"), "left_semi")
            day = F.regexp_extract("path", r"/load_date=([0-9-]+)/", 1)
            self._commit(entity, records_of(taken, layout), new, F.try_to_date(day), loaded_at(batch_id) if loaded_at else None, writer, batch_id)

        return lines.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def names_of(schema: str) -> list[str]:
    return [f.strip().split(" ")[0] for f in schema.split(",")]
