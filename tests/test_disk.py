"""What a load and a refresh leave on disk, and when."""

from __future__ import annotations

import os
import threading
from datetime import date
from glob import glob

from fixtures import change, land_lines, org, pay, worker
from pyspark.sql import functions as F

from tenurelog.plans import Warehouse, refresh
from tenurelog.session import settings, side_by_side
from tenurelog.sources import CatalogLayers, RawStore, land
from tenurelog.sources import landing as landing_module

T1, T2 = "2024-01-01 06:00:00", "2024-01-02 06:00:00"
DAY = "2024-01-01"
LAST = date(2024, 1, 3)


def land_all(root, day=DAY, level="IC3"):
    land_lines(root, "workers", day, [worker("W1", level=level), worker("W2", level=level)])
    land_lines(root, "job_changes", day, [change("C1", "W1", "New Hire", "2024-01-01"), change("C2", "W2", "Transfer", "2024-01-02")])
    land_lines(root, "compensation", day, [pay("P1", "W1", "2024-01-01", 100.0), pay("P2", "W1", "2024-01-02", 110.0)])
    land_lines(root, "organizations", day, [org("ORG001", "Platform")])


def shown(df):
    return sorted(map(str, df.drop("_loaded_at", "_file_name").collect()))


def shuffle_files(spark):
    """The files of shuffles that lie on this machine's local disks now."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {path for top in dirs for path in glob(f"{top}/*/shuffle_*")}


def test_landed_lines_are_compressed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing_module, "PER_FILE", 100)
    folder, store = str(tmp_path / "landing"), RawStore(spark, str(tmp_path / "wh"))
    records = spark.range(0, 950, 1, 2).select(F.concat(F.lit("W"), "id").alias("worker_id"), F.repeat(F.lit("same text "), 20).alias("note"))
    for _ in range(2):  # landed again: the same records, not more
        land(records, folder, "workers", DAY)
    files = glob(f"{folder}/workers/load_date={DAY}/part-*")
    assert len(files) == 10 and all(f.endswith(".json.gz") for f in files)
    assert sum(map(os.path.getsize, files)) < 950 * 200 / 5
    done = store.load(folder, "workers", DAY, T1, "lines")
    assert (done.files, done.records, done.bad_records) == (10, 950, 0)
    assert store.read("workers").select("_file_name").distinct().count() == 10
    # plain files beside them are read as before, and nothing is loaded twice
    land_lines(folder, "workers", DAY, [worker("X1")])
    done = store.load(folder, "workers", DAY, T2, "lines")
    assert (done.files, done.records) == (1, 1)


def test_purge_deletes_what_is_in_raw_and_nothing_else(spark, tmp_path, monkeypatch):
    folder, store = str(tmp_path / "two landings"), RawStore(spark, str(tmp_path / "wh"))
    before = land_lines(folder, "workers", DAY, [worker("W1")], name="before.json")
    store.load(folder, "workers", DAY, T1, "lines")
    loaded, other_day = land_lines(folder, "workers", DAY, [worker("W2")], name="loaded.json"), land_lines(folder, "workers", "2024-01-02", [worker("W9")])
    rewritten = land_lines(folder, "workers", DAY, [worker("W3")], name="rewritten.json")
    commit = RawStore._commit

    def meanwhile(self, *args, **kw):
        done = commit(self, *args, **kw)
        land_lines(folder, "workers", DAY, [worker("W3"), worker("W4")], name="rewritten.json")
        land_lines(folder, "workers", DAY, [worker("W5")], name="late.json")
        return done

    monkeypatch.setattr(RawStore, "_commit", meanwhile)
    assert store.load(folder, "workers", DAY, T2, "lines", purge=True).records == 2
    monkeypatch.undo()
    assert [os.path.exists(p) for p in (before, loaded, rewritten, other_day)] == [False, False, True, True]
    done = store.load(folder, "workers", DAY, T2, "lines", purge=True)
    assert (done.files, done.records) == (2, 3)
    assert glob(f"{folder}/workers/load_date={DAY}/*") == []
    assert store.load(folder, "workers", DAY, T2, "lines", purge=True).files == 0
    assert store.read("workers").count() == 6 and store.manifest("workers").count() == 5


def test_refresh_gives_shuffle_files_back_and_puts_the_setting_back(spark, tmp_path):
    name = next(iter(refresh.FREED))
    set_before = spark.conf.get(name)
    land_all(str(tmp_path / "landing"))
    before = shuffle_files(spark)
    home = Warehouse(spark, str(tmp_path / "home"), buckets=4)
    home.refresh(str(tmp_path / "landing"), DAY, LAST, loaded_at=T1, layout="lines")
    assert shuffle_files(spark) <= before
    assert spark.conf.get(name) == set_before


def test_large_merges_run_alone_with_the_same_result(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "landing")
    for day, level in ((DAY, "IC3"), ("2024-01-02", "IC4")):
        land_all(folder, day, level)
    running, most, lock, merge = set(), {}, threading.Lock(), Warehouse._merge

    def watched(self, name):
        with lock:
            running.add(name)
            most[self.root] = max(most.get(self.root, 0), len(running))
        try:
            return merge(self, name)
        finally:
            with lock:
                running.remove(name)

    monkeypatch.setattr(Warehouse, "_merge", watched)
    found = {}
    for limit in (1_000_000, 0):
        monkeypatch.setattr(refresh, "LARGE_LOAD", limit)
        home = Warehouse(spark, str(tmp_path / f"home{limit}"), buckets=4)
        for day, at in ((DAY, T1), ("2024-01-02", T2)):
            done = home.refresh(folder, day, LAST, loaded_at=at, layout="lines", strict_checks=False)
        found[limit] = {name: shown(df) for name, df in done.models.items()}
    assert found[0] == found[1_000_000] and all(found[0].values())
    assert most[str(tmp_path / "home0")] == 1


def test_refresh_with_purge_equals_refresh_without(spark, tmp_path):
    found = []
    for purge in (False, True):
        folder = str(tmp_path / f"landing{purge}")
        home = Warehouse(spark, str(tmp_path / f"home{purge}"), buckets=4)
        for day, at, level in ((DAY, T1, "IC3"), ("2024-01-02", T2, "IC4")):
            land_all(folder, day, level)
            done = home.refresh(folder, day, LAST, loaded_at=at, layout="lines", strict_checks=False, purge=purge)
        found.append({name: shown(df) for name, df in done.models.items()})
        assert len(glob(f"{folder}/*/*/*.json")) == (0 if purge else 8)
        assert home.raw.read("workers").count() == 4
    assert found[0] == found[1]


def test_settings_held_side_by_side_are_put_back_by_the_last(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen, both = spark.conf.get(name), [], threading.Barrier(2, timeout=30)

    def early():
        with settings(spark, {name: "8"}):
            both.wait()  # both hold it
        both.wait()

    def late():
        with settings(spark, {name: "8"}):
            both.wait()
            both.wait()  # the other has left
            seen.append(spark.conf.get(name))

    side_by_side(spark, {"early": early, "late": late})
    assert seen == ["8"] and spark.conf.get(name) == before != "8"


def test_stored_tables_are_compressed(spark, tmp_path):
    folder = str(tmp_path / "landing")
    land_all(folder)
    Warehouse(spark, str(tmp_path / "home"), buckets=4).refresh(folder, DAY, LAST, loaded_at=T1, layout="lines")
    written = [f for layer in ("raw", "refined", "curated") for f in glob(f"{tmp_path}/home/{layer}/*/data/**/part-*", recursive=True)]
    assert written and all(f.endswith(".zstd.parquet") for f in written)


def test_catalog_models_are_compressed_and_leave_no_shuffle_files(spark, tmp_path):
    folder = str(tmp_path / "landing")
    before = shuffle_files(spark)
    for day, at in ((DAY, T1), ("2024-01-02", T2)):
        land_all(folder, day)
        layers = CatalogLayers(spark, "disk_")
        Warehouse(spark, str(tmp_path / "home"), buckets=4, catalog=layers).refresh(folder, day, LAST, loaded_at=at, layout="lines", strict_checks=False, purge=True)
    files = [f for model in ("dim_worker", "fct_compensation", "fct_headcount_daily") for f in layers.table("curated", model).inputFiles()]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert shuffle_files(spark) <= before and not glob(f"{folder}/*/*/*.json")
    assert layers.table("raw", "workers").count() == 4
