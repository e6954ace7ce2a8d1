"""One run over all layers: load RAW, merge REFINED, rebuild CURATED, check."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import require_clean, run_checks
from ..operators.upsert import incremental_upsert
from ..session import settings, side_by_side
from ..sources.catalog import CatalogLayers
from ..sources.landing import LoadResult, RawStore
from ..sources.table import BUCKETS, KeyedTable, RebuiltTable
from . import curated, refined
from .models import CHECKS, ENTITIES


# A stage ends with tables written, so shuffle files go with the job that made them and not when the driver's heap is next collected.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
LARGE_LOAD = 1_000_000  # records; a merge of more keeps all tasks busy alone, and two would only need the disk of both


@dataclass(frozen=True)
class Refresh:
    loads: list[LoadResult]
    models: dict[str, DataFrame]
    checks: DataFrame


class Warehouse:
    """Folders of the three layers under one root; with ``catalog`` all models are read and rebuilt there by name."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, catalog: CatalogLayers | None = None):
        self.spark, self.root, self.catalog = spark, root.rstrip("/"), catalog
        self.raw = RawStore(spark, self.root)
        self.refined = {
            name: (KeyedTable(spark, f"{self.root}/refined/{name}", key, buckets), entity, build)
            for name, key, entity, build in (
                ("stg_workers", "worker_id", "workers", refined.stg_workers),
                ("stg_job_changes", "change_id", "job_changes", refined.stg_job_changes),
                ("stg_compensation", "compensation_id", "compensation", refined.stg_compensation),
            )
        }

    def rebuild(self, name: str, df: DataFrame) -> DataFrame:
        """Write a curated table anew and return it as read back."""
        if self.catalog is not None:
            return self.catalog.save("curated", name, df)
        return RebuiltTable(self.spark, f"{self.root}/curated/{name}").write(df)

    def refresh(
        self,
        landing: str,
        load_date: str,
        as_of: date | None = None,
        *,
        loaded_at: str | None = None,
        layout: str = "array",
        max_days: int | None = None,
        strict_checks: bool = True,
        purge: bool = False,
    ) -> Refresh:
        """Run all stages in order. Fails after the last if a check fails.

        Steps of one stage do not depend on each other and run side by side, but for
        merges of large loads. An entity without files has empty tables. ``max_days`` cuts the
        calendar. ``purge`` deletes landed files once their records are in RAW.
        """
        with settings(self.spark, FREED):
            loads = self.raw.load_all(landing, ENTITIES, load_date, loaded_at, layout, purge)
            models = self._models(loads, as_of, max_days)
            checked = run_checks(models, CHECKS)
            if self.catalog is not None:
                checks = self.catalog.save("curated", "checks", checked)
            else:
                checks = RebuiltTable(self.spark, f"{self.root}/checks").write(checked)
            if strict_checks:
                require_clean(checks)
        return Refresh(loads, models, checks)

    def _models(self, loads: list[LoadResult], as_of: date | None, max_days: int | None) -> dict[str, DataFrame]:
        """Merge REFINED and rebuild CURATED."""
        large = {load.entity for load in loads if load.records > LARGE_LOAD}
        alone = [name for name, (_, entity, _) in self.refined.items() if entity in large]
        models = side_by_side(self.spark, {name: partial(self._merge, name) for name in self.refined if name not in alone})
        models |= {name: self._merge(name) for name in alone}
        organizations = self._raw("organizations")
        models |= side_by_side(
            self.spark,
            {
                "dim_org": lambda: self.rebuild("dim_org", curated.dim_org(organizations)),
                "dim_worker": lambda: self.rebuild(
                    "dim_worker", curated.dim_worker(models["stg_workers"], models["stg_job_changes"])
                ),
            },
        )
        dim = models["dim_worker"]
        models |= side_by_side(
            self.spark,
            {
                # stg_workers holds one row per worker, so intervals cannot overlap
                "fct_headcount_daily": lambda: self.rebuild(
                    "fct_headcount_daily", curated.fct_headcount_daily(dim, as_of, max_days=max_days, disjoint=True)
                ),
                "fct_turnover": lambda: self.rebuild(
                    "fct_turnover", curated.fct_turnover(dim, as_of, max_days=max_days, disjoint=True)
                ),
                "fct_compensation": lambda: self.rebuild(
                    "fct_compensation", curated.fct_compensation(models["stg_compensation"], dim)
                ),
            },
        )
        return models

    def _raw(self, entity: str) -> DataFrame:
        return self.raw.read(entity) if self.catalog is None else self.catalog.publish_raw(entity, self.raw)

    def _merge(self, name: str) -> DataFrame:
        table, entity, build = self.refined[name]
        raw = self._raw(entity)
        incremental_upsert(table, raw, build, day="_load_day")
        if self.catalog is not None:
            return self.catalog.publish_keyed(name, table, build(raw).schema)
        merged = table.read()
        return self.spark.createDataFrame([], build(raw).schema) if merged is None else merged
