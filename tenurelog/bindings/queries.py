"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    Check,
    as_of_join,
    change_over_previous,
    date_spine,
    duplicate_values,
    export_pages,
    flatten,
    incremental_upsert,
    interval_snapshot,
    latest_by_key,
    page,
    page_after,
    run_checks,
    scd2_from_changes,
    spine_bounds,
    status_counts,
    unexpected_values,
    updated_since,
)
from ..operators.snapshot import MAX_DAYS
from ..plans import Warehouse, curated, refined
from ..plans.models import ENTITIES
from ..session import scratch_dir, side_by_side
from ..sources import CatalogLayers, KeyedTable, RawStore, RebuiltTable, land
from ..streaming import refresh_history, stream_upsert
from ..streaming.upsert import merge_batch
from . import records as r

Query = Callable[[SparkSession, str], DataFrame]
HOT = 1000  # low limit that makes the hot-key path run on small data


def crowd(worker_id: str = "worker_id") -> Column:
    """Every third worker becomes worker 0, which then has a third of all rows."""
    third = F.substring_index(worker_id, "-", -1).cast("long") % 3 == 0
    return F.when(third, "WKR-0").otherwise(F.col(worker_id))


# -- refined ---------------------------------------------------------------


def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = r.table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.parse_json("props").alias("raw_data")
    )
    fields = [("k", "long", "k"), ("k", "string", "k_text"), ("a.b", "string", "missing")]
    return flatten(raw, fields, keep=["event_id", "user_id"])


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = r.table(spark, sf_dir, "events")
    return latest_by_key(events, ["user_id"], ["ts", "event_id"])


def stg_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refined.stg_workers(r.raw_workers(spark, sf_dir))


def stg_job_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refined.stg_job_changes(r.raw_job_changes(spark, sf_dir))


def stg_compensation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refined.stg_compensation(r.raw_compensation(spark, sf_dir))


# -- curated ---------------------------------------------------------------


def _history(changes: DataFrame, **options) -> DataFrame:
    return scd2_from_changes(
        changes.where("approval_status = 'Approved'"),
        key="worker_id",
        effective="effective_date",
        tie_break=["source_updated_at", "change_id"],
        carry=["change_id", "change_type", "new_position_id", "new_organization_id"],
        rank="recency_rank",
        **options,
    )


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(r.job_changes(spark, sf_dir))


def scd2_history_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(r.job_changes(spark, sf_dir).withColumn("worker_id", crowd()), max_rows=HOT)


def dim_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.dim_worker(r.workers(spark, sf_dir), r.job_changes(spark, sf_dir))


def dim_worker_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = r.job_changes(spark, sf_dir).withColumn("worker_id", crowd())
    return curated.dim_worker(r.workers(spark, sf_dir), changes, max_rows=HOT)


def dim_worker_collapse_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = r.job_changes(spark, sf_dir).withColumn("worker_id", crowd())
    return curated.dim_worker(r.workers(spark, sf_dir), changes, max_rows=HOT, collapse_same_day=True)


def dim_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.dim_org(r.raw_organizations(spark, sf_dir))


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = r.workers(spark, sf_dir).agg(F.min("hire_date")).first()[0]
    return date_spine(spark, lo, r.AS_OF, max_days=MAX_DAYS)


def headcount_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    # customer holds one row per worker: its intervals cannot overlap
    return curated.fct_headcount_daily(dim_worker(spark, sf_dir), r.AS_OF, disjoint=True)


def headcount_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headcount from early changes, corrected for the workers whose changes came late, moved or were withdrawn."""
    workers, final = r.workers(spark, sf_dir), r.job_changes(spark, sf_dir)
    number = F.substring_index("change_id", "-", -1).cast("long")
    late = (F.col("source_updated_at") >= F.lit("2024-01-25").cast("timestamp_ntz")) | (number % 7 == 0)
    other = F.concat(F.lit("WKR-"), F.substring_index("worker_id", "-", -1).cast("long") + 1)
    early = final.where(~late).withColumns(
        {
            "worker_id": F.when(number % 11 == 0, other).otherwise(F.col("worker_id")),
            # what the final table does not approve was approved once
            "approval_status": F.lit("Approved"),
        }
    )
    changed = late | (number % 11 == 0) | (F.col("approval_status") != "Approved")
    hit = final.where(changed).select("worker_id").union(final.where(number % 11 == 0).select(other.alias("worker_id"))).distinct()
    head = curated.HeadcountSteps(spark, scratch_dir(spark, "steps"), buckets=8)
    head.apply(None, curated.dim_worker(workers, early))

    def of_touched(changes: DataFrame) -> DataFrame:
        return curated.dim_worker(workers.join(hit, "worker_id", "left_semi"), changes.join(hit, "worker_id", "left_semi"))

    head.apply(of_touched(early), of_touched(final))
    first = workers.agg(F.min("hire_date")).first()[0]
    return head.read(spine_bounds(first, r.AS_OF))


def _overlapping(spark: SparkSession, sf_dir: str, max_days: int | None) -> DataFrame:
    """Orders as intervals of 30 days that overlap within a customer, from the first order to the last."""
    orders = r.table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderpriority",
        "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("valid_from"),
        F.date_add(F.col("o_orderdate").cast("date"), 29).alias("valid_to"),
    )
    first, last = orders.agg(F.min("valid_from"), F.max("valid_from")).first()
    return interval_snapshot(
        orders,
        dims=["o_orderpriority"],
        entity="o_custkey",
        start="valid_from",
        end="valid_to",
        bounds=spine_bounds(first, last, max_days),
        starts={"opened": F.col("o_orderstatus") == "O", "filled": F.col("o_orderstatus") == "F"},
    )


def headcount_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlapping(spark, sf_dir, None)


def headcount_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the calendar cut after 1,500 days, on request."""
    return _overlapping(spark, sf_dir, MAX_DAYS)


def dim_org_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second organization is renamed by a later load; the last name counts."""
    first = r.organizations(spark, sf_dir).withColumn("_loaded_at", F.lit(r.FIRST_LOAD).cast("timestamp_ntz"))
    odd = F.substring_index("id", "-", -1).cast("int") % 2 == 1
    later = first.where(odd).withColumns(
        {"name": F.concat("name", F.lit(" II")), "_loaded_at": F.lit(r.SECOND_LOAD).cast("timestamp_ntz")}
    )
    both = first.unionByName(later)
    raw = both.select(F.to_variant_object(F.struct("id", "name", "parent_id", "type")).alias("raw_data"), "_loaded_at")
    return curated.dim_org(raw, latest_only=True)


def _pct_change(pay: DataFrame, **options) -> DataFrame:
    return change_over_previous(
        pay.select("compensation_id", "worker_id", "effective_date", "base_salary"),
        key="worker_id",
        order=["effective_date", "compensation_id"],
        value="base_salary",
        previous="previous_base_salary",
        change_pct="salary_change_pct",
        **options,
    )


def pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pct_change(r.compensation(spark, sf_dir))


def pct_change_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pct_change(r.compensation(spark, sf_dir).withColumn("worker_id", crowd()), max_rows=HOT)


def pct_change_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth salary is 0; the change after it is NULL, not an error."""
    pay = r.compensation(spark, sf_dir)
    none = F.substring_index("compensation_id", "-", -1).cast("long") % 5 == 0
    return _pct_change(pay.withColumn("base_salary", F.when(none, 0.0).otherwise(F.col("base_salary"))), zero_division="null")


def comp_current_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.fct_compensation(r.compensation(spark, sf_dir), dim_worker(spark, sf_dir))


def comp_current_worker_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    pay = r.compensation(spark, sf_dir).withColumn("worker_id", crowd())
    return curated.fct_compensation(pay, dim_worker(spark, sf_dir), max_rows=HOT)


def _as_of(pay: DataFrame, changes: DataFrame, **options) -> DataFrame:
    """Each payment, moved to a day in January 2024, with the change that was valid then."""
    day = F.date_add(F.lit("2023-12-28").cast("date"), (F.substring_index("compensation_id", "-", -1).cast("long") % 45).cast("int"))
    return as_of_join(
        pay.select("compensation_id", "worker_id", day.alias("paid_on")),
        _history(changes),
        key="worker_id",
        at="paid_on",
        start="effective_from",
        end="effective_to",
        carry=["change_id", "change_type", "effective_from"],
        **options,
    )


def as_of_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_of(r.compensation(spark, sf_dir), r.job_changes(spark, sf_dir))


def as_of_worker_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    pay, changes = (t.withColumn("worker_id", crowd()) for t in (r.compensation(spark, sf_dir), r.job_changes(spark, sf_dir)))
    return _as_of(pay, changes, max_rows=HOT)


def as_of_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_of(r.compensation(spark, sf_dir), r.job_changes(spark, sf_dir), inner=True)


def turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.fct_turnover(dim_worker(spark, sf_dir), r.AS_OF, disjoint=True)


# -- checks ----------------------------------------------------------------


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_values(r.compensation(spark, sf_dir), "worker_id")


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["change_id", "worker_id", "new_position_id", "new_organization_id"]
    checks = [Check("job_changes", c, "not_null") for c in columns]
    return run_checks({"job_changes": r.job_changes(spark, sf_dir)}, checks)


def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unexpected_values(r.job_changes(spark, sf_dir), "change_type", ["New Hire", "Promotion", "Transfer"])


def dq_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared checks, over tables built from the driver's."""
    from ..plans.models import CHECKS

    workers, changes = r.workers(spark, sf_dir), r.job_changes(spark, sf_dir)
    pay = r.compensation(spark, sf_dir)
    # written once: three of the models and checks read it
    dim = RebuiltTable(spark, scratch_dir(spark, "checks")).write(dim_worker(spark, sf_dir))
    models = {
        "stg_workers": workers,
        "stg_job_changes": changes,
        "stg_compensation": pay,
        "dim_worker": dim,
        "dim_org": dim_org(spark, sf_dir),
        "fct_headcount_daily": curated.fct_headcount_daily(dim, r.AS_OF, disjoint=True),
        "fct_compensation": curated.fct_compensation(pay, dim),
    }
    return run_checks(models, CHECKS)


# -- access ----------------------------------------------------------------


def changed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = r.table(spark, sf_dir, "orders")
    return updated_since(orders, "2000-02-01T00:00:00", updated="o_orderdate", created=None)


def page_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = r.table(spark, sf_dir, "orders")
    return page(orders, newest="o_orderdate", key="o_orderkey", offset=120, limit=50).data


def page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = r.table(spark, sf_dir, "orders")
    return page(orders, newest="o_orderdate", key="o_orderkey", offset=1000, limit=100).data


def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total, has_more and the rows of a page, in its middle and at the end of the table."""
    orders = r.table(spark, sf_dir, "orders")
    out = None
    for offset, limit in ((0, 20), (700, 100), (orders.count() - 30, 100)):
        found = page(orders, newest="o_orderdate", key="o_orderkey", offset=offset, limit=limit)
        part = found.data.select(
            F.lit(found.total).cast("long").alias("total"),
            F.lit(limit).cast("long").alias("page_limit"),
            F.lit(found.has_more).alias("has_more"),
            "o_orderkey",
        )
        out = part if out is None else out.unionByName(part)
    return out


def page_seek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page behind the last row of the first page."""
    orders = r.table(spark, sf_dir, "orders")
    last = page_after(orders, newest="o_orderdate", key="o_orderkey", limit=100).collect()[-1]
    return page_after(
        orders, newest="o_orderdate", key="o_orderkey", after=(last["o_orderdate"], last["o_orderkey"]), limit=100
    )


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as pages of 1,000, newest first: row number and page of each."""
    orders = r.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    order = [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc_nulls_last()]
    return export_pages(orders, order, scratch_dir(spark, "export"), 1000)


def changed_or_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without an update time count by their creation time; with neither they are left out."""
    events = r.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", "").when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("updated_at"),
        F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("created_at"),
    )
    return updated_since(events, "2024-01-20T00:00:00").select("event_id")


def flatten_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value that does not fit its type becomes NULL."""
    raw = r.table(spark, sf_dir, "events").select(
        "event_id", F.to_variant_object(F.struct(F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("event_id").cast("string")).alias("n"))).alias("raw_data")
    )
    return flatten(raw, [("n", "long", "n"), ("n", "string", "n_text")], keep=["event_id"], strict=False)


def active_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(r.workers(spark, sf_dir), status="employment_status")


# -- loads -----------------------------------------------------------------


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of an incremental model; the second reads only the second load."""
    target = KeyedTable(spark, scratch_dir(spark, "upsert"), "change_id", buckets=8)
    raw = r.raw_job_changes(spark, sf_dir)
    first = raw.where(F.col("_loaded_at") <= F.lit(r.FIRST_LOAD).cast("timestamp_ntz"))
    incremental_upsert(target, first, refined.stg_job_changes)
    incremental_upsert(target, raw, refined.stg_job_changes)
    return target.read()


def upsert_rebucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with two buckets, rewritten into nine between the runs."""
    target = KeyedTable(spark, scratch_dir(spark, "rebucket"), "change_id", buckets=2)
    raw = r.raw_job_changes(spark, sf_dir)
    first = raw.where(F.col("_loaded_at") <= F.lit(r.FIRST_LOAD).cast("timestamp_ntz"))
    incremental_upsert(target, first, refined.stg_job_changes)
    target.rebucket(9)
    incremental_upsert(target, raw, refined.stg_job_changes)
    return target.read()


def schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run drops one column, adds another and touches half of the keys."""
    target = KeyedTable(spark, scratch_dir(spark, "schema"), "o_orderkey", buckets=8)
    orders = r.table(spark, sf_dir, "orders")
    target.replace(orders.select("o_orderkey", "o_custkey", "o_orderpriority"))
    later = orders.where(F.col("o_orderkey") % 2 == 0)
    target.replace(later.select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), "o_orderstatus"))
    return target.read()


def schema_sync_retype(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run turns a number into text and narrows another; old rows follow."""
    target = KeyedTable(spark, scratch_dir(spark, "retype"), "o_orderkey", buckets=8)
    orders = r.table(spark, sf_dir, "orders")
    target.replace(orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 100).alias("part")))
    later = orders.where(F.col("o_orderkey") % 3 == 0)
    # opened with another number of buckets: the stored one counts
    again = KeyedTable(spark, target.path, "o_orderkey", buckets=3)
    again.replace(later.select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey")).alias("o_custkey"), (F.col("o_orderkey") % 7).cast("int").alias("part")))
    return again.read()


ID_OF = {
    "workers": "worker_id",
    "positions": "id",
    "organizations": "id",
    "compensation": "compensation_id",
    "time_off": "time_off_id",
    "job_changes": "change_id",
}


def raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six entities landed as JSON and loaded; one row per RAW record."""
    root = scratch_dir(spark, "ingest")
    store = RawStore(spark, f"{root}/warehouse")
    sources = {
        "workers": r.worker_records(spark, sf_dir),
        "positions": r.position_records(spark, sf_dir),
        "organizations": r.organizations(spark, sf_dir),
        "compensation": r.pay_records(spark, sf_dir),
        "time_off": r.time_off_records(spark, sf_dir),
        "job_changes": r.change_records(spark, sf_dir),
    }
    side_by_side(
        spark, {e: partial(land, rows, f"{root}/landing", e, "2024-02-01") for e, rows in sources.items()}
    )
    store.load_all(f"{root}/landing", ENTITIES, "2024-02-01", r.SECOND_LOAD, "lines")
    out = None
    for entity in ENTITIES:
        part = flatten(store.read(entity), [(ID_OF[entity], "string", "record_id")], keep=["_loaded_at", "_source"])
        out = part if out is None else out.unionByName(part)
    return out


def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, the same load again, then a new date: what each one added."""
    root = scratch_dir(spark, "manifest")
    store = RawStore(spark, f"{root}/warehouse")
    changes = r.change_records(spark, sf_dir)
    land(changes.where("change_type = 'New Hire'"), f"{root}/landing", "job_changes", "2024-02-01")
    land(changes.where("change_type <> 'New Hire'"), f"{root}/landing", "job_changes", "2024-02-02")
    store.load(f"{root}/landing", "job_changes", "2024-02-01", "2024-02-01 06:00:00", "lines")
    store.load(f"{root}/landing", "job_changes", "2024-02-01", "2024-02-01 07:00:00", "lines")
    store.load(f"{root}/landing", "job_changes", "2024-02-02", "2024-02-02 06:00:00", "lines")
    fields = [("change_type", "string", "change_type")]
    return (
        flatten(store.read("job_changes"), fields, keep=["_loaded_at"])
        .groupBy("_loaded_at", "change_type")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events are landed as broken JSON: set aside, the others loaded."""
    root = scratch_dir(spark, "quarantine")
    store = RawStore(spark, f"{root}/warehouse")
    events = r.table(spark, sf_dir, "events")
    text = F.to_json(F.struct("event_id", "user_id", "event_type"))
    broken = F.when(F.col("event_type") == "error", F.substring_index(text, ',"event_type"', 1)).otherwise(text)
    events.select(broken.alias("value")).write.option("compression", "none").text(
        f"{root}/text/job_changes/load_date=2024-02-01"
    )
    store.load(f"{root}/text", "job_changes", "2024-02-01", r.SECOND_LOAD, "lines", pattern="*.txt")
    good = flatten(store.read("job_changes"), [("event_id", "long", "event_id")])
    bad = store.quarantine("job_changes").select(F.regexp_extract("value", r'"event_id":(\d+)', 1).cast("long").alias("event_id"))
    return good.withColumn("status", F.lit("loaded")).unionByName(bad.withColumn("status", F.lit("quarantined")))


PER_FILE = 2000


def _dump(records: DataFrame, key: str, folder: str, indent: int, *, nested: str | None = None, crlf: bool = False, cut: bool = False) -> None:
    """Records as the source dumps them: one indented array per ``PER_FILE`` of them, each in the order of ``key``.

    A record ends with an object or an array if ``nested`` says so. ``cut`` takes the
    end off each file, in the middle of its last record.
    """
    text = F.to_json(F.struct(*records.columns))
    pad, inner, deep = (" " * (indent * n) for n in (1, 2, 3))
    last = {None: '"kind": "x"', "object": f'"kind": {{\n{deep}"name": "x] }} [{{"\n{inner}}}', "array": f'"kind": [\n{deep}"x",\n{deep}"y}}"\n{inner}]'}[nested]
    body = F.concat(F.lit(f"{pad}{{\n{inner}\"record\": "), text, F.lit(f",\n{inner}{last}\n{pad}}}"))
    rows = records.select(F.struct(F.col(key), body.alias("one")).alias("row"), F.expr(f"{key} div {PER_FILE}").alias("file"))
    ones = F.transform(F.array_sort(F.collect_list("row")), lambda x: x["one"])
    whole = F.concat(F.lit("[\n"), F.concat_ws(",\n", ones), F.lit("\n]"))
    dumped = rows.groupBy("file").agg(whole.alias("value")).select("value")
    if cut:
        dumped = dumped.select(F.expr("left(value, length(value) - 12)").alias("value"))
    if crlf:
        dumped = dumped.select(F.regexp_replace("value", "\n", "\r\n").alias("value"))
    # one row per file, so that each part is one array
    dumped.write.option("lineSep", " ").option("compression", "none").option("maxRecordsPerFile", 1).mode("append").text(folder)


def raw_ingest_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays indented by two, by four, and with other line ends; payload and file names compared."""
    root = scratch_dir(spark, "arrays")
    store, folder = RawStore(spark, f"{root}/warehouse"), f"{root}/landing/job_changes/load_date=2024-02-01"
    events = r.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    for number, (indent, crlf) in enumerate(((2, False), (4, False), (2, True))):
        _dump(events.where(F.col("event_id") % 3 == number), "event_id", folder, indent, crlf=crlf)
    store.load(f"{root}/landing", "job_changes", "2024-02-01", r.SECOND_LOAD, pattern="*.txt")
    fields = [("record.event_id", "long", "event_id"), ("record.user_id", "long", "user_id"), ("record.event_type", "string", "event_type"), ("record.props", "string", "props"), ("kind", "string", "kind")]
    return flatten(store.read("job_changes"), fields, keep=["_loaded_at", F.col("_file_name").endswith(".txt").alias("from_file")])


def ingest_array_any_indent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of every indent whose records end in an object or an array, in a folder with a blank; some files cut off."""
    root = scratch_dir(spark, "any indent")
    store, folder = RawStore(spark, f"{root}/warehouse"), f"{root}/two landings/job_changes/load_date=2024-02-01"
    events = r.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    kinds = [(0, "object"), (1, "array"), (2, "object"), (2, "array"), (4, "object")]
    for number, (indent, nested) in enumerate(kinds):
        _dump(events.where(F.col("event_id") % 6 == number), "event_id", folder, indent, nested=nested, crlf=number == 3)
    _dump(events.where(F.col("event_id") % 6 == 5), "event_id", folder, 2, nested="array", cut=True)
    done = store.load(f"{root}/two landings", "job_changes", "2024-02-01", r.SECOND_LOAD, pattern="*.txt")
    good = flatten(store.read("job_changes"), [("record.event_id", "long", "event_id"), ("record.props", "string", "props")])
    bad = store.quarantine("job_changes").select(F.regexp_extract("value", r'"event_id":(\d+)', 1).cast("long").alias("event_id"), F.lit(None).cast("string").alias("props"))
    both = good.withColumn("status", F.lit("loaded")).unionByName(bad.withColumn("status", F.lit("quarantined")))
    return both.withColumn("n", F.lit(done.records + done.bad_records).cast("long"))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops loaded as a stream, the stream started anew before the last; one file was loaded before by hand."""
    root = scratch_dir(spark, "stream-in")
    store, landing = RawStore(spark, f"{root}/warehouse"), f"{root}/landing"
    events = r.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    for number, day in enumerate(("2024-02-01", "2024-02-02", "2024-02-03")):
        drop = events.where(F.col("event_id") % 3 == number)
        _dump(drop, "event_id", f"{landing}/job_changes/load_date={day}", number, nested="array")
        if number == 0:
            store.load(landing, "job_changes", day, r.FIRST_LOAD, pattern="*.txt")
        else:  # the second run finds one new drop, and the first drop too, which is in the manifest
            at = f"2024-02-0{number + 1} 06:00:00"
            store.stream(landing, "job_changes", f"{root}/checkpoint", pattern="*.txt", files_per_batch=1000, loaded_at=lambda batch, at=at: at).awaitTermination()
    return flatten(store.read("job_changes"), [("record.event_id", "long", "event_id"), ("record.event_type", "string", "event_type")], keep=["_loaded_at"])


class _DyingStore(RawStore):
    """A store whose job dies when all is written and nothing is entered in the log."""

    def _log(self, entity: str):
        log = super()._log(entity)

        def die(*_) -> None:
            raise InterruptedError(entity)

        log.append = die
        return log


def ingest_crash_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that dies behind its last file and is tried again: each record once."""
    root = scratch_dir(spark, "crash")
    store, dying = RawStore(spark, f"{root}/warehouse"), _DyingStore(spark, f"{root}/warehouse")
    changes = r.change_records(spark, sf_dir)
    store.load(f"{root}/landing", "job_changes", "2024-02-01", "2024-02-01 05:00:00", "lines")
    land(changes.where("change_type = 'New Hire'"), f"{root}/landing", "job_changes", "2024-02-01")
    for _ in range(2):
        try:
            dying.load(f"{root}/landing", "job_changes", "2024-02-01", "2024-02-01 06:00:00", "lines")
        except InterruptedError:
            pass
    store.load(f"{root}/landing", "job_changes", "2024-02-01", "2024-02-01 07:00:00", "lines")
    store.load(f"{root}/landing", "job_changes", "2024-02-01", "2024-02-01 08:00:00", "lines")
    return flatten(store.read("job_changes"), [("change_id", "string", "change_id")], keep=["_loaded_at"])


def land_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date landed again replaces that date only."""
    folder = scratch_dir(spark, "landing")
    events = r.table(spark, sf_dir, "events").select("event_id", "event_type")
    for day, kept in (("2024-02-01", "event_id % 2 = 0"), ("2024-02-02", "event_id % 2 = 1"), ("2024-02-02", "event_id % 4 = 1")):
        land(events.where(kept), folder, "events", day)
    return spark.read.schema("event_id long, event_type string, load_date date").json(f"{folder}/events")


def ingest_trailing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a second record behind the first, text behind it, or no object are set aside whole."""
    root = scratch_dir(spark, "trailing")
    store = RawStore(spark, f"{root}/warehouse")
    text = F.to_json(F.struct("event_id", "user_id"))
    kind = F.col("event_type")
    line = (
        F.when(kind == "error", F.concat(text, text))
        .when(kind == "click", F.concat(text, F.lit(" xx")))
        .when(kind == "signup", F.concat(F.lit("[ "), text, F.lit(" ]")))
        .when(kind == "purchase", F.concat(F.lit('"'), F.col("event_id").cast("string"), F.lit('"')))
        .otherwise(text)
    )
    r.table(spark, sf_dir, "events").select(line.alias("value")).write.option("compression", "none").text(
        f"{root}/text/job_changes/load_date=2024-02-01"
    )
    store.load(f"{root}/text", "job_changes", "2024-02-01", r.SECOND_LOAD, "lines", pattern="*.txt")
    good = flatten(store.read("job_changes"), [("event_id", "long", "event_id")])
    bad = store.quarantine("job_changes").select(F.regexp_extract("value", r"(\d+)", 1).cast("long").alias("event_id"))
    return good.withColumn("status", F.lit("loaded")).unionByName(bad.withColumn("status", F.lit("quarantined")))


def refresh_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run, twice: the second load brings changed, back-dated and re-owned records."""
    root = scratch_dir(spark, "refresh")
    return _refresh_twice(spark, sf_dir, root, Warehouse(spark, f"{root}/warehouse", buckets=8))


def refresh_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the layers in the session's catalog; the models are read from there by name."""
    root = scratch_dir(spark, "refresh")
    catalog = CatalogLayers(spark, f"run_{uuid.uuid4().hex[:12]}_")
    _refresh_twice(spark, sf_dir, root, Warehouse(spark, f"{root}/warehouse", buckets=8, catalog=catalog))
    return _shown({m: catalog.table("curated", m) for m in ("fct_headcount_daily", "fct_compensation", "fct_turnover")})


def _refresh_twice(spark: SparkSession, sf_dir: str, root: str, warehouse: Warehouse) -> DataFrame:
    number = F.substring_index("change_id", "-", -1).cast("long")
    changes = r.change_records(spark, sf_dir)
    early = changes.where((F.col("effective_date") < "2024-01-16") & (number % 7 != 0))
    # every eleventh change now belongs to the next worker
    owner = F.concat(F.lit("WKR-"), F.substring_index("worker_id", "-", -1).cast("long") + 1)
    final = changes.withColumn("worker_id", F.when(number % 11 == 0, owner).otherwise(F.col("worker_id")))
    workers = r.worker_records(spark, sf_dir)
    loads = (
        ("2024-01-16", {"workers": workers, "job_changes": early}),  # no organizations, no pay on the first day
        (
            "2024-02-01",
            {
                "workers": r.worker_records(spark, sf_dir, F.lit(1)),
                "job_changes": final,
                "organizations": r.organizations(spark, sf_dir),
                "compensation": r.pay_records(spark, sf_dir),
                "positions": r.position_records(spark, sf_dir),
                "time_off": r.time_off_records(spark, sf_dir),
            },
        ),
    )
    for day, sources in loads:
        side_by_side(spark, {e: partial(land, rows, f"{root}/landing", e, day) for e, rows in sources.items()})
        done = warehouse.refresh(
            f"{root}/landing", day, r.AS_OF, loaded_at=f"{day} 06:00:00", layout="lines", strict_checks=False, purge=True
        )
    return _shown(done.models)


def _shown(models: dict[str, DataFrame]) -> DataFrame:
    head = models["fct_headcount_daily"]
    pay = models["fct_compensation"]
    turnover_ = models["fct_turnover"]
    return (
        head.select(F.lit("headcount").alias("model"), F.col("report_date").cast("string").alias("item"), F.concat_ws("|", "organization_id", "job_family", "job_level", "work_location").alias("detail"), F.col("headcount").cast("double").alias("measure"))
        .unionByName(pay.select(F.lit("compensation").alias("model"), F.col("compensation_id").alias("item"), F.concat_ws("|", "worker_id", "job_level", "work_location").alias("detail"), F.col("salary_change_pct").alias("measure")))
        .unionByName(turnover_.select(F.lit("turnover").alias("model"), F.col("period_start").cast("string").alias("item"), F.lit("").alias("detail"), F.col("terminations").cast("double").alias("measure")))
    )


# -- streams ---------------------------------------------------------------


def scd2_reassigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that move to another worker, and others whose approval is withdrawn."""
    changes = r.job_changes(spark, sf_dir)
    number = F.substring_index("change_id", "-", -1).cast("long")
    owner = F.concat(F.lit("WKR-"), F.substring_index("worker_id", "-", -1).cast("long") + 1)
    final = changes.withColumns(
        {
            "worker_id": F.when(number % 11 == 0, owner).otherwise(F.col("worker_id")),
            "approval_status": F.when(number % 13 == 0, "Denied").otherwise(F.col("approval_status")),
        }
    )
    spec = {
        "key": "worker_id",
        "effective": "effective_date",
        "tie_break": ["source_updated_at", "change_id"],
        "carry": ["change_id", "change_type"],
    }
    approved = F.col("approval_status") == "Approved"
    target = KeyedTable(spark, scratch_dir(spark, "moved"), "worker_id", buckets=8)
    target.replace(scd2_from_changes(changes.where(approved), **spec))
    touched = final.where((number % 11 == 0) | (number % 13 == 0))
    refresh_history(target, final.where(approved), touched, change_key="change_id", **spec)
    return target.read()


def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History built from early events, then refreshed for the workers touched later."""
    changes = r.job_changes(spark, sf_dir).where("approval_status = 'Approved'")
    late = F.col("source_updated_at") >= F.lit("2024-01-25").cast("timestamp_ntz")
    # every seventh early change arrives late as well: back-dated
    late = late | (F.substring_index("change_id", "-", -1).cast("long") % 7 == 0)
    spec = {
        "key": "worker_id",
        "effective": "effective_date",
        "tie_break": ["source_updated_at", "change_id"],
        "carry": ["change_id", "change_type"],
    }
    target = KeyedTable(spark, scratch_dir(spark, "history"), "worker_id", buckets=8)
    target.replace(scd2_from_changes(changes.where(~late), **spec))
    refresh_history(target, changes, changes.where(late), **spec)
    return target.read()


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is replayed after another writer's merge, with old contents, changes nothing."""
    target = KeyedTable(spark, scratch_dir(spark, "replay"), "user_id", buckets=8)
    events = r.table(spark, sf_dir, "events")

    def build(batch: DataFrame) -> DataFrame:
        return latest_by_key(batch, ["user_id"], ["ts", "event_id"])

    early, late = events.where(F.dayofmonth("ts") <= 15), events
    merge_batch(early, 0, target, build, "one")
    merge_batch(late, 0, target, build, "two")
    merge_batch(early, 0, target, build, "one")
    return target.read()


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in four drops and are merged as a stream."""
    root = scratch_dir(spark, "stream")
    events = r.table(spark, sf_dir, "events")
    for week in range(4):
        drop = events.where(F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)) == week)
        drop.write.mode("append").parquet(f"{root}/in")
    target = KeyedTable(spark, f"{root}/latest", "user_id", buckets=8)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    stream_upsert(
        stream,
        target,
        lambda batch: latest_by_key(batch, ["user_id"], ["ts", "event_id"]),
        f"{root}/checkpoint",
    ).awaitTermination()
    return target.read()


QUERIES: dict[str, Query] = {
    "json_flatten": json_flatten,
    "latest_by_key": latest,
    "stg_workers": stg_workers,
    "stg_job_changes": stg_job_changes,
    "stg_compensation": stg_compensation,
    "scd2_history": scd2_history,
    "scd2_history_hot": scd2_history_hot,
    "dim_worker": dim_worker,
    "dim_worker_hot": dim_worker_hot,
    "dim_worker_collapse_hot": dim_worker_collapse_hot,
    "dim_org": dim_org,
    "dim_org_latest": dim_org_latest,
    "date_spine": spine,
    "headcount_daily": headcount_daily,
    "headcount_incremental": headcount_incremental,
    "headcount_overlapping": headcount_overlapping,
    "headcount_capped": headcount_capped,
    "pct_change": pct_change,
    "pct_change_hot": pct_change_hot,
    "pct_change_zero": pct_change_zero,
    "comp_current_worker": comp_current_worker,
    "comp_current_worker_hot": comp_current_worker_hot,
    "as_of_worker": as_of_worker,
    "as_of_worker_hot": as_of_worker_hot,
    "as_of_inner": as_of_inner,
    "turnover": turnover,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_accepted": dq_accepted,
    "dq_all": dq_all,
    "updated_since": changed_since,
    "page_window": page_window,
    "page_deep": page_deep,
    "page_meta": page_meta,
    "page_seek": page_seek,
    "export_pages": all_pages,
    "changed_or_created": changed_or_created,
    "flatten_lenient": flatten_lenient,
    "active_count": active_count,
    "incremental_upsert": upsert,
    "upsert_rebucketed": upsert_rebucketed,
    "schema_sync": schema_sync,
    "schema_sync_retype": schema_sync_retype,
    "raw_ingest": raw_ingest,
    "ingest_manifest": ingest_manifest,
    "ingest_quarantine": ingest_quarantine,
    "raw_ingest_array": raw_ingest_array,
    "ingest_array_any_indent": ingest_array_any_indent,
    "stream_ingest": stream_ingest,
    "ingest_crash_retry": ingest_crash_retry,
    "land_overwrite": land_overwrite,
    "ingest_trailing_text": ingest_trailing_text,
    "refresh_all": refresh_all,
    "refresh_catalog": refresh_catalog,
    "scd2_incremental": scd2_incremental,
    "scd2_reassigned": scd2_reassigned,
    "stream_upsert": stream_latest,
    "stream_replay": stream_replay,
}
