"""The driver's tables read as HR records.

customer -> workers, events -> job changes, orders -> compensation,
nation and region -> organizations, part -> positions, lineitem -> time off.
RAW copies of a record differ between loads, as repeated full pulls do.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of these bindings; the comparison SQL uses the same.
FIRST_LOAD = "2024-01-16 06:00:00"
SECOND_LOAD = "2024-02-01 06:00:00"
AS_OF = date(2024, 2, 15)
CHANGE_TYPES = {"signup": "New Hire", "purchase": "Promotion", "view": "Transfer", "error": "Termination"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), key.cast("string"))


def _ntz(text: str | Column) -> Column:
    return (F.lit(text) if isinstance(text, str) else text).cast("timestamp_ntz")


def change_type(event_type: Column) -> Column:
    out = F
    for event, name in CHANGE_TYPES.items():
        out = out.when(event_type == event, name)
    return out.otherwise("Leave")


# -- typed records ---------------------------------------------------------


def workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _id("WKR", key).alias("worker_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat(F.lower("c_mktsegment"), F.lit("."), key.cast("string"), F.lit("@example.org")).alias("email"),
        F.when(key % 3 == 0, "Male").when(key % 3 == 1, "Female").otherwise("Non-Binary").alias("gender"),
        _id("COUNTRY", F.col("c_nationkey")).alias("nationality"),
        F.when(key % 2 == 0, "Full-Time").otherwise("Part-Time").alias("employment_type"),
        F.when(F.col("c_acctbal") < 0, "Terminated").otherwise("Active").alias("employment_status"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 20).cast("int")).alias("hire_date"),
        F.lit(None).cast("date").alias("termination_date"),
        F.lit(None).cast("string").alias("termination_reason"),
        _id("POS", key % 14).alias("position_id"),
        _id("Title", key % 14).alias("job_title"),
        _id("IC", key % 3).alias("job_level"),
        F.col("c_mktsegment").alias("job_family"),
        _id("ORG", F.col("c_nationkey")).alias("organization_id"),
        _id("Org", F.col("c_nationkey")).alias("organization_name"),
        _id("Site", key % 6).alias("work_location"),
        F.lit(None).cast("string").alias("manager_id"),
    )


def job_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, event = change_type(F.col("event_type")), F.col("event_id")
    return table(spark, sf_dir, "events").select(
        _id("JCH", event).alias("change_id"),
        _id("WKR", F.col("user_id")).alias("worker_id"),
        kind.alias("change_type"),
        F.col("ts").cast("date").alias("effective_date"),
        F.when(kind != "Termination", _id("POS", event % 14)).alias("new_position_id"),
        F.when(kind == "Transfer", _id("ORG", event % 25)).alias("new_organization_id"),
        F.when(F.col("event_type") == "click", "Pending").otherwise("Approved").alias("approval_status"),
        F.col("ts").alias("source_updated_at"),
    )


def compensation(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, pay = F.col("o_orderkey"), F.col("o_totalprice")
    pct = ((key % 5) * 5).cast("double")
    return table(spark, sf_dir, "orders").select(
        _id("CMP", key).alias("compensation_id"),
        _id("WKR", F.col("o_custkey")).alias("worker_id"),
        F.col("o_orderdate").cast("date").alias("effective_date"),
        F.lit("Salary").alias("compensation_type"),
        F.when(key % 3 == 0, "USD").when(key % 3 == 1, "GBP").otherwise("CAD").alias("currency"),
        pay.alias("base_salary"),
        pct.alias("bonus_target_pct"),
        (pay * pct / 100).alias("bonus_target_amount"),
        (pay * (1 + pct / 100)).alias("total_compensation"),
        F.lit("Semi-Monthly").alias("pay_frequency"),
        F.col("o_orderdate").alias("source_updated_at"),
        _ntz(SECOND_LOAD).alias("_loaded_at"),
    )


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region rows as departments and nation rows as their teams."""
    text = F.lit(None).cast("string")
    departments = table(spark, sf_dir, "region").select(
        _id("DEP", F.col("r_regionkey")).alias("id"),
        F.col("r_name").alias("name"),
        text.alias("parent_id"),
        F.lit("Department").alias("type"),
    )
    teams = table(spark, sf_dir, "nation").select(
        _id("ORG", F.col("n_nationkey")).alias("id"),
        F.col("n_name").alias("name"),
        _id("DEP", F.col("n_regionkey")).alias("parent_id"),
        F.lit("Team").alias("type"),
    )
    return departments.unionByName(teams)


# -- nested records, as the source sends them ------------------------------


def worker_records(spark: SparkSession, sf_dir: str, load: Column | None = None) -> DataFrame:
    """Nested worker records; level and account change with the load number."""
    load = F.lit(0) if load is None else load
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _id("WKR", key).alias("worker_id"),
        F.struct(
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.concat(F.lower("c_mktsegment"), F.lit("@example.org")).alias("email"),
            F.lit(None).cast("string").alias("phone"),
            F.date_add(F.lit("1960-01-01").cast("date"), (key % 9000).cast("int")).cast("string").alias("date_of_birth"),
            F.when(key % 3 == 0, "Male").when(key % 3 == 1, "Female").otherwise("Non-Binary").alias("gender"),
            _id("COUNTRY", F.col("c_nationkey")).alias("nationality"),
        ).alias("personal_data"),
        F.struct(
            F.when(key % 2 == 0, "Full-Time").otherwise("Part-Time").alias("employment_type"),
            F.when(F.col("c_acctbal") < 0, "Terminated").otherwise("Active").alias("status"),
            F.date_add(F.lit("2024-01-01").cast("date"), (key % 20).cast("int")).cast("string").alias("hire_date"),
            F.when(F.col("c_acctbal") < 0, "2024-01-31").alias("termination_date"),
            F.when(F.col("c_acctbal") < 0, "Voluntary").alias("termination_reason"),
        ).alias("employment_data"),
        F.struct(
            _id("POS", key % 14).alias("position_id"),
            _id("Title", key % 14).alias("title"),
            _id("IC", (key + load) % 3).alias("level"),
            F.col("c_mktsegment").alias("job_family"),
            _id("ORG", F.col("c_nationkey")).alias("organization_id"),
            _id("Org", F.col("c_nationkey")).alias("organization_name"),
            _id("Site", key % 6).alias("location"),
            F.lit(None).cast("string").alias("manager_id"),
        ).alias("current_position"),
        F.lit("2023-12-01T00:00:00").alias("created_at"),
    )


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, event = change_type(F.col("event_type")), F.col("event_id")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select(
        _id("JCH", event).alias("change_id"),
        _id("WKR", F.col("user_id")).alias("worker_id"),
        kind.alias("change_type"),
        kind.alias("reason"),
        F.col("ts").cast("date").cast("string").alias("effective_date"),
        _id("POS", (event + 1) % 14).alias("old_position_id"),
        F.when(kind != "Termination", _id("POS", event % 14)).alias("new_position_id"),
        F.lit(None).cast("string").alias("old_organization_id"),
        F.when(kind == "Transfer", _id("ORG", event % 25)).alias("new_organization_id"),
        F.col("event_type").alias("initiated_by"),
        F.when(F.col("event_type") == "click", "Pending").otherwise("Approved").alias("approval_status"),
        at.alias("created_at"),
        at.alias("updated_at"),
    )


def pay_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, pay = F.col("o_orderkey"), F.col("o_totalprice")
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "orders").select(
        _id("CMP", key).alias("compensation_id"),
        _id("WKR", F.col("o_custkey")).alias("worker_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("effective_date"),
        F.lit("Salary").alias("compensation_type"),
        F.when(key % 3 == 0, "USD").when(key % 3 == 1, "GBP").otherwise("CAD").alias("currency"),
        pay.alias("base_salary"),
        ((key % 5) * 5).alias("bonus_target_pct"),
        (pay * (key % 5)).alias("bonus_target_amount"),
        (pay * 2).alias("total_compensation"),
        F.lit("Semi-Monthly").alias("pay_frequency"),
        at.alias("created_at"),
        at.alias("updated_at"),
    )


def position_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _id("POS", F.col("p_partkey")).alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("level"),
        F.col("p_type").alias("family"),
    )


def time_off_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("l_shipdate").cast("date")
    days = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.lit("PTO"), "l_orderkey", "l_linenumber").alias("time_off_id"),
        _id("WKR", F.col("l_suppkey")).alias("worker_id"),
        F.col("l_returnflag").alias("type"),
        start.cast("string").alias("start_date"),
        F.date_add(start, days).cast("string").alias("end_date"),
        days.alias("days_requested"),
        F.when(F.col("l_linestatus") == "F", "Approved").otherwise("Pending").alias("status"),
    )


def as_raw(records: DataFrame, entity: str, loaded_at: Column | str, file_name: Column | str) -> DataFrame:
    """RAW rows: the record as parsed JSON, with its lineage."""
    file = F.lit(file_name) if isinstance(file_name, str) else file_name
    return records.select(
        F.parse_json(F.to_json(F.struct("*"))).alias("raw_data"),
        _ntz(loaded_at).alias("_loaded_at"),
        file.alias("_file_name"),
        F.lit(entity).alias("_source"),
    )


def raw_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three copies of each worker: an earlier load, then two versions in one load."""

    def copy(load: int, loaded_at: str, updated_at: Column) -> DataFrame:
        records = worker_records(spark, sf_dir, F.lit(load)).withColumn("updated_at", updated_at)
        return as_raw(records, "workers", loaded_at, f"workers_{loaded_at[:10]}.json")

    fifth = F.substring_index("worker_id", "-", -1).cast("long") % 5 == 0
    return (
        copy(0, FIRST_LOAD, F.lit("2024-01-15T08:00:00"))
        .unionByName(copy(1, SECOND_LOAD, F.lit("2024-01-31T08:00:00.250000")))
        .unionByName(copy(2, SECOND_LOAD, F.when(~fifth, F.lit("2024-01-20T08:00:00"))))
    )


def raw_job_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load: events before it, all still pending. Second load: all events."""
    records = change_records(spark, sf_dir)
    early = records.where(F.col("created_at").cast("timestamp_ntz") < _ntz(FIRST_LOAD)).withColumn(
        "approval_status", F.lit("Pending")
    )
    return as_raw(early, "job_changes", FIRST_LOAD, "job_changes_2024-01-16.json").unionByName(
        as_raw(records, "job_changes", SECOND_LOAD, "job_changes_2024-02-01.json")
    )


def raw_compensation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full pulls; the second one has the salaries raised by one."""
    records = pay_records(spark, sf_dir)
    raised = records.withColumn("base_salary", F.col("base_salary") + 1)
    return as_raw(records, "compensation", FIRST_LOAD, "compensation_2024-01-16.json").unionByName(
        as_raw(raised, "compensation", SECOND_LOAD, "compensation_2024-02-01.json")
    )


def raw_organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full pulls that differ only in their times."""
    records = organizations(spark, sf_dir)

    def pull(at: str) -> DataFrame:
        stamped = records.withColumn("updated_at", F.lit(at.replace(" ", "T")))
        return as_raw(stamped, "organizations", at, f"organizations_{at[:10]}.json")

    return pull(FIRST_LOAD).unionByName(pull(SECOND_LOAD))
