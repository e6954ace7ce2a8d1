"""Hand-written records with fixed ids and times, in the source's shapes."""

from __future__ import annotations

import json
import os


def worker(id_, *, status="Active", hired="2024-01-01", level="IC3", updated="2024-01-31T08:00:00", org="ORG001"):
    return {
        "worker_id": id_,
        "personal_data": {
            "first_name": f"First {id_}",
            "last_name": f"Last {id_}",
            "email": f"{id_.lower()}@example.org",
            "phone": "555-0100",
            "date_of_birth": "1980-02-29",
            "gender": "Female",
            "nationality": "Chile",
        },
        "employment_data": {
            "employment_type": "Full-Time",
            "status": status,
            "hire_date": hired,
            "termination_date": None,
            "termination_reason": None,
        },
        "current_position": {
            "position_id": "POS001",
            "title": "Engineer",
            "level": level,
            "job_family": "Engineering",
            "organization_id": org,
            "organization_name": "Platform",
            "location": "Remote",
            "manager_id": None,
        },
        "hire_date": hired,
        "created_at": "2024-01-01T00:00:00.000001",
        "updated_at": updated,
    }


def change(
    id_, worker_id, kind, day, *, status="Approved", position=None, org=None, updated="2024-01-31T08:00:00", reason=None
):
    return {
        "change_id": id_,
        "worker_id": worker_id,
        "change_type": kind,
        "reason": reason or kind,
        "effective_date": day,
        "old_position_id": None,
        "new_position_id": position,
        "old_organization_id": None,
        "new_organization_id": org,
        "initiated_by": "Someone",
        "approval_status": status,
        "created_at": "2024-01-01T00:00:00",
        "updated_at": updated,
    }


def pay(id_, worker_id, day, salary, *, currency="USD", updated="2024-01-31T08:00:00"):
    return {
        "compensation_id": id_,
        "worker_id": worker_id,
        "effective_date": day,
        "compensation_type": "Salary",
        "currency": currency,
        "base_salary": salary,
        "bonus_target_pct": 10,
        "bonus_target_amount": salary * 0.1,
        "total_compensation": salary * 1.1,
        "pay_frequency": "Semi-Monthly",
        "created_at": "2024-01-01T00:00:00",
        "updated_at": updated,
    }


def org(id_, name, parent=None, pulled="2024-01-31T08:00:00"):
    return {
        "id": id_,
        "name": name,
        "parent_id": parent,
        "type": "Team" if parent else "Department",
        "created_at": pulled,
        "updated_at": pulled,
    }


def land_text(root, entity, load_date, text, name=None):
    folder = os.path.join(root, entity, f"load_date={load_date}")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name or f"{entity}_{load_date}.json")
    with open(path, "w") as f:
        f.write(text)
    return path


def land_lines(root, entity, load_date, records, **kw):
    return land_text(root, entity, load_date, "".join(json.dumps(r) + "\n" for r in records), **kw)


def raw(spark, loads):
    """RAW rows from ``[(loaded_at, records), ..]``."""
    from pyspark.sql import functions as F

    rows = [
        (json.dumps(record), loaded_at, f"file_{loaded_at[:10]}.json")
        for loaded_at, records in loads
        for record in records
    ]
    return spark.createDataFrame(rows, "j string, t string, f string").select(
        F.parse_json("j").alias("raw_data"),
        F.col("t").cast("timestamp_ntz").alias("_loaded_at"),
        F.col("f").alias("_file_name"),
        F.lit("x").alias("_source"),
    )
