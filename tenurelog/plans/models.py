"""The HR models: what is read from each record, and the declared checks."""

from __future__ import annotations

from ..operators.flatten import Field
from ..operators.quality import Check

# ---------------------------------------------------------------------------
# Entity names, JSON paths, types, column names and checks.
# ---------------------------------------------------------------------------

ENTITIES = ("workers", "positions", "organizations", "compensation", "time_off", "job_changes")

WORKER_FIELDS: tuple[Field, ...] = (
    ("worker_id", "string", "worker_id"),
    ("personal_data.first_name", "string", "first_name"),
    ("personal_data.last_name", "string", "last_name"),
    ("personal_data.email", "string", "email"),
    ("personal_data.phone", "string", "phone"),
    ("personal_data.date_of_birth", "date", "date_of_birth"),
    ("personal_data.gender", "string", "gender"),
    ("personal_data.nationality", "string", "nationality"),
    ("employment_data.employment_type", "string", "employment_type"),
    ("employment_data.status", "string", "employment_status"),
    ("employment_data.hire_date", "date", "hire_date"),
    ("employment_data.termination_date", "date", "termination_date"),
    ("employment_data.termination_reason", "string", "termination_reason"),
    ("current_position.position_id", "string", "position_id"),
    ("current_position.title", "string", "job_title"),
    ("current_position.level", "string", "job_level"),
    ("current_position.job_family", "string", "job_family"),
    ("current_position.organization_id", "string", "organization_id"),
    ("current_position.organization_name", "string", "organization_name"),
    ("current_position.location", "string", "work_location"),
    ("current_position.manager_id", "string", "manager_id"),
    ("created_at", "timestamp_ntz", "source_created_at"),
    ("updated_at", "timestamp_ntz", "source_updated_at"),
)

JOB_CHANGE_FIELDS: tuple[Field, ...] = (
    ("change_id", "string", "change_id"),
    ("worker_id", "string", "worker_id"),
    ("change_type", "string", "change_type"),
    ("reason", "string", "change_reason"),
    ("effective_date", "date", "effective_date"),
    ("old_position_id", "string", "old_position_id"),
    ("new_position_id", "string", "new_position_id"),
    ("old_organization_id", "string", "old_organization_id"),
    ("new_organization_id", "string", "new_organization_id"),
    ("initiated_by", "string", "initiated_by"),
    ("approval_status", "string", "approval_status"),
    ("created_at", "timestamp_ntz", "source_created_at"),
    ("updated_at", "timestamp_ntz", "source_updated_at"),
)

COMPENSATION_FIELDS: tuple[Field, ...] = (
    ("compensation_id", "string", "compensation_id"),
    ("worker_id", "string", "worker_id"),
    ("effective_date", "date", "effective_date"),
    ("compensation_type", "string", "compensation_type"),
    ("currency", "string", "currency"),
    ("base_salary", "double", "base_salary"),
    ("bonus_target_pct", "double", "bonus_target_pct"),
    ("bonus_target_amount", "double", "bonus_target_amount"),
    ("total_compensation", "double", "total_compensation"),
    ("pay_frequency", "string", "pay_frequency"),
    ("created_at", "timestamp_ntz", "source_created_at"),
    ("updated_at", "timestamp_ntz", "source_updated_at"),
)

ORGANIZATION_FIELDS: tuple[Field, ...] = (
    ("id", "string", "org_id"),
    ("name", "string", "org_name"),
    ("parent_id", "string", "parent_org_id"),
    ("type", "string", "org_type"),
)

LINEAGE = ("_loaded_at", "_file_name")

# Worker columns the dimension shows as they are now (no phone, no birth date).
WORKER_NOW = (
    "first_name",
    "last_name",
    "email",
    "gender",
    "nationality",
    "employment_type",
)

HEADCOUNT_DIMS = ("organization_id", "organization_name", "job_family", "job_level", "work_location")

CHECKS: tuple[Check, ...] = (
    Check("stg_workers", "worker_id", "unique"),
    Check("stg_workers", "worker_id", "not_null"),
    Check("stg_workers", "employment_status", "accepted_values", ("Active", "Terminated")),
    Check("stg_job_changes", "change_id", "unique"),
    Check("stg_job_changes", "change_id", "not_null"),
    Check("stg_job_changes", "worker_id", "not_null"),
    Check("stg_compensation", "compensation_id", "unique"),
    Check("stg_compensation", "compensation_id", "not_null"),
    Check("stg_compensation", "worker_id", "not_null"),
    Check("dim_worker", "worker_dim_key", "not_null"),
    Check("dim_worker", "worker_id", "not_null"),
    Check("dim_org", "org_key", "unique"),
    Check("dim_org", "org_key", "not_null"),
    Check("fct_headcount_daily", "report_date", "not_null"),
    Check("fct_compensation", "compensation_id", "unique"),
    Check("fct_compensation", "compensation_id", "not_null"),
)
