from .curated import HeadcountSteps, dim_org, dim_worker, fct_compensation, fct_headcount_daily, fct_turnover
from .models import CHECKS, ENTITIES
from .refined import stg_compensation, stg_job_changes, stg_workers
from .refresh import Refresh, Warehouse

__all__ = [
    "CHECKS",
    "ENTITIES",
    "HeadcountSteps",
    "Refresh",
    "Warehouse",
    "dim_org",
    "dim_worker",
    "fct_compensation",
    "fct_headcount_daily",
    "fct_turnover",
    "stg_compensation",
    "stg_job_changes",
    "stg_workers",
]
