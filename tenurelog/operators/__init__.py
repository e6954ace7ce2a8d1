from .access import Page, page, page_after, status_counts, updated_since
from .asof import as_of_join
from .change import change_over_previous
from .flatten import flatten
from .history import scd2_from_changes
from .latest import latest_by_key
from .numbering import export_pages, number_rows
from .quality import (
    Check,
    DataTestFailure,
    duplicate_values,
    require_clean,
    run_checks,
    unexpected_values,
)
from .skew import KeySplit, split_hot_keys, with_neighbour
from .snapshot import date_spine, interval_snapshot, spine_bounds
from .steps import StepTable
from .upsert import incremental_upsert, newer_than

__all__ = [
    "Check",
    "DataTestFailure",
    "KeySplit",
    "Page",
    "StepTable",
    "as_of_join",
    "change_over_previous",
    "date_spine",
    "duplicate_values",
    "export_pages",
    "flatten",
    "incremental_upsert",
    "interval_snapshot",
    "latest_by_key",
    "newer_than",
    "number_rows",
    "page",
    "page_after",
    "require_clean",
    "run_checks",
    "scd2_from_changes",
    "spine_bounds",
    "split_hot_keys",
    "status_counts",
    "unexpected_values",
    "updated_since",
    "with_neighbour",
]
