from .catalog import CatalogLayers
from .landing import LoadResult, RawStore, land, list_files, read_records
from .table import KeyedTable, RebuiltTable, State, read_if_exists

__all__ = [
    "CatalogLayers",
    "KeyedTable",
    "LoadResult",
    "RawStore",
    "RebuiltTable",
    "State",
    "land",
    "list_files",
    "read_if_exists",
    "read_records",
]
