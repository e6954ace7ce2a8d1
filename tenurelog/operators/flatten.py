"""Nested JSON to flat typed columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

Field = tuple[str, str, str]  # (path, type, alias)


def flatten(
    raw: DataFrame,
    fields: Iterable[Field],
    *,
    record: str = "raw_data",
    keep: Sequence[str] = (),
    strict: bool = True,
) -> DataFrame:
    """Project typed columns out of one semi-structured column.

    ``record`` may be a VARIANT or a struct; a path such as ``a.b`` reads a
    nested field. A missing path and a JSON null both give NULL. With
    ``strict`` a value that does not fit its type fails the job; without, it
    becomes NULL. On a parquet VARIANT Spark pushes the paths into the scan.
    """
    if isinstance(raw.schema[record].dataType, VariantType):
        get = F.variant_get if strict else F.try_variant_get
        columns = [get(record, f"$.{path}", kind).alias(name) for path, kind, name in fields]
    else:
        columns = []
        for path, kind, name in fields:
            field = F.col(f"{record}.{path}")
            columns.append((field.cast(kind) if strict else field.try_cast(kind)).alias(name))
    return raw.select(*columns, *keep)
