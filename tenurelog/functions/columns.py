"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end date of a validity interval that is still open.
OPEN_END = "9999-12-31"


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def asc(*names: str) -> list[Column]:
    """Ascending with NULL as the largest value (Spark's own default is smallest)."""
    return [F.col(n).asc_nulls_last() for n in names]


def desc(*names: str) -> list[Column]:
    """Descending with NULL as the largest value."""
    return [F.col(n).desc_nulls_first() for n in names]


def order_struct(names: Iterable[str]) -> Column:
    """One comparable value that sorts exactly as ``asc(*names)`` does."""
    parts = []
    for i, n in enumerate(names):
        parts += [F.col(n).isNull().alias(f"n{i}"), F.col(n).alias(f"v{i}")]
    return F.struct(*parts)


def null_safe_equal(left: Iterable[str], right: Iterable[str]) -> Column:
    """Equi-join condition under which NULL keys match each other, as in a window group."""
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)]
    return reduce(lambda a, b: a & b, pairs)


def text_key(*parts: Column) -> Column:
    """Parts joined by ``|``; one NULL part makes the whole key NULL."""
    joined = parts[0].cast("string")
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("|"), part.cast("string"))
    return joined


def hash_key(*parts: Column) -> Column:
    """Surrogate key: lower-case hex MD5 of :func:`text_key`."""
    return F.md5(text_key(*parts))


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero, once, on the shortest decimal that stands for the double."""
    return F.round(value, digits)
