"""Joins of a large table with a smaller one, safe for any size and any key skew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def _field_bytes(field: T.StructField) -> Column:
    col, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType):
        size = F.octet_length(col)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        size = 8 * F.size(col)
    elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        size = F.octet_length(F.to_json(col))
    else:
        size = F.lit(0)
    return 8 + F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long")


def data_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``, measured by one aggregation over it."""
    row = reduce(lambda a, b: a + b, [_field_bytes(f) for f in df.schema.fields], F.lit(16).cast("long"))
    return df.agg(F.sum(row).alias("bytes")).first()["bytes"] or 0


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    max_bytes: int = MAX_BROADCAST_BYTES,
    small_bytes: int | None = None,
) -> DataFrame:
    """Join ``big`` with ``small``: broadcast if ``small`` measures at most ``max_bytes``.

    Beyond that it is a sort-merge join whose hot keys adaptive execution splits; nothing runs
    over ``big`` to plan it. ``small_bytes`` is the size of ``small`` if the caller has measured it already.

    The sort-merge join is asked for by name. Spark takes a table read from files for as large as its compressed files, shared
    out among its columns by type: the ids of millions of people, beside columns that take no space, look few enough to broadcast.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join keeps the large side on the left: {how!r} is not supported")
    if small_bytes is None:
        small_bytes = data_bytes(small)
    return big.join(F.broadcast(small) if small_bytes <= max_bytes else small.hint("merge"), on, how)
