"""Broadcasts behind a measured size."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

# A broadcast table is held whole by the driver and by every executor.
MAX_BROADCAST_BYTES = 64 << 20
_FIXED_WIDTH = 16
# Text columns from which on a table counts as wide.
_WIDE = 4


def _row_bytes(df: DataFrame) -> int:
    return _FIXED_WIDTH * (1 + len(df.columns))


def _texts(df: DataFrame) -> list[Column]:
    """The bytes of each column that has no fixed width; of a nested one as JSON text."""
    sizes = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.octet_length(column))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            sizes.append(F.octet_length(F.to_json(F.struct(column))))
    return sizes


def _measure(df: DataFrame) -> DataFrame:
    size = F.count(F.lit(1)) * _row_bytes(df)
    for text in _texts(df):
        size = size + F.coalesce(F.sum(text), F.lit(0))
    return df.agg(size.alias("bytes"))


def fit_broadcast(
    dimensions: Mapping[str, DataFrame], max_bytes: int = MAX_BROADCAST_BYTES
) -> dict[str, bool]:
    """Which dimensions are small, from one job that reads their columns once.

    The answer can be kept and given to the operators as ``small``, so that a table is
    measured once and not with every question.
    """
    if max_bytes <= 0:
        return dict.fromkeys(dimensions, False)
    sizes = [_measure(df).withColumn("name", F.lit(name)) for name, df in dimensions.items()]
    found = reduce(DataFrame.unionAll, sizes).collect()
    return {row["name"]: row["bytes"] <= max_bytes for row in found}


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return fit_broadcast({"df": df}, max_bytes)["df"]


def broadcast_if_small(
    df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, small: bool | None = None
) -> DataFrame:
    """Hint a broadcast when ``df`` is measured, or known by the caller, to be small.

    Otherwise ``df`` is returned as it is, and the join shuffles both sides;
    adaptive execution then splits a hot key of the large side.

    Spark's own estimate of a joined dimension is the product of its inputs, so
    without the measure a small one would make the facts shuffle. The rows of a wide
    ``df`` are counted first, which reads no column of a stored table: its texts are
    measured only where there are few.
    """
    if max_bytes <= 0 or small is False:
        return df
    if small:
        return F.broadcast(df)
    if len(_texts(df)) > _WIDE and df.count() * _row_bytes(df) > max_bytes:
        return df
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df
