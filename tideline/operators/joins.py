"""Join helpers: size-checked broadcast and change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.ordered import null_safe

# 32 MB as estimated by the optimizer. The estimate starts from file sizes and
# filters do not lower it, so it errs towards not broadcasting.
BROADCAST_BYTES = 32 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a frame; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return planned_bytes(df) <= limit


def fits(written: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of a written table fit as they are sent, by their count (from file footers) and the columns' default widths.

    Compressed files can hold rows of many times their size.
    """
    width = 8 * (len(written.columns) + 1) + sum(_width(f.dataType) for f in written.schema.fields)
    return written.count() * width <= limit


def _width(kind: T.DataType) -> int:
    if isinstance(kind, T.StructType):
        return sum(8 + _width(f.dataType) for f in kind.fields)
    return 24 if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)) else 0


def dimension_join(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str = "inner", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join a dimension, broadcast only while its planned size is within ``limit``.

    Beyond it the join is left to the adaptive planner: a sort-merge join whose
    skewed partitions are split. Use ``skew.heavy_key_join`` when one key is so
    hot that the split itself should be laid out beforehand.
    """
    side = F.broadcast(dimension) if is_small(dimension, limit) else dimension
    return fact.join(side, list(keys), how)


def rows_of(df: DataFrame, wanted: DataFrame, keys: Sequence[str], how: str = "left_semi", limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``df`` whose key is in ``wanted`` (``left_anti``: is not); a null key equals a null key."""
    renamed = wanted.select(*[F.col(k).alias(f"__wanted_{k}") for k in keys])
    side = F.broadcast(renamed) if is_small(renamed, limit) else renamed
    return df.join(side, null_safe([(k, f"__wanted_{k}") for k in keys]), how)


def sum_before_join(df: DataFrame, keys: Sequence[str], **sums) -> DataFrame:
    """Reduce the many-rows side to one row per join key: ``total=column`` pairs."""
    return df.groupBy(*keys).agg(*[F.sum(column).alias(name) for name, column in sums.items()])


def changed_rows(
    incoming: DataFrame, current: DataFrame, keys: Sequence[str], hash_column: str, include_new: bool = True
) -> DataFrame:
    """Incoming rows whose key is new or whose hash differs from the current one.

    The current side is cut down to key and hash and renamed first, so no
    column of the result is ambiguous.
    """
    known = current.select(*keys, F.col(hash_column).alias("__known"))
    different = F.col(hash_column) != F.col("__known")
    if include_new:
        joined = incoming.join(known, list(keys), "left").filter(F.col("__known").isNull() | different)
    else:
        joined = incoming.join(known, list(keys), "inner").filter(different)
    return joined.select(*incoming.columns)
