"""Checks that stop a pipeline before it publishes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.ordered import SplitPolicy
from tideline.operators.scd import CURRENT, FROM, HASH, TO, multiple_active, overlapping


class CheckFailed(Exception):
    pass


def require_empty(offending: DataFrame, message: str) -> None:
    """Raise with one sample row if the frame has any; reads no further than that row."""
    sample = offending.take(1)
    if sample:
        raise CheckFailed(f"{message}: {sample[0].asDict()}")


def unsound(keys: Sequence[str]) -> Column:
    """Whether the versions of a row's key overlap here or several of them are active, as windows over ``keys``."""
    own = Window.partitionBy(*keys)
    following, active = F.lead(FROM).over(own.orderBy(FROM, TO, HASH)), F.sum(F.col(CURRENT).cast("int")).over(own)
    late_end = following.isNotNull() & (F.col(TO).isNull() | (F.col(TO) > following))
    return late_end | (active > 1)


def require_sound_dimension(dimension: DataFrame, keys: Sequence[str], split: SplitPolicy | None = SplitPolicy()) -> None:
    """Raise if a key has several active versions or overlapping ones.

    ``split`` as in ``scd.overlapping``; without it both are looked for in one pass.
    """
    if split is None:
        seen = dimension.withColumn("__unsound", unsound(keys))
        require_empty(seen.filter("__unsound").drop("__unsound"), "overlapping or several active versions of one key")
        return
    require_empty(multiple_active(dimension, keys), "several active versions of one key")
    require_empty(overlapping(dimension, keys, split), "overlapping versions")
