"""Row hash for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the encoding: escape, separator, null mark. Data never
# contains the null mark, because its backslashes are doubled.
ESCAPE = "\\"
SEPARATOR = "|"
NULL_MARK = "\\N"


def _as_text(df: DataFrame, name: str, scale: int) -> Column:
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        # The text of a double differs between engines (1.0E8, 100000000.0).
        return F.coalesce(value.try_cast(T.DecimalType(38, scale)).cast("string"), value.cast("string"))
    return value.cast("string")


def row_hash(df: DataFrame, columns: Sequence[str], scale: int = 6) -> Column:
    """SHA-256 over ``columns``, in which nulls and separators keep their place.

    ``concat_ws`` alone skips nulls, so ``(a, null, b)`` and ``(a, b, null)``
    would hash alike and a change would be missed.
    """
    parts = []
    for name in columns:
        text = F.replace(_as_text(df, name, scale), F.lit(ESCAPE), F.lit(ESCAPE * 2))
        text = F.replace(text, F.lit(SEPARATOR), F.lit(ESCAPE + SEPARATOR))
        parts.append(F.coalesce(text, F.lit(NULL_MARK)))
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)
