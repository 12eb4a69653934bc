"""Column expressions shared by the pipelines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(38, 2)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(amount: Column | str) -> Column:
    """Exact cents: a sum of doubles depends on partition order, a decimal sum does not."""
    return _column(amount).cast(MONEY)


def money_total(amount: Column | str) -> Column:
    """A sum of money, rounded to cents, with room for any number of rows."""
    return _column(amount).cast(TOTAL)


def money_out(amount: Column | str) -> Column:
    """Back to the double of the published schemas, rounded to cents first."""
    return money_total(amount).cast("double")


def parse_timestamp(text: Column | str) -> Column:
    """Zone-less timestamp from text; unreadable text becomes null instead of failing the job."""
    return _column(text).try_cast("timestamp_ntz")


def moment(at: datetime | str, kind: T.DataType) -> Column:
    """A literal time of type ``kind``, free of the driver's own time zone."""
    return F.lit(str(at)).cast(kind)


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def differs(left: Column, right: Column, tolerance: float) -> Column:
    """True where two amounts are further apart than ``tolerance``, compared as decimals."""
    return F.abs(money(left) - money(right)) > F.lit(tolerance).cast(MONEY)


def position(df: DataFrame, column: str) -> Column:
    """A number that grows with ``column``, whatever the session time zone is."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        of_day = F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
        return (F.unix_date(value.cast("date")).cast("double") * 86400) + of_day
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    return value.cast("double")
