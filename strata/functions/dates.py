"""Calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(value: Column) -> Column:
    """The ``yyyyMMdd`` integer of a date or timestamp: arithmetic, so no text is built."""
    day = F.to_date(value)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
