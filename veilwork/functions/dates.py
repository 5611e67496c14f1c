"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def is_weekend(c: Column) -> Column:
    return F.weekday(c) >= 5


def date_parts(c: Column, with_week: bool = True) -> list[Column]:
    """Date-dimension columns; `with_week` adds day_name and the ISO week."""
    named = {
        "date_key": date_key(c),
        "full_date": c,
        "day": F.dayofmonth(c),
        "day_name": F.date_format(c, "EEEE"),
        "week": F.weekofyear(c),
        "month": F.month(c),
        "month_name": F.date_format(c, "MMMM"),
        "quarter": F.quarter(c),
        "year": F.year(c),
        "is_weekend": is_weekend(c),
    }
    if not with_week:
        del named["day_name"], named["week"]
    return [value.alias(name) for name, value in named.items()]
