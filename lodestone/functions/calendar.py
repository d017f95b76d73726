"""Calendar attributes. They are functions of the date, so a star query can
compute them in its scan stage instead of joining a date table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_of_key(key: Column) -> Column:
    return F.make_date(F.floor(key / 10000), F.floor(key / 100) % 100, key % 100)


def calendar_columns(day: Column) -> dict[str, Column]:
    """Every attribute of the date dimension for one date expression."""
    weekday = F.dayofweek(day) - 1  # 0 = Sunday
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day": F.dayofmonth(day),
        "day_of_week": weekday.cast("int"),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": weekday.isin(0, 6),
    }
