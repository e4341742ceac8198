"""Calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week(date_col: str | Column = "date") -> Column:
    """1 = Monday ... 7 = Sunday, as bigint."""
    return (F.weekday(date_col) + 1).cast("long")


def is_weekend(dow: Column) -> Column:
    return F.when(dow.isin(6, 7), 1).otherwise(0).cast("long")


def calendar_dict(date_col: str = "date") -> dict[str, Column]:
    """Year, month, quarter, ISO week, weekday, weekend flag (all bigint)."""
    d = F.col(date_col)
    dow = day_of_week(d)
    return {
        "year": F.year(d).cast("long"),
        "month": F.month(d).cast("long"),
        "quarter": F.quarter(d).cast("long"),
        "week_of_year": F.weekofyear(d).cast("long"),
        "day_of_week": dow,
        "is_weekend": is_weekend(dow),
    }


def calendar_columns(date_col: str = "date") -> list[Column]:
    return [c.alias(n) for n, c in calendar_dict(date_col).items()]


def date_range(start: str | Column, end: str | Column) -> Column:
    """One element per day from start to end inclusive (explode it)."""
    s = F.to_date(start) if isinstance(start, Column) else F.lit(start).cast("date")
    e = F.to_date(end) if isinstance(end, Column) else F.lit(end).cast("date")
    return F.explode(F.sequence(s, e, F.expr("interval 1 day")))
