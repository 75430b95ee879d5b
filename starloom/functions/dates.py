"""Column expressions for calendar attributes; all run inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_KEY_PATTERN = "yyMMdd"


def date_key(ts: Column, pattern: str = DEFAULT_KEY_PATTERN) -> Column:
    """Integer day key; NULL in gives NULL out.

    The two usual patterns are plain integer arithmetic, which equals formatting
    the day and casting the text but allocates no string per row. Two-digit years
    make 1905 and 2005 share keys; pass ``yyyyMMdd`` where that matters.
    """
    day = F.month(ts) * 100 + F.dayofmonth(ts)
    if pattern == "yyMMdd":
        return (F.pmod(F.year(ts), F.lit(100)) * 10000 + day).cast("int")
    if pattern == "yyyyMMdd":
        return (F.year(ts) * 10000 + day).cast("int")
    return F.date_format(ts, pattern).cast("int")


def year_quarter(ts: Column) -> Column:
    """Text such as ``2005Q1``."""
    return F.concat(F.year(ts).cast("string"), F.lit("Q"), F.quarter(ts).cast("string"))


def calendar_columns(
    day: Column, pattern: str = DEFAULT_KEY_PATTERN, as_text: bool = False
) -> list[Column]:
    """The nine date-dimension columns of one day.

    ``week`` is the ISO week while ``year`` is the calendar year, so 2005-01-01
    is year 2005, week 53. With ``as_text`` the key keeps its leading zero and
    the weekend flag is the text true/false, as an untyped extract has them.
    """
    weekend = F.weekday(day) >= 5
    return [
        (F.date_format(day, pattern) if as_text else date_key(day, pattern)).alias("date_key"),
        day.cast("date").alias("date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        year_quarter(day).alias("year_quart"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week"),
        (weekend.cast("string") if as_text else weekend).alias("is_weekend"),
    ]
