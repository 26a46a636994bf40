"""Dates: business days, source days and request windows, as column expressions and small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _weekdays_up_to(day: Column) -> Column:
    """Mondays to Fridays from Monday 1970-01-05 up to ``day``, inclusive."""
    n = F.datediff(day, F.lit("1970-01-05").cast("date")) + 1
    return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))


def business_days(start: Column, end: Column) -> Column:
    """Mondays to Fridays after ``start`` up to ``end``; 0 unless end is later.  Closed form, no sequence."""
    return F.when(end > start, _weekdays_up_to(end) - _weekdays_up_to(start)).otherwise(0).cast("int")


def source_day(moment: Column) -> Column:
    """The calendar day in central Mexico at a UTC timestamp."""
    return F.to_date(F.from_utc_timestamp(moment, "America/Mexico_City"))


def parse_day(text: Column) -> Column:
    """Day, month and year, digits possibly not padded; null if unreadable."""
    return F.to_date(F.try_to_timestamp(text, F.lit("d/M/yyyy")))


def quarterly_windows(spans: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Each span cut at quarter starts: adjacent windows that cover it exactly.  Spans that end before they start give none."""
    valid = spans.where(F.col(end) >= F.col(start))
    each = valid.withColumn("__q", F.explode(F.sequence(F.trunc(start, "quarter"), F.col(end), F.expr("interval 3 months"))))
    return each.select(
        *[c for c in spans.columns],
        F.greatest(F.col("__q"), F.col(start)).alias("window_start"),
        F.least(F.date_sub(F.add_months("__q", 3), 1), F.col(end)).alias("window_end"),
    )


def split_windows(windows: DataFrame, start: str = "window_start", end: str = "window_end") -> DataFrame:
    """Two adjacent halves of each window of two days or more, the first the longer; ``exhausted`` marks one-day windows, kept as they are."""
    days = F.datediff(end, start) + 1
    middle = F.date_add(start, (F.ceil(days / 2) - 1).cast("int"))
    halves = F.when(days > 1, F.array(F.struct(F.col(start).alias("s"), middle.alias("e")), F.struct(F.date_add(middle, 1).alias("s"), F.col(end).alias("e")))).otherwise(F.array(F.struct(F.col(start).alias("s"), F.col(end).alias("e"))))
    other = [c for c in windows.columns if c not in (start, end)]
    return windows.select(*other, (days <= 1).alias("exhausted"), F.posexplode(halves).alias("half", "__w")).select(*other, "exhausted", "half", F.col("__w.s").alias(start), F.col("__w.e").alias(end))


def look_back(today: Column, days: int) -> tuple[Column, Column]:
    """The window of ``days`` days that ends today."""
    if days < 1:
        raise ValueError("a window has one day at least")
    return F.date_sub(today, days - 1), today
