"""Published aggregates, kept up to date from the days that an upsert touched.

Two tables lie behind them: ``parts`` has one row for each day and group (count, exact sum, least and greatest
price), in partitions of the raw table's days; ``final`` has the groups, in partitions of a period (a year).  After an
upsert the raw rows of its days are aggregated anew and nothing else of the raw table is read; the periods of those days are
then added up from their parts.  The parts of a period are as many as its days times its groups, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD = "period"


def touched_days(stage: DataFrame, day: str = "fecha") -> list[date]:
    """The days that an upsert of ``stage`` rewrites; no more than the calendar has."""
    return sorted(r[0] for r in stage.select(day).where(F.col(day).isNotNull()).distinct().collect())


def parts_of(priced: DataFrame, by: list[str], day: str = "fecha", price: str = "farm_gate") -> DataFrame:
    """A row for each day and group: ``n`` (prices), ``total``, ``least`` and ``greatest``; sums are exact if prices are decimals."""
    return priced.groupBy(*by, day).agg(F.count(price).alias("n"), F.sum(price).alias("total"), F.min(price).alias("least"), F.max(price).alias("greatest"))


def finals_of(parts: DataFrame, by: list[str], day: str = "fecha", period: Callable[[Column], Column] = F.year) -> DataFrame:
    """A row for each group and period, from the parts of its days; a group without any price has a null mean."""
    sums = parts.groupBy(*by, period(F.col(day)).alias(PERIOD)).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    return sums.select(*by, "n", mean.alias("mean"), "least", "greatest", PERIOD)


def _replace(rows: DataFrame, path: str, key: str) -> None:
    out = rows.hint("rebalance", F.col(key))
    out.write.partitionBy(key).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def touched_rows(raw: DataFrame, days: list[date], day: str = "fecha") -> DataFrame:
    """Rows of these days alone: literals, so that a scan of a table in daily partitions lists no other."""
    return raw.where(F.col(day).isin(days))


def refresh(raw: DataFrame, days: list[date], parts: str, final: str, by: list[str], priced: Callable[[DataFrame], DataFrame], day: str = "fecha", period: Callable[[Column], Column] = F.year) -> None:
    """Brings the tables at ``parts`` and ``final`` up to date after an upsert that touched ``days`` of ``raw``.

    ``priced`` adds the column farm_gate to raw rows.  All days of the raw table make a full build.  Run again, after a
    failure too, it leaves the same tables.  An upsert replaces and adds rows but takes none away, so a touched day
    has rows; days without rows keep the parts that they had.  No days: nothing is done.  One writer at a time.
    """
    if not days:
        return
    spark: SparkSession = raw.sparkSession
    fresh = parts_of(priced(touched_rows(raw, days, day)), by, day)
    _replace(fresh, parts, day)
    stored = spark.read.schema(fresh.schema).parquet(parts)
    # a filter on the partition column alone: only the days of these periods are listed
    of = period(F.col(day))
    periods = [r[0] for r in spark.createDataFrame([(d,) for d in days], f"{day} date").select(of).distinct().collect()]
    _replace(finals_of(stored.where(of.isin(periods)), by, day, period), final, PERIOD)
