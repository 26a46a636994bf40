"""How far back and how densely each market reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import quarterly_windows


def rows_by_year(raw: DataFrame, market: str = "destino_id", day: str = "fecha") -> DataFrame:
    return raw.groupBy(F.col(market).cast("string").alias("destination_id"), F.year(day).alias("year")).agg(F.count(F.lit(1)).alias("rows"))


def year_grid(markets: DataFrame, first: int, last: Column) -> DataFrame:
    """Every market with every year."""
    return markets.select("destination_id").distinct().withColumn("year", F.explode(F.sequence(F.lit(first), last)))


def dense(grid: DataFrame, counts: DataFrame) -> DataFrame:
    """A row for each cell of the grid, zeros included.

    The joins with a grid are merge joins: Spark takes a grid for as small as its markets, since its estimates don't count
    what ``explode`` adds, and would gather millions of cells in the driver to broadcast them.
    """
    return grid.hint("merge").join(counts, ["destination_id", "year"], "left").select("destination_id", "year", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))


def remaining(grid: DataFrame, known: DataFrame) -> DataFrame:
    """Cells of the grid not counted yet."""
    return grid.hint("merge").join(known.select("destination_id", "year"), ["destination_id", "year"], "left_anti")


def summary(by_year: DataFrame) -> DataFrame:
    """First and last year with rows, years with rows, total, and the years missing in between; markets without rows have nulls."""
    live = F.col("rows") > 0
    out = by_year.groupBy("destination_id").agg(
        F.min(F.when(live, F.col("year"))).alias("first_year"),
        F.max(F.when(live, F.col("year"))).alias("last_year"),
        F.count_if(live).alias("years_with_data"),
        F.sum("rows").alias("total_rows"),
        F.collect_set(F.when(live, F.col("year"))).alias("__live"),
    )
    span = F.when(F.col("first_year").isNotNull(), F.sequence("first_year", "last_year")).otherwise(F.array().cast("array<int>"))
    return out.withColumn("gap_years", F.array_sort(F.array_except(span, "__live"))).drop("__live")


def active(summaries: DataFrame, this_year: Column) -> DataFrame:
    """Markets whose last year with rows is this or the one before."""
    return summaries.where(F.col("last_year") > this_year - 2)


def volume(by_year: DataFrame) -> DataFrame:
    """One row: total rows, and the years with fewest and most rows among those with any."""
    years = by_year.groupBy("year").agg(F.sum("rows").alias("rows")).where("rows > 0")
    return years.agg(
        F.sum("rows").alias("total_rows"),
        F.min_by("year", F.struct("rows", "year")).alias("thinnest_year"),
        F.min("rows").alias("thinnest_rows"),
        F.max_by("year", F.struct(F.col("rows"), -F.col("year"))).alias("fattest_year"),
        F.max("rows").alias("fattest_rows"),
    )


def differing(recomputed: DataFrame, stored: DataFrame, key: str = "destination_id") -> DataFrame:
    """Keys whose rows differ between two tables of one layout, or that one of them lacks."""
    other = [c for c in recomputed.columns if c != key]
    a = recomputed.select(key, F.struct(*other).alias("a"))
    b = stored.select(key, F.struct(*other).alias("b"))
    return a.join(b, key, "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(key)


def backfill(summaries: DataFrame) -> DataFrame:
    """Years worth asking for: from a market's first to its last, without its gap years."""
    return summaries.where("first_year is not null").select("destination_id", F.explode(F.array_except(F.sequence("first_year", "last_year"), "gap_years")).alias("year"))


def backfill_quarters(summaries: DataFrame, known: DataFrame) -> DataFrame:
    """Quarters worth asking for: those of ``backfill`` years but the ones that are known already (destination_id, window_start)."""
    years = backfill(summaries).select("destination_id", F.make_date("year", F.lit(1), F.lit(1)).alias("start"), F.make_date("year", F.lit(12), F.lit(31)).alias("end"))
    quarters = quarterly_windows(years).select("destination_id", "window_start", "window_end")
    return quarters.join(known.select("destination_id", "window_start"), ["destination_id", "window_start"], "left_anti")


def markets_by_span(summaries: DataFrame) -> DataFrame:
    """Markets by the years in which they begin and end: (first_year, last_year, n_markets); null years for those without rows."""
    return summaries.groupBy("first_year", "last_year").agg(F.count(F.lit(1)).alias("n_markets"))


def ended_series(summaries: DataFrame, days: DataFrame, this_year: Column) -> DataFrame:
    """Markets with no row in the window: ``series_end`` if they stopped years ago, else ``ingest_hole``."""
    return summaries.join(days.select("destination_id").distinct(), "destination_id", "left_anti").select("destination_id", F.when(F.coalesce("last_year", F.lit(0)) > this_year - 2, F.lit("ingest_hole")).otherwise(F.lit("series_end")).alias("state"))
