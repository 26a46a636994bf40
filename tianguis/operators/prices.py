"""Farm-gate prices and the season's position; every parameter is the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def farm_gate(rows: DataFrame, shrink: Column, commission: Column, freight_per_kg: Column, central: str = "precio_frecuente") -> DataFrame:
    """Adds the price at the farm and its breakdown: shrink, commission, freight, farm_gate.

    farm_gate = central * (1 - shrink) * (1 - commission) - freight.  A null price stays null.
    """
    price = F.col(central)
    lost = price * shrink
    fee = (price - lost) * commission
    return rows.withColumns({"shrink_amount": lost, "commission_amount": fee, "freight_amount": freight_per_kg, "farm_gate": price - lost - fee - freight_per_kg})


def season_position(rows: DataFrame, by: list[str], min_years: int, price: str = "precio_frecuente", day: str = "fecha") -> DataFrame:
    """The mean price of each week of a year against all observations of that week in earlier years.

    Weeks and years are ISO ones (29 December may lie in week 1 of the next year).  Returns one
    row for each group, week and year with a price: ``years`` (earlier years with prices),
    ``observations`` and ``share_below``, the share of them below the mean; null where fewer than
    ``min_years`` earlier years are known.

    Equal prices of a year's week are counted before they are shuffled, and each count is placed once among the
    week's means (one for each year); what is left are sums by year and place, whatever the observations.
    """
    week = [*by, "week"]
    dated = rows.where(F.col(price).isNotNull()).select(*by, F.weekofyear(day).alias("week"), F.expr(f"extract(yearofweek from {day})").cast("int").alias("year"), F.col(price).alias("__price"))
    # as many as years, in order of price
    means = dated.groupBy(*week, "year").agg(F.avg("__price").alias("price")).groupBy(*week).agg(F.sort_array(F.collect_list(F.struct("price", "year"))).alias("__means"))
    counted = dated.groupBy(*week, "year", "__price").agg(F.count(F.lit(1)).alias("n"))
    place = F.size(F.filter("__means", lambda m: m["price"] <= F.col("__price"))).alias("place")
    placed = counted.join(means, week).select(*week, "year", place, "n").groupBy(*week, "year", "place").agg(F.sum("n").alias("n"))
    # at most (years + 1) for each year
    sums = placed.groupBy(*week).agg(F.collect_list(F.struct("year", "place", "n")).alias("__past"))
    each = means.join(sums, week, "left").select(*week, "__means", F.coalesce("__past", F.array()).alias("__past"), F.explode("__means").alias("m"))
    each = each.select(*week, F.col("m.year").alias("year"), F.col("m.price").alias("price"), F.filter("__past", lambda p: p["year"] < F.col("m.year")).alias("__past"),
                       F.size(F.filter("__means", lambda x: x["price"] < F.col("m.price"))).alias("__less"))
    total = lambda past: F.aggregate(past, F.lit(0).cast("long"), lambda acc, p: acc + p["n"])
    out = each.withColumns({"years": F.size(F.array_distinct(F.transform("__past", lambda p: p["year"]))), "observations": total(F.col("__past"))})
    # a price lies below a mean if no mean from this one on is at or below it
    below = total(F.filter("__past", lambda p: p["place"] <= F.col("__less")))
    return out.withColumn("share_below", F.when((F.col("years") >= min_years) & (F.col("observations") > 0), below / F.col("observations"))).drop("__past", "__less")


#: Quantiles of a distribution that a price is placed among; a power of two, so that ranks are exact.
GRID = 256


def rank_error(k: int) -> float:
    """How far a sketch's rank may lie from the true one (with 99 % confidence; the published bound of these sketches).  Up to ``k`` observations it is exact."""
    return 2.296 / k**0.9723


def season_sketches(rows: DataFrame, by: list[str], k: int = 200, price: str = "precio_frecuente", day: str = "fecha") -> DataFrame:
    """A sketch of the prices of each group, ISO week and year: ``price`` (sum and number of them) and ``sketch``, a few KB whatever the rows.

    New rows need a sketch of their own only: ``merged_sketches`` joins it to the stored ones.
    """
    dated = rows.where(F.col(price).isNotNull()).select(*by, F.weekofyear(day).alias("week"), F.expr(f"extract(yearofweek from {day})").cast("int").alias("year"), F.col(price).cast("double").alias("__price"))
    return dated.groupBy(*by, "week", "year").agg(F.sum("__price").alias("total"), F.count("__price").alias("n"), F.kll_sketch_agg_double("__price", k).alias("sketch"))


def merged_sketches(stored: DataFrame, more: DataFrame, by: list[str]) -> DataFrame:
    """Two tables of ``season_sketches`` over different rows as one."""
    return stored.unionByName(more).groupBy(*by, "week", "year").agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def season_distribution(sketches: DataFrame, by: list[str], min_years: int) -> DataFrame:
    """The mean price of each week of a year among all observations of that week in earlier years, from sketches alone.

    One row for each group, week and year: ``years`` and ``observations`` (earlier ones), ``quartiles`` of
    them and ``share``, the part of them at or below the mean, counted on a grid of GRID quantiles and so
    within ``rank_error`` and 1 / GRID of the exact share; both null where fewer than ``min_years`` earlier years are known.  Earlier years' sketches are merged in one
    sorted pass: no observation is read again, and a group's week has as many rows as years.
    """
    earlier = Window.partitionBy(*by, "week").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    out = sketches.select(
        *by, "week", "year", (F.col("total") / F.col("n")).alias("price"), F.count(F.lit(1)).over(earlier).alias("years"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("observations"), F.kll_merge_agg_double("sketch").over(earlier).alias("__past"),
    )
    known = (F.col("years") >= min_years) & (F.col("observations") > 0)
    # ranks must be constants, a row's own price is none
    grid = F.array(*[F.lit(i / GRID) for i in range(1, GRID + 1)])
    out = out.withColumn("__grid", F.when(known, F.kll_sketch_get_quantile_double("__past", grid)))
    share = F.size(F.filter("__grid", lambda q: q <= F.col("price"))) / GRID
    quartiles = F.transform(F.array(*[F.lit(GRID * i // 4 - 1) for i in (1, 2, 3)]), lambda i: F.get("__grid", i))
    return out.withColumns({"share": F.when(F.col("__grid").isNotNull(), share), "quartiles": F.when(F.col("__grid").isNotNull(), quartiles)}).drop("__past", "__grid")


def season_counts(rows: DataFrame, by: list[str], price: str = "precio_frecuente", day: str = "fecha") -> DataFrame:
    """How often each price occurs in a group, ISO week and year: ``price``, ``n`` and ``total`` (their sum).

    Like sketches, counts of different rows are merged without reading the rows again (``merged_counts``), but exactly.
    """
    dated = rows.where(F.col(price).isNotNull()).select(*by, F.weekofyear(day).alias("week"), F.expr(f"extract(yearofweek from {day})").cast("int").alias("year"), F.col(price).alias("price"))
    return dated.groupBy(*by, "week", "year", "price").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"))


def merged_counts(stored: DataFrame, more: DataFrame, by: list[str]) -> DataFrame:
    """Two tables of ``season_counts`` over different rows as one."""
    return stored.unionByName(more).groupBy(*by, "week", "year", "price").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def exact_distribution(counts: DataFrame, by: list[str], min_years: int) -> DataFrame:
    """``season_distribution`` from counts (``season_counts``, read twice): the same columns, without any error of rank.

    The distinct years, a few dozen, are collected.  A group's week is sorted by price once, with a running count for
    each year of what lies before it; no price is repeated for later years.
    """
    week = [*by, "week"]
    years = sorted(r["year"] for r in counts.select("year").distinct().collect())
    if not years:
        years = [0]  # no rows: the columns alone
    own = counts.groupBy(*week, "year").agg((F.sum("total").cast("double") / F.sum("n")).alias("price"), F.sum("n").alias("n"))
    earlier = Window.partitionBy(*week).orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumns({"years": F.count(F.lit(1)).over(earlier), "observations": F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long"))})
    targets = own.groupBy(*week).agg(F.map_from_entries(F.collect_list(F.struct("year", F.struct("price", "years", "observations")))).alias("__own"))
    upward = Window.partitionBy(*week).orderBy("price").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = counts.select(*week, "year", F.col("price"), "n")
    each = each.select("*", *[F.sum(F.when(F.col("year") < y, F.col("n")).otherwise(0)).over(upward).alias(f"__upto{y}") for y in years])
    # an observation is weighed as the double that the means are
    each = each.join(targets, week).withColumns({"__price": F.col("price").cast("double"), **{f"__own{y}": F.try_element_at("__own", F.lit(y)) for y in years}})

    def sums(y: int):
        mean, seen = F.col(f"__own{y}.price"), F.col(f"__own{y}.observations")
        at_most = F.sum(F.when((F.col("year") < y) & (F.col("__price") <= mean), F.col("n")).otherwise(0)).alias(f"__below{y}")
        # the place of the i-th quartile is i * observations / 4, rounded up
        cuts = [F.min(F.when(F.col(f"__upto{y}") >= F.ceil(seen * i / 4), F.col("__price"))).alias(f"__q{i}_{y}") for i in (1, 2, 3)]
        return [F.first(f"__own{y}").alias(f"__own{y}"), at_most, *cuts]

    found = each.groupBy(*week).agg(*[c for y in years for c in sums(y)])
    per_year = F.array(*[F.struct(F.lit(y).alias("year"), F.col(f"__own{y}").alias("own"), F.col(f"__below{y}").alias("below"), F.array(*[F.col(f"__q{i}_{y}") for i in (1, 2, 3)]).alias("quartiles")) for y in years])
    out = found.select(*week, F.inline(per_year)).where("own is not null").select(*week, "year", "own.*", "below", "quartiles")
    known = (F.col("years") >= min_years) & (F.col("observations") > 0)
    # so many of the grid's quantiles lie at or below the mean
    share = F.floor(F.col("below") * GRID / F.col("observations")) / GRID
    return out.withColumns({"share": F.when(known, share), "quartiles": F.when(known, F.col("quartiles"))}).drop("below")


def final_table(rows: DataFrame, by: list[str]) -> DataFrame:
    """Aggregates for publication: rows, mean, least and greatest farm-gate price of each group."""
    return rows.groupBy(*by).agg(F.count("farm_gate").alias("n"), F.avg("farm_gate").alias("mean"), F.min("farm_gate").alias("least"), F.max("farm_gate").alias("greatest"))
