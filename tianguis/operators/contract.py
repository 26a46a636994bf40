"""The identity contract of parsed rows: keys, required fields, all-or-nothing pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..schemas import ALL

#: Parts of a row's natural key, in order.
KEY = ("date", "product", "presentation", "origin", "destination", "prices_per_id")


def criterion_key(label: Column, pinned_id: Column) -> Column:
    """The served label, else ``id:<id>`` of a pinned criterion, else null."""
    return F.coalesce(label, F.when(pinned_id != ALL, F.concat(F.lit("id:"), pinned_id)))


def product_label(name: Column, quality: Column) -> Column:
    return F.when((name != "") & (quality != ""), F.concat_ws(" - ", name, quality)).otherwise(name)


def row_date(served: Column, start: Column, end: Column) -> Column:
    """The table's date, else the day of a one-day window."""
    return F.coalesce(served, F.when(F.datediff(end, start) == 0, F.date_format(start, "dd/MM/yyyy")))


def key_parts(of: Callable[[str], Column], dated: Column) -> dict[str, Column]:
    """The natural key's parts of a row whose fields ``of`` gives; ``dated`` is its date."""
    return {
        "date": dated,
        "product": criterion_key(product_label(of("product"), of("quality")), of("product_id")),
        "presentation": of("presentation"),
        "origin": criterion_key(of("origin"), of("origin_id")),
        "destination": criterion_key(of("destination"), of("destination_id")),
        "prices_per_id": of("prices_per_id"),
    }


def missing_parts(parts: dict[str, Column]) -> Column:
    """Names of the empty parts, in order."""
    return F.array_compact(F.array(*[F.when(blank_to_null(parts[k]).isNull(), F.lit(k)) for k in KEY]))


def with_identity(rows: DataFrame) -> DataFrame:
    """Adds ``natural_key`` (array, in order) and ``missing`` (names of empty parts, in order)."""
    dated = row_date(F.col("date"), F.col("window_start"), F.col("window_end")) if "window_start" in rows.columns else F.col("date")
    parts = key_parts(F.col, dated)
    return rows.withColumns({"natural_key": F.array(*[parts[k] for k in KEY]), "missing": missing_parts(parts)})


def key_text(natural_key: Column) -> Column:
    """A key as one text that no other key gives: each part after its length; null and empty parts are alike."""
    return F.array_join(F.transform(natural_key, lambda p: F.concat(F.length(F.coalesce(p, F.lit(""))).cast("string"), F.lit(":"), F.coalesce(p, F.lit("")))), "")


def row_key(natural_key: Column) -> Column:
    """SHA-256 (hex) of the key's parts, joined by pipes.  For complete keys only."""
    return F.sha2(F.array_join(natural_key, "|"), 256)


def _narrow(keyed: DataFrame, *more: Column) -> DataFrame:
    """What a verdict needs of each row, by page: one shuffle of digests serves the groupings by key and by page."""
    key = F.unhex(F.sha2(key_text(F.col("natural_key")), 256)).alias("key")
    return keyed.select("page_id", key, "missing", *more).repartition(F.col("page_id"))


def duplicate_keys(rows: DataFrame) -> DataFrame:
    """Natural keys that a page holds more than once: (page_id, natural_key joined by pipes, n)."""
    same = with_identity(rows).groupBy("page_id", "natural_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return same.select("page_id", F.array_join("natural_key", "|").alias("natural_key"), "n")


def page_reasons(keyed: DataFrame, broken: Column | None = None, unwritable: Column | None = None) -> DataFrame:
    """One line for each bad page (page_id, reason, rows) of rows with identity.

    MissingFields names every missing part of any row; DuplicateKey says that two rows of
    the page have one natural key.  ``broken`` is a row's own reason, which comes before these,
    ``unwritable`` a condition that gives UnwritableRow where none of them holds.
    """
    none = F.lit(None)
    own, odd = none.cast("string") if broken is None else broken, none.cast("boolean") if unwritable is None else unwritable
    keys = _narrow(keyed, own.alias("own"), odd.alias("odd")).groupBy("page_id", "key")
    keys = keys.agg(F.count(F.lit(1)).alias("n"), F.first("missing").alias("missing"), F.min("own").alias("own"), F.max("odd").alias("odd"))
    lacks = F.array_sort(F.array_distinct(F.flatten(F.collect_set("missing"))))
    page = keys.groupBy("page_id").agg(F.sum("n").alias("rows"), F.max("n").alias("same"), lacks.alias("lacks"), F.min("own").alias("own"), F.max("odd").alias("odd"))
    reason = (
        F.when(F.col("own").isNotNull(), F.col("own"))
        .when(F.size("lacks") > 0, F.concat(F.lit("MissingFields: "), F.array_join("lacks", ", ")))
        .when(F.col("same") > 1, F.lit("DuplicateKey"))
        .when(F.col("odd"), F.lit("UnwritableRow"))
    )
    return page.select("page_id", reason.alias("reason"), "rows").where("reason is not null")


def whole_pages(rows: DataFrame) -> DataFrame:
    """Rows (without identity) of pages where no row lacks a part of its key and no key occurs twice, in one pass.

    Rows meet by page once (not at all, if they are dealt by page already), with a digest of their key; what a result doesn't use
    of them is not shuffled, as the key itself is not carried along.
    """
    flagged = with_identity(rows).select(*rows.columns, F.substring(F.unhex(F.sha2(key_text(F.col("natural_key")), 256)), 1, 16).alias("__key"), (F.size("missing") > 0).alias("__lacks"))
    page = Window.partitionBy("page_id")
    # the digests of a page in order: an equal one is a repeat
    repeat = F.coalesce(F.lag("__key").over(page.orderBy("__key")) == F.col("__key"), F.lit(False))
    marked = flagged.withColumn("__bad", F.col("__lacks") | repeat)
    return marked.withColumn("__bad", F.max("__bad").over(page)).where("not __bad").select(*rows.columns)


def accepted_and_rejected(rows: DataFrame, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of good pages, and one line for each bad page (page_id, reason, rows): one bad row rejects its whole page.

    Each of the two computes ``rows`` once (``whole_pages``, and a narrow aggregate for the lines), unless
    ``store`` names a path: then they are written there and read by both.
    """
    if store:
        rows.write.parquet(store)
        rows = rows.sparkSession.read.schema(rows.schema).parquet(store)
    return with_identity(whole_pages(rows)), page_reasons(with_identity(rows))


def failure_counts(rejections: DataFrame) -> DataFrame:
    """Rejected pages of each reason."""
    return rejections.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
