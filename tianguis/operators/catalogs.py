"""Catalogs: labels taken apart, invariants, and drift against a newer copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_at_colon, split_at_last_dash

# Origins that are no states, and the state that two catalogs abbreviate differently.
ORIGIN_KINDS = {"Sin Especificar": "unspecified", "Nacional": "national", "Importación": "import"}
STATE_ALIASES = {"DF": "Distrito Federal"}
STATES = 32


def options(raw: DataFrame) -> DataFrame:
    """Options (id, label) without the sentinel of "all"."""
    return raw.where(F.col("id") != "-1")


def products(raw: DataFrame) -> DataFrame:
    name, quality = split_at_last_dash(F.col("label"))
    return options(raw).select(F.col("id").alias("product_id"), "label", name.alias("name"), quality.alias("quality"))


def origins(raw: DataFrame) -> DataFrame:
    kind = F.lit("state")
    for label, k in ORIGIN_KINDS.items():
        kind = F.when(F.col("label") == label, F.lit(k)).otherwise(kind)
    return options(raw).select(F.col("id").alias("origin_id"), "label", kind.alias("kind"))


def destinations(raw: DataFrame) -> DataFrame:
    state, market = split_at_colon(F.col("label"), STATE_ALIASES)
    return options(raw).select(F.col("id").alias("destination_id"), "label", state.alias("state"), market.alias("market"))


def violations(raw: DataFrame) -> DataFrame:
    """Broken invariants of an options table (id, label): (check, n), n > 0."""
    own = raw.agg(
        F.count_if(~F.col("id").rlike("^[0-9]+$") & (F.col("id") != "-1")).alias("id not of digits"),
        F.count_if(F.coalesce(F.trim("label"), F.lit("")) == "").alias("empty label"),
        (F.count("id") - F.countDistinct("id")).alias("repeated id"),
        (F.count("label") - F.countDistinct("label")).alias("repeated label"),
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long").alias("no option"),
    )
    pairs = F.create_map(*[x for c in own.columns for x in (F.lit(c), F.col(f"`{c}`"))])
    return own.select(F.explode(pairs).alias("check", "n")).where("n > 0")


def origin_violations(origin_rows: DataFrame) -> DataFrame:
    """Kinds of origin that are absent, and a count of states other than expected."""
    kinds = origin_rows.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in (*ORIGIN_KINDS.values(), "state")])
    pairs = F.create_map(*[x for k in ORIGIN_KINDS.values() for x in (F.lit(f"no {k}"), F.when(F.col(k) == 0, 1).otherwise(0))], F.lit("states"), F.when(F.col("state") != STATES, F.col("state") + 1).otherwise(0).cast("int"))
    return kinds.select(F.explode(pairs).alias("check", "n")).where("n > 0")


def unknown_states(destination_rows: DataFrame, origin_rows: DataFrame) -> DataFrame:
    """States of destinations that no origin names."""
    return destination_rows.select("state").distinct().join(origin_rows.where("kind = 'state'").select(F.col("label").alias("state")), "state", "left_anti")


def drift(old: DataFrame, new: DataFrame, key: str = "id", label: str = "label") -> DataFrame:
    """Entries added, removed or renamed between two copies: (key, change, old_label, new_label)."""
    a = old.select(F.col(key).alias("k"), F.col(label).alias("old_label"), F.lit(True).alias("was"))
    b = new.select(F.col(key).alias("k"), F.col(label).alias("new_label"), F.lit(True).alias("is"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(~F.col("old_label").eqNullSafe(F.col("new_label")), "renamed")
    return a.join(b, "k", "full_outer").select(F.col("k").alias(key), change.alias("change"), "old_label", "new_label").where("change is not null")


def category_map(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products with their category, and products that have several."""
    pairs = raw.select("producto_raw", "grupo_raw").where("producto_raw is not null and grupo_raw is not null").distinct()
    return pairs, pairs.groupBy("producto_raw").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
