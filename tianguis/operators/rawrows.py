"""Parsed rows to typed raw rows: prices, flags, names and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_day
from ..functions.text import blank_to_null
from ..schemas import ALL, RAW_SCHEMA, REQUIRED
from .contract import product_label, row_key

# Price modes and quality flags.
PRICE_MODES = {"1": "presentacion_comercial", "2": "kilogramo_calculado"}
ABSENT, NOT_NUMERIC, ZERO, INCOHERENT = "precio_ausente", "precio_no_numerico", "precio_cero", "precios_incoherentes"


def price(text: Column) -> Column:
    """Exact decimal; thousands separators dropped, unreadable text null."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("decimal(38,9)")


def price_flag(text: Column, value: Column) -> Column:
    return F.when(text.isNull(), ABSENT).when(value.isNull(), NOT_NUMERIC).when(value == 0, ZERO)


def quality_flags(low: Column, high: Column, frequent: Column, values: list[Column] | None = None) -> Column:
    """Flags of the three price texts, each once, in the order met; then incoherence.

    ``values`` are the parsed prices, where they are columns already.
    """
    texts = (low, high, frequent)
    values = values or [price(x) for x in texts]
    own = F.array_distinct(F.array_compact(F.array(*[price_flag(x, v) for x, v in zip(texts, values)])))
    ordered = (values[0] <= values[2]) & (values[2] <= values[1])
    bad = values[0].isNotNull() & values[1].isNotNull() & values[2].isNotNull() & ~ordered
    return F.concat(own, F.when(bad, F.array(F.lit(INCOHERENT))).otherwise(F.array().cast("array<string>")))


def price_mode(mode_id: Column) -> Column:
    """The mode's name; null if unknown."""
    out = F.lit(None).cast("string")
    for k, name in PRICE_MODES.items():
        out = F.when(mode_id == k, F.lit(name)).otherwise(out)
    return out


PRICES = {"price_min": "precio_min", "price_max": "precio_max", "price_frequent": "precio_frecuente"}


def with_prices(records: DataFrame) -> DataFrame:
    """Adds the three prices as exact decimals and ``banderas_calidad``; each text is parsed once, in a projection of its own."""
    parsed = records.withColumns({new: price(F.col(old)) for old, new in PRICES.items()})
    return parsed.withColumn("banderas_calidad", quality_flags(*[F.col(c) for c in PRICES], [F.col(c) for c in PRICES.values()]))


def with_destination(records: DataFrame, destinations: DataFrame | None) -> DataFrame:
    """Adds ``destino_raw`` and ``destino_id``: the served label or, for a pinned market, the catalog's, and its id.

    ``destinations`` (destination_id, label) is a small dimension that Spark broadcasts by its size.  Without one nothing
    is joined: an empty table would still have all rows shuffled by market, those of no market to one task.
    """
    if destinations is None:
        market = F.when(F.col("destination_id") != ALL, F.col("destination_id").try_cast("long"))
        return records.withColumns({"destino_raw": blank_to_null(F.col("destination")), "destino_id": market})
    names = destinations.select(F.col("destination_id").alias("__id"), F.col("label").alias("__label"))
    pinned = F.col("destination_id") != ALL
    joined = records.join(names, F.col("destination_id") == F.col("__id"), "left")
    label = F.coalesce(blank_to_null(F.col("destination")), F.when(pinned, F.col("__label")))
    return joined.withColumns({"destino_raw": label, "destino_id": F.when(pinned, F.col("destination_id").try_cast("long"))}).drop("__id", "__label")


def with_product(records: DataFrame, products: DataFrame, name: str = "product", quality: str = "quality") -> DataFrame:
    """Adds ``product_key``, the catalog's id for "name - quality"; null where the catalog (product_id, label) has no such label."""
    labels = products.groupBy("label").agg(F.min("product_id").alias("product_key")).withColumnRenamed("label", "__label")
    return records.join(labels, product_label(F.col(name), F.col(quality)) == F.col("__label"), "left").drop("__label")


def typed_layer(raw: DataFrame, products: DataFrame, destinations: DataFrame) -> DataFrame:
    """Raw rows with their keys in the catalogs: product_key, destination_key, and ``problems`` besides the flags.

    Nothing is mended or dropped: unknown_product, unknown_destination and the row's own flags tell what is doubtful.
    """
    known = with_product(raw, products, "producto_raw", "calidad_raw")
    by_label = destinations.groupBy("label").agg(F.min("destination_id").alias("__by_label")).withColumnRenamed("label", "__label")
    known = known.join(by_label, F.col("destino_raw") == F.col("__label"), "left").drop("__label")
    known = known.withColumn("destination_key", F.coalesce(F.col("destino_id").cast("string"), F.col("__by_label"))).drop("__by_label")
    unknown = F.array_compact(F.array(F.when(F.col("product_key").isNull(), "unknown_product"), F.when(F.col("destination_key").isNull(), "unknown_destination")))
    return known.withColumn("problems", F.concat("banderas_calidad", unknown))


def to_raw_rows(records: DataFrame, destinations: DataFrame | None = None) -> DataFrame:
    """Accepted records as raw rows plus ``reject_reason`` (UnwritableRow: date or price mode unreadable).

    The destination's label comes from the row or, for a pinned market, from the catalog,
    a small dimension that Spark broadcasts by its size.
    """
    key = F.col("natural_key")
    df = with_prices(with_destination(records, destinations))
    fecha = parse_day(key[0])
    mode = price_mode(F.col("prices_per_id"))
    columns = {
        "fecha": fecha,
        "producto_raw": F.col("product"),
        "calidad_raw": F.col("quality"),
        "presentacion_raw": F.col("presentation"),
        "origen_raw": F.col("origin"),
        "destino_raw": F.col("destino_raw"),
        "destino_id": F.col("destino_id"),
        "grupo_raw": F.col("category"),
        "tipo_precio": mode,
        **{c: F.col(c) for c in PRICES.values()},
        "observaciones": F.col("obs"),
        "banderas_calidad": F.col("banderas_calidad"),
        "extraido_en": F.col("fetched_at"),
        "url_consulta": F.col("source_url"),
        "llave_fila": row_key(key),
    }
    reason = F.when(fecha.isNull() | mode.isNull(), F.lit("UnwritableRow"))
    return df.select("page_id", *[columns[f.name].cast(f.dataType).alias(f.name) for f in RAW_SCHEMA], reason.alias("reject_reason"))


def violations(raw: DataFrame) -> DataFrame:
    """Checks of a raw table: (check, n) for every rule that it breaks; empty if it is sound."""
    layout = [f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMA]
    found = [f"{f.name} {f.dataType.simpleString()}" for f in raw.schema]
    counts = raw.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in REQUIRED if c in raw.columns],
        (F.count("llave_fila") - F.countDistinct("llave_fila")).alias("repeated llave_fila"),
    )
    one = counts.select(F.explode(F.create_map(*[x for c in counts.columns for x in (F.lit(c), F.col(f"`{c}`"))])).alias("check", "n"))
    shape = raw.sparkSession.createDataFrame([("schema", int(layout != found))], "check string, n long")
    return one.unionByName(shape).where("n > 0")
