"""Table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

#: The raw price row, in its fixed order.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("fecha", T.DateType()),
        T.StructField("producto_raw", T.StringType()),
        T.StructField("calidad_raw", T.StringType()),
        T.StructField("presentacion_raw", T.StringType()),
        T.StructField("origen_raw", T.StringType()),
        T.StructField("destino_raw", T.StringType()),
        T.StructField("destino_id", T.LongType()),
        T.StructField("grupo_raw", T.StringType()),
        T.StructField("tipo_precio", T.StringType()),
        T.StructField("precio_min", T.DecimalType(38, 9)),
        T.StructField("precio_max", T.DecimalType(38, 9)),
        T.StructField("precio_frecuente", T.DecimalType(38, 9)),
        T.StructField("observaciones", T.StringType()),
        T.StructField("banderas_calidad", T.ArrayType(T.StringType())),
        T.StructField("extraido_en", T.TimestampType()),
        T.StructField("url_consulta", T.StringType()),
        T.StructField("llave_fila", T.StringType()),
    ]
)
#: Fields that may not be null.
REQUIRED = ("fecha", "presentacion_raw", "tipo_precio", "extraido_en", "url_consulta", "llave_fila")

PRODUCTS = "product_id string, label string, name string, quality string"
ORIGINS = "origin_id string, label string, kind string"
DESTINATIONS = "destination_id string, label string, state string, market string"
COVERAGE_BY_YEAR = "destination_id string, year int, rows long"
PAGES = "page_id string, html string, source_url string, fetched_at timestamp, product_id string, origin_id string, destination_id string, prices_per_id string, window_start date, window_end date"

#: The criterion id that means "all".
ALL = "-1"
