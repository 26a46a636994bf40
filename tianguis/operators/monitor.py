"""What a run captured and what it lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import business_days

#: Business days without new data from which on data count as late.
STALE_AFTER = 3
#: Silent markets and failures named in an alert, the first by order; the rest are rows of ``silent_markets`` and of the failures.
NAMED = 100


def rows_by_market_day(raw: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows of each market and day of a window; the window reaches the scan as a partition filter."""
    return raw.where(F.col("fecha").between(start, end)).groupBy("destino_id", "fecha").agg(F.count(F.lit(1)).alias("n_rows"))


def run_report(counts: DataFrame) -> DataFrame:
    """One row: rows by market (ids as text, null as ``None``), days with data, total and last day."""
    per_market = counts.groupBy(F.coalesce(F.col("destino_id").cast("string"), F.lit("None")).alias("market")).agg(F.sum("n_rows").alias("n"))
    markets = per_market.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("market", "n")))).alias("rows_by_market"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    days = counts.agg(F.array_sort(F.collect_set("fecha")).alias("dates_with_data"), F.max("fecha").alias("last_date"))
    return markets.crossJoin(days)  # two tables of one row each


def silent_markets(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected markets (``market`` as text) without a row."""
    seen = counts.select(F.col("destino_id").cast("string").alias("market")).distinct()
    return expected.select("market").distinct().join(seen, "market", "left_anti")


def alerts(counts: DataFrame, expected: DataFrame, failures: DataFrame, start: Column, end: Column, today: Column, stale_after: int = STALE_AFTER) -> DataFrame:
    """Alerts on a run, most routine first: ord, kind, level, message, context (JSON).

    ``counts`` is rows_by_market_day of the window, ``expected`` has ``market``, ``failures``
    has ``line``.  Every rule is an aggregate of one row; their union has five rows at most.
    A context names NAMED markets or failures at most and counts them all.
    """
    report = run_report(counts)
    wanted = expected.select("market").distinct().agg(F.count("*").alias("n_expected"))
    silent = silent_markets(counts, expected)
    first = lambda rows, c, to: rows.orderBy(c).limit(NAMED).agg(F.array_sort(F.collect_list(c)).alias(to))
    missing = silent.agg(F.count("*").alias("n_silent")).crossJoin(first(silent, "market", "silent"))
    failed = failures.agg(F.count("*").alias("n_failed")).crossJoin(first(failures, "line", "lines"))
    one = report.crossJoin(wanted).crossJoin(missing).crossJoin(failed)  # single rows
    window = F.concat_ws("..", F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd"))
    age = business_days(F.coalesce("last_date", start), today)
    last = F.date_format("last_date", "yyyy-MM-dd")
    n_seen = F.size("rows_by_market")

    def alert(order: int, kind: str, level: str, when: Column, message: Column, context: Column) -> Column:
        return F.when(when, F.struct(F.lit(order).alias("ord"), F.lit(kind).alias("kind"), F.lit(level).alias("level"), message.alias("message"), F.to_json(context, {"ignoreNullFields": "false"}).alias("context")))

    # Kinds, levels, messages and context keys.
    every = F.array(
        alert(1, "resumen", "info", F.lit(True), F.concat(F.lit("Ingesta "), window, F.lit(": "), F.col("n_rows"), F.lit(" filas de "), n_seen, F.lit(" mercados")), F.struct(window.alias("ventana"), F.col("n_rows").alias("filas"), n_seen.alias("mercados_con_datos"), F.col("n_expected").alias("mercados_esperados"), F.size("dates_with_data").alias("fechas_con_datos"), last.alias("ultima_fecha"), F.col("rows_by_market").alias("filas_por_mercado"))),
        alert(2, "sin_datos", "error", n_seen == 0, F.concat(F.lit("Ventana "), window, F.lit(" sin una sola fila")), F.struct(F.col("n_expected").alias("mercados_esperados"))),
        alert(3, "mercados_sin_datos", "warning", (n_seen > 0) & (F.col("n_silent") > 0), F.concat(F.col("n_silent"), F.lit(" mercado(s) activos sin datos en la ventana")), F.struct(F.col("n_silent").alias("total"), F.col("silent").alias("mercados"))),
        alert(4, "datos_atrasados", "error", age >= stale_after, F.concat(F.lit("Sin datos nuevos desde hace "), age, F.lit(" días hábiles")), F.struct(age.alias("dias_habiles"), last.alias("ultima_fecha"))),
        alert(5, "mercados_fallidos", "error", F.col("n_failed") > 0, F.concat(F.col("n_failed"), F.lit(" ventana(s) fallaron en el barrido")), F.struct(F.col("n_failed").alias("total"), F.col("lines").alias("ventanas"))),
    )
    return one.select(F.explode(F.array_compact(every)).alias("a")).select("a.*").orderBy("ord")


def short_context(context: Column, most: int = 300) -> Column:
    """A context as it is printed: its first ``most`` characters."""
    return F.substr(context, F.lit(1), F.lit(most))
