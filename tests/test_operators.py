"""Small cases of the operators: keys, flags, windows, pages, upserts, alerts, catalogs."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tianguis.functions import dates, text
from tianguis.operators import capture, catalogs, contract, coverage, monitor, pages, prices, rawrows, upsert
from tianguis.plans import requests
from tianguis.schemas import RAW_SCHEMA
from tianguis.sources import readers, sinks

D = dt.date
RECORD = "page_id string, row_pos int, date string, product string, quality string, presentation string, origin string, destination string, price_min string, price_max string, price_frequent string, obs string, category string, product_id string, origin_id string, destination_id string, prices_per_id string, source_url string, fetched_at timestamp, window_start date, window_end date"
NOW = dt.datetime(2026, 7, 2, 1, 0)


def record(**x):
    base = dict(page_id="p", row_pos=1, date="01/07/2026", product="Aguacate Hass", quality="Primera", presentation="Caja de 10 kg.", origin="Sinaloa", destination=None, price_min="50", price_max="60", price_frequent="55", obs=None, category="Frutas", product_id="-1", origin_id="-1", destination_id="210", prices_per_id="2", source_url="u", fetched_at=NOW, window_start=D(2026, 7, 1), window_end=D(2026, 7, 3))
    return tuple((base | x).values())


def records(spark, *rows):
    return spark.createDataFrame([record(**r) for r in rows], RECORD)


@pytest.mark.parametrize(
    "low,high,frequent,flags",
    [
        ("50", "60", "55", []),
        ("50", "1,234.50", "55", []),
        ("99.00", "60", "55", ["precios_incoherentes"]),
        ("50", "60", "0.00", ["precio_cero", "precios_incoherentes"]),
        ("N/D", "60", "55", ["precio_no_numerico"]),
        ("50", "60", None, ["precio_ausente"]),
        (None, "x", None, ["precio_ausente", "precio_no_numerico"]),
    ],
)
def test_flags(spark, low, high, frequent, flags):
    df = spark.createDataFrame([(low, high, frequent)], "a string, b string, c string")
    assert df.select(rawrows.quality_flags(F.col("a"), F.col("b"), F.col("c"))).first()[0] == flags


def test_raw_row(spark):
    good, bad = contract.accepted_and_rejected(records(spark, {}))
    names = spark.createDataFrame([("210", "Puebla: Central")], "destination_id string, label string")
    row = rawrows.to_raw_rows(good, names).first()
    assert bad.count() == 0 and row.reject_reason is None
    assert (row.fecha, row.destino_raw, row.destino_id, row.tipo_precio) == (D(2026, 7, 1), "Puebla: Central", 210, "kilogramo_calculado")
    assert row.precio_max == Decimal(60) and row.banderas_calidad == []
    import hashlib

    key = "01/07/2026|Aguacate Hass - Primera|Caja de 10 kg.|Sinaloa|id:210|2"
    assert row.llave_fila == hashlib.sha256(key.encode()).hexdigest()


def test_contract_names_everything_missing_and_rejects_the_page(spark):
    df = records(spark, {"page_id": "a"}, {"page_id": "a", "row_pos": 2, "destination_id": "-1", "origin": None}, {"page_id": "b"}, {"page_id": "c"}, {"page_id": "c", "row_pos": 2, "price_min": "1"})
    good, bad = contract.accepted_and_rejected(df)
    assert [r.page_id for r in good.collect()] == ["b"]
    assert {(r.page_id, r.reason, r.rows) for r in bad.collect()} == {("a", "MissingFields: destination, origin", 2), ("c", "DuplicateKey", 2)}


def test_pinned_and_one_day_dates(spark):
    df = records(spark, {"product": None, "quality": None, "product_id": "740", "date": None, "window_end": D(2026, 7, 1)}, {"date": None, "page_id": "q"})
    rows = {r.page_id: r for r in contract.with_identity(df).collect()}
    assert rows["p"].natural_key[:2] == ["01/07/2026", "id:740"] and rows["p"].missing == []
    assert rows["q"].missing == ["date"]


def test_unwritable_rows(spark):
    good, _ = contract.accepted_and_rejected(records(spark, {"date": "31/02/2026"}, {"page_id": "q", "prices_per_id": "9"}, {"page_id": "r", "date": "1/7/2026"}))
    found = {r.page_id: r.reject_reason for r in rawrows.to_raw_rows(good).collect()}
    assert found == {"p": "UnwritableRow", "q": "UnwritableRow", "r": None}


def test_business_days_and_source_day(spark):
    cases = [(D(2026, 8, 7), D(2026, 8, 9), 0), (D(2026, 8, 7), D(2026, 8, 10), 1), (D(2026, 8, 5), D(2026, 8, 11), 4), (D(2026, 8, 5), D(2026, 8, 5), 0), (D(2026, 8, 9), D(2026, 8, 1), 0)]
    df = spark.createDataFrame(cases, "a date, b date, n int")
    assert df.where(dates.business_days(F.col("a"), F.col("b")) != F.col("n")).count() == 0
    one = spark.createDataFrame([(dt.datetime(2026, 8, 6, 2),)], "t timestamp")
    assert one.select(dates.source_day(F.col("t"))).first()[0] == D(2026, 8, 5)


def test_windows(spark):
    spans = spark.createDataFrame([(D(2025, 2, 14), D(2025, 7, 3))], "start date, end date")
    got = dates.quarterly_windows(spans).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end) for r in got] == [(D(2025, 2, 14), D(2025, 3, 31)), (D(2025, 4, 1), D(2025, 6, 30)), (D(2025, 7, 1), D(2025, 7, 3))]
    w = spark.createDataFrame([(n, D(2026, 1, 1), D(2026, 1, 1) + dt.timedelta(n - 1)) for n in range(1, 40)], "n int, window_start date, window_end date")
    for r in dates.split_windows(w).groupBy("n").agg(F.min("window_start").alias("a"), F.max("window_end").alias("b"), F.sum(F.datediff("window_end", "window_start") + 1).alias("days"), F.count("*").alias("parts")).collect():
        assert (r.b - r.a).days + 1 == r.n == r.days and r.parts == (1 if r.n == 1 else 2)


HTML = """<html>P&aacute;gina&nbsp; 1 de&nbsp; {n}<table id="tblResultados"><tr>{head}</tr>{body}</table></html>"""


def page(headers, *rows, n=1):
    cells = lambda r: "".join(f"<td>{c}</td>" for c in r)
    return HTML.format(n=n, head=cells(headers), body="".join(f"<tr>{cells(r)}</tr>" for r in rows))


def test_pages(spark):
    good = page(["Fecha", "Producto", "Obs."], ["Frutas"], ["01/07/2026", "Aguacate  <b>Hass</b>", ""], ["&nbsp;"], ["02/07/2026", "Lim&oacute;n &amp; sal", "x"])
    rows = [
        ("good", good),
        ("empty", "x NO HAY REGISTROS x"),
        ("refused", "No puede seleccionar todos los productos"),
        ("none", "<html></html>"),
        ("unknown", page(["Fecha", "Color"], ["a", "b"])),
        ("ragged", page(["Fecha", "Producto"], ["a", "b", "c"])),
        ("cut", page(["Fecha"], ["01/07/2026"], n=3)),
        ("negative", page(["Fecha"], ["01/07/2026"], n=-13355)),
    ]
    df = spark.createDataFrame(rows, "page_id string, html string")
    verdicts = {r.page_id: (r.page_status, r.reject_reason, r.truncated) for r in pages.page_verdicts(df).collect()}
    assert verdicts["empty"] == ("EMPTY", None, False) and verdicts["refused"][1] == "QueryRejected" and verdicts["none"][1] == "UnexpectedResponse"
    assert verdicts["cut"] == ("TABLE", None, True) and verdicts["negative"][1] == "InvalidPageCount" and verdicts["good"][1] is None
    assert {r.page_id: r.n for r in df.select("page_id", pages.probe_rows(F.col("html")).alias("n")).collect() if r.n is not None} == {"empty": 0, "negative": 13355}
    parsed = pages.parsed_rows(df).collect()
    assert {(r.page_id, r.reject_reason) for r in parsed if r.reject_reason} == {("unknown", "UnknownColumn"), ("ragged", "UnexpectedResponse")}
    assert [(r.date, r.product, r.obs, r.category, r.origin) for r in parsed if r.page_id == "good"] == [("01/07/2026", "Aguacate Hass", None, "Frutas", None), ("02/07/2026", "Limón & sal", "x", None, None)]


def test_captured_pages_give_rows_or_reasons(spark, tmp_path):
    head = ["Fecha", "Producto", "Calidad", "Presentación", "Origen", "Precio Mín"]
    row = ["01/07/2026", "Papa", "Primera", "Saco", "Puebla", "1,000.50"]
    week = (D(2026, 7, 1), D(2026, 7, 7))
    made = [
        ("good", page(head, row, ["02/07/2026", *row[1:]]), "2", *week),
        ("empty", "NO HAY REGISTROS", "2", *week),
        ("cut", page(head, row, n=4), "2", *week),
        ("day", page(head, row, n=4), "2", week[0], week[0]),
        ("twice", page(head, row, row), "2", *week),
        ("lacks", page(head, row[:3] + [""] + row[4:]), "2", *week),
        ("mode", page(head), None, *week),
        ("odd mode", page(head, row), "7", *week),
        ("bad day", page(head, row, ["31/02/2026", *row[1:]]), "2", *week),
        ("column", page(["Color"], ["x"]), "2", *week),
        ("refused", "No puede seleccionar todos los productos", "2", *week),
        ("no rows", page(head), "2", *week),
    ]
    schema = "page_id string, html string, prices_per_id string, window_start date, window_end date, source_url string, fetched_at timestamp, product_id string, origin_id string, destination_id string"
    df = spark.createDataFrame([(*m, "u", NOW, "-1", "-1", "210") for m in made], schema)
    names = spark.createDataFrame([("210", "Puebla: Central")], "destination_id string, label string")
    raw_rows, rejections, again = capture.pages_to_raw(df, names, str(tmp_path / "judged"))
    assert {(r.page_id, r.fecha.day, float(r.precio_min), r.destino_raw, r.destino_id) for r in raw_rows.collect()} == {("good", 1, 1000.5, "Puebla: Central", 210), ("good", 2, 1000.5, "Puebla: Central", 210)}
    assert sorted((r.page_id, r.reason) for r in rejections.collect()) == [
        ("bad day", "UnwritableRow"), ("column", "UnknownColumn"), ("day", "WindowExhausted"), ("lacks", "MissingFields: presentation"), ("mode", "MissingFields: prices_per_id"),
        ("odd mode", "UnwritableRow"), ("refused", "QueryRejected"), ("twice", "DuplicateKey"),
    ]
    assert sorted((r.page_id, r.window_start.day, r.window_end.day) for r in again.collect()) == [("cut", 1, 4), ("cut", 5, 7)]
    nothing = capture.pages_to_raw(df.limit(0), names, str(tmp_path / "none"))
    assert [x.count() for x in nothing] == [0, 0, 0]


def test_strict_forms_refuse(spark):
    markets = spark.createDataFrame([("210",), ("100",)], "destination_id string")
    assert requests.chosen_strict(markets, markets.limit(1)).count() == 1
    with pytest.raises(ValueError, match="7"):
        requests.chosen_strict(markets, spark.createDataFrame([("7",)], "destination_id string"))
    day = F.lit("2026-07-01").cast("date")
    url = lambda d: requests.strict_url(requests.request_url("b", day, day, F.lit("-1"), F.lit("-1"), F.lit(d), F.lit("1")))
    assert spark.range(1).select(url("210")).first()[0].startswith("b?fechaInicio=01%2F07%2F2026")
    with pytest.raises(Exception, match="cannot all be"):
        spark.range(1).select(url("-1")).collect()


def test_outcomes_of_a_plan(spark):
    keys = "destination_id string, prices_per_id string"
    planned = spark.createDataFrame([(m, "1") for m in "abcde"], keys)
    landed = spark.createDataFrame([("a", "1", 3)], keys + ", rows long")
    one = lambda m: spark.createDataFrame([(m, "1")], keys)
    got = {r.destination_id: r.state for r in requests.outcome(planned, landed, one("b"), one("c"), one("d")).collect()}
    assert got == {"a": "landed", "b": "rejected", "c": "empty", "d": "expected_empty", "e": "missing"}


def test_typed_layer_marks_and_keeps(spark):
    rows = raw(spark, ("2026-07-01", "a", 1))
    products = spark.createDataFrame([("7", "p - q"), ("9", "p - q")], "product_id string, label string")
    places = spark.createDataFrame([("1", "d")], "destination_id string, label string")
    for catalog, market, want in ((products, places, ("7", "1", [])), (products.limit(0), places, (None, "1", ["unknown_product"]))):
        r = rawrows.typed_layer(rows, catalog, market).first()
        assert (r.product_key, r.destination_key, r.problems) == want
    loose = rawrows.typed_layer(rows.withColumn("destino_id", F.lit(None).cast("long")), products, places).first()
    assert loose.destination_key == "1"
    assert rawrows.typed_layer(rows.withColumns({"destino_id": F.lit(None).cast("long"), "destino_raw": F.lit("?")}), products, places).first().problems == ["unknown_destination"]


def test_season_goes_by_iso_years_and_earlier_observations(spark):
    days = [("2024-12-30", 10), ("2024-12-31", 20), ("2025-12-29", 15), ("2026-12-29", 99), ("2026-01-01", 5)]
    df = spark.createDataFrame([("x", D.fromisoformat(a), float(p)) for a, p in days], "g string, fecha date, precio_frecuente double")
    got = {(r.week, r.year): (r.years, r.observations, r.share_below) for r in prices.season_position(df, ["g"], 1).collect()}
    # 30 and 31 December 2024 are in week 1 of 2025; 29 December 2025 and 1 January 2026 in week 1 of 2026
    assert got == {(1, 2025): (0, 0, None), (1, 2026): (1, 2, 0.0), (53, 2026): (0, 0, None)}


def test_season_from_sketches_keeps_its_error_bound(spark):
    rng = random.Random(9)
    rows = [("x" if rng.random() < 0.7 else "y", D.fromisocalendar(2000 + y, 1 + rng.randrange(2), 1 + rng.randrange(7)), rng.gauss(100 + y, 10)) for y in range(6) for _ in range(4000)]
    df = spark.createDataFrame([*rows, ("z", D(2001, 1, 1), None)], "g string, fecha date, precio_frecuente double")
    exact = {(r.g, r.week, r.year): r for r in prices.season_position(df, ["g"], 2).collect()}
    halves = [prices.season_sketches(df.where(c), ["g"], k=200) for c in ("precio_frecuente < 100", "precio_frecuente >= 100")]
    got = {(r.g, r.week, r.year): r for r in prices.season_distribution(prices.merged_sketches(*halves, ["g"]), ["g"], 2).collect()}
    assert got.keys() == exact.keys()
    past = lambda g, w, y, q: sum(p <= q for a, d, p in rows if a == g and d.isocalendar()[1] == w and d.isocalendar()[0] < y)
    for k, r in got.items():
        assert (r.years, r.observations) == (exact[k].years, exact[k].observations)
        assert (r.share is None) == (exact[k].share_below is None)
        if r.share is not None:
            assert abs(r.share - exact[k].share_below) <= 1.5 * prices.rank_error(200) + 1 / prices.GRID
            for part, q in zip((0.25, 0.5, 0.75), r.quartiles):
                assert abs(past(*k, q) / r.observations - part) <= 1.5 * prices.rank_error(200)
    assert any(r.share is not None for r in got.values())


def test_season_from_counts_is_exact_beyond_any_sketch(spark):
    rng = random.Random(5)
    rows = [("x", D.fromisocalendar(2000 + y, 1 + rng.randrange(2), 1 + rng.randrange(7)), Decimal(rng.randrange(100, 9000)) / 100) for y in (0, 1, 3, 4) for _ in range(3000)]
    df = spark.createDataFrame([*rows, ("x", D.fromisocalendar(2003, 9, 1), Decimal(1)), ("x", D(2001, 1, 1), None)], "g string, fecha date, precio_frecuente decimal(38,9)")
    halves = [prices.season_counts(df.where(c), ["g"]) for c in ("precio_frecuente < 40", "precio_frecuente >= 40")]
    got = {(r.week, r.year): r for r in prices.exact_distribution(prices.merged_counts(*halves, ["g"]), ["g"], 2).collect()}
    of = lambda w, years: sorted(float(p) for _, d, p in rows if d.isocalendar()[1] == w and d.isocalendar()[0] in years)
    assert got.keys() == {(w, y) for w in (1, 2) for y in (2000, 2001, 2003, 2004)} | {(9, 2003)}
    for (w, y), r in got.items():
        past = of(w, range(2000, y))
        assert (r.years, r.observations) == (sum(z < y for z in (2000, 2001, 2003)) if w < 9 else 0, len(past))
        if r.years < 2:
            assert r.share is None and r.quartiles is None
            continue
        mean = sum(of(w, [y])) / len(of(w, [y]))
        assert r.share == sum(past[-(-i * len(past) // 256) - 1] <= mean for i in range(1, 257)) / 256
        assert r.quartiles == [past[-(-i * len(past) // 4) - 1] for i in (1, 2, 3)]
    assert max(r.observations for r in got.values()) > 4096
    assert prices.exact_distribution(prices.season_counts(df.limit(0), ["g"]), ["g"], 2).collect() == []


def test_backfill_quarters_and_spans(spark):
    rows = spark.createDataFrame([("1", y, n) for y, n in ((1998, 5), (1999, 0), (2000, 2))] + [("2", 1998, 0)], "destination_id string, year int, rows long")
    s = coverage.summary(rows)
    known = spark.createDataFrame([("1", D(1998, 4, 1))], "destination_id string, window_start date")
    got = sorted((r.window_start, r.window_end) for r in coverage.backfill_quarters(s, known).collect())
    assert len(got) == 7 and got[0] == (D(1998, 1, 1), D(1998, 3, 31)) and got[1][0] == D(1998, 7, 1) and got[-1] == (D(2000, 10, 1), D(2000, 12, 31))
    assert {(r.first_year, r.last_year, r.n_markets) for r in coverage.markets_by_span(s).collect()} == {(1998, 2000, 1), (None, None, 1)}
    plan = requests.daily_plan(s, F.lit("2001-03-05").cast("date"), 5, "b").collect()
    assert {(r.destination_id, r.prices_per_id, r.window_start, r.window_end) for r in plan} == {("1", m, D(2001, 3, 1), D(2001, 3, 5)) for m in "12"}


def test_alerts_name_some_and_count_all(spark):
    want = spark.range(1000, 1250).select(F.col("id").cast("string").alias("market"))
    lines = spark.range(300).select(F.format_string("destino=%03d", "id").alias("line"))
    day = lambda x: F.lit(x).cast("date")
    got = {r.kind: r for r in monitor.alerts(counts(spark, (1, "2026-08-11", 5)), want, lines, day("2026-08-05"), day("2026-08-11"), day("2026-08-11")).collect()}
    import json

    silent, failed = json.loads(got["mercados_sin_datos"].context), json.loads(got["mercados_fallidos"].context)
    assert got["mercados_sin_datos"].message.startswith("250 ") and silent["total"] == 250 and silent["mercados"] == [str(k) for k in range(1000, 1100)]
    assert failed["total"] == 300 and failed["ventanas"][0] == "destino=000" and len(failed["ventanas"]) == 100
    assert spark.range(1).select(monitor.short_context(F.lit("x" * 400)).alias("c")).first().c == "x" * 300


def test_plan_urls(spark):
    markets = spark.createDataFrame([("210",), ("210",), ("100",)], "destination_id string")
    plan = requests.plan(markets, F.lit("2026-07-01").cast("date"), F.lit("2026-07-05").cast("date"), "http://x/y")
    assert plan.count() == 4
    url = plan.where("destination_id = '100' and prices_per_id = '1'").first().url
    assert url == "http://x/y?fechaInicio=01%2F07%2F2026&fechaFinal=05%2F07%2F2026&ProductoId=-1&OrigenId=-1&DestinoId=100&PreciosPorId=1&RegistrosPorPagina=5000"
    everything = spark.createDataFrame([("-1",)], "destination_id string")
    assert requests.plan(everything, F.lit("2026-07-01").cast("date"), F.lit("2026-07-05").cast("date"), "b").where("url is not null").count() == 0


def raw(spark, *rows):
    full = [(D.fromisoformat(day), "p", "q", "caja", "o", "d", 1, "g", "kilogramo_calculado", Decimal(1), Decimal(2), Decimal(price), None, [], NOW, "u", key) for day, key, price in rows]
    return spark.createDataFrame(full, RAW_SCHEMA)


def test_upsert_twice_revised_and_refused(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = raw(spark, ("2026-07-01", "a", 1), ("2026-07-01", "b", 1), ("2026-07-02", "c", 1))
    stage = raw(spark, ("2026-07-01", "b", 9), ("2026-07-03", "d", 9))
    for rows in (first, stage, stage):
        upsert.upsert(rows, path)
    got = {(str(r.fecha), r.llave_fila): int(r.precio_frecuente) for r in spark.read.parquet(path).collect()}
    assert got == {("2026-07-01", "a"): 1, ("2026-07-01", "b"): 9, ("2026-07-02", "c"): 1, ("2026-07-03", "d"): 9}
    with pytest.raises(ValueError):
        upsert.upsert(raw(spark, ("2026-07-01", "a", 1), ("2026-07-01", "a", 2)), path)
    assert upsert.merged(first, first.limit(0)).count() == 0
    assert rawrows.violations(first).count() == 0
    assert {r.check for r in rawrows.violations(first.union(first)).collect()} == {"repeated llave_fila"}


def test_lines_and_stray_files(spark, tmp_path):
    root = f"{tmp_path}/raw"
    sinks.write_lines(raw(spark, ("2026-07-01", "a", 1), ("2026-07-02", "b", 2)), f"file://{root}")
    sinks.write_lines(raw(spark, ("2026-07-02", "c", 3)), f"file://{root}")
    assert {r.llave_fila for r in sinks.read_lines(spark, f"file://{root}").collect()} == {"a", "c"}
    import os

    os.makedirs(f"{root}/fecha=2026-07-04")
    line = '{"fecha":"2026-07-04","precio_min":1.5,"llave_fila":"z","banderas_calidad":[]}\n'
    for name in ("fecha=2026-07-04/x.ndjson", "stray.ndjson"):
        with open(f"{root}/{name}", "w") as f:
            f.write(line)
    with open(f"{root}/notes.txt", "w") as f:
        f.write("no line\n")
    assert {r.llave_fila for r in readers.raw_lines(spark, f"file://{root}").collect()} == {"a", "c", "z"}
    assert {(str(r.day), r.n_files) for r in readers.partition_days(spark, f"file://{root}").collect()} == {("None", 1), ("2026-07-01", 1), ("2026-07-02", 1), ("2026-07-04", 1)}
    with pytest.raises(ValueError):
        readers.checked_days(spark, f"file://{root}")


def test_load_reports_and_refuses(spark, tmp_path):
    root, table = f"file://{tmp_path}/raw", f"file://{tmp_path}/table"
    sinks.write_lines(raw(spark, ("2026-07-01", "a", 1), ("2026-07-02", "b", 2)), root)
    for _ in range(2):  # idempotent
        report = sinks.load(spark, root, table).first()
        assert (report.files, report.staged_rows, report.affected_rows, report.table, report.dates) == (2, 2, 2, table, [D(2026, 7, 1), D(2026, 7, 2)])
    got = spark.read.schema(RAW_SCHEMA).parquet(table)
    assert {(str(r.fecha), r.llave_fila, int(r.precio_max)) for r in got.collect()} == {("2026-07-01", "a", 2), ("2026-07-02", "b", 2)}
    import os

    os.makedirs(f"{tmp_path}/nothing")
    with pytest.raises(ValueError):
        sinks.load(spark, f"file://{tmp_path}/nothing", table)
    with open(f"{tmp_path}/raw/stray.ndjson", "w") as f:
        f.write("{}\n")
    with pytest.raises(ValueError):
        sinks.load(spark, root, table)


def test_load_refuses_nulls_and_counts_go_on(spark, tmp_path):
    root = f"file://{tmp_path}/raw"
    sinks.write_lines(raw(spark, ("2026-07-01", "a", 1)).withColumn("url_consulta", F.lit(None).cast("string")), root)
    with pytest.raises(ValueError, match="null url_consulta"):
        sinks.load(spark, root, f"file://{tmp_path}/table")
    grid = spark.createDataFrame([("1", 1998), ("1", 1999), ("2", 1998)], "destination_id string, year int")
    path, count = f"file://{tmp_path}/counts", lambda cells: cells.withColumn("rows", F.lit(7).cast("long"))
    assert [sinks.resume_counts(g, path, count) for g in (grid.limit(1), grid, grid)] == [1, 2, 0]
    assert sorted(tuple(r) for r in readers.stored_counts(spark, path).collect()) == [("1", 1998, 7), ("1", 1999, 7), ("2", 1998, 7)]


def test_counting_that_fails_keeps_its_earlier_slices(spark, tmp_path):
    grid = spark.createDataFrame([(str(m), y) for m in range(12) for y in (1998, 1999)], "destination_id string, year int")
    path, asked = f"file://{tmp_path}/counts", []

    def count(cells):
        asked.append({tuple(r) for r in cells.collect()})
        if len(asked) == 3:
            raise OSError("the source is gone")
        return cells.withColumn("rows", F.col("year").cast("long"))

    with pytest.raises(OSError):
        sinks.resume_counts(grid, path, count, slices=5)
    kept = {(r.destination_id, r.year) for r in readers.stored_counts(spark, path).collect()}
    assert kept == asked[0] | asked[1] and len(kept) < 24
    assert sinks.resume_counts(grid, path, count, slices=5) == 24 - len(kept)
    assert not any(kept & cells for cells in asked[2:]) and sinks.resume_counts(grid, path, count, slices=5) == 0
    got = [tuple(r) for r in readers.stored_counts(spark, path).collect()]
    assert sorted(got) == sorted((str(m), y, y) for m in range(12) for y in (1998, 1999))
    with pytest.raises(ValueError):
        sinks.resume_counts(grid, path, count, slices=0)


def test_season_position_equals_brute_force(spark):
    """Ties with the mean, equal means of several years, weeks of one year, null prices and null groups."""
    rng = random.Random(5)
    rows = [(g, D(y, 1, 5) + dt.timedelta(days=7 * w), rng.choice([1.0, 2.0, 2.0, 3.0, 4.5, None])) for g in ("a", "b", None) for y in range(2001, 2009) for w in range(3) for _ in range(rng.randint(0, 9))]
    rows += [("even", D(y, 3, 5), 2.0) for y in (2001, 2002, 2003) for _ in range(3)] + [("one", D(2001, 3, 5), 1.0)]
    got = {(r.g, r.week, r.year): (r.price, r.years, r.observations, r.share_below) for r in prices.season_position(spark.createDataFrame(rows, "g string, fecha date, precio_frecuente double"), ["g"], 2).collect()}
    held = {}
    for g, d, p in rows:
        if p is not None:
            year, week, _ = d.isocalendar()
            held.setdefault((g, week), {}).setdefault(year, []).append(p)
    want = {}
    for (g, week), years in held.items():
        for year, mine in years.items():
            mean, past = sum(mine) / len(mine), {y: p for y, p in years.items() if y < year and g is not None}
            seen = [p for ps in past.values() for p in ps]
            want[g, week, year] = mean, len(past), len(seen), sum(p < mean for p in seen) / len(seen) if len(past) >= 2 else None
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == pytest.approx(row), key


def test_failures_are_lines_that_the_monitor_reads(spark, tmp_path):
    bad = spark.createDataFrame([("210", "2", D(2026, 7, 1), D(2026, 7, 3), "DuplicateKey", "two rows"), ("9", None, None, None, "E", None)], "destination_id string, prices_per_id string, window_start date, window_end date, reason string, message string")
    path = f"file://{tmp_path}/failed"
    sinks.write_failures(bad, path)
    assert {r.line for r in readers.failures(spark, path).collect()} == {"destino=210 precio=2 ventana=2026-07-01..2026-07-03: DuplicateKey: two rows", "destino=9 precio= ventana=..: E: "}
    sinks.write_failures(bad.limit(0), path)
    assert readers.failures(spark, path).count() == 0


def counts(spark, *rows):
    return spark.createDataFrame([(m, D.fromisoformat(x), n) for m, x, n in rows], "destino_id long, fecha date, n_rows long")


@pytest.mark.parametrize(
    "rows,expected,failed,kinds",
    [
        ([(210, "2026-08-10", 120), (100, "2026-08-11", 98)], ["210", "100"], [], []),
        ([(210, "2026-08-10", 120), (100, "2026-08-11", 98)], ["210", "100", "20"], [], ["mercados_sin_datos"]),
        ([], ["210"], [], ["sin_datos", "datos_atrasados"]),
        ([(210, "2026-08-04", 1)], ["210"], [], ["datos_atrasados"]),
        ([(210, "2026-08-07", 1)], ["210"], [], []),
        ([(210, "2026-08-11", 1)], ["210"], ["destino=1"], ["mercados_fallidos"]),
    ],
)
def test_alerts(spark, rows, expected, failed, kinds):
    want = spark.createDataFrame([(m,) for m in expected], "market string")
    lines = spark.createDataFrame([(x,) for x in failed], "line string")
    day = lambda x: F.lit(x).cast("date")
    got = monitor.alerts(counts(spark, *rows), want, lines, day("2026-08-05"), day("2026-08-11"), day("2026-08-11")).collect()
    assert [r.kind for r in got] == ["resumen", *kinds]
    assert all(r.context.startswith("{") for r in got)


def test_coverage(spark):
    rows = spark.createDataFrame([("1", y, n) for y, n in ((1998, 5), (1999, 0), (2000, 0), (2001, 2), (2002, 0))] + [("2", 1998, 0)], "destination_id string, year int, rows long")
    s = {r.destination_id: r for r in coverage.summary(rows).collect()}
    assert (s["1"].first_year, s["1"].last_year, s["1"].years_with_data, s["1"].total_rows, s["1"].gap_years) == (1998, 2001, 2, 7, [1999, 2000])
    assert s["2"].first_year is None and s["2"].gap_years == []
    assert [r.destination_id for r in coverage.active(coverage.summary(rows), F.lit(2002)).collect()] == ["1"]


def test_catalogs(spark):
    p = spark.createDataFrame([("1", "Nuez - Western - Primera"), ("-1", "Todos"), ("2", "Sola")], "id string, label string")
    assert [(r.name, r.quality) for r in catalogs.products(p).orderBy("product_id").collect()] == [("Nuez - Western", "Primera"), (None, None)]
    d = spark.createDataFrame([("1", "Baja California : La Baja"), ("2", "DF: Central: Norte"), ("3", "Sin")], "id string, label string")
    assert [(r.state, r.market) for r in catalogs.destinations(d).orderBy("destination_id").collect()] == [("Baja California", "La Baja"), ("Distrito Federal", "Central: Norte"), (None, None)]
    assert {r.check for r in catalogs.violations(spark.createDataFrame([("x", ""), ("1", "a"), ("1", "a")], "id string, label string")).collect()} == {"id not of digits", "empty label", "repeated id", "repeated label"}
    o = catalogs.origins(spark.createDataFrame([("0", "Sin Especificar"), ("1", "Puebla")], "id string, label string"))
    assert {r.check for r in catalogs.origin_violations(o).collect()} == {"no national", "no import", "states"}


def test_prices(spark):
    df = spark.createDataFrame([(Decimal("20.00"),), (None,)], "precio_frecuente decimal(38,9)")
    got = prices.farm_gate(df, F.lit(0.1), F.lit(0.2), F.lit(2)).collect()
    assert float(got[0].farm_gate) == pytest.approx(20 * 0.9 * 0.8 - 2) and got[1].farm_gate is None


def test_text(spark):
    df = spark.createDataFrame([("  a \n b ", "x &amp; &oacute;"), ("  ", None)], "a string, b string")
    got = df.select(text.squeezed(F.col("a")).alias("a"), text.unescape(F.col("b")).alias("b")).collect()
    assert [tuple(r) for r in got] == [("a b", "x & ó"), (None, None)]


def test_next_windows(spark):
    rows = [("a", True, D(2026, 7, 1), D(2026, 7, 3)), ("b", True, D(2026, 7, 1), D(2026, 7, 1)), ("c", False, D(2026, 7, 1), D(2026, 7, 9))]
    df = spark.createDataFrame([(*r, None) for r in rows], "page_id string, truncated boolean, window_start date, window_end date, reject_reason string")
    again, dead = requests.next_windows(df)
    assert sorted((r.window_start.day, r.window_end.day) for r in again.collect()) == [(1, 2), (3, 3)]
    assert [(r.page_id, r.reject_reason) for r in dead.collect()] == [("b", "WindowExhausted")]
    line = df.where("page_id = 'a'").select(requests.failure_line(F.lit("210"), F.lit("2"), F.col("window_start"), F.col("window_end"), F.lit("E"), F.lit("m"))).first()[0]
    assert line == "destino=210 precio=2 ventana=2026-07-01..2026-07-03: E: m"


def test_archive_manifest_and_failures(spark, tmp_path):
    (tmp_path / "p.html").write_bytes(b"ok \xff P\xc3\xa1gina")
    (tmp_path / "m.json").write_text('{"p": {"file": "p.html", "url": "http://x?DestinoId=210", "purpose": "t", "bytes": 3}}')
    (tmp_path / "f.txt").write_text("one\n\ntwo\n")
    assert [tuple(r) for r in readers.page_archive(spark, f"file://{tmp_path}").collect()] == [("p", "ok \ufffd Página")]
    row = readers.manifest(spark, f"file://{tmp_path}/m.json").select("name", "file", requests.context_of_url(F.col("url"))["destination_id"].alias("d")).first()
    assert tuple(row) == ("p", "p.html", "210")
    assert readers.failures(spark, f"file://{tmp_path}/f.txt").count() == 2
    assert readers.failures(spark, f"file://{tmp_path}/none.txt").count() == 0 and readers.counts(spark, f"file://{tmp_path}/none.csv").count() == 0


def test_csv_and_tables(spark, tmp_path):
    rows = spark.createDataFrame([("10", 'La "Baja", MX', [1999, 2000]), ("9", "x", [])], "destination_id string, label string, gap_years array<int>")
    sinks.write_catalog(rows, f"file://{tmp_path}/c", "destination_id")
    back = readers.catalog(spark, f"file://{tmp_path}/c", "destination_id string, label string, gap_years string").collect()
    assert [tuple(r) for r in back] == [("9", "x", None), ("10", 'La "Baja", MX', "1999 2000")]
    sinks.create_table(spark, "raw_prices", f"file://{tmp_path}/t")
    upsert.upsert(raw(spark, ("2026-07-01", "a", 1)), f"file://{tmp_path}/t")
    spark.sql("msck repair table raw_prices")
    assert spark.table("raw_prices").count() == 1 and set(spark.table("raw_prices").columns) == {f.name for f in RAW_SCHEMA}
    assert readers.window(spark, f"file://{tmp_path}/t", "2026-07-01", "2026-07-02").count() == 1
    spark.sql("drop table raw_prices")
    sinks.append(rows, f"file://{tmp_path}/a"), sinks.append(rows, f"file://{tmp_path}/a")
    assert spark.read.parquet(f"file://{tmp_path}/a").count() == 4
    report = sinks.load_report(raw(spark, ("2026-07-01", "a", 1), ("2026-07-02", "b", 1)), spark.createDataFrame([(3,)], "n_files long")).first()
    assert (report.files, report.staged_rows, len(report.dates)) == (3, 2, 2)


def test_stream_keeps_the_newest_and_is_idempotent(spark, tmp_path):
    from tianguis.streaming import upserts

    source, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    stage = raw(spark, ("2026-07-01", "a", 1), ("2026-07-01", "a", 2), ("2026-07-02", "b", 1)).withColumn("extraido_en", F.timestamp_seconds(F.col("precio_frecuente").cast("long")))
    stage.write.parquet(source)
    for run in ("one", "two"):  # the same files again, as after a lost checkpoint
        upserts.stream_upsert(upserts.files(spark, source, RAW_SCHEMA), target, f"file://{tmp_path}/{run}").awaitTermination()
        assert {r.llave_fila: int(r.precio_frecuente) for r in spark.read.parquet(target).collect()} == {"a": 2, "b": 1}
    totals = upserts.day_totals(upserts.files(spark, source, RAW_SCHEMA), "extraido_en").writeStream.format("memory").queryName("totals").outputMode("complete").trigger(availableNow=True).start()
    totals.awaitTermination()
    assert spark.table("totals").agg(F.sum("n_rows")).first()[0] == 3


def test_grids_are_never_broadcast(spark):
    """Spark's estimates don't count what ``explode`` adds: a grid of millions of cells would look small."""
    markets = spark.range(50).select(F.col("id").cast("string").alias("destination_id"))
    grid = coverage.year_grid(markets, 1990, F.lit(2019))
    counts = spark.range(300).select((F.col("id") % 50).cast("string").alias("destination_id"), (1990 + F.col("id") % 30).cast("int").alias("year"), F.lit(2).cast("long").alias("rows"))
    by = coverage.dense(grid, counts.distinct())
    rest = coverage.remaining(by.select("destination_id", "year"), by.where("rows > 0"))
    assert rest.count() == 50 * 30 - by.where("rows > 0").count() == 50 * 30 - 150
    assert "Broadcast" not in rest._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_catalog_of_markets_are_not_shuffled(spark):
    """An empty catalog joined by market sent all rows of pages without a market (-1) to one task."""
    rows = records(spark, {"destination_id": "-1", "destination": "Puebla"}, {"destination_id": "210", "destination": " "}, {"destination_id": "x", "destination": ""})
    raw = rawrows.to_raw_rows(contract.with_identity(rows))
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    empty = rawrows.to_raw_rows(contract.with_identity(rows), spark.createDataFrame([], "destination_id string, label string"))
    assert sorted(map(str, raw.collect())) == sorted(map(str, empty.collect()))
    assert {(r.destino_raw, r.destino_id) for r in raw.collect()} == {("Puebla", None), (" ", 210), (None, None)}


def test_pages_are_made_by_one_grouping_and_read_by_one_call(spark):
    rows = spark.createDataFrame([(p, n, x, c) for p in (1, 2) for n, x, c in ((2, "b", "k"), (1, "<a> & \u00a0 b", None), (2, "a", "k"), (3, None, "l"), (4, "z", None))], "page long, n int, x string, c string")
    html = pages.result_html(rows, "page", "n", {"Producto": "x", "Obs.": "n"}, "c")
    plan = html._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1
    read = pages.parsed_rows(html)
    plan = read._jdf.queryExecution().executedPlan().toString()
    # the patterns are sought where entities are decoded, and cells come back as text
    assert plan.count("ArrowEvalPython") == 1 and "regexp_extract_all" not in plan
    got = sorted((r.page_id, r.row_pos, r.product, r.obs, r.category) for r in read.collect())
    one = [(0, "<a> & b", "1", None), (2, "a", "2", "k"), (3, "b", "2", "k"), (5, None, "3", "l"), (7, "z", "4", None)]
    assert got == [(p, *r) for p in "12" for r in one]
    # a table of one blank cell has a row, one without cells has none; a page without a table keeps its text
    odd = spark.createDataFrame([("1", "a&nbsp;1<TABLE id=tblResultados><tr><td> </td></tr></TABLE>b"), ("2", "<table id='tblResultados'></table>"), ("3", "no &amp; table"), ("4", None)], "page_id string, html string")
    from tianguis.functions import text as cells
    found = {r.page_id: (r.p.plain, r.p.has, r.c) for r in odd.select("page_id", cells.decoded_page(F.col("html"), pages._TABLE, pages._ROW, pages._CELL).alias("p")).withColumn("c", cells.table_cells(F.col("p.table"))).collect()}
    assert found == {"1": ("a\u00a01 b", True, [[None]]), "2": (" ", True, []), "3": ("no & table", False, []), "4": (None, False, [])}


def test_pages_are_made_with_one_shuffle(spark):
    rows = spark.createDataFrame([(1, 2, "b", "x"), (1, 1, "a", "x"), (2, 1, "c", "y")], "page long, place int, product string, category string")
    html = pages.result_html(rows, "page", "place", {"Producto": "product", "Obs.": "category"}, "category")
    assert html._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert [(r.page_id, r.product, r.category) for r in pages.parsed_rows(html).orderBy("page_id", "row_pos").collect()] == [("1", "a", "x"), ("1", "b", "x"), ("2", "c", "y")]


def test_lines_are_packed(spark, tmp_path):
    n, root = 2_000, f"file://{tmp_path}/raw"
    one = raw(spark, ("2026-07-01", "a", 1))
    rows = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("llave_fila")).crossJoin(one.drop("llave_fila")).select(one.columns)
    sinks.write_lines(rows, root)
    files = list((tmp_path / "raw").rglob("part-*"))
    assert files and all(p.name.endswith(".gz") for p in files)
    assert sum(p.stat().st_size for p in files) < 150 * n  # a line has over 400 characters
    back = sinks.read_lines(spark, root)
    assert back.exceptAll(rows).count() == 0 and back.count() == n
