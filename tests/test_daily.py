"""Pages judged within their row, windows asked for until they are complete, daily runs, and streamed lines."""

import os
import re
from datetime import date as D
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tianguis.operators import capture, published, upsert
from tianguis.plans import requests, worklist
from tianguis.schemas import PAGES, RAW_SCHEMA
from tianguis.sources import readers, sinks
from tianguis.streaming import lines

NOW = datetime(2026, 7, 25, 12)
BASE = "https://prices.example.org/results"
HEAD = ["Fecha", "Producto", "Calidad", "Presentación", "Origen", "Precio Mín"]


def page(head, *rows, n=1):
    line = lambda cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    return f"<html>P&aacute;gina 1 de {n}<table id='tblResultados'>{''.join(map(line, [head, *rows]))}</table></html>"


def row(day, product="Papa", price="10"):
    return [day.strftime("%d/%m/%Y"), product, "Primera", "Saco", "Puebla", price]


def captured(spark, made):
    rows = [(i, html, "u", NOW, "-1", "-1", "210", "2", D(2026, 7, 1), D(2026, 7, 7)) for i, html in made]
    return spark.createDataFrame(rows, PAGES)


def test_judging_needs_no_shuffle_and_names_the_first_bad_row(spark):
    d = D(2026, 7, 1)
    made = [
        ("good", page(HEAD, ["Frutas"], row(d), ["Granos"], row(d, "Maíz"), [""], row(d, "Sal"))),
        ("lacks", page(HEAD, row(d), ["Frutas"], row(d, "Maíz")[:3] + [""] + row(d)[4:], row(d, ""))),
        ("twice", page(HEAD, row(d), row(d, "Maíz"), ["Frutas"], row(d), row(d, "Maíz"))),
        ("only separators", page(HEAD, ["Frutas"], ["Granos"])),
        ("nested mark", page(HEAD, row(d, "No puede seleccionar todos los productos"))),
    ]
    judged = capture.judge_pages(captured(spark, made))
    assert "Exchange" not in judged._jdf.queryExecution().executedPlan().toString()
    got = {r.page_id: r for r in judged.collect()}
    assert {k: (r.reason, r.bad_row, r.n_rows) for k, r in got.items()} == {
        "good": (None, None, 3), "lacks": ("MissingFields: presentation, product", 2, 3), "twice": ("DuplicateKey", 3, 4), "only separators": (None, None, 0), "nested mark": ("QueryRejected", None, 0),
    }
    assert [(r.row_pos, r.product, r.category) for r in got["good"].records] == [(1, "Papa", "Frutas"), (3, "Maíz", "Granos"), (5, "Sal", None)]


def test_a_page_of_many_sections_takes_little_more_time(spark):
    d = D(2026, 7, 1)
    many = page(HEAD, *[x for i in range(3000) for x in ([f"c{i}"], row(d, f"p{i}"))])
    [r] = capture.judge_pages(captured(spark, [("many", many)])).collect()
    assert (r.reason, r.n_rows) == (None, 3000)
    assert [x.category for x in r.records] == [f"c{i}" for i in range(3000)]


class Source:
    """Answers requests from (market, mode, day, product, price); counts what it was asked."""

    def __init__(self, spark, rows, most, broken=(), silent=()):
        self.spark, self.rows, self.most, self.broken, self.silent, self.asked = spark, rows, most, broken, silent, []

    def __call__(self, wanted):
        made = []
        for r in wanted.collect():
            self.asked.append((r.destination_id, r.prices_per_id, r.window_start, r.window_end))
            if r.destination_id in self.silent:
                continue
            own = [x for x in self.rows if x[:2] == (r.destination_id, r.prices_per_id) and r.window_start <= x[2] <= r.window_end]
            html = page(HEAD, *[row(d, p, c) for _, _, d, p, c in own[: self.most]], n=max(1, -(-len(own) // self.most))) if own else "NO HAY REGISTROS"
            html = html.replace("Calidad", "Color") if r.destination_id in self.broken else html
            made.append((r.url, html, r.url, NOW, "-1", "-1", r.destination_id, r.prices_per_id, r.window_start, r.window_end))
        return self.spark.createDataFrame(made, PAGES)


def wanted(spark, markets, start, end):
    m = spark.createDataFrame([(x,) for x in markets], "destination_id string")
    return requests.plan(m, F.lit(start), F.lit(end), BASE)


def test_windows_shrink_until_they_are_complete(spark, tmp_path):
    start = D(2026, 6, 1)
    rows = [("1", "1", D(2026, 6, 1 + i % 20), f"p{i}", "1") for i in range(60)] + [("2", "1", D(2026, 6, 5), f"p{i}", "1") for i in range(9)] + [("2", "2", D(2026, 6, 6), "x", "1")]
    ask = Source(spark, rows, 7, silent=("3",))
    out = worklist.until_complete(wanted(spark, ["1", "2", "3"], start, D(2026, 7, 9)), ask, BASE, str(tmp_path / "s"))
    found = out.collect()
    got = [(r.destination_id, r.prices_per_id, r.window_start, r.window_end, r.state, r.reason, r.n_rows) for r in found]
    for market, mode in {(g[0], g[1]) for g in got}:
        # the last windows lie side by side and cover the span
        last = sorted(g[2:4] for g in got if g[:2] == (market, mode) and g[4] != "split")
        assert last[0][0] == start and last[-1][1] == D(2026, 7, 9)
        assert all((b[0] - a[1]).days == 1 for a, b in zip(last, last[1:]))
    assert sum(g[6] for g in got if g[4] == "complete") == 61
    assert [(g[2], g[3], g[5]) for g in got if g[4] == "rejected"] == [(D(2026, 6, 5), D(2026, 6, 5), "WindowExhausted")]
    assert {g[:2] for g in got if g[4] == "unanswered"} == {("3", "1"), ("3", "2")}
    assert len(ask.asked) == len(set(ask.asked))
    # the first half is the longer; market and mode stay
    assert ("1", "1", D(2026, 6, 1), D(2026, 6, 20)) in ask.asked and ("1", "1", D(2026, 6, 21), D(2026, 7, 9)) in ask.asked
    # started again it goes on after the last whole round
    n, before = len(ask.asked), len(os.listdir(tmp_path / "s"))
    (tmp_path / "s" / f"round={before - 1}" / "_SUCCESS").unlink()
    again = worklist.until_complete(wanted(spark, ["1", "2", "3"], start, D(2026, 7, 9)), ask, BASE, str(tmp_path / "s"))
    assert sorted(map(str, again.collect())) == sorted(map(str, found))
    assert 0 < len(ask.asked) - n < n / 2
    assert worklist.until_complete(wanted(spark, [], start, start), ask, BASE, str(tmp_path / "t")).count() == 0


def test_rounds_needed_bounds_every_length():
    def rounds(days):
        return 1 if days == 1 else 1 + rounds(-(-days // 2))

    assert all(rounds(n) <= worklist.rounds_needed(n) for n in range(1, 400))


def test_a_daily_run_can_be_repeated_and_revised(spark, tmp_path):
    day = lambda n: D(2026, 7, n)
    rows = [("1", m, day(1 + i % 5), f"p{i}", "10.5") for m in "12" for i in range(20)] + [("2", "1", day(2), f"q{i}", "3") for i in range(30)] + [("3", "1", day(3), "r", "1")]
    markets = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "destination_id string")
    names = spark.createDataFrame([("1", "Uno"), ("2", "Dos")], "destination_id string, label string")
    table, store = str(tmp_path / "table"), str(tmp_path / "store")
    args = (F.lit(day(1)), F.lit(day(5)), F.lit(day(20)))

    def run(rows, name, **odd):
        out = worklist.daily_run(markets, *args, Source(spark, rows, 6, **odd), BASE, table, store, name, names).collect()
        spark.catalog.refreshByPath(table)
        return {r.kind: r for r in out}, sorted((r.destino_id, r.producto_raw, r.fecha.day, r.tipo_precio, float(r.precio_min)) for r in spark.read.parquet(table).collect())

    first, landed = run(rows, "a", broken=("3",))
    assert len(landed) == 40 and {x[0] for x in landed} == {1}  # market 2's day is exhausted, 3 has an unknown column
    assert set(first) == {"resumen", "mercados_sin_datos", "datos_atrasados", "mercados_fallidos"}
    lines = sorted(r.value for r in spark.read.text(f"{store}/failures").collect())
    assert [x.split(": ")[1] for x in lines] == ["WindowExhausted", "UnknownColumn"] and lines[0].startswith("destino=2 precio=1 ventana=2026-07-02..2026-07-02")
    assert run(rows, "a")[1] == landed  # the same run again
    revised = [(*r[:4], "11") for r in rows if r[0] == "1" and r[2] > day(2)] + [("3", "1", day(3), "r", "1")]
    kinds, after = run(revised, "b")
    assert len(after) == 41 and {x[4] for x in after if x[0] == 1 and x[2] > 2} == {11.0} and {x[4] for x in after if x[2] <= 2} == {10.5}
    assert "mercados_fallidos" not in kinds and spark.read.text(f"{store}/failures").where("length(value) > 0").isEmpty()
    assert {r.run for r in spark.read.parquet(f"{store}/alerts").collect()} == {"a", "b"}


def raw(spark, *rows):
    blank = dict.fromkeys(f.name for f in RAW_SCHEMA)
    made = [blank | {"fecha": f, "destino_id": m, "tipo_precio": "kilogramo_calculado", "llave_fila": k, "producto_raw": k, "extraido_en": NOW} for f, m, k in rows]
    return spark.createDataFrame([tuple(r.values()) for r in made], RAW_SCHEMA)


def test_streamed_lines_are_those_of_a_batch(spark, tmp_path):
    rows = [(D(2026, 7, 1 + i % 3), None if i % 4 == 0 else i % 2, f"k{i}") for i in range(60)]
    source, root, whole = (str(tmp_path / n) for n in ("source", "root", "whole"))
    for i in range(3):
        raw(spark, *rows[i * 20 : i * 20 + 20]).coalesce(1).write.mode("append").parquet(source)
    sinks.write_lines(raw(spark, *rows), whole)
    stream = lambda: spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)

    def held(path):
        found = {}
        for r in spark.read.option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("p")).collect():
            found.setdefault(re.search(r"fecha=.*?/destino=.*?/precio=[^/]*", r.p)[0], []).append(r.value)
        return {k: sorted(v) for k, v in found.items()}

    old = raw(spark, (D(2026, 7, 1), 1, "old"), (D(2020, 1, 1), 1, "elsewhere"))
    sinks.write_lines(old, root)
    for n in range(2):  # a rerun replaces the days
        lines.stream_lines(stream(), root, str(tmp_path / f"progress{n}")).awaitTermination()
        got = held(root)
        assert len(got.pop("fecha=2020-01-01/destino=1/precio=kilogramo_calculado")) == 1
        assert got == held(whole)
    # the last batch is repeated, as after a failure between its lines and its commit
    commits = tmp_path / "progress1" / "progress" / "commits"
    last = max(int(x) for x in os.listdir(commits) if x.isdigit())
    (commits / str(last)).unlink()
    for f in commits.glob(f".{last}.*"):
        f.unlink()
    lines.stream_lines(stream(), root, str(tmp_path / "progress1")).awaitTermination()
    got = held(root)
    got.pop("fecha=2020-01-01/destino=1/precio=kilogramo_calculado")
    assert got == held(whole)
    assert readers.raw_lines(spark, root).count() == 61


def test_lines_in_day_folders_still_go_by_market_and_mode(spark, tmp_path):
    rows = [(D(2026, 7, 1 + i % 3), None if i % 4 == 0 else i % 20, f"k{i}") for i in range(60)]
    source, root = (str(tmp_path / n) for n in ("source", "root"))
    for i in range(3):
        raw(spark, *rows[i * 20 : i * 20 + 20]).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    held = lambda: sorted(r.llave_fila for r in readers.raw_lines(spark, root).collect())
    # partitions that the stream touches, one in a touched day that it doesn't, and another day's
    old = [(D(2026, 7, 1), 3, "old"), (D(2026, 7, 1), None, "old too"), (D(2026, 7, 1), 99, "stays"), (D(2020, 1, 1), 3, "elsewhere")]
    sinks.write_lines(raw(spark, *old), root, sinks.DAY_FOLDERS)
    sinks.write_lines(raw(spark, (D(2026, 7, 1), 98, "stays too")), root, sinks.DAY_FOLDERS)
    sinks.write_lines(raw(spark, (D(2026, 7, 1), 3, "older than the stream")), root, sinks.DAY_FOLDERS)
    assert held() == sorted(["older than the stream", "old too", "stays", "stays too", "elsewhere"])
    want = sorted([r[2] for r in rows] + ["stays", "stays too", "elsewhere"])
    for n in range(2):  # a rerun replaces the partitions
        lines.stream_lines(stream(), root, str(tmp_path / f"progress{n}"), sinks.DAY_FOLDERS).awaitTermination()
        assert held() == want
    commits = tmp_path / "progress1" / "progress" / "commits"
    last = max(int(x) for x in os.listdir(commits) if x.isdigit())
    for f in [commits / str(last), *commits.glob(f".{last}.*")]:
        f.unlink()
    lines.stream_lines(stream(), root, str(tmp_path / "progress1"), sinks.DAY_FOLDERS).awaitTermination()
    assert held() == want
    # a file a task and day, not one for each market
    assert sum(f.startswith("part-") for _, _, fs in os.walk(root) for f in fs) <= 4 * 4 < len(set(rows)) / 2


def test_newest_is_settled_also_where_moments_are_equal(spark):
    rows = [("k", 1, "a"), ("k", 1, "b"), ("k", 1, None), ("k", 0, "z"), ("n", None, "y"), ("n", 5, "x")]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "llave_fila string, extraido_en int, price string").repartition(parts)
        assert sorted((r.llave_fila, r.price) for r in upsert.newest(df).collect()) == [("k", "b"), ("n", "x")]


def test_accepted_rows_may_be_written_first(spark, tmp_path):
    from tianguis.operators import contract
    from tianguis.plans import adapter

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no tables")
    rows = adapter.parsed(spark, d)
    a, b = contract.accepted_and_rejected(rows), contract.accepted_and_rejected(rows, str(tmp_path / "rows"))
    assert [x.count() for x in a] == [x.count() for x in b]


def test_archived_pages_arrive_as_files(spark, tmp_path):
    """Pages with their context from the manifest's urls, in their own charset, as a stream and as a batch."""
    import json

    from tianguis.streaming import captures

    d, folder = D(2026, 7, 1), tmp_path / "pages"
    folder.mkdir()
    url = lambda market: f"{BASE}?fechaInicio=01%2F07%2F2026&fechaFinal=07%2F07%2F2026&ProductoId=-1&OrigenId=-1&DestinoId={market}&PreciosPorId=2&RegistrosPorPagina=5000"
    made = {"good": page(HEAD, row(d, "Maíz")), "latin": "<meta charset=iso-8859-1>" + page(HEAD, row(d, "Ñame")), "cut": page(HEAD, row(d), n=3), "unlisted": page(HEAD, row(d)), "odd": "<meta charset=none-such>" + page(HEAD, row(d)[:3] + [""] + row(d)[4:])}
    for name, html in made.items():
        (folder / f"{name}.html").write_bytes(html.encode("iso-8859-1" if name == "latin" else "utf-8"))
    listed = {n: {"file": f"pages/{n}.html", "url": url(i), "purpose": "x", "bytes": 1} for i, n in enumerate(made) if n != "unlisted"}
    (tmp_path / "manifest.json").write_text(json.dumps(listed))
    listed = readers.manifest(spark, str(tmp_path / "manifest.json"))
    batch = readers.archived_pages(spark.read.format("binaryFile").load(str(folder)), listed)
    assert {(r.page_id, r.destination_id, r.window_end) for r in batch.collect()} == {("good", "0", D(2026, 7, 7)), ("latin", "1", D(2026, 7, 7)), ("cut", "2", D(2026, 7, 7)), ("unlisted", None, None), ("odd", "4", D(2026, 7, 7))}
    rows, bad, again = capture.pages_to_raw(batch, None, str(tmp_path / "judged"))
    assert {(r.page_id, r.producto_raw, r.destino_id) for r in rows.collect()} == {("good", "Maíz", 0), ("latin", "Ñame", 1)}
    assert again.count() == 2
    stream = readers.archived_pages(captures.page_files(spark, str(folder), per_batch=2), listed)
    out = str(tmp_path / "out")
    captures.stream_captures(stream, out, str(tmp_path / "progress")).awaitTermination()
    got = spark.read.parquet(f"{out}/rows"), spark.read.parquet(f"{out}/rejections")
    assert len([x for x in os.listdir(f"{out}/rows") if x.startswith("batch=")]) > 1
    for x, y in zip(got, (rows, bad)):
        assert sorted(map(str, x.drop("batch").collect())) == sorted(map(str, y.collect()))
    assert {(r.page_id, r.reason) for r in got[1].collect()} == {("unlisted", "MissingFields: destination, prices_per_id"), ("odd", "MissingFields: presentation")}


def test_published_prices_follow_upserts(spark, tmp_path):
    """After revisions the tables equal a full build; only the touched days of the raw table are read."""
    table, parts, final = (f"file://{tmp_path}/{n}" for n in ("t", "p", "f"))
    by, priced = ["product"], lambda r: r.withColumn("farm_gate", F.col("price") - 1)

    def rows(*made):
        return spark.createDataFrame([(f"{day}{key}", D.fromisoformat(day), product, price and Decimal(price)) for day, key, product, price in made], "llave_fila string, fecha date, product string, price decimal(10,2)")

    def upserted_and_refreshed(stage):
        upsert.upsert(stage, table, cluster=("product",))
        days = published.touched_days(stage)
        published.refresh(spark.read.parquet(table), days, parts, final, by, priced)
        return days

    def shown():
        return {(r.product, r.period): (r.n, r["mean"] and float(r["mean"]), r.least and float(r.least), r.greatest and float(r.greatest)) for r in spark.read.parquet(final).collect()}

    def rebuilt():
        whole = published.finals_of(published.parts_of(priced(spark.read.parquet(table)), by), by)
        return {(r.product, r.period): (r.n, r["mean"] and float(r["mean"]), r.least and float(r.least), r.greatest and float(r.greatest)) for r in whole.collect()}

    assert published.refresh(rows(), [], parts, final, by, priced) is None
    upserted_and_refreshed(rows(("2025-12-31", "a", "x", "5"), ("2026-01-02", "a", "x", "7.5"), ("2026-01-02", "b", "x", "3"), ("2026-01-05", "c", "y", None), ("2026-01-05", "d", "x", "9")))
    assert shown() == rebuilt() == {("x", 2025): (1, 4.0, 4.0, 4.0), ("x", 2026): (3, 5.5, 2.0, 8.0), ("y", 2026): (0, None, None, None)}
    old = {p.name for p in (tmp_path / "f" / "period=2025").glob("*.parquet")}
    # a revised least price, a product that a day loses, a new day
    for stage in (rows(("2026-01-02", "b", "x", "8")), rows(("2026-01-05", "c", "z", "2")), rows(("2026-03-01", "e", "x", "1.25"))):
        for _ in range(2):
            upserted_and_refreshed(stage)
            assert shown() == rebuilt()
    assert shown()[("x", 2026)][2] == 0.25 and ("y", 2026) not in shown()
    # other periods' files are left alone
    assert {p.name for p in (tmp_path / "f" / "period=2025").glob("*.parquet")} == old
    # only touched days' partitions are listed
    scan = published.touched_rows(spark.read.parquet(table), [D(2026, 1, 5)])
    assert len(scan.inputFiles()) == 4
    read = scan.select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("fecha=2026-01-05" in r.f for r in read)


def test_row_groups_are_skipped_by_each_clustering_column(spark, tmp_path):
    """A clustered day lets row groups be skipped by product, by market and by mode; counted by the scan's own metric."""
    n = 40_000
    i = F.col("id")
    rows = spark.range(n).select(
        F.sha2(i.cast("string"), 256).alias("llave_fila"), F.lit(D(2026, 7, 1)).alias("fecha"),
        F.format_string("p%03d", i * 7919 % 200).alias("producto_raw"), (F.xxhash64(i) % 128).alias("destino_id"),
        F.when(i % 64 == 0, "presentacion_comercial").otherwise("kilogramo_calculado").alias("tipo_precio"),
    )
    path = f"file://{tmp_path}/t"
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1250")
    try:
        upsert.upsert(rows, path)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    table = spark.read.parquet(path)
    every = len(table.inputFiles())
    assert every >= 30 and table.count() == n
    for where in ("producto_raw = 'p017'", "destino_id = 5", "tipo_precio = 'presentacion_comercial'"):
        wanted = rows.where(where).count()
        found = table.where(where)
        assert found.count() == wanted > 0
        read = rows_scanned(found)
        assert wanted <= read < n / 2, (where, read)
    assert spark.read.parquet(path).exceptAll(rows.select(*table.columns)).count() == 0


def test_interleaved_order_takes_odd_columns(spark):
    rows = spark.createDataFrame([(None, None, 1), ("a", 1.5, 1), ("b", None, 1), ("c", 2.5, 1)], "a string, b double, c int")
    bounds = upsert.cluster_bounds(rows, ["a", "b", "c"], 4)
    assert bounds == [("a", ["b", "c"]), ("b", [2.5]), ("c", [])]
    got = [r.z for r in rows.withColumns(upsert.ranges_of(bounds)).select(upsert.interleaved(bounds).alias("z")).collect()]
    # two bits of a, one of b between them
    assert got == [0b000, 0b000, 0b001, 0b110]
    assert upsert.cluster_bounds(rows.limit(0), ["a"], 0) == [("a", [])]
    assert rows.select(upsert.interleaved([]).alias("z")).distinct().count() == 1


def rows_scanned(df):
    """Rows that the Parquet reader handed on (groups skipped by their statistics are not among them)."""
    qe = df._jdf.queryExecution()
    qe.executedPlan().executeCollect()

    def leaf(node):
        kids = node.children()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return leaf(node.executedPlan())
        return node if kids.isEmpty() else leaf(kids.head())

    return leaf(qe.executedPlan()).metrics().apply("numOutputRows").value()


def test_requests_meet_a_source_and_its_pages_once(spark):
    """Windows asked for again and again: one join with the source's rows and one with the requests, before pages are records."""
    from tianguis import registry

    day = D(2026, 6, 1)
    fields = "date string, product string, quality string, presentation string, origin string, destination string, price_min string, price_max string, price_frequent string"
    rows = [("1", "1", day + timedelta(i % 3), f"{i:02}", "01/06/2026", f"p<{i:02}&", None, "kg", "o", "d", "1", "3", "2") for i in range(9)]
    offered = spark.createDataFrame(rows, f"destination_id string, prices_per_id string, day date, place string, {fields}")
    asked = wanted(spark, ["1", "2"], day, day + timedelta(2))
    answered = worklist._answered(asked, registry._source(offered, 4))
    plan = answered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2
    # pages are read after the last join, so that no records are shuffled
    assert plan.index("ArrowEvalPython") < plan.index("Join ")
    got = {(r.destination_id, r.prices_per_id): r for r in answered.collect()}
    assert {k: (r.state, r.n_pages, r.n_rows) for k, r in got.items()} == {("1", "1"): ("split", 3, 4), ("1", "2"): ("empty", None, 0), ("2", "1"): ("empty", None, 0), ("2", "2"): ("empty", None, 0)}
    # the first rows by day and place
    assert [x.product for x in got["1", "1"].records] == ["p<00&", "p<03&", "p<06&", "p<01&"]


def test_tags_out_of_step_are_read_as_before(spark):
    """Tables whose tags are in capitals, never closed or nested give the cells of the lazy patterns."""
    from tianguis.functions.text import decoded_page, table_cells
    from tianguis.operators import pages

    inner = ["<tr><td>a</td><td>b</td></tr>", "<TR><td>a</TD></tr><tr><td>b</td></TR>", "<tr><td>a<td>b</td></tr>", "<tr foo</tr><tr><td>a</td></tr>", "<tr><td>a</td>", "x</tr><tr><td>a</td></tr>",
             "<tr><td><b>a</b></td><td c=1>b  c</td></tr>", "<trx><td>a</td></tr><tr><tdx>b</td></tr>", "<tr><td>\n a</td></tr></tr><tr></tr>"]
    made = [f'<table id="tblResultados">{x}</table>' for x in inner] + [f'<table id="tblResultados">{inner[0]}</TABLE>', f'<table id="tblResultados">{inner[0]}', "none"]

    def lazy(text):
        found = re.search(pages._TABLE, text)
        rows = [[re.sub("<[^>]*>", "", c) for c in re.findall(pages._CELL, r)] for r in re.findall(pages._ROW, found[0])] if found else []
        # an empty row and an empty cell are one text
        flat = [[" ".join(c.split()) or None for c in r] or [None] for r in rows]
        return [] if flat in ([], [[None]]) else flat

    df = spark.createDataFrame(list(enumerate(made)), "i int, html string").select("i", decoded_page(F.col("html"), pages._TABLE, pages._ROW, pages._CELL).alias("p"))
    got = {r.i: r for r in df.select("i", "p.has", table_cells(F.col("p.table")).alias("cells")).collect()}
    for i, text in enumerate(made):
        assert got[i].has == bool(re.search(pages._TABLE, text)), text
        assert [list(r) for r in got[i].cells] == lazy(text), text


def test_lines_of_many_markets_share_files(spark):
    from tianguis import registry

    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no tables")
    root = registry._lines(spark, d).removeprefix("file://")
    files = [os.path.join(p, f) for p, _, fs in os.walk(root) for f in fs if f.startswith("part-")]
    # seven years; a folder for each market and mode made 154 files of 59 998 rows
    assert 7 <= len(files) <= 7 * 4 and not any("destino=" in f for f in files)
    rows = readers.raw_lines(spark, root)
    assert rows.count() == registry._typed(spark, d).count() and rows.where("destino_id is null").count() > rows.where("destino_id is not null").count() > 0


def test_a_stored_stage_is_not_kept_twice(spark, tmp_path):
    stage, path = str(tmp_path / "stage"), str(tmp_path / "table")
    spark.createDataFrame([(D(2026, 7, 1 + i % 2), f"k{i}", i) for i in range(40)], "fecha date, llave_fila string, n int").write.parquet(stage)
    kept = []
    real = upsert.merged
    upsert.merged = lambda target, rows, *more: kept.append(rows.storageLevel.useMemory or rows.storageLevel.useDisk) or real(target, rows, *more)
    try:
        for _ in range(2):
            assert upsert.upsert(spark.read.parquet(stage), path, cluster=(), stored=True) == 40
    finally:
        upsert.merged = real
    assert kept and not any(kept) and spark.read.parquet(path).count() == 40


def test_repeated_keys_are_told_from_equal_hashes(spark, monkeypatch):
    rows = lambda *pairs: spark.createDataFrame([(D(2026, 7, d), k) for d, k in pairs], "fecha date, llave_fila string")
    for real in (True, False):
        if not real:  # all hashes are equal
            monkeypatch.setattr(upsert.F, "xxhash64", lambda *_: F.lit(1).cast("long"))
        assert upsert.repeated(rows((1, "a"), (1, "b"), (2, "a"))) == (3, False)
        assert upsert.repeated(rows((1, "a"), (1, "b"), (1, "a"))) == (3, True)
        assert upsert.repeated(rows((1, "a")).limit(0)) == (0, False)


def test_rows_of_good_pages_come_from_one_pass(spark):
    from tianguis import registry
    from tianguis.operators import contract
    from tianguis.plans import adapter

    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no tables")
    plan = registry.season_position(spark, d)._jdf.queryExecution().optimizedPlan().toString()
    one = registry._typed(spark, d)._jdf.queryExecution().optimizedPlan().toString()
    assert one.count("Relation [l_orderkey") == 1 and "Join LeftAnti" not in one + plan
    rows = adapter.parsed(spark, d)
    good, bad = contract.accepted_and_rejected(rows)
    left = rows.join(bad.select("page_id"), "page_id", "left_anti").select("page_id", "row_pos")
    assert good.columns == contract.with_identity(rows).columns and {r.reason for r in bad.select("reason").distinct().collect()} == {"DuplicateKey", "MissingFields: presentation"}
    assert sorted(good.select("page_id", "row_pos").collect()) == sorted(left.collect())


def test_the_archive_of_pages_is_streamed_as_it_lies(spark, monkeypatch):
    from tianguis import registry

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no tables")
    made, real = {}, registry._scratch
    monkeypatch.setattr(registry, "_scratch", lambda s, name: made.setdefault(name, real(s, name)))
    n = registry.stream_captures(spark, d).count()
    # no second copy of the pages, and every table of the run in zstd
    assert n > 0 and set(made) == {"pages", "captures", "progress"}
    files = [os.path.join(p, f) for x in ("pages", "captures") for p, _, fs in os.walk(made[x].removeprefix("file://")) for f in fs if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)


def test_judged_pages_hold_no_keys_and_rows_have_them(spark, tmp_path):
    d, store = D(2026, 7, 1), str(tmp_path / "judged")
    pages = captured(spark, [("good", page(HEAD, row(d), row(d, "Maíz"))), ("twice", page(HEAD, row(d), row(d)))])
    raw, bad, _ = capture.pages_to_raw(pages, None, store)
    held = spark.read.parquet(store)
    assert "natural_key" not in held.schema["records"].dataType.elementType.names and all(".zstd." in f for f in held.inputFiles())
    key = lambda name: "|".join(["01/07/2026", f"{name} - Primera", "Saco", "Puebla", "id:210", "2"])
    import hashlib

    assert {r.llave_fila for r in raw.collect()} == {hashlib.sha256(key(x).encode()).hexdigest() for x in ("Papa", "Maíz")}
    assert [tuple(r) for r in bad.collect()] == [("twice", "DuplicateKey")]


def test_a_round_matches_pages_by_their_requests_alone(spark, tmp_path):
    """Pages of other requests are left out, and a page without a url gets its request's; requests without a page are told."""
    start, end = D(2026, 6, 1), D(2026, 6, 3)
    rows = [(m, "1", start + timedelta(i % 3), f"p{i}", "1") for m in ("1", "2") for i in range(4)]
    asked = wanted(spark, ["1", "2", "3"], start, end)
    usual = Source(spark, rows, 7, silent=("3",))

    def odd(todo):
        pages = usual(todo)
        stray = pages.where("destination_id = '1'").withColumn("destination_id", F.lit("9"))
        return pages.withColumn("source_url", F.when(F.col("destination_id") != "2", F.col("source_url"))).unionByName(stray)

    told = lambda df: sorted(str([r[c] for c in (*worklist.REQUEST, "page_id", "source_url", "state", "reason", "n_rows", "records")]) for r in df.collect())
    want = told(worklist._answered(asked, usual))
    assert len(want) == 6 and sum("unanswered" in x for x in want) == 2
    for n, ask in enumerate((usual, odd)):
        store = str(tmp_path / f"s{n}")
        assert told(worklist.until_complete(asked, ask, BASE, store)) == want
        assert os.listdir(store) == ["round=0"] and os.path.exists(f"{store}/round=0/_SUCCESS")


def test_rounds_do_not_shuffle_the_source_again(spark):
    from tianguis import registry

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no tables")
    offered = registry._offered(spark, d)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = wanted(spark, [str(i) for i in range(10)], D(1998, 1, 1), D(1998, 3, 31))
        pages = registry._source(offered, 4)(spark.createDataFrame(asked.collect(), asked.schema))
        # the requests alone
        assert pages._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert pages.count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_dealt_by_page_are_not_dealt_again(spark):
    from tianguis.operators import contract, pages
    from tianguis.plans import adapter

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no tables")
    rows = adapter.parsed(spark, d, by_page=True)
    for df in (contract.whole_pages(rows), pages.result_html(rows, "page_id", "row_pos", {"Fecha": "date"}, "category")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # before they are texts
        assert plan.count("Exchange hashpartitioning(l_orderkey") == plan.count("Exchange hashpartitioning") == 1
    same = lambda df: sorted(map(str, df.collect()))
    assert same(rows) == same(adapter.parsed(spark, d))
