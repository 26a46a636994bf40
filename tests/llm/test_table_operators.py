"""Url filters, vectors, chats and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tianguis.llm import chat, ivfpq, urls
from tianguis.llm.components import connected_components


def test_components_equal_brute_force(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(1, 80)] + [(5, 5), (None, 3), (3, None)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hub_of_many_aliases_is_split_over_tasks(spark):
    """One page that 100 000 aliases name: adaptive execution splits its links, as both sides of the join are shuffles."""
    from tianguis.llm import components

    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {n: spark.conf.get(n, None) for n in names}
    hub = spark.range(1, 100_001).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        # links from the hub to each alias, as the large step turns them
        star = components._large_star(hub.select(F.col("a").alias("u"), F.col("b").alias("v")), split_hubs=True)
        star.collect()
        assert "skew=true" in star._jdf.queryExecution().executedPlan().toString()
        found = connected_components(hub, split_hubs=True)
        assert (found.count(), found.where("component <> 0").count()) == (100_000, 0)
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


# --- urls -----------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, verdict string"
RULES = [("org", "/", "allow"), ("bad.org", "/", "block"), ("shop.net", "/buy", "block"), ("shop.net", "/buyer", "allow"), ("fine.com", "/", "allow")]


def judged(spark, *rows, redirects=None):
    pages = spark.createDataFrame([(*r, "mine", "mine") for r in rows], PAGES)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = urls.judge(pages, rules, redirects=redirects)
    assert out.columns == ["page_id", "url", "host", "verdict", "_host", "path", "rule", "_verdict"]
    return {r.page_id: (r["_host"], r.path, r.rule, r["_verdict"]) for r in out.collect()}


def test_rules_and_aliases(spark):
    got = judged(
        spark,
        (1, "http://A.Bad.org/x", None),
        (2, "https://nobad.org/x?y", ""),
        (3, "http://shop.net/buy?x", None),
        (4, "http://shop.net/buyers#z", None),
        (5, "http://shop.net", None),
        (6, None, None),
        (7, "no scheme", "x"),
        (8, "http://mirror.net/a", '<link rel="canonical" href="https://a.bad.org/x">'),
        (9, "http://mirror.net/b", "<meta http-equiv=refresh content='0;url=/a'>"),
        (10, "http://fine.com/c", '<LINK href="http://mirror.net/b" REL=canonical>'),
        (11, "http://mirror.net/d", '<link rel=canonical href="http://fine.com/c">'),
        (12, "http://other.net/e", '<link rel="stylesheet" href="http://a.bad.org/x">'),
        (13, "http://p@x.net:80?q", None),
    )
    assert got[1] == ("a.bad.org", "/x", "bad.org/", "block") and got[2][2:] == ("org/", "allow")
    assert got[3][1:] == ("/buy", "shop.net/buy", "block") and got[4][2:] == ("shop.net/buyer", "allow") and got[5] == ("shop.net", "", None, "allow")
    assert got[6] == got[7] == ("", "", None, "allow")
    assert got[8][2:] == got[9][2:] == got[11][2:] == (None, "block")  # over an allowed page, too
    assert got[10][2:] == ("fine.com/", "allow") and got[12][2:] == (None, "allow") and got[13][:2] == ("p@x.net:80", "")


def test_redirect_tables_repeated_rows_and_none(spark):
    extra = spark.createDataFrame([("http://q.net/1", "http://bad.org/2"), (None, "http://bad.org/2"), ("x", None)], "s string, t string")
    got = judged(spark, (1, "http://q.net/1", None), (1, "http://q.net/1", None), (2, "http://bad.org/2", None), redirects=extra)
    assert got == {1: ("q.net", "/1", None, "block"), 2: ("bad.org", "/2", "bad.org/", "block")}
    assert judged(spark) == {}


# --- vectors --------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, n_links string, key string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "mine", "k") for i, v, y in rows], VECTORS)


def sample_rows(seed, n=500, dim=16):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).astype(np.float32), int(rng.integers(0, 3))) for i in range(n)]
    for i in range(0, n, 5):
        rows.append((len(rows), (rows[i][1] + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.2])).astype(np.float32), rows[i][2]))
    hot = rng.normal(size=dim)
    rows += [(len(rows) + k, (hot + 0.01 * rng.normal(size=dim) * (k % 2)).astype(np.float32), 1) for k in range(120)]
    return rows


ODD = [(9001, None, 1), (9002, [0.0] * 16, 1), (9003, [None] + [1.0] * 15, 1), (9004, [float("nan")] * 16, 1), (9005, [float("inf")] + [1.0] * 15, 1), (9006, [1.0] * 3, 1), (9007, [1.0] * 16, None), (9008, [1.0] * 16, None), (9009, [2.0] * 16, 2), (9010, [4.0] * 16, 2)]


@pytest.mark.parametrize("shard", [8192, 60])
def test_vector_links_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(ivfpq, "SHARD_ROWS", shard)
    rows = sample_rows(2)
    got = {r.vec_id: r for r in ivfpq.near_duplicate_vectors(vectors(spark, rows + ODD)).collect()}
    x, y = np.stack([r[1] for r in rows]).astype(float), np.array([r[2] for r in rows])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (u @ u.T >= 0.93) & (y[:, None] == y[None])
    np.fill_diagonal(link, False)
    root = np.arange(len(rows))
    while True:
        low = np.where(link, root[None], len(rows)).min(axis=1)
        new = np.minimum(root, low)
        if (new == root).all():
            break
        root = new
    # the probes may lose a link that only just counts
    wrong = [i for i in range(len(rows)) if got[i].n_links != link[i].sum() or got[i].component_id != root[i]]
    assert len(wrong) <= len(rows) // 100
    for i in range(9001, 9009):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[9009].n_links, got[9010].component_id, got[9010].kept) == (1, 9009, False)


def test_no_slack_loses_nothing():
    rng = np.random.default_rng(3)
    x = ivfpq.unit(rng.normal(size=(2000, 12)))
    index = ivfpq.fit(x[:1000], 2000)
    lists, codes, err = index.encode(x)
    probed = ivfpq.near_probes(0.9, 1.0)(index, x, lists)
    assert probed[np.repeat(np.arange(2000), 2000)[(pairs := (x @ x.T >= 0.9)).ravel()], np.tile(lists, 2000)[pairs.ravel()]].all()
    estimates = index.estimates(x[:50], lists, codes)
    assert (np.abs(estimates - x[:50] @ x.T) <= err[None] + 1e-4).all()


@pytest.mark.parametrize("shard", [8192, 100])
def test_search_recall_and_order(spark, monkeypatch, shard):
    monkeypatch.setattr(ivfpq, "SHARD_ROWS", shard)
    rows = sample_rows(4, 1500)
    got = ivfpq.nearest(vectors(spark, rows + ODD), F.col("vec_id") % 20 == 0, 20).toPandas()
    x, ids = np.stack([r[1] for r in rows] + [[1.0] * 16, [1.0] * 16, [2.0] * 16, [4.0] * 16]).astype(float), np.array([r[0] for r in rows] + [9007, 9008, 9009, 9010])
    hits = 0
    queries = [i for i, k in enumerate(ids) if k % 20 == 0]
    assert set(got["query_id"]) == {int(ids[i]) for i in queries}
    for i in queries:
        mine = got[got["query_id"] == ids[i]].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21)) and ids[i] not in set(mine["vec_id"])
        score = (x * x[i]).sum(axis=1)
        at = {k: s for k, s in zip(ids.tolist(), score)}
        assert np.allclose(mine["score"], [at[k] for k in mine["vec_id"]], rtol=1e-12)
        keys = list(zip(-mine["score"], mine["vec_id"]))
        assert keys == sorted(keys)
        score[i] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -score))[:20]]) & set(mine["vec_id"]))
    assert hits >= 0.9 * 20 * len(queries)


def test_few_or_no_vectors(spark):
    few = vectors(spark, [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [1.0, 0.0], None), (2, [1.0, 0.0], None), (None, [1.0, 1.0], 1)])
    got = [(r.query_id, r.rank, r.vec_id) for r in ivfpq.nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2), (0, 2, 2), (0, 3, 1)]
    assert ivfpq.nearest(few.limit(0), F.lit(True)).count() == 0
    assert ivfpq.near_duplicate_vectors(few.limit(0)).count() == 0
    assert ivfpq.near_duplicate_vectors(few.where("label is null")).select("kept").distinct().count() == 1


@pytest.mark.parametrize("widths", [1, 4])
def test_links_of_mixed_widths_equal_brute_force(spark, monkeypatch, widths):
    """Each width by itself: with an index of its own or, beyond MOST_WIDTHS, compared whole."""
    monkeypatch.setattr(ivfpq, "MOST_WIDTHS", widths)
    rng, rows = np.random.default_rng(8), [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)]
    for dim, n in ((3, 90), (5, 40), (16, 60), (1, 5)):
        base = rng.normal(size=(n, dim))
        rows += [(len(rows) + i, v, int(i % 2)) for i, v in enumerate(np.concatenate([base, base + 0.05 * rng.normal(size=base.shape)]).astype(np.float32).tolist())]
    got = {r.vec_id: r for r in ivfpq.near_duplicate_vectors(vectors(spark, rows)).collect()}
    unit = [np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    links = {i: {j for j in range(len(rows)) if j != i and len(unit[i]) == len(unit[j]) and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.93} for i in range(len(rows))}
    assert (got[0].n_links, got[1].component_id) == (1, 0)
    wrong = [i for i in links if got[i].n_links != len(links[i])]
    assert len(wrong) <= len(rows) // 100


@pytest.mark.parametrize("n", [2, 20, 21, 60, 100, 200])
def test_every_query_gets_all_it_can(spark, n):
    """As many rows as there are candidates, 20 at most, also where norms are skewed and every row is a query."""
    rng = np.random.default_rng(n)
    x = (rng.normal(size=(n, 8)) * rng.pareto(0.7, size=(n, 1))).astype(np.float32)
    rows = [(i // 2 if i < n // 4 else i, v.tolist(), 1) for i, v in enumerate(x)] + [(5000 + i, [1.0, float(i + 1)], 1) for i in range(7)]
    got = ivfpq.nearest(vectors(spark, rows), F.lit(True), 20).toPandas()
    ids = [r[0] for r in rows]
    want = sum(min(20, sum(a != b and len(v) == len(w) for b, w, _ in rows)) for a, v, _ in rows)
    assert len(got) == want and set(got["query_id"]) <= set(ids) and (got["query_id"] != got["vec_id"]).all()
    narrow = got[got["query_id"] >= 5000]
    assert (narrow.groupby("query_id").size() == 6).all()
    assert narrow.sort_values("rank").groupby("query_id")["vec_id"].apply(list).map(lambda k: k == sorted(k, reverse=True)).all()


def test_two_level_centroids_still_find(monkeypatch):
    monkeypatch.setattr(ivfpq, "LISTS_AT_ONCE", 8)
    rng = np.random.default_rng(9)
    x = ivfpq.unit(rng.normal(size=(3000, 12)))
    index = ivfpq.fit(x, 3000)
    assert 30 <= index.lists <= 70
    lists, _, _ = index.encode(x)
    probed = ivfpq.near_probes(0.9, 1.0)(index, x, lists)
    a, b = np.nonzero(x @ x.T >= 0.9)
    assert probed[a, lists[b]].all()


# --- chats ----------------------------------------------------------------------------

NASTY = ["[INST] [/INST]", "</s>", "<<SYS>> x <</SYS>>", "[\\INST]", "[\\\\/INST] \\", " ", "", "<s", "$1 \\2", "[ROLE] a [TEXT] b [/ROLE]", "😀 é\n\n", "[[INST]", "<<s>", "x" * 20_000]


def test_chat_round_trip(spark):
    roles = ["user", "assistant", "system", "tool [TEXT] </s>", None]
    rng = random.Random(5)
    rows, want = [], {}
    for conv in [*range(40), None]:
        turns = [(t, rng.choice(roles), rng.choice([*NASTY, None])) for t in range(rng.randint(1, 12))]
        rows += [(conv, t, r, x, "mine") for t, r, x in turns]
        want[conv] = [(r or "", x or "") for _, r, x in turns]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat.format_conversations(df)
    back = {r.conv_id: [(t.role, t.text) for t in r.p] for r in formatted.select("conv_id", chat.parse(F.col("formatted")).alias("p")).collect()}
    assert back == want
    each = chat.examples(formatted).join(formatted.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
    each = each.select("conv_id", "example", "context_turns", "context_chars", "target", "loss_start", "loss_end", chat.example_text(F.col("formatted"), F.col("context_chars"), F.col("target")).alias("whole"), chat.trainable(F.col("target"), F.col("context_chars"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    seen = {}
    for r in each.collect():
        assert r.whole[r.context_chars :] == r.target and r.whole[r.loss_start : r.loss_end] == r.target[4:-5]
        turns = want[r.conv_id]
        assert turns[r.context_turns] == ("assistant", r.loss) and sum(x == "assistant" for x, _ in turns[: r.context_turns]) == r.example
        seen[r.conv_id] = seen.get(r.conv_id, 0) + 1
    assert seen == {k: n for k, v in want.items() if (n := sum(r == "assistant" for r, _ in v))}
    assert chat.examples(chat.format_conversations(df.limit(0))).count() == 0


def test_a_very_long_conversation(spark):
    """Work follows the number of turns: places are running sums, not growing lists."""
    n = 4000
    turns = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.format_string("t%05d", "id").alias("text"))
    got = chat.examples(chat.format_conversations(turns)).orderBy("example").collect()
    assert len(got) == n // 2 and got[-1].context_turns == n - 1 and [r.example for r in got] == list(range(n // 2))
    step = got[1].context_chars - got[0].context_chars
    assert all(b.context_chars - a.context_chars == step for a, b in zip(got, got[1:]))


def test_control_strings_never_survive_in_texts(spark):
    df = spark.createDataFrame([(x,) for x in NASTY], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not any(m in r.e for m in ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[/ROLE]"))


def test_examples_are_expanded_to_their_whole_text(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b </s>"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (None, 0, "assistant", "e")]
    formatted = chat.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    each = chat.expanded(formatted).withColumn("loss", chat.masked(F.col("text"), F.col("loss_start"), F.col("loss_end")))
    first = "[INST] a [/INST]<s> b <\\/s> </s>"
    assert {(r.conv_id, r.example): (r.text, r.loss) for r in each.collect()} == {(1, 0): (first, "b </s>"), (1, 1): (first + "[INST] c [/INST]<s> d </s>", "d"), (None, 0): ("<s> e </s>", "e")}
