"""Centroid clustering, filter audit and repeated spans against brute force."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tianguis.llm import audit, clusters, spans

# --- clustering -----------------------------------------------------------------------


def brute_clusters(rows, k, rounds, dims, scale, salt):
    whole = lambda x: int(x) * scale if abs(x) >= 2.0**53 else math.floor(scale * x)
    kept = [(i, [whole(x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        mine = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            if own := [v for m, (_, v) in zip(mine, kept) if m == j]:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    fit = lambda v: v if v is not None and v < 1 << 63 else None
    sums = {}
    for _, c, d in found:
        sums[c] = None if fit(d) is None or sums.get(c, 0) is None else sums.get(c, 0) + d
    total = None if None in sums.values() else sum(sums.values())
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    return [(i, c, fit(d), fit(sums[c]), fit(total), digest(c)) for i, c, d in found], centroids


def key(r):
    return tuple((x is not None, str(x)) for x in r)


@pytest.mark.parametrize("kind", ["plain", "few", "wide", "empty"])
def test_clusters_equal_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(clusters, "BLOCK_ROWS", 64)
    rng = random.Random(kind)
    v = lambda s=1.0: [rng.gauss(0, s) for _ in range(6)]
    rows = [(i, v()) for i in range(400)] + [(7, v()), (7, v())] + [(1000 + i, [0.25] * 6) for i in range(300)]
    rows += [(2001, None), (2002, []), (2003, [1.0] * 5), (2004, [1.0] * 7), (2005, [None] + [1.0] * 5), (2006, [float("nan")] * 6), (2007, [float("inf")] + [0.0] * 5), (None, v())]
    if kind == "few":
        rows = rows[:3] + rows[-8:]
    if kind == "wide":
        rows = rows[:60] + [(3000, [1e30, -1e300, 0.0, 1.5, -2.0, 3.0]), (3001, [1e7, -3e9, 0.0, 1.5, -2.0, 3.0]), (3002, [-1e7] * 6)]
    if kind == "empty":
        rows = []
    df = spark.createDataFrame([(i, x, "mine") for i, x in rows], "vec_id long, embedding array<double>, cluster string").repartition(3)
    out, centroids = clusters.cluster(df, k=9, rounds=4, dims=6, scale=256, salt="s")
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    want, best = brute_clusters(rows, 9, 4, 6, 256, "s")
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    assert centroids == best


def test_limbs_add_up():
    for v in (0, 5, -5, 1 << 39, 1 << 40, -(1 << 40), 123456789 << 90, -(987654321 << 70) + 1):
        assert sum(part << clusters.LIMB * place for place, part in clusters._limbs(v)) == v


# --- filter audit ---------------------------------------------------------------------


def brute_audit(docs, labels):
    good, bad = {i for i, q, _ in labels if i is not None and q == 1}, {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0d]+", text)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and i > least[text]}
        rows.append((source or "", {f for f in fails if fails[f]}, i in good, i in bad))
    out = []
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        orders = ["".join(o) for o in itertools.permutations("ABCDE")]
        gone = lambda o, i, fails: any(f in fails for f in o[:i])
        removed = lambda o, i: [r for r in own if o[i] in r[0] and not gone(o, i, r[0])]
        shapley = {f: sum(len(removed(o, o.index(f))) for o in orders) for f in "ABCDE"}
        for o in orders:
            for i, f in enumerate(o):
                new = removed(o, i)
                fails = [r for r in own if f in r[0]]
                out.append((part, o, i + 1, sum(not gone(o, i + 1, r[0]) for r in own), len(new), len(fails) - len(new), sum(r[0] == {f} for r in own), sum(r[1] for r in new), sum(r[2] for r in new), shapley[f]))
    return out


def odd_documents(rng, n):
    texts = [None, "", " \t\n", "One", "a " * 60, " ".join(f"w{i}" for i in range(60)), "É" * 30 + "AB", "é " * 70, "x|y", "X" * 9, " ".join(f"w{i % 30}" for i in range(80)), "😀 " * 3 + "A", "w " + "# " * 70]
    return [(rng.choice([None, 5, rng.randrange(300)]), rng.choice(texts), rng.choice([None, "", "hot", "hot", "hot", "b", "c"])) for _ in range(n)]


def test_audit_equals_brute_force(spark, monkeypatch):
    docs = odd_documents(random.Random(2), 500)
    labels = [(i, i % 2, i % 3 - 1 or None) for i in range(0, 300, 2)] + [(4, None, 1), (None, 1, 1), (5, 1, None)]
    frame = spark.createDataFrame([(*d, True) for d in docs], "doc_id long, text string, source string, A boolean").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    monkeypatch.setattr(audit, "SALTS", 4)
    out = audit.audit_documents(frame, known)
    assert out.columns == columns
    assert sorted(map(tuple, out.collect())) == sorted(brute_audit(docs, labels))
    assert audit.audit_documents(frame.limit(0), known.limit(0)).count() == 0


def test_audit_when_batches_cut_parts(spark):
    docs = [(i, f"text {i % 40}", f"s{i % 3}") for i in range(3000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        out = audit.audit_documents(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame([(3, 1, 1)], "doc_id long, quality int, toxic int"))
        assert sorted(map(tuple, out.collect())) == sorted(brute_audit(docs, [(3, 1, 1)]))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_merges_equal_sets():
    rng = np.random.default_rng(3)
    for _ in range(300):
        lists = [np.unique(rng.integers(0, 50, rng.integers(0, 40))) for _ in range(3)]
        a, b, c = map(set, lists)
        assert audit._union(lists).tolist() == sorted(a | b | c)
        assert audit._both(lists[0], lists[1]).tolist() == sorted(a & b)
        assert audit._without(lists[0], lists[1]).tolist() == sorted(a - b)


# --- repeated spans -------------------------------------------------------------------


def brute_spans(texts, n):
    split = [re.findall(r"[^\x20\x09-\x0d]+", t or "") for t in texts]
    seen = {}
    for d, words in enumerate(split):
        for i in range(len(words) - n + 1):
            seen.setdefault(tuple(words[i : i + n]), []).append((d, i))
    gone = {(d, i + j) for at in seen.values() if len(at) > 1 for d, i in at for j in range(n)}
    return [(len(w), sum((d, i) in gone for i in range(len(w))), " ".join(x for i, x in enumerate(w) if (d, i) not in gone)) for d, w in enumerate(split)]


def odd_texts(rng):
    word = lambda: f"w{rng.randrange(4000)}é"
    passage = lambda m: [word() for _ in range(m)]
    shared = [passage(m) for m in (11, 12, 13, 25, 60, 400)]
    texts = [None, "", " \t\v\r\n\f", "one", "a " * 200, "b " * 12, "b " * 11, " ".join(["p", "q", "r"] * 50), "no break " * 3]
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = list(rng.choice(shared))
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "changed"
            if rng.random() < 0.3:
                p = p[rng.randrange(len(p)) :]
            parts += passage(rng.randrange(0, 30)) + p
        texts.append(rng.choice([" ", "\n", " \t "]).join(parts))
    texts += [texts[20]] * 5 + ["\n" + texts[21] + "  "]
    # few words: branches everywhere
    texts += [" ".join(rng.choice("xyz") for _ in range(rng.randrange(40))) for _ in range(80)]
    texts += [" ".join(rng.choice("xy") for _ in range(400))]
    return texts


@pytest.mark.parametrize("n,k", [(12, 4), (12, 8), (3, 8), (1, 8), (35, 8)])
def test_spans_equal_brute_force(spark, n, k):
    texts = odd_texts(random.Random(n + k))
    rows = [(i if i % 9 else None, t, "mine") for i, t in enumerate(texts)] + [(1, texts[1], "mine"), (30, texts[30], "mine"), (31, texts[32], "mine")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string").repartition(4)
    out = spans.drop_repeated_spans(df, words=n, k=k)
    assert out.columns == ["doc_id", "text", "n_words", "_n_words", "n_removed"]
    want = [(r[0], *x, r[2]) for r, x in zip(rows, brute_spans([r[1] for r in rows], n))]
    assert sorted([(r.doc_id, r["_n_words"], r.n_removed, r.text, r.n_words) for r in out.collect()], key=key) == sorted(want, key=key)
    assert spans.drop_repeated_spans(df.limit(0), words=n).count() == 0


def test_long_paths_are_compacted(spark):
    """A passage of 3 000 words in many texts gives one path, and claims at its ends only."""
    rng = random.Random(4)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(3000)]
    texts = [[f"t{d}-{i}" for i in range(50)] + passage + [f"u{d}-{i}" for i in range(50)] for d in range(20)]
    keyed = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "key long, text string")
    found = spans.repeated_spans(keyed).collect()
    longest = {(r.key, r.start, r.length) for r in found if r.length > 35}
    assert len(longest) == 20 and min(x[2] for x in longest) > 2900
    assert len(found) < 20 * 80
    covered = {d: set() for d in range(20)}
    for r in found:
        covered[r.key] |= set(range(r.start, r.start + r.length))
    assert all(covered[d] == set(range(50, 3050)) for d in covered)


def test_a_very_long_text(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[1000:1050])), (3, "a " * 300_000)]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in spans.drop_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_words", "n_removed").collect()}
    assert got == {1: (400_000, 50), 2: (50, 50), 3: (300_000, 300_000)}


def test_rolling_hashes_tell_runs_apart():
    import pyarrow as pa

    words = pa.array(["a", "b", "a", "b", "b", "a", "a", "b", "a"])
    h = spans._Rolling(words, 0)
    at = np.arange(8)
    assert len(set(h.runs(at, at + 2).tolist())) == len({(words[i].as_py(), words[i + 1].as_py()) for i in range(8)})


def test_queries_read_whole_tables(spark):
    from tianguis.llm import queries

    d = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{d}/documents.parquet").count()
    assert queries.op13_substring_dedup(spark, d).count() == n
    assert queries.op12_filter_audit(spark, d).groupBy("filter_order", "step").agg(F.sum("kept") + F.sum("removed")).count() == 600
