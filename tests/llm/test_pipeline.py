"""The pipeline over a small corpus against a brute-force version of each stage."""

import random
import re

import numpy as np
import public_tokenizers

import corpus_pipeline
from tianguis.llm import simhash



def prose(rng, n):
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus(spark, folder):
    rng, rows, labels = random.Random(21), [], []

    def add(text, good):
        rows.append((len(rows), text, "en", "s", len(text)))
        labels.append((len(rows) - 1, int(good), 0))

    for i in range(150):
        words = prose(rng, rng.choice([60, 150])).split()
        if i % 10 == 0:
            words.insert(5, "password=" + "".join(rng.choice("abcdefXYZ0123456789") for _ in range(12)))
        add(" ".join(words), True)
        if i % 3 == 0:  # an exact copy and a near one
            add(" ".join(words), True)
            words[-1] = "changed"
            add(" ".join(words), True)
        if i % 4 == 0:
            add(" ".join(w.upper() + "!!" for w in prose(rng, 60).split()), False)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows, dict((a, b) for a, b, _ in labels)


def test_run_equals_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    folder = f"file://{tmp_path}"
    rows, good = corpus(spark, folder)
    texts = {r[0]: r[1] for r in rows if good[r[0]]}
    sets = {k: set(simhash.shingle_hashes(t, 5).tolist()) for k, t in texts.items()}
    group = {k: k for k in texts}
    for a in texts:
        for b in texts:
            if b < a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if g == old else g for k, g in group.items()}
    kept = {k: re.sub(r"password=[A-Za-z0-9]+", "[SECRET]", texts[k]) for k in set(group.values())}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.run(spark, folder).toPandas().sort_values(["doc_id", "start"])
    assert set(pieces["doc_id"]) == set(kept)
    for k, p in pieces.groupby("doc_id"):
        ids = np.frombuffer(b"".join(p["ids"]), "<u4").tolist()
        assert ids == tok.encode(kept[k], add_special_tokens=False).ids + [0]


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    folder = f"file://{tmp_path}"
    corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "packing"]


def test_stages_take_odd_rows_and_clashing_columns(spark, tmp_path):
    """Nulls, empty and very long texts, repeated ids and rows, and columns named like the operators' own, through all four stages."""
    folder = f"file://{tmp_path}"
    rows, _ = corpus(spark, folder)
    rng = random.Random(22)
    long = prose(rng, 40_000)
    odd = [(None, None, None, None, None), (0, rows[0][1], "en", "s", 5), (0, rows[0][1], "en", "s", 5), (7001, "", "en", None, 0), (7001, None, "en", "s", 0), (7002, long, "en", "s", len(long)), (None, prose(rng, 90), "en", "s", 9), (7003, f"{long[:-9]} token=abcdefgh12345", "xx", "s", 1)]
    table = spark.createDataFrame([(*r, "own", 0.5, "mine", 3) for r in [*rows, *odd]], "doc_id long, text string, lang string, source string, n_chars long, base string, score double, random string, __rid long")
    docs, kept = table, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        docs = docs.sparkSession.createDataFrame(docs.collect(), table.schema)
        assert docs.columns == table.columns
        kept[name] = docs.collect()
        assert {(r.base, r.score, r.random, r["__rid"]) for r in kept[name]} == {("own", 0.5, "mine", 3)}
    # one of the two long texts, which share nearly all shingles; no copy of document 0; no two rows without words
    assert len([r for r in kept["near_duplicates"] if r.text and len(r.text) > 100_000]) == 1
    assert len([r for r in kept["near_duplicates"] if r.doc_id == 0]) == 1
    assert len([r for r in kept["near_duplicates"] if not r.text]) <= 1
    assert not any("token=abcdefgh" in (r.text or "") for r in kept["secrets"])
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept["secrets"])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).toPandas()
    assert pieces["length"].sum() == pieces[pieces["start"] == 0]["doc_tokens"].sum()
    assert len(pieces[pieces["start"] == 0]) == len(kept["secrets"])
