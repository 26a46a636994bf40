"""Interaction of filters: what each removes, in every order they could be applied.

* Every document gets its filters' verdicts by Spark expressions; verdicts across documents
  (equal texts) come from a join that splits hot texts.
* Documents are sorted by part and id over all tasks.  Within a batch, a contiguous range of
  ids of each part, every filter has a posting list: the sorted places of the documents that
  fail it.  What an order's first filters remove together is a union of such lists, what the
  next one adds a difference; both gallop: the elements of the shorter list are found in the
  longer one by searches that start where the one before ended.
* Only sizes leave a batch: 80 rows (filter, set of filters before it) for each part, which
  Spark adds up.  Orders are expanded afterwards, from sums.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package, text_or_empty, written

#: Salts of a hot text's documents.
SALTS = 256


def text_filters(text: Column) -> dict[str, Column]:
    """Conditions under which a text fails: A short, B repetitive, C many capitals, D symbols."""
    words = F.split(text, r"[\x20\x09-\x0D]+")
    blank = F.array_contains(words, "").cast("int")
    n = F.size(F.array_remove(words, ""))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n < 50,
        "B": 100 * (F.size(F.array_distinct(words)) - blank) < 65 * n,
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def repeats_smaller(rows: DataFrame, digest: str, id_col: str) -> DataFrame:
    """``rows`` with ``repeats``: whether a smaller id has the same digest.  Null ids neither fail nor count.

    Texts met once never reach the join's other side; those met often are dealt out by salts.
    """
    salt = F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int")
    salted = rows.withColumn("__salt", salt)
    some = salted.where(F.col(id_col).isNotNull()).groupBy(digest, "__salt").agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi"))
    same = some.groupBy(digest).agg(F.min("lo").alias("__least"), F.max("hi").alias("hi"), F.collect_list("__salt").alias("salts")).where("__least < hi")
    dealt = same.select(digest, F.explode("salts").alias("__salt"), "__least")
    joined = salted.join(dealt, [digest, "__salt"], "left")
    return joined.withColumn("repeats", F.coalesce(F.col(id_col) > F.col("__least"), F.lit(False))).drop("__salt", "__least")


def _union(lists: list[np.ndarray]) -> np.ndarray:
    """Sorted union of sorted lists without repeats; shorter ones gallop through what longer ones gave."""
    lists = sorted(lists, key=len, reverse=True)
    out = lists[0]
    for more in lists[1:]:
        at = np.searchsorted(out, more)
        known = (at < len(out)) & (out[np.minimum(at, len(out) - 1)] == more) if len(out) else np.zeros(len(more), bool)
        out = np.insert(out, at[~known], more[~known])
    return out


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sorted intersection: the shorter list gallops through the longer one."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return a
    at = np.searchsorted(b, a)
    return a[(at < len(b)) & (b[np.minimum(at, len(b) - 1)] == a)]


def _without(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sorted difference a - b; ``b``'s shorter than ``a`` are looked up and cut out, else ``a``'s are looked up in ``b``."""
    if not len(a) or not len(b):
        return a
    if len(b) < len(a):
        at = np.searchsorted(a, b)
        hit = at[(at < len(a)) & (a[np.minimum(at, len(a) - 1)] == b)]
        return np.delete(a, hit)
    at = np.searchsorted(b, a)
    return a[~((at < len(b)) & (b[np.minimum(at, len(b) - 1)] == a))]


_SIZES = "part string, filter int, before int, docs long, removed long, redundant long, good long, toxic long"


def _sizes(batches: Iterator[pa.RecordBatch], n_filters: int) -> Iterator[pa.RecordBatch]:
    """Sizes of differences and intersections of a batch's posting lists, by part.  Rows come sorted by part."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        names = column["part"].dictionary_encode()
        runs = names.indices.to_numpy()
        edges = np.flatnonzero(np.diff(runs, prepend=-1, append=-1))  # id ranges of the parts
        parts = names.dictionary.take(pa.array(runs[edges[:-1]]))
        places = lambda c: np.flatnonzero(column[c].to_numpy(zero_copy_only=False))
        count = lambda found: np.diff(np.searchsorted(found, edges))
        lists = [places(f"f{i}") for i in range(n_filters)]
        good, toxic = places("good"), places("toxic")
        docs = np.diff(edges)
        for before in range(1 << n_filters):
            gone = _union([lists[i] for i in range(n_filters) if before >> i & 1] or [np.empty(0, np.int64)])
            for f in range(n_filters):
                if before >> f & 1:
                    continue
                new = _without(lists[f], gone)
                numbers = (docs, count(new), count(_both(lists[f], gone)), count(_both(new, good)), count(_both(new, toxic)))
                fixed = [np.full(len(docs), f, np.int32), np.full(len(docs), before, np.int32)]
                yield pa.RecordBatch.from_arrays([parts, *map(pa.array, fixed), *[pa.array(x.astype(np.int64)) for x in numbers]], names=["part", "filter", "before", "docs", "removed", "redundant", "good", "toxic"])


def audit(judged: DataFrame, filters: list[str], part: str, id_col: str, good: str, toxic: str) -> DataFrame:
    """One row for every part, order of the filters, and step.

    ``judged`` has a row for each document: boolean columns ``filters`` (true: fails), ``good``
    and ``toxic``; nulls count as false, a null part as the empty string.  Columns: part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.
    Every row of ``judged`` is a document, also where ids are null or repeated.
    """
    n = len(filters)
    ship_package(judged.sparkSession)
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    narrow = judged.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(id_col).alias("id"), *[flag(c).alias(f"f{i}") for i, c in enumerate(filters)], flag(good).alias("good"), flag(toxic).alias("toxic"))
    ranges = narrow.repartitionByRange("part", "id").sortWithinPartitions("part", "id").drop("id")

    def sizes(batches):
        return _sizes(batches, n)

    total = ranges.mapInArrow(sizes, _SIZES).groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in ("docs", "removed", "redundant", "good", "toxic")])
    total = written(total, "sizes")
    # of an order's n! arrangements, those with exactly this set before the filter
    weight = F.when(F.lit(False), 0)
    for size in range(n):
        weight = F.when(F.bit_count("before") == size, math.factorial(size) * math.factorial(n - 1 - size)).otherwise(weight)
    alone = F.when(F.bit_count("before") == n - 1, F.col("removed"))
    whole = total.groupBy("part", "filter").agg(F.max(alone).alias("unique_fails"), F.sum(F.col("removed") * weight).alias("shapley"))
    spark = judged.sparkSession
    steps = []
    for order in itertools.permutations(range(n)):
        for i, f in enumerate(order):
            steps.append(("".join(filters[x] for x in order), i + 1, f, reduce(lambda m, x: m | 1 << x, order[:i], 0)))
    orders = spark.createDataFrame(steps, "filter_order string, step int, filter int, before int")  # n! n rows, whatever the documents
    # kept after a step: all documents but the union of the filters up to it; removed ones of each step add up to that
    every = total.join(F.broadcast(orders), ["filter", "before"]).join(whole, ["part", "filter"])
    gone = F.sum("removed").over(_up_to())
    return every.select(
        "part", "filter_order", "step", (F.col("docs") - gone).alias("kept"), "removed", "redundant", "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
    )


def _up_to():
    from pyspark.sql import Window

    return Window.partitionBy("part", "filter_order").orderBy("step")


def audit_documents(docs: DataFrame, labels: DataFrame, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``audit`` of the five filters: short, repetitive, capitals, symbols, repeats of a smaller id's text.

    Null texts are empty.  Labels given twice for an id count if any of them says so; null ids have
    no label.  An empty table gives no rows.  Other columns are not looked at.
    """
    text = text_or_empty(text_col)
    judged = docs.select(F.col(part).alias("part"), F.col(id_col).alias("id"), *[v.alias(k) for k, v in text_filters(text).items()], F.unhex(F.sha2(text, 256)).alias("digest"))
    judged = written(judged, "judged")  # texts are read once
    judged = repeats_smaller(judged, "digest", "id").withColumnRenamed("repeats", "E").drop("digest")
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    judged = judged.join(known, F.col("id") == F.col("__id"), "left").drop("__id")
    return audit(judged, list("ABCDE"), "part", "id", "good", "bad")
