"""Centroid clustering of integer vectors by scalar look-up tables.

Components are integers (a scaled component, floored), so a squared difference depends on
three things only: the dimension, the integer that occurs there, and the centroid.  Each
round tabulates it for the integers that occur in a block of vectors, and a distance is a
sum of gathered table entries.  Means, distances and inertia are exact integers.

* Vectors are coded once into blocks (a value list for every dimension, and a 16-bit place
  in it for every component), a table in the shared folder that all rounds read.
* A round returns a centroid's sums and counts from each task; Spark adds them up.  The
  driver holds centroids and their sums alone: ``k`` times the dimensions, whatever the rows.
* Integers beyond 2**27 go through tables of Python integers: slower, equally exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package, written

#: Vectors of a block at most: places in a block's value lists fit 16 bits, a table fits a core's cache.
BLOCK_ROWS = 4096
#: Up to this size a sum of 64 squared differences fits a signed 64-bit integer.
PLAIN = 1 << 27
#: Bits of a limb of a task's sums: limbs of millions of tasks add up within 64 bits.
LIMB = 40


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, as 64-bit integers if all are plain, else as Python's."""
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * values)
    if not scaled.size or np.abs(scaled).max() <= PLAIN:
        return scaled.astype(np.int64)
    # from 2**53 on a double is a whole number
    whole = [int(x) * scale if abs(x) >= 2.0**53 else math.floor(scale * x) for x in values.ravel().tolist()]
    return np.array(whole, dtype=object).reshape(values.shape)


def _pack(ids: pa.Array, values: np.ndarray) -> dict:
    """A block's row: ids, value lists of all dimensions one after another, their lengths, and places in them."""
    lists, codes = [], np.empty(values.shape, np.uint16)
    for d in range(values.shape[1]):
        own, codes[:, d] = np.unique(values[:, d], return_inverse=True)
        lists.append(own)
    flat, wide = np.concatenate(lists), values.dtype == object
    return {
        "ids": ids,
        "sizes": np.array([len(x) for x in lists], "<i4").tobytes(),
        "plain": None if wide else flat.astype("<i8").tobytes(),
        "wide": [str(x) for x in flat] if wide else None,
        "codes": codes.astype("<u2").tobytes(),
    }


def _unpack(row: dict) -> tuple[list[np.ndarray], np.ndarray]:
    sizes = np.frombuffer(row["sizes"], "<i4")
    flat = np.array([int(x) for x in row["wide"]], dtype=object) if row["plain"] is None else np.frombuffer(row["plain"], "<i8")
    return np.split(flat, np.cumsum(sizes)[:-1]), np.frombuffer(row["codes"], "<u2").reshape(-1, len(sizes))


def _nearest(lists: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (of equal ones the first) and squared distance of each vector of a block."""
    far = np.zeros((len(codes), len(centroids)), dtype=np.result_type(lists[0], centroids))
    for d, own in enumerate(lists):
        table = (own[:, None] - centroids[None, :, d]) ** 2
        far += table[codes[:, d]]
    best = np.array(far.argmin(axis=1), np.int64)
    return best, far[np.arange(len(best)), best]


def _limbs(v: int) -> Iterator[tuple[int, int]]:
    """(place, part) with v = sum(part << LIMB * place)."""
    place = 0
    while abs(v) >= 1 << LIMB:
        yield place, v & ((1 << LIMB) - 1)
        v, place = v >> LIMB, place + 1
    yield place, v


def blocks(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """Coded blocks of the vectors with exactly ``dims`` components, none null or non-finite."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = vectors.where(x.isNotNull() & (F.size(x) == dims) & F.coalesce(finite, F.lit(False))).select(F.col(id_col).alias("id"), x.alias("x"))
    id_type = kept.schema["id"].dataType

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)
                row = _pack(part.column(0), _integers(values, scale))
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), row["ids"])
                rest = [pa.array([row[c]], t) for c, t in (("sizes", pa.binary()), ("plain", pa.binary()), ("wide", pa.list_(pa.string())), ("codes", pa.binary()))]
                yield pa.RecordBatch.from_arrays([ids, *rest], names=["ids", "sizes", "plain", "wide", "codes"])

    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type)), *T._parse_datatype_string("sizes binary, plain binary, wide array<string>, codes binary").fields])
    return kept.mapInArrow(code, schema)


def _first(vectors: DataFrame, k: int, dims: int, scale: int, salt: str, id_col: str, vector_col: str) -> np.ndarray:
    """The ``k`` vectors of least hash, in its order (equal ids by their components; null ids last)."""
    x = F.col(vector_col).cast("array<double>")
    hashed = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(id_col).cast("string")), 256)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    chosen = vectors.where(x.isNotNull() & (F.size(x) == dims) & F.coalesce(finite, F.lit(False))).select(hashed.alias("h"), x.alias("x")).orderBy(F.asc_nulls_last("h"), "x").limit(k)
    return _integers(np.array([r["x"] for r in chosen.collect()], dtype=float).reshape(-1, dims), scale)


def _tight(centroids: list[list[int]], dims: int) -> np.ndarray:
    plain = all(abs(x) <= PLAIN for c in centroids for x in c)
    return np.array(centroids, dtype=np.int64 if plain else object).reshape(-1, dims)


def _round(coded: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means, empty ones as they were."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), dtype=object), np.zeros(k, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                lists, codes = _unpack(row)
                best, _ = _nearest(lists, codes, centroids)
                mine = best[None, :] == np.arange(k)[:, None]
                count += mine.sum(axis=1)
                for d, own in enumerate(lists):
                    # how often each occurring integer meets each centroid, times the integer
                    met = np.bincount(best * len(own) + codes[:, d], minlength=k * len(own)).reshape(k, len(own))
                    total[:, d] += (met.astype(object) if own.dtype == object else met) @ own
        rows = [(c, -1, 0, int(count[c])) for c in range(k) if count[c]]
        rows += [(c, d, place, part) for c in range(k) if count[c] for d in range(dims) for place, part in _limbs(int(total[c, d]))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["c", "d", "place", "part"])

    parts = coded.select("sizes", "plain", "wide", "codes").mapInArrow(sums, "c int, d int, place int, part long")
    found = {(r["c"], r["d"], r["place"]): r["part"] for r in parts.groupBy("c", "d", "place").agg(F.sum("part").alias("part")).collect()}
    after = [list(map(int, c)) for c in centroids]
    whole: dict[tuple[int, int], int] = {}
    for (c, d, place), part in found.items():
        whole[c, d] = whole.get((c, d), 0) + (part << LIMB * place)
    for (c, d), total in whole.items():
        if d >= 0:
            after[c][d] = total // whole[c, -1]
    return _tight(after, dims)


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: str = "2", id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, list[list[int]]]:
    """Rows (id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of all usable vectors, and the final centroids.

    A component x counts as floor(scale * x).  Vectors that are null, have another number of
    components, or hold a null or non-finite one are left out.  Centroids start as the ``k``
    vectors with the least sha256 of ``salt:id``; with fewer vectors there are as many
    clusters as vectors, with none there are no rows.  Rows with the same id, or the same
    vector, are rows of their own.  ``distance`` and the inertias are null where they exceed a
    64-bit integer.  Other columns of ``vectors`` are not looked at.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    coded = written(blocks(vectors, dims, scale, id_col, vector_col), "blocks")
    centroids = _first(vectors, k, dims, scale, salt, id_col, vector_col)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _round(coded, centroids)
    id_type = coded.schema["ids"].dataType.elementType
    most = (1 << 63) - 1

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                lists, codes = _unpack(row)
                best, far = _nearest(lists, codes, centroids)
                far = pa.array([int(x) if x <= most else None for x in far] if far.dtype == object else far, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0)[i].values, pa.array(best, pa.int32()), far], names=[id_col, "cluster", "distance"])

    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    assigned = written(coded.mapInArrow(assign, schema), "assigned")
    each = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("odd")).collect()
    sums = {r["cluster"]: None if r["odd"] else int(r["s"]) for r in each}
    fit = lambda v: v if v is not None and v <= most else None
    inertia = None if None in sums.values() else sum(sums.values())
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    about = [(c, fit(s), fit(inertia), digests[c]) for c, s in sums.items()]
    stats = spark.createDataFrame(about, "__cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows at most
    out = assigned.join(F.broadcast(stats), F.col("cluster") == F.col("__cluster")).drop("__cluster")
    return out, [[int(x) for x in c] for c in centroids]
