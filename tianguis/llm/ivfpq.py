"""Inverted files with product-quantised residuals, for search and for similarity joins.

Vectors are compared with those of their own width alone, so each width has an index: coarse
centroids and subspace codebooks, fitted in numpy on the driver on a sample of at most
16 * MOST_LISTS vectors, the least by hash.  Its size does not grow with the data, so it is
broadcast.  The MOST_WIDTHS most frequent widths are fitted; any other has one list and no
codes, which compares all of its vectors exactly, in blocks.  Every vector is indexed: its
list, the code of its residual, and the length of the quantisation error, which bounds how
far any asymmetric distance can be off.

Lists are dealt into shards of about ``SHARD_ROWS`` vectors, near lists together; larger
shards split into blocks.  A query goes to the shards that hold lists it probes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .forest import Forest

#: Vectors that an index is fitted on: SAMPLE, or 16 for each list where there are more lists.
SAMPLE = 16_384
#: Lists are about the square root of the vectors; centroids beyond LISTS_AT_ONCE are found in two levels.
MOST_LISTS, LISTS_AT_ONCE = 4096, 512
#: Widths that have an index of their own.
MOST_WIDTHS = 4
SUBSPACES, CODEWORDS = 16, 256
SHARD_ROWS = 8192
#: Queries that a task compares at once, and vectors that are given their lists at once.
QUERY_BLOCK, DEAL_BLOCK = 256, 1024


def _kmeans(x: np.ndarray, k: int, rng, rounds: int) -> np.ndarray:
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        a = _nearest(x, c)
        n = np.bincount(a, minlength=k)
        sums = np.stack([np.bincount(a, x[:, j], minlength=k) for j in range(x.shape[1])], axis=1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
        empty = np.nonzero(n == 0)[0]
        c[empty] = x[rng.choice(len(x), len(empty))]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x @ c.T - (c * c).sum(axis=1) / 2).argmax(axis=1)


def _by_nearness(c: np.ndarray, at: np.ndarray) -> list[int]:
    """An order of the centroids in which near ones are close: halves along the widest direction."""
    if len(at) < 3:
        return at.tolist()
    x = c[at] - c[at].mean(axis=0)
    along = x @ np.linalg.svd(x, full_matrices=False)[2][0]
    order = at[np.argsort(along, kind="stable")]
    half = len(order) // 2
    return _by_nearness(c, order[:half]) + _by_nearness(c, order[half:])


@dataclass(frozen=True)
class Index:
    """Coarse centroids (in an order that keeps near ones together) and one codebook for each subspace."""

    centroids: np.ndarray
    books: np.ndarray  # subspace, codeword, dimension; unused dimensions are zero
    width: int
    probes: int = 1  # of a search
    plain: bool = False  # one list, no codes: estimates tell nothing, their errors are whole lengths

    @property
    def lists(self) -> int:
        return len(self.centroids)

    def _split(self, r: np.ndarray) -> np.ndarray:
        m, w = self.books.shape[0], self.books.shape[2]
        out = np.zeros((len(r), m * w))
        out[:, : self.width] = r
        return out.reshape(len(r), m, w)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, code and length of the error of each vector."""
        at = _nearest(x, self.centroids)
        r = self._split(x - self.centroids[at])
        codes = np.stack([_nearest(r[:, m], self.books[m]) for m in range(len(self.books))], axis=1).astype(np.uint8)
        back = np.stack([self.books[m][codes[:, m]] for m in range(len(self.books))], axis=1)
        return at, codes, np.sqrt(((r - back) ** 2).sum(axis=(1, 2)))

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of the queries' subvectors with all codewords: query, subspace, codeword."""
        return np.einsum("qmw,mcw->qmc", self._split(q), self.books).astype(np.float32)

    def estimates(self, q: np.ndarray, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Asymmetric estimates of all inner products: table look-ups by code, plus the centroid's."""
        tables = self.tables(q)
        out = (q @ self.centroids.T).astype(np.float32)[:, lists]
        for m in range(codes.shape[1]):
            out += tables[:, m, codes[:, m]]
        return out


def lists_for(total: int) -> int:
    return int(max(1, min(MOST_LISTS, np.sqrt(total))))


def _coarse(x: np.ndarray, lists: int, rng) -> np.ndarray:
    if lists <= LISTS_AT_ONCE:
        return _kmeans(x, lists, rng, 8)
    top = _kmeans(x, int(np.sqrt(lists)), rng, 8)
    at = _nearest(x, top)
    parts = [x[at == i] for i in range(len(top)) if (at == i).any()]
    return np.concatenate([_kmeans(p, max(1, round(lists * len(p) / len(x))), rng, 8) for p in parts])


def fit(sample: np.ndarray, total: int, seed: int = 5) -> Index:
    """An index for ``total`` vectors like ``sample``: about sqrt(total) lists, MOST_LISTS at most."""
    rng = np.random.default_rng(seed)
    x = sample.astype(np.float64)
    width = x.shape[1]
    c = _coarse(x, max(1, min(lists_for(total), len(x) // 16)), rng)
    c = c[_by_nearness(c, np.arange(len(c)))]
    w = -(-width // SUBSPACES)
    m = -(-width // w)
    r = np.zeros((len(x), m * w))
    r[:, :width] = x - c[_nearest(x, c)]
    r = r.reshape(len(x), m, w)
    some = r[rng.choice(len(r), min(len(r), 8192), replace=False)]
    return Index(c, np.stack([np.resize(_kmeans(some[:, j], CODEWORDS, rng, 6), (min(CODEWORDS, len(some)), w)) for j in range(m)]), width)


def plain_index(width: int) -> Index:
    return Index(np.zeros((1, width)), np.zeros((1, 1, width)), width, plain=True)


class Indexes:
    """The indexes of the most frequent widths; any other width has a plain one."""

    def __init__(self, of_width: dict[int, Index]):
        self.of_width = of_width

    def of(self, width: int) -> Index:
        return self.of_width.get(width) or plain_index(width)


def fit_all(vectors: DataFrame, vector: str, make) -> Indexes:
    """``make(sample, total)`` for each of the MOST_WIDTHS most frequent widths."""
    top = vectors.groupBy(F.size(vector).alias("w")).count().orderBy(F.desc("count"), "w").limit(MOST_WIDTHS).collect()
    return Indexes({r["w"]: make(sample_of(vectors.where(F.size(vector) == r["w"]), vector, max(SAMPLE, 16 * lists_for(r["count"]))), r["count"]) for r in top})


def usable(vector: str) -> Column:
    """True for vectors that are not null, have no null or non-finite component and are not zero."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def sample_of(vectors: DataFrame, vector: str, most: int) -> np.ndarray:
    rows = vectors.select(F.col(vector).alias("v")).orderBy(F.xxhash64("v", F.lit(11))).limit(most).toPandas()
    return np.stack(rows["v"].to_numpy()).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# --- dealing out ----------------------------------------------------------------------

_CODED = "rid long, key string, w long, v array<double>, query boolean, need long, shards int, list int, code binary, err double"
_DEALT = "rid long, key string, w long, v array<double>, role int, shard int, list int, probes binary, code binary, err double"


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _by_width(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Parts of one width, of DEAL_BLOCK rows at most."""
    widths = pdf["v"].map(len).to_numpy()
    for w in np.unique(widths):
        part = pdf[widths == w]
        for i in range(0, len(part), DEAL_BLOCK):
            yield part.iloc[i : i + DEAL_BLOCK]


def coded(rows: DataFrame, indexes: Indexes, directions: bool) -> DataFrame:
    """``rows`` (rid, key, w, v, query, need, shards), indexed: ``list``, ``code`` and ``err`` added; ``shards`` at most the lists.

    Vectors of one ``key`` have one width.  ``directions``: index unit vectors.
    """
    shared = rows.sparkSession.sparkContext.broadcast(indexes)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in _by_width(pdf):
                x = _matrix(part["v"])
                ix = shared.value.of(x.shape[1])
                lists, codes, err = ix.encode(unit(x) if directions else x)
                yield part.assign(v=list(x), shards=np.minimum(part["shards"], ix.lists).astype(np.int32), list=lists.astype(np.int32), code=[c.tobytes() for c in codes], err=err)

    return cut(rows.mapInPandas(code, _CODED))


def dealt(rows: DataFrame, indexes: Indexes, probed, directions: bool) -> DataFrame:
    """``rows`` (as ``coded``) as members of their shard (role 0) and, if queries, as queries of those they probe (role 1).

    ``probed(index, x, lists, need)`` gives each query's lists as a boolean matrix.  Adds ``mb`` and ``qb``,
    the blocks of shards that have too many members: every query block meets every member block.
    """
    shared = rows.sparkSession.sparkContext.broadcast(indexes)
    columns = [c.split()[0] for c in _DEALT.split(", ")]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in _by_width(pdf):
                x = _matrix(part["v"])
                ix = shared.value.of(x.shape[1])
                lists, shards, place = part["list"].to_numpy(), part["shards"].to_numpy().astype(np.int64), np.arange(ix.lists)
                wanted = probed(ix, unit(x) if directions else x, lists, part["need"].to_numpy())
                base = part.assign(v=list(x), shard=(lists * shards // ix.lists).astype(np.int32), role=np.int32(0), probes=[b.tobytes() for b in np.packbits(wanted, axis=1, bitorder="little")])[columns]
                yield base
                for s in np.unique(shards):
                    rows_s = np.nonzero((shards == s) & part["query"].to_numpy())[0]
                    if not len(rows_s):
                        continue
                    of_list = place * s // ix.lists
                    starts = np.nonzero(np.concatenate([[True], of_list[1:] != of_list[:-1]]))[0]
                    q, k = np.nonzero(np.logical_or.reduceat(wanted[rows_s], starts, axis=1))
                    out = base.iloc[rows_s[q]].copy()
                    out["shard"], out["role"] = of_list[starts][k].astype(np.int32), np.int32(1)
                    yield out

    lists_of_key = F.col("lists")
    sizes = rows.withColumn("lists", _lists_column(indexes)).withColumn("shard", F.floor(F.col("list").cast("long") * F.col("shards") / lists_of_key).cast("int"))
    sizes = sizes.groupBy("key", "shard").count().select("key", "shard", F.ceil(F.col("count") / SHARD_ROWS).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    visits = rows.mapInPandas(deal, _DEALT).join(sizes, ["key", "shard"])
    visits = visits.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    member = F.col("role") == 0
    return visits.withColumns({"mb": F.when(member, F.col("own")).otherwise(F.col("other")), "qb": F.when(member, F.col("other")).otherwise(F.col("own"))}).drop("blocks", "own", "other")


def _lists_column(indexes: Indexes) -> Column:
    out = F.lit(1)
    for width, ix in indexes.of_width.items():
        out = F.when(F.size("v") == width, F.lit(ix.lists)).otherwise(out)
    return out


class Shard:
    """One task's members and queries, all of one width."""

    def __init__(self, pdf: pd.DataFrame, indexes: Indexes, directions: bool):
        self.m, self.q = pdf[pdf["role"] == 0], pdf[pdf["role"] == 1]
        self.empty = not len(self.m) or not len(self.q)
        if self.empty:
            return
        self.mx, self.qx = _matrix(self.m["v"]), _matrix(self.q["v"])
        self.index = indexes.of(self.mx.shape[1])
        self.lists = self.m["list"].to_numpy()
        self.codes = np.frombuffer(b"".join(self.m["code"]), np.uint8).reshape(len(self.m), -1)
        self.err = self.m["err"].to_numpy()
        self.qu = unit(self.qx) if directions else self.qx
        self.q_probes, self.m_probes = (np.unpackbits(np.frombuffer(b"".join(p["probes"]), np.uint8).reshape(len(p), -1), axis=1, bitorder="little").astype(bool) for p in (self.q, self.m))

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Query rows, and their estimates for all members; -inf where the list isn't probed."""
        for i in range(0, len(self.q), QUERY_BLOCK):
            at = np.arange(i, min(i + QUERY_BLOCK, len(self.q)))
            est = self.index.estimates(self.qu[at], self.lists, self.codes)
            est[~self.q_probes[at][:, self.lists]] = -np.inf
            yield at, est


# --- near-duplicates ------------------------------------------------------------------


def near_probes(threshold: float, slack: float):
    """Lists that a vector with cosine ``threshold`` or more may lie in.

    A partner lies within d = sqrt(2 - 2 * threshold) on the sphere.  It is in list c rather
    than in the query's own list only if it lies beyond the plane between the centroids, so a
    list is probed where that plane is nearer than slack * d.  slack 1 can lose nothing; at
    1/2, a partner at distance d in a random direction of 64 dimensions is lost with chance
    3e-5, and none is lost within d / 2.
    """
    reach = slack * np.sqrt(max(0.0, 2 - 2 * threshold))

    def probed(index: Index, u: np.ndarray, own: np.ndarray, need: np.ndarray | None = None) -> np.ndarray:
        c = index.centroids
        half = (c * c).sum(axis=1) / 2
        score = u @ c.T - half
        gap = np.sqrt(np.maximum((c * c).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None] - 2 * c @ c.T, 0))[own]
        out = score[np.arange(len(u)), own][:, None] - score <= reach * gap
        out[np.arange(len(u)), own] = True
        return out

    return probed


def similar(rows: DataFrame, indexes: Indexes, threshold: float, slack: float = 0.5) -> DataFrame:
    """Links among ``rows`` (rid, key, w, v, shards) of equal key, and so of equal width, with cosine ``threshold`` or more.

    Returns rows (a, b, n): where b is null, n is to be added to a's number of linked
    vectors (each weighs w); else a-b is a link of a spanning forest (n is 0).
    """
    shared = rows.sparkSession.sparkContext.broadcast(indexes)
    every = coded(rows.select("rid", "key", "w", "v", F.lit(True).alias("query"), F.lit(0).cast("long").alias("need"), "shards"), indexes, True)

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        s = Shard(pdf, shared.value, True)
        none = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="Int64"), "n": pd.Series(dtype="int64")})
        if s.empty:
            return none
        forest = Forest()
        q_id, m_id = s.q["rid"].to_numpy(), s.m["rid"].to_numpy()
        q_w, m_w, q_list = s.q["w"].to_numpy(), s.m["w"].to_numpy(), s.q["list"].to_numpy()
        q_norm, m_norm = np.sqrt((s.qx * s.qx).sum(axis=1)), np.sqrt((s.mx * s.mx).sum(axis=1))
        q_n, m_n = np.zeros(len(s.q), np.int64), np.zeros(len(s.m), np.int64)
        for at, est in s.blocks():
            i, j = np.nonzero(est + (s.err + 1e-5)[None].astype(np.float32) >= threshold)
            i = at[i]
            for k in range(0, len(i), 200_000):
                x, y = i[k : k + 200_000], j[k : k + 200_000]
                ok = ((s.qx[x] * s.mx[y]).sum(axis=1) / (q_norm[x] * m_norm[y]) >= threshold) & (q_id[x] != m_id[y])
                x, y = x[ok], y[ok]
                np.add.at(q_n, x, m_w[y])
                # the other direction is met elsewhere only if the member probes the query's list
                alone = ~s.m_probes[y, q_list[x]]
                np.add.at(m_n, y[alone], q_w[x[alone]])
                forest.add(q_id[x], m_id[y], np.zeros(len(x), np.int64))
        a, b, _ = forest.links()
        some_q, some_m = np.nonzero(q_n)[0], np.nonzero(m_n)[0]
        counted = pd.DataFrame({"a": np.concatenate([q_id[some_q], m_id[some_m]]), "n": np.concatenate([q_n[some_q], m_n[some_m]])})
        linked = pd.DataFrame({"a": a, "b": b, "n": np.zeros(len(a), np.int64)})
        out = pd.concat([linked.astype({"b": "Int64"}), counted.assign(b=pd.array([None] * len(counted), dtype="Int64"))[["a", "b", "n"]]], ignore_index=True)
        return out

    return dealt(every, indexes, near_probes(threshold, slack), True).groupBy("key", "shard", "mb", "qb").applyInPandas(links, "a long, b long, n long")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """One row for each vector: its id, ``n_links``, ``component_id`` and ``kept``.

    Vectors of equal, non-null label link at a cosine (double precision) of ``threshold`` or
    more.  Equal vectors are compared once, as a class, and count as linked copies.
    ``component_id`` is the least id reachable, ``kept`` says that it is the row's own.

    Vectors that are null, zero or hold a null or non-finite component link with nothing,
    nor do vectors without a label; vectors of different widths don't link.  Rows with equal
    ids are different vectors.  Empty tables give empty results; other columns are not read.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    takes_part = usable("v") & F.col("label").isNotNull()
    key_of = F.concat_ws(":", F.size("v").cast("string"), F.col("label").cast("string"))
    classes = rows.where(takes_part).groupBy(key_of.alias("key"), "v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("w"))
    classes = cut(classes.withColumn("rid", F.monotonically_increasing_id()))
    indexes = fit_all(classes, "v", lambda sample, total: fit(unit(sample), total))
    per_key = classes.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"))
    found = cut(similar(classes.join(per_key, "key").select("rid", "key", "w", F.col("v").cast("array<double>").alias("v"), "shards"), indexes, threshold))
    from .components import connected_components

    counts = found.groupBy(F.col("a").alias("rid")).agg(F.sum("n").alias("links"))
    comps = connected_components(found.where("b is not null"))
    rooted = (
        classes.join(counts, "rid", "left")
        .join(comps, F.col("rid") == F.col("node"), "left")
        .select("key", "v", "least", F.coalesce("component", "rid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("links"))
    )
    rooted = cut(rooted)
    roots = rooted.groupBy("root").agg(F.min("least").alias("group"))
    named = rooted.join(roots, "root").select(F.col("key").alias("__key"), F.col("v").alias("__v"), "links", "group")
    key = F.when(takes_part, key_of)
    joined = rows.withColumn("key", key).join(named, (F.col("key") == F.col("__key")) & (F.col("v") == F.col("__v")), "left")
    component = F.when(F.col("__key").isNotNull(), F.col("group")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


# --- search ---------------------------------------------------------------------------

#: Probes are chosen on the sample so that at least this share of true neighbours lies in probed lists.
RECALL = 0.97
#: Exact products are computed for all members whose estimate is within so many deviations of the k-th best.
DEVIATIONS = 4.0


def probes_for(index: Index, sample: np.ndarray, k: int, recall: float = RECALL) -> int:
    """The fewest lists to probe, by products with the centroids, that hold ``recall`` of the sample's own k nearest."""
    q = sample[:: max(1, len(sample) // 256)][:256]
    lists = _nearest(sample, index.centroids)
    products = q @ sample.T
    top = np.argsort(-products, axis=1, kind="stable")[:, 1 : k + 1]
    rank = np.argsort(np.argsort(-(q @ index.centroids.T), axis=1), axis=1)
    at = np.sort(np.take_along_axis(rank, lists[top], axis=1).ravel())
    return int(at[min(len(at) - 1, int(np.ceil(recall * len(at))))]) + 1 if len(at) else index.lists


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` vectors of largest inner product (double precision) for each query, nearest first.

    Queries are the rows where ``is_query`` holds; candidates are all rows of its width with
    another id.  Returns query_id, rank (from 1), vec_id, score; ties go to the smaller id.  A
    query probes the chosen number of lists, and more until they hold ``k`` candidates, so it
    gets ``k`` rows, or all candidates if they are fewer.

    Vectors that are null, zero or hold a null or non-finite component, and rows with null
    ids, take no part.  Rows with equal ids are different vectors, none of which is a
    candidate of the others; queries with equal ids give a ranking of their own each.  Empty
    tables give empty results; other columns are not read.
    """
    schema = "query_row long, query_id long, vec_id long, score double"
    spark = vectors.sparkSession
    fine = vectors.where(usable(vector_col) & F.col(id_col).isNotNull())
    rows = fine.select(F.col(id_col).cast("long").alias("w"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
    rows = cut(rows.withColumn("rid", F.monotonically_increasing_id()))

    def searchable(sample: np.ndarray, total: int) -> Index:
        index = fit(sample, total)
        return replace(index, probes=probes_for(index, sample, k))

    indexes = fit_all(rows, "v", searchable)
    # candidates that a query must meet: k, besides the rows of its own id
    twice = rows.groupBy("w").count().where("count > 1").select("w", F.col("count").alias("same"))
    per_width = rows.groupBy(F.size("v").alias("width")).agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"))
    every = rows.withColumn("width", F.size("v")).join(per_width, "width").join(twice, "w", "left")
    every = coded(every.select("rid", F.col("width").cast("string").alias("key"), "w", "v", "query", (F.coalesce("same", F.lit(1)) + k).alias("need"), "shards"), indexes, False)
    # the lengths of the lists: MOST_WIDTHS * MOST_LISTS numbers at most
    held = every.where(F.size("v").isin(list(indexes.of_width))).groupBy(F.size("v").alias("width"), "list").count().collect()
    lengths = {w: np.zeros(ix.lists, np.int64) for w, ix in indexes.of_width.items()}
    for r in held:
        lengths[r["width"]][r["list"]] = r["count"]
    shared, sizes = spark.sparkContext.broadcast(indexes), spark.sparkContext.broadcast(lengths)

    def probed(ix: Index, x: np.ndarray, own: np.ndarray, need: np.ndarray) -> np.ndarray:
        if ix.plain:
            return np.ones((len(x), 1), bool)
        order = np.argsort(-(x @ ix.centroids.T), axis=1, kind="stable")
        met = np.cumsum(sizes.value[ix.width][order], axis=1)
        # lists before the one that fills up what is needed, and that one
        count = np.maximum((met < need[:, None]).sum(axis=1) + 1, ix.probes)
        out = np.zeros(order.shape, bool)
        np.put_along_axis(out, order, np.arange(ix.lists)[None] < count[:, None], axis=1)
        return out

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        s = Shard(pdf, shared.value, False)
        out: list[tuple] = []
        if not s.empty:
            # in the shard's rows, w carries the id
            m_id, q_id, q_row = s.m["w"].to_numpy(), s.q["w"].to_numpy(), s.q["rid"].to_numpy()
            margin = s.err * (1.0 if s.index.plain else min(1.0, DEVIATIONS / np.sqrt(s.mx.shape[1])))
            for at, est in s.blocks():
                est[q_id[at][:, None] == m_id[None]] = -np.inf
                for i, row in zip(at, est):
                    live = np.nonzero(row > -np.inf)[0]
                    if not len(live):
                        continue
                    if len(live) > k:
                        best = live[np.argpartition(-row[live], k - 1)[:k]]
                        floor = (s.mx[best] * s.qx[i]).sum(axis=1).min()
                        near = row + np.linalg.norm(s.qx[i]) * margin + 1e-5 >= floor
                        near[best] = True
                        live = live[near[live]]
                    exact = (s.mx[live] * s.qx[i]).sum(axis=1)
                    order = np.lexsort((m_id[live], -exact))[:k]
                    out += zip([int(q_row[i])] * len(order), [int(q_id[i])] * len(order), m_id[live[order]].tolist(), exact[order].tolist())
        return pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"]).astype({"query_row": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = dealt(every, indexes, probed, False).groupBy("key", "shard", "mb", "qb").applyInPandas(search, schema)
    by = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
