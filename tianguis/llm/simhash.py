"""SimHash near-duplicates by vantage-point trees.

1. Every text becomes a fingerprint (majority bits over the hashes of its word shingles).
2. Equal fingerprints collapse to one class; only distinct ones are compared.
3. The bits are dealt into bands.  Two fingerprints within r bits of each other are within
   r // bands bits of each other in one band at least, so each band has a vantage-point
   tree of its own that looks for pairs within that smaller radius.
4. A node of a tree has a pivot and a radius m of its own, chosen from a bounded sample so
   that it parts its members evenly: ``inner`` (d <= m) and ``outer`` (d > m).  By the
   triangle inequality two members within r of each other that fall on different sides both
   lie within r of the boundary, so a node splits exactly into pairs(inner), pairs(outer)
   and pairs(inner boundary x outer boundary); a two-sided node splits into four.  At radius
   0 nothing lies in the boundary, and a tree deals every row out once.
5. Leaves are cells.  A cell of a single lane that is too large for one task goes on through an inner tree
   over all 64 bits at the whole radius r, with boundary shards.  What is still too large then
   (rows that no pivot can part) is cut into blocks, every two of which meet in one task.
   Within a task, large runs of one band value are searched by a tree over all bits too.  A task gives back a spanning forest of its
   links (fewer rows than it has members), never all pairs within a group.
6. Connected components over the forests give the groups.

One tree over all 64 bits deals unlike fingerprints out 1.7 times over at each level, as
two thirds of them lie within 4 bits of any median: rows would grow near N^1.75.  So the bands come
first, and the trees over all bits only take the levels that the bands' values leave open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, free_name, text_or_empty, written
from .components import connected_components
from .forest import Forest

#: Rows of the sample that the trees' pivots and radii come from, and what a node needs to be split.
SAMPLE_ROWS, NODE_SAMPLE = 16_384, 16
#: A node is split if that leaves less than this share of its pairs to compare, while the tree has few nodes.
WORTH, MOST_NODES = 0.85, 8192
#: Rows that one task should compare, at most and (where there are fewer rows than tasks could share) at least.
CELL_ROWS, LEAST_CELL = 16_384, 512
#: In a task, blocks of so many fingerprints are compared directly.
LEAF_ROWS = 512
#: Comparisons that are held in memory at once.
COMPARED = 1 << 20
_SEED = 42


def _words(text: str) -> list[bytes]:
    # bytes.lower() changes A-Z alone and bytes.split() splits at 0x20 and 0x09-0x0D alone
    return text.encode("utf-8", "replace").lower().split()


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each ``width``-word shingle; fewer words: of the whole sequence; none: empty."""
    from xxhash import xxh64_intdigest

    words = _words(text)
    if not words:
        return np.empty(0, np.uint64)
    n = max(1, len(words) - width + 1)
    joined = map(b" ".join, zip(*(words[i : i + n] for i in range(min(width, len(words))))))
    return np.fromiter((xxh64_intdigest(s, _SEED) for s in joined), np.uint64, n)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th further hash of a shingle, from its first (splitmix64 finaliser)."""
    if not k:
        return h
    x = h + np.uint64((k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority_bits(h: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half of ``h``; 0 for none."""
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = np.ascontiguousarray(h[i : i + (1 << 16)])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprint_udf(width: int, lanes: int):
    """Column function: text -> (lanes: array of 64-bit fingerprints, distinct shingles, key of the word sequence)."""
    schema = T.StructType(
        [
            T.StructField("lanes", T.ArrayType(T.LongType(), False)),
            T.StructField("size", T.IntegerType()),
            T.StructField("key", T.StringType()),
        ]
    )

    @F.pandas_udf(schema)
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_hexdigest

        for texts in batches:
            lane_rows, sizes, keys = [], [], []
            for text in texts:
                h = shingle_hashes(text, width)
                if lanes > 1:  # the check of similarity is on sets: repeats don't count
                    h = np.unique(h)
                lane_rows.append([majority_bits(_mixed(h, k)) for k in range(lanes)])
                if lanes > 1:  # sizes and keys serve that check only
                    sizes.append(len(h))
                    keys.append(xxh3_128_hexdigest(b" ".join(_words(text))))
                else:
                    sizes.append(0)
                    keys.append("")
            yield pd.DataFrame({"lanes": lane_rows, "size": sizes, "key": keys})

    return fingerprint


# --- the trees ------------------------------------------------------------------------


def _near(a: np.ndarray, pivot) -> np.ndarray:
    return np.bitwise_count(a ^ pivot)


def band_masks(lanes: int, bands: int, width: int = 0) -> list[tuple[int, int, int]]:
    """(lane, first bit, bits) of each band: ``bands`` equal shares of each lane, or as many of ``width`` bits as it holds."""
    if width:
        return [(lane, at, width) for lane in range(lanes) for at in range(0, 64 - width + 1, width)]
    ends = [64 * i // bands for i in range(bands + 1)]
    return [(lane, a, b - a) for lane in range(lanes) for a, b in zip(ends, ends[1:])]


def band_values(lane: np.ndarray, first: int, bits: int) -> np.ndarray:
    return (lane >> np.uint64(first)) & np.uint64((1 << bits) - 1)


class Tree:
    """A vantage-point tree; each node is a leaf (None) or (pivot, radius, children)."""

    def __init__(self, sample: np.ndarray, per_sample: float, cell_rows: float, radius: int):
        self.radius, self.nodes = radius, []
        self._rng = np.random.default_rng(1)
        self._grow(sample, None, per_sample, cell_rows, 0)

    def _pivot(self, x: np.ndarray) -> tuple | None:
        """Of some members, the one whose distances part the others best: (pivot, radius) or none."""
        best = None
        for pivot in np.unique(self._rng.choice(x, min(8, len(x)), replace=False)):
            d = np.sort(_near(x, pivot).astype(np.int64))
            steps = np.nonzero(d[1:] > d[:-1])[0]
            if len(steps):
                i = steps[np.argmin(np.abs(steps + 1 - len(d) / 2))]
                uneven = abs(int(i) + 1 - len(d) / 2)
                if best is None or uneven < best[0]:
                    best = uneven, pivot, int(d[i])
        return best and best[1:]

    def _grow(self, left: np.ndarray, right: np.ndarray | None, per: float, cell_rows: float, depth: int) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        both = left if right is None else np.concatenate([left, right])
        if len(both) * per <= cell_rows or len(both) < NODE_SAMPLE or depth > 40:
            return at
        found = self._pivot(both)
        if found is None:
            return at
        pivot, mid = found

        def parts(x):
            d = _near(x, pivot).astype(np.int64)
            inner = d <= mid
            return x[inner], x[~inner], x[inner & (d > mid - self.radius)], x[~inner & (d <= mid + self.radius)]

        a_in, a_out, a_edge_in, a_edge_out = parts(left)
        if right is not None:
            b_in, b_out, b_edge_in, b_edge_out = parts(right)
        # pairs left to compare: a split that prunes next to nothing would only deal rows out
        if right is None:
            work, before = len(a_in) ** 2 / 2 + len(a_out) ** 2 / 2 + len(a_edge_in) * len(a_edge_out), len(left) ** 2 / 2
        else:
            work, before = len(a_in) * len(b_in) + len(a_out) * len(b_out) + len(a_edge_in) * len(b_edge_out) + len(a_edge_out) * len(b_edge_in), len(left) * len(right)
        if work > WORTH * before or len(self.nodes) > MOST_NODES:
            return at
        grow = lambda x, y: self._grow(x, y, per, cell_rows, depth + 1)
        if right is None:
            children = [grow(a_in, None), grow(a_out, None)] + ([grow(a_edge_in, a_edge_out)] if self.radius else [])
        else:
            children = [grow(a_in, b_in), grow(a_out, b_out)] + ([grow(a_edge_in, b_edge_out), grow(a_edge_out, b_edge_in)] if self.radius else [])
        self.nodes[at] = (pivot, mid, children)
        return at

    def route(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, leaves and roles: every leaf that a value takes part in; role 0 in one-sided leaves, 2 or 3 as a side of others."""
        out, todo = [], [(0, np.arange(len(values)), None)]
        while todo:
            at, rows, side = todo.pop()
            if not len(rows):
                continue
            node = self.nodes[at]
            if node is None:
                out.append((rows, np.full(len(rows), at), np.zeros(len(rows), np.int64) if side is None else 2 + side))
                continue
            pivot, mid, children = node
            d = _near(values[rows], pivot).astype(np.int64)
            inner = d <= mid
            todo += [(children[0], rows[inner], side if side is None else side[inner]), (children[1], rows[~inner], side if side is None else side[~inner])]
            if self.radius:
                edge = np.where(inner, d > mid - self.radius, d <= mid + self.radius)
                if side is None:
                    todo.append((children[2], rows[edge], (~inner[edge]).astype(np.int64)))
                else:
                    # left-inner meets right-outer, left-outer meets right-inner
                    first = edge & (inner == (side == 0))
                    todo += [(children[2], rows[first], side[first]), (children[3], rows[edge & ~first], side[edge & ~first])]
        if not out:
            return (np.empty(0, np.int64),) * 3
        return tuple(map(np.concatenate, zip(*out)))


def _pairs_in(fp: np.ndarray, left: np.ndarray, right: np.ndarray | None, radius: int, rng, found) -> None:
    """Calls found(rows, rows) with all pairs within ``radius``; the tree within a task."""
    todo = [(left, right, 0)]
    while todo:
        a, b, depth = todo.pop()
        if not len(a) or b is not None and not len(b):
            continue
        n, m = len(a), len(b) if b is not None else len(a)
        if n * m <= LEAF_ROWS * LEAF_ROWS or min(n, m) <= 16 or depth > 40 or radius > 8:
            step = max(1, COMPARED // m)
            for i in range(0, n, step):
                x, y = np.nonzero(np.bitwise_count(fp[a[i : i + step], None] ^ fp[None, a if b is None else b]) <= radius)
                if b is None:
                    up = y > x + i
                    x, y = x[up], y[up]
                if len(x):
                    found(a[i + x], (a if b is None else b)[y])
            continue
        pivot = fp[a[rng.integers(n)]] if b is None or rng.integers(2) else fp[b[rng.integers(m)]]
        da = _near(fp[a], pivot).astype(np.int64)
        mid = int(np.median(da))
        if mid == da.max():
            mid -= 1
        ai = da <= mid
        a_in, a_out = a[ai & (da > mid - radius)], a[~ai & (da <= mid + radius)]
        if b is None:
            todo += [(a[ai], None, depth + 1), (a[~ai], None, depth + 1), (a_in, a_out, depth + 1)]
            continue
        db = _near(fp[b], pivot).astype(np.int64)
        bi = db <= mid
        b_in, b_out = b[bi & (db > mid - radius)], b[~bi & (db <= mid + radius)]
        todo += [(a[ai], b[bi], depth + 1), (a[~ai], b[~bi], depth + 1), (a_in, b_out, depth + 1), (a_out, b_in, depth + 1)]


def bits_allowed(size: np.ndarray, bits: int, ratio: float) -> np.ndarray:
    """Bits that rows may differ in; where sets are compared, small ones, whose majorities vary more, a fifth more."""
    return np.where(size < SMALL_SET, bits * 6 // 5, bits) if ratio else np.full(len(size), bits)


def _same_band(lanes: np.ndarray, size: np.ndarray, value: np.ndarray, left: np.ndarray, right: np.ndarray | None, bits: int, ratio: float, found) -> None:
    """Calls found(rows, rows, distances) with the pairs of equal ``value`` that differ in few bits and are of like size."""
    left = left[np.lexsort((size[left], value[left]))]
    other = left if right is None else right[np.lexsort((size[right], value[right]))]
    allowed = bits_allowed(size, bits, ratio)
    values, first = np.unique(value[left], return_index=True)
    lows, highs = np.searchsorted(value[other], values), np.searchsorted(value[other], values, side="right")
    columns = [np.ascontiguousarray(c) for c in lanes.T]
    rng = np.random.default_rng(1)

    def near(a, b):
        found(a, b, _near(columns[0][a], columns[0][b]).astype(np.int64))

    for k, (start, end) in enumerate(zip(first, np.append(first[1:], len(left)))):
        run = other[lows[k] : highs[k]]
        if not len(run) or right is None and len(run) < 2:
            continue
        if len(columns) == 1 and not ratio and (end - start) * len(run) > LEAF_ROWS * LEAF_ROWS:
            _pairs_in(columns[0], left[start:end], None if right is None else run, bits, rng, near)
            continue
        sizes, step = size[run], max(1, COMPARED // len(run))
        for i in range(start, end, step):
            a = left[i : min(i + step, end)]
            # both are in order of size: only a stretch of the others can be like enough
            low = 0 if not ratio else int(np.searchsorted(sizes, ratio * size[a[0]]))
            high = len(run) if not ratio else int(np.searchsorted(sizes, size[a[-1]] / ratio, side="right"))
            if right is None:
                low = max(low, i - start)
            b = run[low:high]
            d = np.bitwise_count(columns[0][a, None] ^ columns[0][None, b]).astype(np.uint16)
            for c in columns[1:]:
                d += np.bitwise_count(c[a, None] ^ c[None, b])
            x, y = np.nonzero(d <= int(allowed[a].max()))
            if right is None:
                up = y + low > x + (i - start)
                x, y = x[up], y[up]
            p, q, d = a[x], b[y], d[x, y].astype(np.int64)
            fine = d <= np.minimum(allowed[p], allowed[q]) if not ratio else (d <= np.maximum(allowed[p], allowed[q])) & (np.minimum(size[p], size[q]) >= ratio * np.maximum(size[p], size[q]))
            if fine.any():
                found(p[fine], q[fine], d[fine])


def _cell_links(lanes_n: int, radius: int, bits: int, ratio: float):
    """applyInPandas function: the forest of links of one task."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["id"].to_numpy()
        lanes = np.stack([pdf[f"l{k}"].to_numpy() for k in range(lanes_n)], axis=1).view(np.uint64)
        size, role, value = pdf["size"].to_numpy().astype(np.int64), pdf["role"].to_numpy(), pdf["value"].to_numpy().view(np.uint64)
        forest = Forest()
        left = np.nonzero(role % 2 == 0)[0]
        right = np.nonzero(role % 2 == 1)[0] if len(role) and role[0] >= 2 else None
        if radius:
            allowed = bits_allowed(size, bits, ratio)

            def near(a, b):
                d = np.bitwise_count(lanes[a] ^ lanes[b]).sum(axis=1).astype(np.int64)
                fine = (d <= np.maximum(allowed[a], allowed[b])) & (np.minimum(size[a], size[b]) >= ratio * np.maximum(size[a], size[b]))
                forest.add(a[fine], b[fine], d[fine])

            _pairs_in(value, left, right, radius, np.random.default_rng(1), near)
        else:
            _same_band(lanes, size, value, left, right, bits, ratio, forest.add)
        a, b, d = forest.links()
        return pd.DataFrame({"a": ids[a], "b": ids[b], "bits": d})

    return links


def _sample(reps: DataFrame, lanes: int) -> np.ndarray:
    """At most SAMPLE_ROWS rows of lanes, the least by hash: the same rows however they are dealt out."""
    names = [f"l{k}" for k in range(lanes)]
    rows = reps.select(*names).orderBy(F.xxhash64(*names, F.lit(7)), *names).limit(SAMPLE_ROWS).toPandas()
    return rows.to_numpy(np.int64).view(np.uint64).reshape(-1, lanes)


def plan_trees(sample: np.ndarray, total: int, bands: list, radius: int, partitions: int, cell_rows: int | None = None) -> list[Tree]:
    """A tree for each band; cells are as large as CELL_ROWS allows and tasks can share."""
    cell = cell_rows or min(CELL_ROWS, max(LEAST_CELL, total * len(bands) // (2 * partitions)))
    per = total / max(1, len(sample))
    return [Tree(band_values(sample[:, lane], first, bits), per, cell, radius) for lane, first, bits in bands]


#: Inner trees are for radii that bounds can prune at; their leaves are numbered above a cell's own bits.
INNER_RADIUS, INNER_SHIFT = 8, 40


class Inner:
    """Trees over all 64 bits for cells that are too large: ``depth`` of each such cell (a power of two of tasks), a tree for each depth."""

    def __init__(self, cells: dict[int, int], sample: np.ndarray, sample_cells: np.ndarray, radius: int):
        self.cells = np.array(sorted(cells), np.int64)
        self.depth = np.array([int(np.ceil(np.log2(cells[c] / CELL_ROWS))) for c in self.cells.tolist()], np.int64)
        # pivots come from rows of these cells where the sample has enough of them
        own = sample[np.isin(sample_cells, self.cells).any(axis=0)] if len(sample) else sample
        pivots = own if len(own) >= 64 * NODE_SAMPLE else sample
        self.trees = {d: Tree(pivots, (CELL_ROWS << d) / max(1, len(pivots)), CELL_ROWS, radius) for d in np.unique(self.depth).tolist()}

    def route(self, lane: np.ndarray, rows: np.ndarray, cell: np.ndarray, role: np.ndarray) -> tuple:
        """Rows of these cells by the leaves of their trees, once for each leaf that they take part in; others as they are."""
        at = np.searchsorted(self.cells, cell)
        at[at == len(self.cells)] = 0
        large = self.cells[at] == cell
        out = [(rows[~large], cell[~large], role[~large])]
        for d, tree in self.trees.items():
            mine = np.nonzero(large & (self.depth[at] == d))[0]
            some, leaf, side = tree.route(lane[rows[mine]])
            some = mine[some]
            out.append((rows[some], cell[some] | (leaf + 1) << INNER_SHIFT, side))
        return tuple(map(np.concatenate, zip(*out)))


def _banded(lanes: list[np.ndarray], bands: list, trees: list[Tree]) -> Iterator[tuple]:
    """For each band: rows, cells, roles, and the band's value of every row."""
    for band, ((lane, first, width), tree) in enumerate(zip(bands, trees)):
        value = band_values(lanes[lane], first, width)
        rows, leaf, role = tree.route(value)
        yield rows, band << 32 | leaf, role, value


def plan_inner(sample: np.ndarray, bands: list, trees: list[Tree], cells: dict[int, int], radius: int) -> Inner:
    """Inner trees of the one-sided cells (radius 0: one cell a band and row) that have so many rows."""
    where = np.zeros((len(bands), len(sample)), np.int64)
    for i, (rows, cell, _, _) in enumerate(_banded([sample[:, 0]], bands, trees)):
        where[i, rows] = cell
    return Inner(cells, sample[:, 0], where, radius)


def links_between(reps: DataFrame, lanes: int, bands: list, band_radius: int, bits: int, similarity: float = 0.0) -> DataFrame:
    """Links ``(a, b, bits)`` among ``reps`` (id, l0.. lanes, size): a spanning forest for each task.

    Two rows link if they are within ``band_radius`` in one band, differ in at most ``bits`` bits of all
    lanes and, where asked, the sizes' ratio is ``similarity`` or more (sets can't be more
    alike than that).
    """
    spark = reps.sparkSession
    total, sample = reps.count(), _sample(reps, lanes)
    trees = plan_trees(sample, total, bands, band_radius, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ["id", *[f"l{k}" for k in range(lanes)], "size"]

    def routing(inner: Inner | None):
        shared = spark.sparkContext.broadcast((bands, trees, inner))

        def routed(batch: pa.RecordBatch) -> Iterator[tuple]:
            bands, trees, inner = shared.value
            columns = [batch.column(1 + k).to_numpy().view(np.uint64) for k in range(lanes)]
            for rows, cell, role, value in _banded(columns, bands, trees):
                if inner is not None:
                    rows, cell, role = inner.route(columns[0], rows, cell, role)
                yield rows, cell, role, value

        return routed

    def large_kinds(routed) -> dict[int, int]:
        """Rows of each cell and role above CELL_ROWS: no more than the trees have leaves, which the sample bounds."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, cell, role, _ in routed(batch):
                    kinds, n = np.unique(cell * 4 + role, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n)], names=["kind", "n"])

        counted = reps.select(*names).mapInArrow(count, "kind long, n long").groupBy("kind").agg(F.sum("n").alias("n")).where(F.col("n") > CELL_ROWS)
        return {r["kind"]: r["n"] for r in counted.collect()}

    routed = routing(None)
    large = large_kinds(routed)
    if large and lanes == 1 and not band_radius and not similarity and bits <= INNER_RADIUS:
        routed = routing(plan_inner(sample, bands, trees, {kind >> 2: n for kind, n in large.items()}, bits))
        large = large_kinds(routed)
    blocks = spark.sparkContext.broadcast({kind: -(-n // CELL_ROWS) for kind, n in large.items()})
    schema = ", ".join(f"{n} long" for n in names[:-1]) + ", size int, value long, cell long, x int, y int, role int"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _mixed(batch.column(0).to_numpy().view(np.uint64), 9)
            for rows, cell, role, value in routed(batch):
                rows, cell, x, y, role = _in_blocks(rows, cell, role, own, blocks.value)
                part = batch.take(pa.array(rows))
                columns = [*part.columns, pa.array(value[rows].view(np.int64)), pa.array(cell), pa.array(x, pa.int32()), pa.array(y, pa.int32()), pa.array(role, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "value", "cell", "x", "y", "role"])

    dealt = reps.select(*names).mapInArrow(deal, schema)
    return dealt.groupBy("cell", "x", "y").applyInPandas(_cell_links(lanes, band_radius, bits, similarity), "a long, b long, bits long")


def _in_blocks(rows: np.ndarray, cell: np.ndarray, role: np.ndarray, own: np.ndarray, blocks: dict) -> tuple:
    """Rows of cells with several blocks once for each pair of blocks (x, y) that theirs is in; the others stay in (0, 0)."""
    hot = {kind >> 2 for kind in blocks}
    large = np.isin(cell, list(hot)) if hot else np.zeros(len(cell), bool)
    out = [(rows[~large], cell[~large], np.zeros((~large).sum(), np.int64), np.zeros((~large).sum(), np.int64), role[~large])]
    for kind in np.unique(cell[large] * 4 + role[large]).tolist():
        c, r = kind >> 2, kind & 3
        mine = rows[large & (cell == c) & (role == r)]
        k = blocks.get(kind, 1)
        b = (own[mine] % np.uint64(k)).astype(np.int64)
        for j in range(k if r == 0 else blocks.get(kind ^ 1, 1)):
            other = np.full(len(mine), j)
            x, y = (np.minimum(b, other), np.maximum(b, other)) if r == 0 else (b, other) if r == 2 else (other, b)
            # in a one-sided cell a block meets itself (one-sided) and each other one, the lesser block on the left
            as_role = np.where(b == j, 0, np.where(b < j, 2, 3)) if r == 0 else np.full(len(mine), r)
            out.append((mine, np.full(len(mine), c), x, y, as_role))
    return tuple(map(np.concatenate, zip(*out)))


# --- the operators --------------------------------------------------------------------


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4, bands: int | None = None) -> DataFrame:
    """Groups documents whose fingerprints are linked, directly or over others.

    Returns the columns of ``docs`` but the text, with ``fingerprint`` (16 hex digits) and
    ``component_id`` (the least non-null id of the group).  Links join fingerprints that
    differ in ``radius`` bits or fewer; equal ones always link.  ``bands`` (radius + 1 unless
    given) changes the work alone.

    Null texts count as empty; texts without words have fingerprint zero and link like any
    other.  Repeated ids and rows with null ids keep their rows; a group whose ids are all
    null has a null component_id.  Empty tables give empty results.  Clashing column names:
    the new columns get underscores in front.
    """
    fp_name, comp_name, tmp = (free_name(docs, c) for c in ("fingerprint", "component_id", "lane0"))
    lane = fingerprint_udf(width, 1)(text_or_empty(text_col))["lanes"][0]
    marked = cut(docs.withColumn(tmp, lane).drop(text_col))
    classes = cut(marked.groupBy(F.col(tmp).alias("fp")).agg(F.min(id_col).alias("least")))
    # a class goes by its fingerprint while links are made: ids may be null or repeated
    reps = classes.select(F.col("fp").alias("id"), F.col("fp").alias("l0"), F.lit(0).alias("size"))
    bands = bands or radius + 1
    found = connected_components(links_between(reps, 1, band_masks(1, bands), radius // bands, radius))
    rooted = classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("root"), "least")
    roots = rooted.groupBy("root").agg(F.min("least").alias("group"))
    named = rooted.join(roots, "root").select(F.col("fp").alias("__fp"), F.col("group").alias("__group"))
    kept = [c for c in docs.columns if c != text_col]
    return marked.join(named, marked[tmp] == named["__fp"], "left").select(
        *[marked[c] for c in kept],
        F.lower(F.lpad(F.hex(marked[tmp]), 16, "0")).alias(fp_name),
        named["__group"].alias(comp_name),
    )


#: The stage of near-duplicates: 64-bit lanes, bits of a band, bits that all lanes may differ in.  Sets of Jaccard 0.8
#: have cosine 0.89, so a bit differs with chance 0.15.  Of 28 bands of 9 bits one at least is equal but for a chance
#: of 0.0007; of 256 bits 39 +- 5.7 differ, 60 lies 3.7 deviations above.  Sets under SMALL_SET shingles may differ
#: in a fifth more (4 shingles against 5: a chance of 0.19, all bands unlike in 0.009).
STAGE_LANES, STAGE_BAND, STAGE_BITS, SMALL_SET = 4, 9, 60, 24


#: Rows and bytes of shingle sets that a block of a group still to be settled should hold; a task holds two.
BLOCK_ROWS, BLOCK_BYTES = 4096, 32 << 20


def _shingle_sets(links: DataFrame, keyed: DataFrame, text_col: str, width: int) -> DataFrame:
    """Rows (id, s: the distinct shingles, sorted) of the links' ends; only these texts are read again."""

    @F.pandas_udf(T.ArrayType(T.LongType(), False))
    def shingle_set(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(t, width)).view(np.int64) for t in texts])

    # as a table, so that its size is known before the join is planned: texts are shuffled only if the ends are many
    ends = written(links.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ends")
    return cut(keyed.join(ends, "id", "left_semi").select("id", shingle_set(text_or_empty(text_col)).alias("s")))


def _jaccard_of_links(links: DataFrame, sets: DataFrame) -> DataFrame:
    """Links with the exact Jaccard of their shingle sets."""
    both = links.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    inter = F.size(F.array_intersect("sa", "sb")).cast("double")
    union = F.size("sa") + F.size("sb") - inter
    return both.select("a", "b", F.when(union > 0, inter / union).otherwise(1.0).alias("jaccard"))


def _block_links(similarity: float):
    """applyInPandas function: links that join the roots of two blocks, each verified on the shingle sets."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, size = pdf["id"].to_numpy(), pdf["size"].to_numpy().astype(np.int64)
        root = np.unique(pdf["root"].to_numpy(), return_inverse=True)[1]
        lanes = np.stack(pdf["lanes"].to_numpy()).astype(np.int64).view(np.uint64)
        sets = list(pdf["s"])
        ends = np.cumsum([0] + [len(x) for x in sets])
        shingles, at = np.unique(np.concatenate(sets), return_inverse=True)
        marked = np.zeros(len(shingles), bool)
        left, right = np.nonzero(pdf["role"].to_numpy() == 0)[0], np.nonzero(pdf["role"].to_numpy() == 1)[0]
        two, found, allowed = bool(len(right)), [], bits_allowed(size, STAGE_BITS, similarity)
        for i, a in enumerate(left):
            others = right if two else left[i + 1 :]
            others = others[root[others] != root[a]]
            others = others[np.minimum(size[others], size[a]) >= similarity * np.maximum(size[others], size[a])]
            others = others[np.bitwise_count(lanes[others] ^ lanes[a]).sum(axis=1) <= np.maximum(allowed[others], allowed[a])]
            if not len(others):
                continue
            mine = at[ends[a] : ends[a + 1]]
            marked[mine] = True
            shared = np.array([np.count_nonzero(marked[at[ends[b] : ends[b + 1]]]) for b in others])
            marked[mine] = False
            union = size[a] + size[others] - shared
            for b in others[shared >= similarity * union]:
                if root[a] != root[b]:
                    found.append((ids[a], ids[b]))
                    root[root == root[b]] = root[a]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return links


def _links_across(near: DataFrame, found: DataFrame, classes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Verified links ``(a, b)`` that the forest of candidates ``near`` hides behind its false links.

    Rows that verified links join (``found``: their components) have one root.  Where a false link lies between
    two roots, a path of false links may stand for a true one, so every candidate between
    roots that false links connect is verified: their rows are dealt out in blocks, each
    pair of blocks is a task.  Rows of one root need no comparison, so blocks of a large
    root meet the other roots' blocks alone.
    """
    rooted = cut(sets.join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("root"), F.size("s").alias("size")))
    root_a, root_b = (rooted.select(F.col("id").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
    open_links = cut(near.join(root_a, "a").join(root_b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    groups = connected_components(open_links)
    groups = cut(groups.unionByName(groups.select(F.col("component").alias("node"), "component").distinct()))
    blocks_of = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("bytes") / BLOCK_BYTES))
    roots = rooted.join(groups, F.col("root") == F.col("node")).groupBy("component", "root").agg(F.count("*").alias("n"), F.sum(8 * F.col("size").cast("long")).alias("bytes")).withColumn("own", blocks_of)
    small = roots.where("own <= 1").groupBy("component").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).select("component", blocks_of.alias("shared"))
    # two rows have the one link between them that was false
    alone = roots.groupBy("component").agg(F.sum("n").alias("n")).where("n <= 2").select("component")
    roots = cut(roots.join(small, "component", "left").join(alone, "component", "left_anti").select("component", "root", "own", "shared"))
    large = F.col("own") > 1
    block = F.when(large, F.concat_ws(":", "root", F.pmod(F.xxhash64("id"), "own"))).otherwise(F.pmod(F.xxhash64("root"), "shared").cast("string"))
    rows = cut(rooted.select("id", "root").join(roots, "root").select("id", "root", "component", block.alias("block"), F.when(large, F.col("root")).alias("only")))
    blocks = rows.select("component", "block", "only").distinct()
    x, y = blocks.toDF("component", "x", "only_x"), blocks.toDF("component", "y", "only_y")
    pairs = cut(x.join(y, "component").where("x <= y and (only_x is null or only_y is null or only_x <> only_y)").select("component", "x", "y"))
    sides = pairs.select("component", "x", "y", F.col("x").alias("block"), F.lit(0).alias("role")).unionByName(pairs.where("x < y").select("component", "x", "y", F.col("y").alias("block"), F.lit(1).alias("role")))
    full = rows.join(classes.select("id", "lanes"), "id").join(sets.select("id", "s", F.size("s").alias("size")), "id")
    dealt = full.join(sides, ["component", "block"]).select("id", "root", "lanes", "size", "s", "component", "x", "y", "role")
    return cut(dealt.groupBy("component", "x", "y").applyInPandas(_block_links(similarity), "a long, b long"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, same columns.

    Documents link if the Jaccard similarity of their ``width``-word shingle sets is
    ``similarity`` or more.  Candidates agree in a band of their fingerprints' bits (a tree
    each), are checked on all bits and on sizes in the same task, and are verified on the whole texts: first a spanning forest of them, then, where a link of it is false, every
    candidate between the groups around it.  The document with the least (id, row) of a
    group stays; null ids come last.

    Equal word sequences (empty and null texts among them) are one class.  Repeated ids
    are rows of their own.  Empty tables give empty results; extra columns stay as they are.
    """
    rid, key, lanes, size = (free_name(docs, c) for c in ("__rid", "__key", "__lanes", "__size"))
    fp = free_name(docs, "__fp")
    marked = docs.withColumn(fp, fingerprint_udf(width, STAGE_LANES)(text_or_empty(text_col)))
    marked = marked.select(*docs.columns, F.monotonically_increasing_id().alias(rid), F.col(fp)["key"].alias(key), F.col(fp)["lanes"].alias(lanes), F.col(fp)["size"].alias(size))
    marked = written(marked, "marked")
    first = F.min(F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col(rid).alias("r")))
    classes = cut(
        marked.groupBy(F.col(key).alias("key"))
        .agg(first.alias("first"), F.min(F.struct(lanes, size)).alias("x"))
        .select(F.col("first.r").alias("id"), "first", F.col(f"x.{lanes}").alias("lanes"), F.col(f"x.{size}").alias("size"))
    )
    each_lane = [F.col("lanes")[k].alias(f"l{k}") for k in range(STAGE_LANES)]
    near = cut(links_between(classes.select("id", *each_lane, "size"), STAGE_LANES, band_masks(STAGE_LANES, 0, STAGE_BAND), 0, STAGE_BITS, similarity))
    sets = _shingle_sets(near, marked.select(F.col(rid).alias("id"), text_col), text_col, width)
    found = connected_components(_jaccard_of_links(near, sets).where(F.col("jaccard") >= similarity))
    found = connected_components(found.toDF("a", "b").unionByName(_links_across(near, found, classes, sets, similarity)))
    rooted = classes.join(found, F.col("id") == F.col("node"), "left").select(F.coalesce("component", "id").alias("root"), "first")
    keep = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.r").alias(rid))
    return marked.join(keep, rid, "left_semi").select(*docs.columns)
