"""Token ids in files of canonical, length-limited Huffman codes.

1. Texts are encoded once and their ids dealt out by ranges of the document id, sorted, and
   written to a table beside the files (``PATH-ids``).  The rows of an id that holds several
   ranges (repeated ids, null ids) are dealt over them in order of their token ids.
2. Each task of a scan over that table counts ids and tokens; counts are summed by id.  The
   code lengths (package-merge, at most ``LIMIT`` bits) follow from the global counts and
   are as many as the vocabulary, so the driver computes them.
3. A second scan writes the ids as blocks of code bits, with the bit offset of every
   ``CHECKPOINT``-th id of a document.

The file format is a folder with two Parquet tables: ``codebook`` (id, length) and ``blocks``
(start, doc_ids, doc_tokens, checkpoints, payload), where start is the number of ids before
the block.  A block can be decoded by itself, from any checkpoint on, with a table of
2^LIMIT entries; a whole block's segments are decoded side by side.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_path
from .tokens import binary_array, library_coder, with_end

LIMIT = 18
CHECKPOINT = 512
BLOCK_TOKENS = 1 << 16
#: Ids that the ranges of shards are read from, at most (about; they are sampled by rate).
RANGE_SAMPLE = 50_000
#: Tokens that are decoded together.
DECODE_TOKENS = 1 << 21


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for ids with a positive count, else 0 (package-merge)."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.nonzero(counts)[0]
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes of that length")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.lexsort((used, counts[used]))]
    weight = counts[order].astype(np.float64)
    leaves = np.arange(len(order))
    kept, level = [], weight
    for _ in range(limit - 1):
        pairs = len(level) // 2
        merged = np.concatenate([weight, level[: 2 * pairs : 2] + level[1 : 2 * pairs : 2]])
        by = np.argsort(merged, kind="stable")
        kept.append(by < len(weight))
        level = merged[by]
    need = 2 * len(order) - 2
    out = np.zeros(len(order), np.int64)
    for is_leaf in reversed(kept):
        n = int(is_leaf[:need].sum())
        out[leaves < n] += 1
        need = 2 * (need - n)
    out[leaves < need] += 1
    lengths[order] = out
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: ascending by (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.nonzero(lengths)[0]
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        # the sum of 2^-length of the codes before, in units of 2^-limit
        top = int(lengths.max())
        steps = np.left_shift(1, top - lengths[order])
        codes[order] = (np.cumsum(steps) - steps) >> (top - lengths[order])
    return codes


def pack_bits(values: np.ndarray, lengths: np.ndarray, at: np.ndarray, total_bits: int) -> bytes:
    """Bits, most significant first: ``lengths`` bits of each value from bit ``at`` on (ascending, not overlapping)."""
    words = np.zeros((total_bits + 63) // 64 + 1, np.uint64)
    if len(values):
        word, room = at >> 6, 64 - (at & 63) - lengths
        high = np.where(room >= 0, values << np.maximum(room, 0).astype(np.uint64), values >> np.maximum(-room, 0).astype(np.uint64))
        first = np.nonzero(np.concatenate([[True], word[1:] != word[:-1]]))[0]
        words[word[first]] |= np.bitwise_or.reduceat(high, first)
        over = np.nonzero(room < 0)[0]
        words[word[over] + 1] |= values[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: (total_bits + 7) // 8]


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and length for every run of as many bits as the longest code has."""
    top = int(lengths.max()) if len(lengths) else 0
    used = np.nonzero(lengths)[0]
    order = used[np.lexsort((used, lengths[used]))]
    spans = np.left_shift(1, top - lengths[order])
    ids, sizes = np.repeat(order, spans), np.repeat(lengths[order], spans)
    short = (1 << top) - len(ids)  # a lone id leaves half of the table empty
    return np.pad(ids, (0, short)).astype(np.uint32), np.pad(sizes, (0, short), constant_values=1), top


def unpack_bits(data: np.ndarray, starts: np.ndarray, counts: np.ndarray, table: tuple) -> np.ndarray:
    """Ids of all segments, one after another: segment i has ``counts[i]`` ids from bit ``starts[i]`` on."""
    ids, sizes, top = table
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
    n = len(data) + 4
    window = (padded[:n] << 24) | (padded[1 : n + 1] << 16) | (padded[2 : n + 2] << 8) | padded[3 : n + 3]
    order = np.argsort(-counts, kind="stable")
    at, left = starts[order].copy(), counts[order]
    into = (np.cumsum(counts) - counts)[order]
    out = np.empty(int(counts.sum()), np.uint32)
    live = np.searchsorted(-left, -np.arange(1, int(left[0]) + 1), side="right") if len(left) else []
    for step, k in enumerate(live):
        bits = at[:k]
        key = (window[bits >> 3] << (bits & 7).astype(np.uint32)) >> np.uint32(32 - top)
        out[into[:k] + step] = ids[key]
        at[:k] += sizes[key]
    return out


def _runs(column: pa.Array, form: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of binaries, and how many each row has."""
    if not len(column):
        return np.empty(0, form), np.empty(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(form) if data else np.empty(0, form)
    return flat, np.diff(offsets) // np.dtype(form).itemsize


def _width(tokenizer: str) -> str:
    """How ids are kept on the way: in 16 bits where the vocabulary allows it."""
    return "<u2" if library_coder(tokenizer).size <= 1 << 16 else "<u4"


def _order(key) -> tuple:
    """Null ids come first."""
    return (key is not None, key)


def _bounds(docs: DataFrame, id_col: str, shards: int) -> list:
    """Ids (by ``_order``) that part the rows in about equal ranges, from a sample of bounded expected size.

    Equal ids of the sample are counted together before they are gathered.  An id that holds several
    ranges of rows stands there as many times (``_shard`` deals its rows over them).
    """
    ids = docs.select(F.col(id_col).alias("id"))
    total = ids.count()
    if shards < 2 or not total:
        return []
    some = sorted((_order(r["id"]), r["n"]) for r in ids.sample(min(1.0, RANGE_SAMPLE / total), 1).groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect())
    upto = np.cumsum([n for _, n in some])
    return [some[i][0] for i in np.searchsorted(upto, np.arange(1, shards) * upto[-1] // shards, side="right")] if some else []


def _shard(bounds: list, key, ids: Callable[[], bytes]) -> int:
    """The range of a row; of an id with several ranges by the first bytes of its token ids, in their order."""
    k = _order(key)
    high = bisect_right(bounds, k)
    ranges = high - bisect_left(bounds, k)
    if ranges < 2:
        return high
    return high - ranges + 1 + (ranges * int.from_bytes(ids()[:8].ljust(8, b"\0"), "big") >> 64)


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1) -> None:
    """Writes the ids of all texts, each with ``end_id`` after it, in ascending order of the document id.

    Null and empty texts have the end id alone.  Null ids come first; rows with equal ids
    are ordered by their token ids' bytes.  An empty table gives an empty codebook and no blocks.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs, id_col, shards)
    kind = docs.schema[id_col].dataType
    form = _width(tokenizer)
    beside = f"{path.rstrip('/')}-ids"
    with _shuffles_removed(spark):
        _sorted_ids(docs, tokenizer, id_col, text_col, end_id, bounds, shards, form).write.option("compression", "zstd").parquet(beside)
    ids = spark.read.parquet(beside)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, tokens = np.zeros(0, np.int64), {}
        for b in batches:
            flat, sizes = _runs(b.column(1), form)
            shards, of = np.unique(b.column(0).to_numpy(), return_inverse=True)
            for shard, n in zip(shards.tolist(), np.bincount(of, sizes).astype(np.int64).tolist()):
                tokens[shard] = tokens.get(shard, 0) + n
            more = np.bincount(flat, minlength=len(seen))
            more[: len(seen)] += seen
            seen = more
        used = np.nonzero(seen)[0]
        keys = [*used.tolist(), *(-1 - s for s in tokens)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([*seen[used].tolist(), *tokens.values()], pa.int64())], names=["key", "n"])

    # as many rows as the vocabulary and the shards have
    totals = ids.select("shard", "ids").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    of_ids, of_shards = totals[totals["key"] >= 0], totals[totals["key"] < 0]
    counts = np.zeros(int(of_ids["key"].max()) + 1 if len(of_ids) else 0, np.int64)
    counts[of_ids["key"].to_numpy()] = of_ids["n"].to_numpy()
    per_shard = np.zeros(len(bounds) + 1, np.int64)
    per_shard[-1 - of_shards["key"].to_numpy()] = of_shards["n"].to_numpy()
    bases = (np.cumsum(per_shard) - per_shard).tolist()
    lengths = code_lengths(counts)
    used = np.nonzero(lengths)[0]
    book = pa.table({"id": pa.array(used, pa.int32()), "length": pa.array(lengths[used], pa.int32())})
    spark.createDataFrame(book).coalesce(1).write.parquet(f"{path}/codebook")
    codes = spark.sparkContext.broadcast((canonical_codes(lengths), lengths))
    schema = T.StructType(
        [T.StructField("start", T.LongType()), T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("doc_tokens", T.ArrayType(T.IntegerType())), T.StructField("checkpoints", T.BinaryType()), T.StructField("payload", T.BinaryType())]
    )

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        names = to_arrow_schema(schema)
        code_of, length_of = codes.value

        def block(start: int, keys: list, counts: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
            sizes = length_of[ids]
            ends = np.cumsum(sizes)
            raw = pack_bits(code_of[ids], sizes, ends - sizes, int(ends[-1]))
            marks_of = -(-counts // CHECKPOINT)
            first = np.cumsum(counts) - counts
            marks = np.repeat(first - CHECKPOINT * (np.cumsum(marks_of) - marks_of), marks_of) + CHECKPOINT * np.arange(marks_of.sum())
            row = (start, keys, counts.tolist(), (ends - sizes)[marks].astype("<u8").tobytes(), raw)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, names)], schema=names)

        for b in batches:
            flat, counts = _runs(b.column(3), form)
            ends, shard, before = np.cumsum(counts), b.column(0).to_numpy(), b.column(1).to_numpy()
            # a block holds neighbours: documents of one shard, each where the one before ends
            broken = np.nonzero((shard[1:] != shard[:-1]) | (before[1:] != before[:-1] + counts[:-1]))[0] + 1
            i = 0
            while i < len(counts):
                full = np.searchsorted(ends, ends[i] - counts[i] + BLOCK_TOKENS) + 1
                k = min([full, len(counts), *broken[np.searchsorted(broken, i, side="right") :][:1]])
                yield block(bases[shard[i]] + int(before[i]), b.column(2)[i:k].to_pylist(), counts[i:k], flat[ends[i] - counts[i] : ends[k - 1]])
                i = k

    ids.select("shard", "before", "id", "ids").mapInArrow(compress, schema).write.parquet(f"{path}/blocks")


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go when the query has ended, and not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, was)


def _sorted_ids(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int, bounds: list, shards: int, form: str) -> DataFrame:
    """Rows (shard, before, id, ids): sorted by id within each shard; before counts the shard's ids up to a row."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("id", kind), T.StructField("ids", T.BinaryType())])
    out_schema = T.StructType([schema["shard"], T.StructField("before", T.LongType()), schema["id"], schema["ids"]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        names, coder = to_arrow_schema(schema), library_coder(tokenizer)
        for b in batches:
            ids, counts = with_end(*coder.encode(b.column(1)), end_id)
            made = binary_array(ids.astype(form), counts)
            shard = [_shard(bounds, k, lambda i=i: made[i].as_py()) for i, k in enumerate(b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), b.column(0), made], schema=names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        names, last, held = to_arrow_schema(out_schema), None, 0
        for b in batches:
            if not len(b):
                continue
            counts, shard = _runs(b.column(2), form)[1], b.column(0).to_numpy()
            ends = np.cumsum(counts)
            first = np.concatenate([[True], shard[1:] != shard[:-1]])
            # ids before the shard's first row in this batch, less those of the shard in the batches before
            base = (ends - counts)[first]
            if shard[0] == last:
                base[0] -= held
            before = ends - counts - base[np.cumsum(first) - 1]
            last, held = shard[-1], before[-1] + counts[-1]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(before, pa.int64()), b.column(1), b.column(2)], schema=names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(encode, schema)
    return rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "id", "ids").mapInArrow(place, out_schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of files that ``write`` made: ``doc_id``, ``start``, ``n_tokens`` and ``ids`` (binary)."""
    book = spark.read.parquet(f"{path}/codebook").toPandas()  # as many rows as the vocabulary
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 1, np.int64)
    lengths[book["id"].to_numpy()] = book["length"].to_numpy()
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        names = to_arrow_schema(schema)
        table = decode_table(shared.value)

        def decoded(held: list) -> pa.RecordBatch:
            keys, starts, counts, seg_starts, seg_counts, data, base = [], [], [], [], [], [], 0
            for start, doc_ids, doc_tokens, marks, payload in held:
                n = np.array(doc_tokens, np.int64)
                keys += doc_ids
                starts.append(start + np.cumsum(n) - n)
                counts.append(n)
                segments = -(-n // CHECKPOINT)
                per = np.full(int(segments.sum()), CHECKPOINT, np.int64)
                per[np.cumsum(segments) - 1] = n - (segments - 1) * CHECKPOINT
                seg_counts.append(per)
                seg_starts.append(np.frombuffer(marks, "<u8").astype(np.int64) + 8 * base)
                data.append(np.frombuffer(payload, np.uint8))
                base += len(payload)
            ids = unpack_bits(np.concatenate(data), np.concatenate(seg_starts), np.concatenate(seg_counts), table)
            counts = np.concatenate(counts)
            columns = [pa.array(keys, names.field(0).type), pa.array(np.concatenate(starts)), pa.array(counts), binary_array(ids.astype("<u4"), counts)]
            return pa.RecordBatch.from_arrays(columns, schema=names)

        held, tokens = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.append(row)
                tokens += sum(row[2])
                if tokens >= DECODE_TOKENS:
                    yield decoded(held)
                    held, tokens = [], 0
        if held:
            yield decoded(held)

    return blocks.select("start", "doc_ids", "doc_tokens", "checkpoints", "payload").mapInArrow(expand, schema)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Writes the ids of ``docs`` to a new folder in the shared space and reads them back."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write(docs, path, tokenizer, end_id=end_id)
    return read(docs.sparkSession, path)
