"""Removal of long passages that repeat, by compacting a De Bruijn graph of token k-mers.

A window is ``words`` consecutive words.  Every window chooses the k-mer in it with the least
hash (of equal ones the first).  Equal windows choose the same k-mer at the same place, so the
chosen k-mers, about 7 % of all positions, are the graph's nodes, and the words from one
chosen k-mer of a text to the end of the next are an edge.

1. *Nodes*: k-mers chosen twice or more.  A node is inner if all its occurrences have the same
   edge before it and the same edge after it, and no text begins or ends there.
2. *Compaction*: an edge that leaves an inner node has one predecessor.  Pointers to
   predecessors are doubled by Spark joins until each edge knows the head of its path and its
   place in it.  A path's head occurs as often as the whole path, so its occurrences
   are spans of the source that repeat.
3. *Verification* at source coordinates: texts with repeated nodes are visited once.  Spans of
   paths, and the context of every other repeated node (all windows that chose it, as one run of
   words), are claimed with two independent 64-bit hashes of their words.  A claim stands if
   another place claims the same words; contexts of inner nodes within their path's
   span need no claim.  Where a node has several different contexts, one of each shows its
   windows, and those of contexts met once stand if another context has them too.
4. Words of standing claims are cut out of the texts.

The work is one row for each chosen k-mer, and for repeated passages one row a path, not one a
word.  Nothing gathers a group: counts are summed map-side, and rows of frequent k-mers meet
their verdict in plain sort-merge joins with written tables, which adaptive execution splits.
Texts are compressed one by one before they are shuffled to their coordinates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, ship_package, text_or_empty, written

#: Words of a k-mer.  Shorter ones are chosen more sparsely, longer ones repeat less by chance.
K = 8
#: Texts are cut up together up to this many bytes; a longer text alone.
SLICE_BYTES = 4 << 20
#: Fixed odd multipliers of the two polynomial hashes (mod 2**64), and seeds of their word hashes.
MULTIPLIERS, SEEDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03), (1, 2)


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets of the texts' words, and all words one after another.  Nulls are empty."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    words, counts = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    # leading or trailing white space leaves empty words
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(real)])[np.cumsum(counts)] if len(counts) else np.empty(0, np.int64)
    return np.concatenate([[0], ends]).astype(np.int64), words.filter(pa.array(real))


class _Rolling:
    """Hashes of any run of consecutive words, from prefix sums: sum(word[i] * M**i), moved to the run's start."""

    def __init__(self, words: pa.Array, lane: int) -> None:
        coded = words.dictionary_encode()
        own = np.array([xxhash.xxh64_intdigest(w, SEEDS[lane]) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
        n, m = len(words), MULTIPLIERS[lane]
        self.back = _powers(pow(m, -1, 1 << 64), n + 1)
        hashes = own[coded.indices.to_numpy()] if n else np.empty(0, np.uint64)
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(m, n), dtype=np.uint64)])

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.prefix[end] - self.prefix[start]) * self.back[start])


def _powers(m: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), m, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    """Bits spread over the whole word (fixed constants of a published finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _chosen(offsets: np.ndarray, hashes: _Rolling, words: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows, and for each the start of its k-mer of least hash (the first of equal ones)."""
    n = int(offsets[-1])
    if n < words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.arange(n - k + 1)
    least, where = hashes.runs(at, at + k), at
    width, span = 1, words - k + 1
    while width < span:  # minima over twice as many k-mers each time; k-mers across texts only reach windows that are dropped
        step = min(width, span - width)
        right = least[step:] < least[:-step]
        least, where = np.where(right, least[step:], least[:-step]), np.where(right, where[step:], where[:-step])
        width += step
    sizes = np.diff(offsets)
    lengths = np.maximum(sizes - words + 1, 0)
    starts = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(int(lengths.sum()))
    return starts, where[starts]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Batches cut so that their texts have SLICE_BYTES together at most, or are one text; column ``text`` apart, opened if it is packed."""
    opener = zstandard.ZstdDecompressor()
    for batch in batches:
        at = batch.schema.get_field_index("text")
        column, packed = batch.column(at), batch.schema.field(at).type == pa.binary()
        start, total, texts = 0, 0, []
        for i, value in enumerate(column):
            raw = value.as_buffer().to_pybytes() if value.is_valid else b""
            text = opener.decompress(raw) if packed else raw
            if texts and total + len(text) > SLICE_BYTES:
                yield batch.slice(start, i - start), pa.array(texts, pa.binary()).cast(pa.string())
                start, total, texts = i, 0, []
            texts.append(text)
            total += len(text)
        if texts:
            yield batch.slice(start), pa.array(texts, pa.binary()).cast(pa.string())


def packed(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with its texts compressed, each by itself."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            at = batch.schema.get_field_index(column)
            done = pa.array([small.compress(x.as_buffer() if x.is_valid else b"") for x in batch.column(at)], pa.binary())
            yield batch.set_column(at, column, done)

    schema = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == column else f.dataType) for f in docs.schema])
    return docs.mapInArrow(pack, schema)


_ANCHORS = "key long, pos int, node long, edge_in long, edge_out long, step int"


def _anchors(batches: Iterator[pa.RecordBatch], words: int, k: int) -> Iterator[pa.RecordBatch]:
    """A row for each chosen k-mer of each text: its place, its hash, its edges (null at a text's ends) and the way to the next."""
    for batch, texts in _slices(batches):
        offsets, tokens = _split(texts)
        hashes = _Rolling(tokens, 0)
        starts, where = _chosen(offsets, hashes, words, k)
        places = np.unique(where)
        if not len(places):
            continue
        doc = np.searchsorted(offsets, places, "right") - 1
        follows = doc[1:] == doc[:-1]
        edges = hashes.runs(places[:-1], places[1:] + k).view(np.int64)
        none = np.zeros(1, bool)
        out = pa.array(np.append(edges, 0), mask=~np.append(follows, none))
        into = pa.array(np.append(np.zeros(1, np.int64), edges), mask=~np.append(none, follows))
        step = pa.array(np.append(np.diff(places), 0).astype(np.int32), mask=~np.append(follows, none))
        node = hashes.runs(places, places + k).view(np.int64)
        keys = batch.column(0).take(pa.array(doc))
        yield pa.RecordBatch.from_arrays([keys, pa.array((places - offsets[doc]).astype(np.int32)), pa.array(node), into, out, step], names=["key", "pos", "node", "edge_in", "edge_out", "step"])


def repeated_nodes(anchors: DataFrame) -> DataFrame:
    """Nodes with two occurrences or more: (node, inner)."""
    pair = F.when(F.col("edge_in").isNotNull() & F.col("edge_out").isNotNull(), F.xxhash64("edge_in", "edge_out"))
    counts = anchors.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.count(pair).alias("m"), F.min(pair).alias("lo"), F.max(pair).alias("hi")).where("n > 1")
    return counts.select("node", ((F.col("n") == F.col("m")) & (F.col("lo") == F.col("hi"))).alias("inner"))


def compacted(occurrences: DataFrame, k: int, max_rounds: int = 60) -> DataFrame:
    """Non-branching paths of the repeated edges: (head, length), ``length`` in words from the head's first word to the path's last.

    ``occurrences`` are those of repeated nodes, with ``inner``.  An edge after an inner node points to
    the edge before it; pointers double until all of them point to heads.
    """
    edges = occurrences.where("edge_out is not null").groupBy("edge_out").agg(F.count(F.lit(1)).alias("n"), F.min("step").alias("step"), F.max(F.when(F.col("inner"), F.col("edge_in"))).alias("before"))
    edges = written(edges.where("n > 1").select(F.col("edge_out").alias("edge"), F.col("step").cast("long").alias("step"), "before"), "edges")
    steps = edges.select(F.col("edge").alias("before"), F.col("step").alias("back"))
    # the pointer of an edge, the words from there to the edge, and whether the pointer is a head
    chain = edges.join(steps, "before", "left").select("edge", "step", F.when(F.col("back").isNull(), F.col("edge")).otherwise(F.col("before")).alias("to"), F.coalesce("back", F.lit(0)).alias("way"), F.col("back").isNull().alias("done"))
    chain = written(chain, "chain")
    for _ in range(max_rounds):
        if chain.where("not done").isEmpty():
            break
        onward = chain.select(F.col("edge").alias("to"), F.col("to").alias("to2"), F.col("way").alias("way2"), F.col("done").alias("done2"))
        moved = chain.where("not done").join(onward, "to").select("edge", "step", F.col("to2").alias("to"), (F.col("way") + F.col("way2")).alias("way"), F.col("done2").alias("done"))
        chain = written(chain.where("done").unionByName(moved), "chain")
    else:
        raise RuntimeError("paths did not settle")
    return chain.groupBy(F.col("to").alias("head")).agg((F.max(F.col("way") + F.col("step")) + k).alias("length"))


_CLAIMS = "key long, start int, length int, a long, b long, windows array<long>"


def _claims(batches: Iterator[pa.RecordBatch], words: int, k: int) -> Iterator[pa.RecordBatch]:
    """Spans of paths, and contexts of repeated nodes that no span stands for, with hashes of their words.

    Columns: key, text, and lists of equal length: places of repeated nodes, lengths of the paths
    that begin there (0: none), and whether the nodes are inner.  ``a`` and ``b`` are both lanes' hashes of a span;
    ``a`` of a context is its node's.  The first of equal contexts of a slice shows hashes of its windows.
    """
    for batch, texts in _slices(batches):
        offsets, tokens = _split(texts)
        lanes = _Rolling(tokens, 0), _Rolling(tokens, 1)
        starts, where = _chosen(offsets, lanes[0], words, k)
        counts = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(batch.num_rows), counts)
        places = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64) + offsets[doc]
        lengths = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        inner = batch.column(4).flatten().to_numpy(zero_copy_only=False)
        # places of another text with the same key lie beyond this one's end, are no choice of it, or claim what no other place claims
        fits = places + np.maximum(lengths, k) <= offsets[doc + 1]
        places, lengths, inner = places[fits], lengths[fits], inner[fits]
        long = lengths >= words
        spans = np.unique(np.stack([places[long], lengths[long]]), axis=1)
        held = np.zeros(int(offsets[-1]) + 2, np.int64)
        np.add.at(held, spans[0], 1)
        np.add.at(held, spans[0] + spans[1] - words + 1, -1)
        inside = np.concatenate([[0], np.cumsum(np.cumsum(held)[starts] > 0)])

        places, at = np.unique(places, return_index=True)
        low, high = np.searchsorted(where, places), np.searchsorted(where, places, "right")
        stands_for = inner[at] & (inside[high] - inside[low] == high - low)
        rest = (high > low) & ~stands_for
        places, low, high = places[rest], low[rest], high[rest]
        begin = starts[low]
        size = starts[high - 1] + words - begin
        a, b = lanes[0].runs(places, places + k), lanes[1].runs(begin, begin + size)
        _, first = np.unique(np.stack([a, b, size.astype(np.uint64)]), axis=1, return_index=True)
        shows = np.zeros(len(begin), bool)
        shows[first] = True
        many = np.where(shows, high - low, 0)
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(many)])
        shown = np.repeat(begin - ends[:-1], many) + np.arange(ends[-1])
        shown = pa.array(lanes[1].runs(shown, shown + words).view(np.int64))
        # spans show no windows
        ends = np.concatenate([np.zeros(spans.shape[1], np.int64), ends]).astype(np.int32)
        blank = np.concatenate([np.ones(spans.shape[1], bool), ~shows, np.zeros(1, bool)])
        windows = pa.ListArray.from_arrays(pa.array(ends, mask=blank), shown)
        sa, sb = (x.runs(spans[0], spans[0] + spans[1]) for x in lanes)
        begin, size = np.concatenate([spans[0], begin]), np.concatenate([spans[1], size])
        of = np.searchsorted(offsets, begin, "right") - 1
        whole = [pa.array(np.concatenate(x).view(np.int64)) for x in ((sa, a), (sb, b))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(of)), pa.array((begin - offsets[of]).astype(np.int32)), pa.array(size.astype(np.int32)), *whole, windows], names=["key", "start", "length", "a", "b", "windows"]
        )


_CUT = "kept string, n_words long, n_removed long"


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of their spans; further columns pass."""
    own = ("text", "starts", "lengths")
    for batch, texts in _slices(batches):
        column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        offsets, tokens = _split(texts)
        lists = column["starts"]
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(batch.num_rows), counts)
        begin = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + offsets[doc]
        size = column["lengths"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        depth = np.zeros(int(offsets[-1]) + 1, np.int64)
        np.add.at(depth, begin, 1)
        np.add.at(depth, np.minimum(begin + size, offsets[doc + 1]), -1)
        stays = np.cumsum(depth)[:-1] == 0
        kept_to = np.concatenate([[0], np.cumsum(stays)])[offsets]
        kept = pa.ListArray.from_arrays(pa.array(kept_to.astype(np.int32)), tokens.filter(pa.array(stays)))
        n = np.diff(offsets)
        names = [c for c in column if c not in own]
        yield pa.RecordBatch.from_arrays([*[column[c] for c in names], pc.binary_join(kept, " "), pa.array(n), pa.array(n - np.diff(kept_to))], names=[*names, "kept", "n_words", "n_removed"])


def repeated_spans(docs: DataFrame, words: int = 35, k: int = K) -> DataFrame:
    """Spans (key, start, length; in words) of texts that repeat at another place; ``docs`` has (key, text), a row for each text.

    A span is a window, or a longer run all of whose windows repeat.  Equal keys must mean equal
    texts, or texts whose spans may be told apart afterwards.
    """
    k = min(k, words)
    docs = docs.select("key", "text")
    anchors = written(docs.mapInArrow(lambda it: _anchors(it, words, k), _ANCHORS), "anchors")
    nodes = written(repeated_nodes(anchors), "nodes")
    occurrences = written(anchors.join(nodes, "node"), "occurrences")
    paths = written(compacted(occurrences, k).where(F.col("length") >= words), "paths")
    begun = occurrences.join(paths, F.col("edge_out") == F.col("head"), "left").select("key", "pos", F.coalesce("length", F.lit(0)).cast("int").alias("length"), "inner")
    per_text = begun.distinct().groupBy("key").agg(F.collect_list(F.struct("pos", "length", "inner")).alias("x"))
    visited = packed(docs, "text").join(per_text, "key").select("key", "text", F.col("x.pos").alias("places"), F.col("x.length").alias("lengths"), F.col("x.inner").alias("inner"))
    claims = written(visited.mapInArrow(lambda it: _claims(it, words, k), _CLAIMS), "claims")

    same = ["length", "a", "b"]
    shows = F.col("windows").isNotNull()
    groups = claims.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.when(shows, F.struct("key", "start"))).alias("at"))
    groups = written(groups, "groups")
    standing = claims.join(groups.where("n > 1").select(*same), same).select("key", "start", "length")

    # nodes with several contexts, one of them met once: one of each context shows its windows
    mixed = groups.where("at is not null").groupBy("a").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1").select("a")
    chosen = groups.where("at is not null").join(written(mixed, "mixed"), "a").select(*same, "n", "at.key", "at.start")
    shown = claims.where(shows).join(chosen, [*same, "key", "start"]).select("key", "start", "a", "n", F.posexplode("windows").alias("i", "w"))
    shown = written(shown.select("key", (F.col("start") + F.col("i")).alias("start"), "a", "w", "n"), "windows")
    again = written(shown.groupBy("a", "w").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("a", "w"), "again")
    single = shown.where("n = 1").join(again, ["a", "w"]).select("key", "start", F.lit(words).alias("length"))
    return standing.unionByName(single)


def drop_repeated_spans(docs: DataFrame, words: int = 35, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """``docs`` with only the kept words in its texts, joined by one space, and ``n_words`` (before) and ``n_removed``.

    A word goes if a window of ``words`` consecutive words that covers it starts anywhere else
    too, in the same text or another.  Words are runs of anything but ASCII white space.  Windows are judged on
    the input.  Null and empty texts have no words and become empty; rows with the same id, and rows given twice,
    are texts of their own (so a row given twice loses all its windows).  Columns named like the
    new ones stay; the new ones get underscores in front.
    """
    ship_package(docs.sparkSession)
    order = docs.columns
    text = text_or_empty(text_col)
    keyed = docs.select(F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(order) if c != text_col])
    spans = repeated_spans(keyed, words, k)
    # rows of one key are alike
    per_text = spans.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "length")).alias("x")).select("key", F.col("x.start").alias("starts"), F.col("x.length").alias("lengths"))
    joined = packed(keyed, "text").join(per_text, "key", "left").drop("key")
    rest = [f for f in keyed.schema if f.name not in ("key", "text")]
    out = joined.mapInArrow(_cut_out, T.StructType([*rest, *T._parse_datatype_string(_CUT).fields]))
    columns = [F.col("kept" if c == text_col else f"c{i}").alias(c) for i, c in enumerate(order)]
    return out.select(*columns, *[F.col(c).alias(free_name(docs, c)) for c in ("n_words", "n_removed")])
