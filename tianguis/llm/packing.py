"""Hierarchical multi-length packing of tokenised documents.

Each task packs the documents of its own partition while it encodes them: nothing is
shuffled and no partition's tokens are held at once.

* A document is cut into windows of the longest tier; what remains is routed to the
  shortest tier (context size) that holds it.
* A remainder of the longest tier opens a window.  The gap is filled from the shorter
  tiers, best fit first, and then exactly, by cutting a shorter remainder.
* Remainders that no long window needed are packed in windows of their own tier in the same
  way, from the tiers below.
* Windows are dealt into step groups of one tier and an equal number of tokens, the costly
  ones (sum of squared piece lengths) spread evenly.

At the end of a partition the rest is cut to powers of two, so that nothing is padded.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import binary_array, library_coder, with_end

#: Context sizes, longest first.
TIERS = (1024, 512, 256, 128)
#: Remainders waiting at most before shorter tiers get windows of their own.
WAITING = 4096
#: Tokens of a step group, and groups that windows are balanced over at once.
GROUP_TOKENS, GROUPS = 64 * 1024, 4


class _Pool:
    """Waiting remainders by length, with the longest one up to any bound at hand."""

    def __init__(self) -> None:
        self.by_length: dict[int, deque] = {}
        self.mask = self.count = self.tokens = 0

    def put(self, piece: tuple) -> None:
        n = len(piece[2])
        self.by_length.setdefault(n, deque()).append(piece)
        self.mask |= 1 << n
        self.count, self.tokens = self.count + 1, self.tokens + n

    def take(self, most: int) -> tuple | None:
        """The longest remainder of at most ``most`` tokens, the oldest of its length."""
        n = (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1
        if n <= 0:
            return None
        piece = self.by_length[n].popleft()
        if not self.by_length[n]:
            self.mask &= ~(1 << n)
        self.count, self.tokens = self.count - 1, self.tokens - n
        return piece


class Packer:
    """Packs (document, start, ids) remainders into full windows; ``ready`` collects (tier, pieces)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, waiting: int = WAITING):
        self.tiers, self.waiting = tiers, waiting
        self.open: deque = deque()  # remainders of the longest tier
        self.pool = _Pool()
        self.ready: list[tuple[int, list]] = []

    def add(self, doc, ids: np.ndarray) -> None:
        top = self.tiers[0]
        whole = len(ids) // top * top
        for i in range(0, whole, top):
            self.ready.append((top, [(doc, i, ids[i : i + top])]))
        if whole < len(ids):
            rest = (doc, whole, ids[whole:].copy())
            if len(rest[2]) > self.tiers[1]:
                self.open.append(rest)
            else:
                self.pool.put(rest)
        if len(self.open) > self.waiting:  # hardly any short remainders: cut up a long one
            self.pool.put(self.open.pop())
        while self.open and self.pool.tokens >= top - len(self.open[0][2]):
            self._fill(top, self.open.popleft())
        while self.pool.count > self.waiting:
            self._own_window()

    def _fill(self, size: int, first: tuple) -> None:
        """A full window that begins with ``first``; the pool must hold enough tokens."""
        pieces, gap = [first], size - len(first[2])
        while gap:
            piece = self.pool.take(gap)
            if piece is None:  # only longer ones: cut one
                doc, start, ids = self.pool.take(size)
                self.pool.put((doc, start + gap, ids[gap:]))
                piece = (doc, start, ids[:gap])
            pieces.append(piece)
            gap -= len(piece[2])
        self.ready.append((size, pieces))

    def _own_window(self) -> None:
        first = self.pool.take(self.tiers[0])
        size = min(t for t in self.tiers if t >= len(first[2]))
        if size - len(first[2]) > self.pool.tokens:
            raise AssertionError("a window without enough tokens")
        self._fill(size, first)

    def finish(self) -> None:
        while self.open:  # no shorter remainders are left for these: the last of them fill the others
            first = self.open.popleft()
            gap = self.tiers[0] - len(first[2])
            while self.open and self.pool.tokens < gap:
                self.pool.put(self.open.pop())
            if self.pool.tokens < gap:
                self.pool.put(first)
                break
            self._fill(self.tiers[0], first)
        while self.pool.tokens:
            size = next((t for t in self.tiers if t <= self.pool.tokens), 1 << (self.pool.tokens.bit_length() - 1))
            longest = self.pool.take(self.tiers[0])
            if len(longest[2]) > size:
                doc, start, ids = longest
                self.pool.put((doc, start + size, ids[size:]))
                longest = (doc, start, ids[:size])
            self._fill(size, longest)


class _Groups:
    """Step groups: windows of one tier, an equal number of tokens, costs spread."""

    def __init__(self) -> None:
        self.held: dict[int, list] = {}
        self.groups = 0

    def put(self, tier: int, pieces: list) -> Iterator[tuple[int, int, list]]:
        held = self.held.setdefault(tier, [])
        held.append(pieces)
        if len(held) >= GROUPS * max(1, GROUP_TOKENS // tier):
            yield from self.deal(tier)

    def deal(self, tier: int) -> Iterator[tuple[int, int, list]]:
        held = self.held.pop(tier, [])
        n = max(1, -(-len(held) * tier // GROUP_TOKENS))
        held.sort(key=lambda pieces: -sum(len(p[2]) ** 2 for p in pieces))
        for i, pieces in enumerate(held):
            turn, k = divmod(i, n)
            yield tier, self.groups + (k if turn % 2 == 0 else n - 1 - k), pieces
        self.groups += n


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """Pieces of all documents, packed: one row for each piece.

    Columns: ``doc_id``, ``start`` (its document's ids before it), ``length``, ``ids``
    (little-endian unsigned 32-bit), ``doc_tokens`` (with the end id), ``sequence_id``,
    ``offset`` (place in the sequence, gapless from 0), ``tier`` (the sequence's length) and
    ``step_group``.  Every id lies in exactly one piece.  Sequences are as long as a tier
    and full; at the end of a partition they may be shorter powers of two.

    Null and empty texts are documents of the end id alone.  Null and repeated document ids
    are kept as they are.  Empty tables give empty results.  Other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("doc_id", kind)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length")]
        + [T.StructField("ids", T.BinaryType())]
        + [T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset", "tier", "step_group")]
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        names = to_arrow_schema(schema)
        part = TaskContext.get().partitionId() << 36
        coder, packer, groups, made, rows = library_coder(tokenizer), Packer(tiers), _Groups(), 0, []

        def batch() -> pa.RecordBatch:
            doc, start, ids, *rest = zip(*rows)
            rows.clear()
            length = np.fromiter(map(len, ids), np.int64, len(ids))
            columns = [pa.array(doc, names.field(0).type), pa.array(start), pa.array(length), binary_array(np.concatenate(ids).astype("<u4"), length), *map(pa.array, rest)]
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, names)], schema=names)

        def emit(windows) -> None:
            nonlocal made
            for tier, group, pieces in windows:
                offset = 0
                for (doc, tokens), start, ids in pieces:
                    rows.append((doc, start, ids, tokens, part + made, offset, tier, part + group))
                    offset += len(ids)
                made += 1

        def drain() -> None:
            for tier, pieces in packer.ready:
                emit(groups.put(tier, pieces))
            packer.ready.clear()

        for b in batches:
            flat, counts = with_end(*coder.encode(b.column(1)), end_id)
            ends = np.cumsum(counts).tolist()
            for doc, n, at in zip(b.column(0).to_pylist(), counts.tolist(), ends):
                packer.add((doc, n), flat[at - n : at])
            drain()
            if rows:
                yield batch()
        packer.finish()
        drain()
        for tier in list(groups.held):
            emit(groups.deal(tier))
        if rows:
            yield batch()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(packed, schema)
